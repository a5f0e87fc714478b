"""The raw nested ``food`` table, derived by Spark from the driver's TPC-H-like tables.

The pipeline's real input is a Parquet dump of nested product rows. The test
tables have no such table, so this adapter builds one with the same shape
(one row per part, plus an older second version of every seventh part):

* countries = the supplier nations a part ships from (``lineitem`` x ``supplier`` x ``nation``),
* last modified = the part's last ship date,
* names, grades, brands, categories and nutrients from ``part`` columns, with
  deliberate NULL / empty / padded values so every cleaning rule has work.

Its DuckDB twin (``larder.oracles.FOOD_DUCKDB``) defines the same table for the oracle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.dates import ntz_to_seconds
from larder.operators.keys import small_surrogate_key

# Part type -> nutrition grade; any other type is 'unknown'.
GRADE_OF_TYPE = [("ECONOMY", "a"), ("SMALL", "b"), ("MEDIUM", "c"), ("STANDARD", "d"), ("LARGE", "e")]

#: Nations whose bits one number holds.
WORD = 62


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def part_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per part: sorted distinct country tags of its suppliers, last ship time (seconds).

    Lines are reduced to one row per part on integer keys (map-side combined): the nations met are bits, of as many
    numbers as the nation table needs. The tags are read off the bits from the sorted list of all nations, which is
    one row.
    """
    nation = _table(spark, sf_dir, "nation").select(
        "n_nationkey", F.concat(F.lit("en:"), F.lower(F.replace(F.col("n_name"), F.lit("_"), F.lit("-"))))
        .alias("tag"))
    known = nation.select("n_nationkey").filter(F.col("n_nationkey").isNotNull()).distinct()
    words = max(1, -(-known.count() // WORD))
    i = F.col("_i") - 1
    placed = small_surrogate_key(known, ["n_nationkey"], "_i").select("n_nationkey", F.floor(i / WORD).cast("int").alias("word"), F.expr(f"shiftleft(1L, CAST((_i - 1) % {WORD} AS INT))").alias("bit"))
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lineitem = _table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate")
    lines = lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey).join(placed, F.col("s_nationkey") == F.col("n_nationkey"))
    met = [F.coalesce(F.bit_or(F.when(F.col("word") == w, F.col("bit"))), F.lit(0)).alias(f"_met{w}") for w in range(words)]
    per_part = lines.groupBy("l_partkey").agg(F.max("l_shipdate").alias("_ship"), *met)
    listed = nation.join(placed, "n_nationkey").agg(
        F.sort_array(F.collect_list(F.when(F.col("tag").isNotNull(), F.struct("tag", "word", "bit")))).alias("_nations"))

    def is_met(n):
        mine = F.col("_met0") if words == 1 else F.get(F.array(*[F.col(f"_met{w}") for w in range(words)]), n["word"])
        return mine.bitwiseAND(n["bit"]) != 0

    tags = F.transform(F.filter("_nations", is_met), lambda n: n["tag"])
    return (per_part.crossJoin(F.broadcast(listed))
            .select("l_partkey", tags.alias("tags"), ntz_to_seconds("_ship").alias("t")))


def food(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    c = part_countries(spark, sf_dir)
    k = F.col("p_partkey")
    size = F.col("p_size")
    grade = F.lit("unknown")
    for t, g in reversed(GRADE_OF_TYPE):
        grade = F.when(F.col("p_type") == t, F.lit(g)).otherwise(grade)

    def name_entry(lang, text):
        return F.struct(F.lit(lang).alias("lang"), text.alias("text"))

    def nutrient(name, value):
        return F.struct(F.lit(name).alias("name"), value.cast("double").alias("100g"))

    v = F.col("v")
    base = [nutrient("energy-kcal", size * F.lit(36.0)), nutrient("fat", size.cast("double")),
            nutrient("saturated-fat", size / F.lit(4.0)), nutrient("sugars", size / F.lit(5.0))]
    full = base + [nutrient("salt", size / F.lit(10.0) + v), nutrient("proteins", size / F.lit(2.0)),
                   nutrient("fiber", size / F.lit(8.0))]
    short = base + [nutrient("proteins", size / F.lit(2.0))]

    rows = (part.join(c, part.p_partkey == c.l_partkey, "left")
            .withColumn("v", F.explode(F.when(k % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))))
    return rows.select(
        F.when(k % 97 == 0, F.lit(None).cast("string")).otherwise(k.cast("string")).alias("code"),
        F.when(k % 3 == 0, F.array(name_entry("en", F.upper("p_name"))))
         .otherwise(F.array(name_entry("en", F.upper("p_name")), name_entry("main", F.col("p_name"))))
         .alias("product_name"),
        grade.alias("nutriscore_grade"),
        F.when(k % 11 != 0, size - 15).alias("nutriscore_score"),
        (size % 4 + 1).alias("nova_group"),
        F.lower(F.substr(F.col("p_type"), F.lit(1), F.lit(1))).alias("environmental_score_grade"),
        F.concat(size.cast("string"), F.lit(" g")).alias("quantity"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).when(k % 17 == 0, F.lit(""))
         .otherwise(F.concat(F.lit(" "), F.col("p_brand"), F.lit(" , House"))).alias("brands"),
        F.when(k % 13 == 0, F.lit(None).cast("array<string>"))
         .otherwise(F.array(F.concat(F.lit("XX:"), F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit("-")))),
                            F.lit("xx:house"))).alias("brands_tags"),
        F.concat(F.col("p_type"), F.lit(" goods, other")).alias("categories"),
        F.when(k % 23 == 0, F.lit(None).cast("array<string>"))
         .when(k % 29 == 0, F.array().cast("array<string>"))
         .otherwise(F.array(F.concat(F.lit(" en:"), F.lower("p_type"), F.lit("-goods")), F.lit("en:other")))
         .alias("categories_tags"),
        F.when(k % 19 == 0, F.lit(None).cast("array<string>")).otherwise(F.col("tags")).alias("countries_tags"),
        F.when(k % 31 == 0, F.lit(None).cast("bigint")).otherwise(F.col("t") - F.lit(86400) * v)
         .alias("last_modified_t"),
        F.when(k % 5 == 0, F.array(*short)).otherwise(F.array(*full)).alias("nutriments"),
    )


_LANDED: dict[tuple, str] = {}


def _changed(spark: SparkSession, path: str) -> int:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getModificationTime()


def food_path(spark: SparkSession, sf_dir: str) -> str:
    """Where the raw table of ``sf_dir`` is landed; landed anew if a source table has changed."""
    from larder.session import work_dir
    from larder.sources.io import write_parquet

    base = sf_dir.rstrip("/")
    stamp = tuple(_changed(spark, f"{base}/{t}.parquet") for t in ("part", "lineitem", "supplier", "nation"))
    key = (spark.sparkContext.applicationId, base, stamp)
    if key not in _LANDED:
        path = work_dir(spark, "raw", uuid.uuid4().hex[:12], "food.parquet")
        write_parquet(food(spark, sf_dir), path)
        _LANDED[key] = path
    return _LANDED[key]


def load_food(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``food`` table for ``sf_dir``: built once per session, landed as Parquet in
    the shared work folder (as the raw dump is landed before staging), then read
    back with the narrow raw schema."""
    from larder.sources.io import RAW_FOOD_SCHEMA

    return spark.read.schema(RAW_FOOD_SCHEMA).parquet(food_path(spark, sf_dir))
