"""Sources, sinks and table management.

Writes report their row count, and if asked a checksum of the content, through ``DataFrame.observe`` during the write
itself, so no second pass over the lineage is needed to know what was written.
"""

from __future__ import annotations

import datetime as _dt
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType, VariantType

from larder.session import work_dir
from larder.sources.footers import contract_breaks

# The raw columns the pipeline reads. Passing this narrow schema to the reader
# prunes the nested ``nutriments`` / ``product_name`` structs to the fields used,
# which Spark does not do by itself for array-of-struct columns.
RAW_FOOD_SCHEMA = (
    "code string, product_name array<struct<lang:string,text:string>>, nutriscore_grade string, "
    "nutriscore_score int, nova_group int, environmental_score_grade string, quantity string, "
    "brands string, brands_tags array<string>, categories string, categories_tags array<string>, "
    "countries_tags array<string>, last_modified_t bigint, "
    "nutriments array<struct<name:string,`100g`:double>>"
)


def read_raw(spark: SparkSession, path: str, schema: str | StructType | None = RAW_FOOD_SCHEMA) -> DataFrame:
    """Scan the raw Parquet dump."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def layer_path(base: str, layer: str, name: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{name}"


def read_layer(spark: SparkSession, base: str, layer: str, name: str) -> DataFrame:
    """Scan a silver/gold table."""
    return spark.read.parquet(layer_path(base, layer, name))


_INTEGRAL = {"tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long"}


def typed(df: DataFrame, src: str, typ: str):
    """``try_cast`` of one column. Text headed for an integer type is first tested
    against a digits pattern: a failed cast is costly in Spark (an exception per
    value), the pattern test is not; the answer is the same."""
    c = F.col(src)
    cast = c.try_cast(typ)
    if typ.lower() in _INTEGRAL and isinstance(df.schema[src].dataType, StringType):
        return F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), cast)
    return cast


def project_typed(df: DataFrame, spec: Sequence[tuple[str | Column, str, str]]) -> DataFrame:
    """Typed projection on read (S3): ``[(source, type, alias), ...]``; values that do not
    convert become NULL (``try_cast``) instead of failing the job, and so does a source column the
    table lacks. A source may be an expression, such as a field of a nested column."""
    def one(src, typ):
        if isinstance(src, Column):
            return src.try_cast(typ)
        return typed(df, src, typ) if src in df.columns else F.lit(None).cast(typ)

    return df.select(*[one(src, typ).alias(alias) for src, typ, alias in spec])


def food_spec() -> list[tuple[str | Column, str, str]]:
    """The typed raw table: names flattened to text, tags joined by commas, one column per nutrient."""
    from larder.functions.nested import NUTRIENTS, name_with_fallback, struct_lookup

    text, number = "string", "bigint"
    plain = [("code", text), ("nutriscore_grade", text), ("nova_group", number), ("environmental_score_grade", text), ("categories", text),
             ("brands", text), ("created_t", number), ("last_modified_t", number), ("nutriscore_score", number)]
    tags = [(F.array_join(c, ","), text, c) for c in ("categories_tags", "countries_tags", "brands_tags")]
    nutrients = [(struct_lookup("nutriments", "name", raw, "100g"), "double", name.removesuffix("_100g") + "_100g") for raw, name, _ in NUTRIENTS]
    return [(c, t, c) for c, t in plain] + [(name_with_fallback("product_name"), text, "product_name"), ("quantity", text, "product_quantity"), *tags, *nutrients]


def read_paths(spark: SparkSession, paths: Sequence[str], path_col: str = "source_file",
               basename: bool = True, schema: str | StructType | None = None,
               merge_schema: bool = False) -> DataFrame:
    """Read a list of Parquet paths as one table with the source file as a column.
    Blank entries in the list are skipped. ``merge_schema`` unions differing file
    schemas (missing columns read as NULL)."""
    paths = [p for p in paths if p and p.strip()]
    if not paths:
        raise ValueError("no paths to read")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    df = reader.parquet(*paths)
    src = F.col("_metadata.file_name") if basename else F.col("_metadata.file_path")
    return df.select("*", src.alias(path_col))


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    obs = Observation()
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


_SIZED = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": None}
_sizing = threading.Lock()


@contextmanager
def _file_size(spark: SparkSession, target: int | None) -> Iterator[None]:
    """For the writes inside, AQE aims at partitions of ``target`` bytes after a rebalance."""
    if target is None:
        yield
        return
    with _sizing:  # session settings: one sized write at a time
        before = {k: spark.conf.get(k, None) for k in _SIZED}
        for k, v in _SIZED.items():
            spark.conf.set(k, v or str(target))
        try:
            yield
        finally:
            for k, v in before.items():
                spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", codec: str | None = None,
                  row_group_bytes: int | None = None, max_records: int | None = None,
                  partition_by: Sequence[str] | None = None, file_bytes: int | None = None) -> int:
    """Parquet write with codec / row-group / records-per-file options (S5 S6); returns rows written. ``file_bytes``: files of
    about that many shuffled bytes, small partitions merged and large or skewed ones split (REBALANCE under AQE)."""
    with _file_size(df.sparkSession, file_bytes):
        if file_bytes is not None:
            df = df.hint("rebalance", *(partition_by or []))
        return _write_parquet(df, path, mode, codec, row_group_bytes, max_records, partition_by)


def _write_parquet(df, path, mode, codec, row_group_bytes, max_records, partition_by) -> int:
    observed, obs = _observed(df)
    w = observed.write.mode(mode)
    if codec is not None:
        w = w.option("compression", codec)
    if row_group_bytes is not None:
        w = w.option("parquet.block.size", str(row_group_bytes))
    if max_records is not None:
        w = w.option("maxRecordsPerFile", str(max_records))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(obs.get["rows"])


def write_layer(df: DataFrame, base: str, layer: str, name: str, **kw) -> int:
    """Idempotent overwrite of a silver/gold table (S5); returns rows written."""
    return write_parquet(df, layer_path(base, layer, name), mode="overwrite", **kw)


# JSON text keeps full microsecond timestamps (Spark's default JSON format stops at
# milliseconds, which would make a JSON copy differ from its source).
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _write(df: DataFrame, fmt: str, path: str, options: dict | None = None, mode: str = "overwrite") -> None:
    opts = {**(JSON_OPTIONS if fmt == "json" else {}), **(options or {})}
    df.write.mode(mode).options(**opts).format(fmt).save(path)


def fan_out(df: DataFrame, sinks: Sequence[tuple[str, str, dict | None]]) -> int:
    """Write the same rows to several sinks (S7): ``[(format, path, options), ...]``.

    The input is computed once. A Parquet sink, wherever it stands in the list, serves the others as
    their source; without one a Parquet staging table in the shared work folder does. A sink whose
    format or options lose something (CSV without a header, say) so never feeds another.
    Returns the number of rows.
    """
    if not sinks:
        raise ValueError("no sinks")
    spark = df.sparkSession
    exact = next((k for k, s in enumerate(sinks) if s[0] == "parquet"), None)
    observed, obs = _observed(df)
    path = sinks[exact][1] if exact is not None else work_dir(spark, "fan-out", uuid.uuid4().hex[:12])
    _write(observed, "parquet", path, sinks[exact][2] if exact is not None else None)
    source = spark.read.schema(df.schema).parquet(path)
    for k, (fmt, to, opt) in enumerate(sinks):
        if k != exact:
            _write(source, fmt, to, opt)
    return int(obs.get["rows"])


def land_raw(df: DataFrame, base: str, run_date: _dt.date | None = None, dated: bool = True,
             name: str = "food") -> tuple[str, int]:
    """Land the raw dump under ``food/food_YYYYMMDD.parquet`` (or fixed ``food.parquet``)."""
    path = _landing_path(base, run_date, dated, name)
    return path, write_parquet(df, path)


def _landing_path(base: str, run_date: _dt.date | None, dated: bool, name: str) -> str:
    if not dated:
        return f"{base.rstrip('/')}/{name}.parquet"
    return f"{base.rstrip('/')}/{name}/{name}_{(run_date or _dt.date.today()).strftime('%Y%m%d')}.parquet"


class Checksum(NamedTuple):
    """Rows and an order-free digest of their content."""
    rows: int
    digest: str


def row_hash(df: DataFrame) -> Column:
    """64 bits of a row's whole content. NULLs count with their place, nested values through their text."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (ArrayType, StructType, MapType, VariantType)):
            c = F.to_json(c, {**JSON_OPTIONS, "ignoreNullFields": "false"})
        parts += [c, c.isNull()]
    return F.xxhash64(*parts)


def _digests(df: DataFrame) -> list[Column]:
    """Rows, and two sums of 32-bit halves of the row hashes: the order of rows is of no account, repeated rows count."""
    h = row_hash(df)
    return [F.count(F.lit(1)).alias("rows"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)).cast("decimal(20,0)")).alias("low"),
            F.sum(F.shiftrightunsigned(h, 32).cast("decimal(20,0)")).alias("high")]


def _checksum(row) -> Checksum:
    return Checksum(int(row["rows"]), f"{int(row['high'] or 0):x}-{int(row['low'] or 0):x}")


def content_checksum(df: DataFrame) -> Checksum:
    """Rows and digest of a table, in one pass without a shuffle of rows."""
    return _checksum(df.agg(*_digests(df)).first())


def write_checked(df: DataFrame, path: str, **options) -> Checksum:
    """Parquet write that returns the checksum of what was written, observed during the write."""
    obs = Observation()
    write_parquet(df.observe(obs, *_digests(df)), path, **options)
    return _checksum(obs.get)


def land_checked(df: DataFrame, base: str, run_date: _dt.date | None = None, dated: bool = True, name: str = "food") -> tuple[str, Checksum]:
    """:func:`land_raw` with the checksum of the landed content."""
    path = _landing_path(base, run_date, dated, name)
    return path, write_checked(df, path)


def verify_landing(spark: SparkSession, path: str, expected: int | Checksum | None = None) -> tuple[bool, int]:
    """Hold a landed table against what was written (S9): the row count, from Parquet footers, or with a
    :class:`Checksum` the whole content, read again. Returns (as expected, rows)."""
    df = spark.read.parquet(path)
    if isinstance(expected, Checksum):
        found = content_checksum(df)
        return found == expected, found.rows
    n = df.count()
    return (expected is None or n == expected), n


# ---- partitions replaced one run at a time (S5) -----------------------------------------------

def _commits(path: str) -> str:
    return f"{path.rstrip('/')}/_commits"


def _partition_key(by: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in by]), {"ignoreNullFields": "false"})


def _partition_digests(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """(partition, rows, low, high); hashed without the partition columns, whose types a read back may change."""
    return df.groupBy(_partition_key(by).alias("partition")).agg(*_digests(df.drop(*by)))


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str], run: str) -> int:
    """Replace the partitions that ``df`` has rows for, and only these (dynamic partition overwrite): a rerun of a day leaves the
    other days. The new files become visible when the job commits, so a failed rerun leaves the old rows. Then a marker per
    partition (run, rows, digest) is appended below ``_commits``. Returns the rows written."""
    spark, by = df.sparkSession, list(by)
    obs = Observation()
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)
    replaced = df.select(*by).distinct()
    back = _typed_back(spark, path, df.schema)
    on = [back[c].eqNullSafe(replaced[c]) for c in by]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    marks = _partition_digests(back.join(replaced, condition, "left_semi"), by)
    marks.withColumn("run", F.lit(run)).withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(_commits(path))
    return int(obs.get["rows"])


def _typed_back(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*[F.col(f"`{f.name}`") for f in schema.fields])


def partition_status(spark: SparkSession, path: str, by: Sequence[str], schema: StructType) -> DataFrame:
    """(partition, run, rows, committed): the run that last committed each partition and whether its content is still the
    committed one; a partition without a marker, or changed since, is not committed."""
    now = _partition_digests(_typed_back(spark, path, schema), list(by)).withColumnsRenamed({"rows": "n", "low": "l", "high": "h"})
    marks = spark.read.parquet(_commits(path)).groupBy("partition").agg(F.max(F.struct("at", "run", "rows", "low", "high")).alias("m")).select("partition", "m.*")
    same = (F.col("n") == F.col("rows")) & (F.col("l") == F.col("low")) & (F.col("h") == F.col("high"))
    return now.join(marks, "partition", "left").select("partition", "run", F.col("n").alias("rows"), F.coalesce(same, F.lit(False)).alias("committed"))


def register(df: DataFrame, name: str) -> DataFrame:
    """Temp view registration."""
    df.createOrReplaceTempView(name)
    return df


def materialize(df: DataFrame, mode: str, name: str, path: str | None = None) -> DataFrame:
    """Staging models stay views, marts become tables (S13): ``table`` saves a table in the catalog (external at
    ``path``, else managed), which outlives the session's views and is found by name."""
    if mode == "view":
        return register(df, name)
    if mode == "table":
        w = df.write.mode("overwrite").format("parquet")
        (w.option("path", path) if path is not None else w).saveAsTable(name)
        return df.sparkSession.table(name)
    raise ValueError(f"unknown materialisation {mode!r}")


def write_bucketed(df: DataFrame, name: str, path: str, by: str, buckets: int) -> DataFrame:
    """A catalog table at ``path`` dealt into ``buckets`` by a key and sorted by it within each (S13 J5): tables
    bucketed alike are joined and grouped by that key without an exchange."""
    dealt = df.repartition(buckets, by)  # one file per bucket, not one per task and bucket
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, by).sortBy(by).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def run_sql(spark: SparkSession, text: str, views: dict[str, DataFrame] | None = None, **args) -> DataFrame:
    """SQL text over named views (S14 S20), with named parameters (``:name``)."""
    for name, df in (views or {}).items():
        register(df, name)
    return spark.sql(text, args=args or None)


def create_external(spark: SparkSession, name: str, path: str, columns_ddl: str | None = None) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet LOCATION`` over a Parquet folder."""
    cols = f"({columns_ddl}) " if columns_ddl else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {cols}USING parquet LOCATION {sql_text(path)}")
    return spark.table(name)


def sql_text(value: str) -> str:
    """A string literal of Spark SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def schema_diff(df: DataFrame, contract: dict[str, str]) -> list[tuple[str, str, str | None, bool]]:
    """Compare a table's schema to a contract ``{column: simple type}``."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [(c, t, actual.get(c), actual.get(c) == t) for c, t in contract.items()]


#: What a run needs of the raw table, checked in every file before it starts.
RAW_CONTRACT = {"code": "string", "nutriscore_grade": "string", "nutriscore_score": "int", "last_modified_t": "bigint"}


def check_contract(spark: SparkSession, path: str, contract: dict[str, str], most: int = 20, via: str = "store") -> list[tuple[str, str, str, str | None]]:
    """The first ``most`` breaches of a contract in the files below ``path``: (file, column, expected, actual or None). Every
    file's own footer is read, on the executors (:func:`contract_breaks`)."""
    rows = contract_breaks(spark, path, contract, via).orderBy("file", "column_name").limit(most).collect()
    return [(r["file"], r["column_name"], r["expected_type"], r["actual_type"]) for r in rows]


def schema_report(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """Contract check as a DataFrame: per contract column, the actual type, whether it
    matches, and how many rows are NULL in it (one aggregation pass over the table)."""
    diff = schema_diff(df, contract)
    present = [c for c, _, a, _ in diff if a is not None]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(present)]) \
        if present else df.agg(F.count(F.lit(1)).alias("_unused"))
    rows = []
    for c, expected, actual, ok in diff:
        nulls = F.col(f"_n{present.index(c)}").cast("bigint") if c in present else F.lit(None).cast("bigint")
        rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(expected).alias("expected_type"),
                             F.lit(actual).cast("string").alias("actual_type"), F.lit(ok).alias("type_ok"),
                             nulls.alias("null_rows")))
    return counts.select(F.inline(F.array(*rows)))
