"""The registered queries: one per operator / model, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (or data Spark derives from them, such as
the landed ``food`` table and the gold tables built from it) in full.
Queries whose output holds arrays or structs present them as JSON text, the
form the document export writes, so results compare as plain values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.config import DEFAULT, VARIANT_A, VARIANT_B, Variant
from larder.operators import quality as Q
from larder.functions.dates import date_key, seconds_to_date
from larder.functions.nested import array_size, keep_items, map_items
from larder.functions.predicates import if_
from larder.operators.dedup import dedup, latest_per_key
from larder.operators.joins import bridge_lookup, lookup
from larder.operators.keys import sort_spec, surrogate_key
from larder.operators.metrics import count_distinct, pct_nonnull, pct_where
from larder.plans import staging as S
from larder.plans import warehouse as W
from larder.session import work_dir
from larder.sources import audit as AU
from larder.sources import documents as DOC
from larder.sources import footers as FT
from larder.sources import io as IO
from larder.sources.testdata import food_path, load_food

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _scratch(spark: SparkSession, name: str) -> str:
    return work_dir(spark, "scratch", name, uuid.uuid4().hex[:12])


def _jsonify(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
                       for f in df.schema.fields])


def _gold(spark: SparkSession, sf_dir: str, v: Variant) -> W.Gold:
    return W.gold_for(load_food(spark, sf_dir), v, food_path(spark, sf_dir))


# ---- sources --------------------------------------------------------------------------------

# Typed projection spec: (source column, target type, output name). A value that does
# not convert becomes NULL (e.g. the return flag letters as int).
LINEITEM_TYPED = [("l_orderkey", "string", "order_key"), ("l_linenumber", "bigint", "line_number"),
                  ("l_quantity", "double", "quantity"), ("l_shipdate", "date", "ship_date"),
                  ("l_returnflag", "string", "return_flag"), ("l_returnflag", "int", "return_flag_code")]


def raw_scan_typed(spark, sf):
    return IO.project_typed(table(spark, sf, "lineitem"), LINEITEM_TYPED)


def read_paths_source(spark, sf):
    base = sf.rstrip("/")
    return IO.read_paths(spark, [f"{base}/orders.parquet", f"{base}/lineitem.parquet"], merge_schema=True)


# ---- staging ------------------------------------------------------------------------------

def _stg(fn, v):
    def q(spark, sf):
        return fn(load_food(spark, sf), v)
    return q


def stg_nutrition_max(spark, sf):
    return S.stg_nutrition(load_food(spark, sf), VARIANT_A)


def stg_nutrition_latest(spark, sf):
    return S.stg_nutrition(load_food(spark, sf), VARIANT_B)


# ---- gold ---------------------------------------------------------------------------------

def _gold_table(name: str, v: Variant):
    def q(spark, sf):
        return _gold(spark, sf, v)[name]
    return q


def _kpi(name: str, v: Variant = VARIANT_A):
    def q(spark, sf):
        return W.kpis(_gold(spark, sf, v))[name]
    return q


def kpi_pct_grade_a_products(spark, sf):
    from larder.plans.kpis import pct_grade_a
    g = _gold(spark, sf, VARIANT_A)
    return pct_grade_a(g["fact_nutrition"], g["dim_product"], per="product")


def dq_report(spark, sf):
    report = W.quality_report(_gold(spark, sf, VARIANT_A))
    li = Q.run_checks(table(spark, sf, "lineitem"), [
        Q.unique("l_orderkey,l_linenumber"),
        Q.Check("unique", "l_orderkey,l_linenumber", mode="rows", label="unique_rows"),
        Q.not_null("l_shipdate"), Q.at_least("l_quantity", 0), Q.in_range("l_discount", 0.0, 0.1)], "lineitem")
    return report.unionByName(li)


def dq_report_b(spark, sf):
    return W.quality_report(_gold(spark, sf, VARIANT_B), unique_mode="rows")


# ---- documents ----------------------------------------------------------------------------

def document_subset(spark, sf):
    return _jsonify(DOC.document_subset(load_food(spark, sf), max_energy=900))


def document_top_n(spark, sf):
    """The export with an explicit limit that binds."""
    return _jsonify(DOC.document_subset(load_food(spark, sf), n=100, max_energy=900))


def document_subset_basic(spark, sf):
    """The subset without nutrients and without the energy cap."""
    return _jsonify(DOC.document_subset(load_food(spark, sf), nutrients=False))


def document_roundtrip(spark, sf):
    docs = DOC.document_subset(load_food(spark, sf), max_energy=900)
    path = _scratch(spark, "documents")
    DOC.export_documents(docs, path)
    return _jsonify(DOC.read_documents(spark, path, docs.schema))


# ---- generic queries on the other tables ------------------------------------------------------

def star_join_sales(spark, sf):
    """Revenue per region, nation and order year.

    Lines are first reduced to one row per order (sum, count; map-side combined),
    so the order join shuffles orders, not lines. Customer -> nation -> region is
    a chain of dimension lookups.
    """
    li = table(spark, sf, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("_rev"),
        F.count(F.lit(1)).alias("_lines"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("order_year"))
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf, "region").select("r_regionkey", "r_name")
    geo = lookup(nation, region, ("n_regionkey", "r_regionkey"), ["r_name"], how="inner")
    cust = lookup(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), geo,
                  ("c_nationkey", "n_nationkey"), ["n_name", "r_name"], how="inner")
    joined = per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
    joined = joined.join(cust, joined.o_custkey == cust.c_custkey)
    return joined.groupBy("r_name", "n_name", "order_year").agg(
        F.round(F.sum("_rev") / F.sum("_lines"), 2).alias("avg_revenue"),
        count_distinct("o_custkey").alias("nb_customers"),
        F.sum("_lines").cast("bigint").alias("nb_lines"))


EVENT_PAYLOAD = ["event_id", "ts", "event_type", "value", "props"]


def latest_event_per_user(spark, sf):
    ev = table(spark, sf, "events")
    return latest_per_key(ev, "user_id", ["ts"], payload=EVENT_PAYLOAD)


def pct_errors(spark, sf):
    ev = table(spark, sf, "events")
    return ev.groupBy(F.to_date("ts").alias("event_date")).agg(
        F.count(F.lit(1)).cast("bigint").alias("nb_events"),
        pct_where(F.col("event_type") == "error", "event_type").alias("pct_errors"))


def completeness_labels(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    joined = lookup(docs, labels, "doc_id", ["quality"], how="left")
    return joined.groupBy("lang").agg(F.count(F.lit(1)).cast("bigint").alias("nb_documents"),
                                      pct_nonnull("quality").alias("pct_labelled"))


def surrogate_key_scalable(spark, sf):
    li = table(spark, sf, "lineitem")
    return surrogate_key(li, [sort_spec(c) for c in li.columns], "line_sk", unique=False)


# ---- sinks, table management ------------------------------------------------------------------

def parquet_roundtrip(spark, sf):
    path = _scratch(spark, "part")
    IO.write_parquet(table(spark, sf, "part"), path, codec="uncompressed", row_group_bytes=268435456,
                     max_records=1_000_000)
    return spark.read.parquet(path)


def fan_out(spark, sf):
    ev = table(spark, sf, "events")
    base = _scratch(spark, "fanout")
    IO.fan_out(ev, [("parquet", f"{base}/parquet", None), ("json", f"{base}/json", None)])
    a = spark.read.parquet(f"{base}/parquet").withColumn("sink", F.lit("parquet"))
    b = spark.read.schema(ev.schema).options(**IO.JSON_OPTIONS).json(f"{base}/json").withColumn("sink", F.lit("json"))
    return a.unionByName(b)


def land_raw(spark, sf):
    import datetime as dt
    food = load_food(spark, sf)
    path, rows = IO.land_raw(food, _scratch(spark, "landing"), run_date=dt.date(2024, 6, 10))
    ok, n = IO.verify_landing(spark, path, rows)
    if not ok:
        raise RuntimeError(f"landing check failed: wrote {rows}, read {n}")
    return _jsonify(IO.read_raw(spark, path))


def audit_append(spark, sf):
    food = load_food(spark, sf)
    base = _scratch(spark, "audit")
    path, rows = IO.land_raw(food, base, dated=False)
    ok, _ = IO.verify_landing(spark, path, rows)
    AU.log_run(spark, f"{base}/pipeline_logs", "food", path, rows, "SUCCESS" if ok else "FAILED")
    return AU.read_audit(spark, f"{base}/pipeline_logs").select(
        F.col("run_id").rlike(r"^PL_[0-9]{8}_[0-9]{6}$").alias("run_id_ok"),
        (F.date_format("run_date", "yyyyMMdd_HHmmss") == F.substring("run_id", 4, 15)).alias("run_date_ok"), "source_file", F.regexp_extract("output_file", r"([^/]+)$", 1).alias("output_file"),
        "nb_lignes_output", "statut")


def external_table(spark, sf):
    path = _scratch(spark, "external")
    IO.write_parquet(table(spark, sf, "part"), path)
    name = f"larder_part_{uuid.uuid4().hex[:8]}"
    made = IO.create_external(spark, name, path)
    spark.sql(f"DROP TABLE {name}")  # external: the catalog entry goes, the data stay
    return made


def audit_catalog(spark, sf):
    """The audit log read as a catalog table."""
    base = _scratch(spark, "audit-table")
    rows = table(spark, sf, "part").count()
    AU.log_run(spark, base, "part", "part.parquet", rows)
    name = f"larder_audit_{uuid.uuid4().hex[:8]}"
    made = AU.audit_table(spark, name, base).select("source_file", "output_file", "nb_lignes_output", "statut")
    spark.sql(f"DROP TABLE {name}")
    return made


# Contract of the raw table; one type is deliberately stricter than the data and
# one column is absent, so the report shows both kinds of finding.
FOOD_CONTRACT = {"code": "string", "nutriscore_grade": "string", "nutriscore_score": "bigint",
                 "nova_group": "int", "last_modified_t": "bigint", "countries_tags": "array<string>",
                 "created_t": "bigint"}


def schema_contract(spark, sf):
    return IO.schema_report(spark.read.parquet(food_path(spark, sf)), FOOD_CONTRACT)


def schema_drift(spark, sf):
    """The contract against a file that has drifted: the score as text, one column more."""
    path = _scratch(spark, "drifted")
    food = load_food(spark, sf).withColumn("nutriscore_score", F.col("nutriscore_score").cast("string")) \
        .withColumn("created_t", F.col("last_modified_t"))
    IO.write_parquet(food, path)
    return IO.schema_report(spark.read.parquet(path), FOOD_CONTRACT)


def date_out_of_range(spark, sf):
    """Seconds far past the year 9999 give NULL, not a failed job."""
    d = seconds_to_date(F.col("o_orderkey") * F.lit(10**9))
    return table(spark, sf, "orders").select("o_orderkey", d.alias("d"), date_key(d).alias("d_key"))


def _fan_out_first(fmt: str, options: dict):
    """fan_out with a first sink that is not Parquet."""
    def q(spark, sf):
        ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
        base = _scratch(spark, f"fanout-{fmt}")
        IO.fan_out(ev, [(fmt, f"{base}/{fmt}", options), ("parquet", f"{base}/parquet", None), ("json", f"{base}/json", None)])
        reads = [spark.read.schema(ev.schema).options(**options).format(fmt).load(f"{base}/{fmt}"), spark.read.parquet(f"{base}/parquet"),
                 spark.read.schema(ev.schema).json(f"{base}/json")]
        parts = [r.withColumn("sink", F.lit(n)) for r, n in zip(reads, ("first", "parquet", "json"))]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])
    return q


def gold_dim_product(spark, sf):
    """dim_product as a finished run leaves it in the gold folder."""
    out = _scratch(spark, "run-a")
    W.run_pipeline(load_food(spark, sf), VARIANT_A, out=out, raw_path=food_path(spark, sf), contract=IO.RAW_CONTRACT)
    return IO.read_layer(spark, *out.rsplit("/", 1), "dim_product")


def layer_view(spark, sf):
    """A layer table read back and shown as a view."""
    base = _scratch(spark, "layers")
    IO.write_layer(table(spark, sf, "orders"), base, "silver", "orders")
    return IO.materialize(IO.read_layer(spark, base, "silver", "orders"), "view", f"orders_{uuid.uuid4().hex[:8]}")


def mart_table(spark, sf):
    """A staging view and the mart built from it as a catalog table, read by name once the view is gone."""
    view, name = f"stg_orders_{uuid.uuid4().hex[:8]}", f"mart_customer_{uuid.uuid4().hex[:8]}"
    IO.materialize(table(spark, sf, "orders"), "view", view)
    mart = IO.run_sql(spark, f"SELECT o_custkey, count(*) AS nb_orders, max(o_orderdate) AS last_order FROM {view} GROUP BY o_custkey")
    IO.materialize(mart, "table", name, _scratch(spark, "mart"))
    spark.catalog.dropTempView(view)
    return spark.newSession().table(name)  # another session: no view of this one is seen there


def food_typed(spark, sf):
    """The raw table under its typed projection: flattened names, joined tags, a column per nutrient (S3)."""
    return IO.project_typed(IO.read_raw(spark, food_path(spark, sf)), IO.food_spec())


def food_rich_nutrients(spark, sf):
    """Nutrients above 5 per 100 g, by a filter over the struct array."""
    rich = keep_items("nutriments", ["name", "100g"], lambda i: i["100g"] > 5)
    return load_food(spark, sf).filter("code IS NOT NULL").select(
        "code", "last_modified_t", F.array_join(F.transform(rich, lambda i: i["name"]), ",").alias("rich"), F.size(rich).cast("bigint").alias("nb_rich"))


def food_nutrient_labels(spark, sf):
    """A label per nutrient, by a transform over the struct array."""
    label = map_items("nutriments", ["name", "100g"], lambda i: F.concat(i["name"], F.lit("="), F.floor(i["100g"] * 10).cast("string")))
    return load_food(spark, sf).filter("code IS NOT NULL").select("code", "last_modified_t", F.array_join(label, ";").alias("labels"))


def active_products_by_period(spark, sf):
    """Distinct products per month, year and in all, merged from monthly bitmaps."""
    from larder.plans.kpis import active_products_by_period as by_period
    g = _gold(spark, sf, VARIANT_A)
    return by_period(g["fact_nutrition"], g["dim_date"])


def bucketed_grades(spark, sf):
    """Fact rows and products per grade over tables bucketed by product: no exchange before the grades."""
    g = W.bucket_by_product(_gold(spark, sf, VARIANT_A), _scratch(spark, "bucketed"), 8, f"larder_{uuid.uuid4().hex[:8]}")
    per_product = g["fact_nutrition"].groupBy("product_sk").agg(F.count(F.lit(1)).alias("_n"))
    graded = lookup(per_product, g["dim_product"], "product_sk", ["nutriscore_grade"], how="inner")
    return graded.groupBy("nutriscore_grade").agg(F.sum("_n").alias("nb_lignes"), F.count(F.lit(1)).alias("nb_produits"))


EVENT_CONTRACT = {"event_id": "bigint", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}


def contract_by_file(spark, sf):
    """Four batches in one folder, one of them drifted (a type changed, a column gone): the breaches by file."""
    base = _scratch(spark, "batches")
    ev = table(spark, sf, "events")
    for k in range(4):
        batch = ev.filter(F.col("event_id") % 4 == k)
        IO.write_parquet(batch.withColumn("value", F.col("value").cast("string")).drop("props") if k == 2 else batch, f"{base}/batch={k}")
    return FT.contract_breaks(spark, base, EVENT_CONTRACT).withColumn("batch", F.regexp_extract("file", "/batch=([0-9]+)/", 1).cast("int")) \
        .groupBy("batch", "column_name", "expected_type", "actual_type").agg(F.sum("rows").alias("nb_rows"))


def write_options(spark, sf):
    """Codec, row groups and file sizes as the files' footers have them."""
    path, group, size = _scratch(spark, "options"), 256 << 10, 1 << 20
    IO.write_parquet(table(spark, sf, "lineitem"), path, codec="zstd", row_group_bytes=group, file_bytes=size)
    f = FT.footers(spark, path)
    return f.agg(F.sum("rows").alias("nb_rows"), F.array_join(F.array_distinct(F.flatten(F.collect_set("codecs"))), ",").alias("codecs"),
                 (F.max("max_group_bytes") <= 2 * group).alias("groups_small"), (F.max("bytes") <= 2 * size).alias("files_small"))


def landing_checksum(spark, sf):
    """The landing check by content (S9 S17): the same rows in another order pass, one changed value with the same count does not."""
    base, orders = _scratch(spark, "landings"), table(spark, sf, "orders")
    _, landed = IO.land_checked(orders, base, dated=False, name="orders")
    IO.write_parquet(orders.repartition(3, "o_custkey"), f"{base}/moved.parquet")
    first = orders.agg(F.min("o_orderkey").alias("k"))
    IO.write_parquet(orders.join(F.broadcast(first)).withColumn("o_totalprice", F.when(F.col("o_orderkey") == F.col("k"), F.col("o_totalprice") + 1)
                                                                .otherwise(F.col("o_totalprice"))).drop("k"), f"{base}/changed.parquet")
    rows = []
    for name in ("orders", "moved", "changed"):
        by_rows, _ = IO.verify_landing(spark, f"{base}/{name}.parquet", landed.rows)
        by_content, n = IO.verify_landing(spark, f"{base}/{name}.parquet", landed)
        rows.append((name, n, by_rows, by_content))
    return spark.createDataFrame(rows, "landing string, nb_rows bigint, rows_ok boolean, content_ok boolean")


def partition_rerun(spark, sf):
    """A day's partition replaced by a rerun, then a rerun that fails: the other days and the committed rows stay."""
    path, ev = _scratch(spark, "daily"), table(spark, sf, "events").withColumn("event_date", F.to_date("ts"))
    IO.overwrite_partitions(ev, path, ["event_date"], "first")
    days = ev.agg(F.min("event_date").alias("first"), F.max("event_date").alias("last")).first()
    IO.overwrite_partitions(ev.filter(F.col("event_date") == F.lit(days["first"])).withColumn("value", F.col("value") * 2), path, ["event_date"], "again")
    broken = ev.filter(F.col("event_date") == F.lit(days["last"])).withColumn(
        "value", F.when(F.col("event_id") % 3 == 0, F.raise_error(F.lit("a rerun that fails")).cast("double")).otherwise(F.lit(0.0)))
    try:
        IO.overwrite_partitions(broken, path, ["event_date"], "failed")
    except Exception as e:  # noqa: BLE001 - the failure is the point
        if "a rerun that fails" not in str(e):
            raise
    status = IO.partition_status(spark, path, ["event_date"], ev.schema).select(
        F.get_json_object("partition", "$.event_date").cast("date").alias("event_date"), "run", "committed")
    now = spark.read.schema(ev.schema).parquet(path).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("nb_events"), F.sum(F.floor(F.col("value") * 100)).alias("cents"))
    return now.join(status, "event_date")


def order_nation(spark, sf):
    """Order -> customer -> nation name."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return bridge_lookup(orders, "c_custkey", table(spark, sf, "customer"), "c_nationkey", table(spark, sf, "nation"),
                         ["n_name"], "n_nationkey")


def food_flags(spark, sf):
    """Array size and IF."""
    return load_food(spark, sf).select("code", array_size("countries_tags").cast("bigint").alias("nb_countries"),
                                       if_(F.col("nutriscore_score") > 10, "nutriscore_grade").alias("weak_grade")).filter("code IS NOT NULL")


def run_status(spark, sf):
    """The soft-failure status of a quality report (Q7), with the number of failed checks."""
    path = _scratch(spark, "report")
    IO.write_parquet(dq_report(spark, sf), path)  # a few rows, read twice: the checks run once
    report = spark.read.parquet(path)
    return report.agg(F.count_if(~F.col("passed")).alias("failed")).withColumn("statut", F.lit(Q.status(report)))


def one_per_customer(spark, sf):
    """One whole order per customer, chosen by hash."""
    return dedup(table(spark, sf, "orders"), ["o_custkey"], by=["o_orderkey"])


def stg_nutrition_rows_a(spark, sf):
    """Variant A's nutrition staging: one row per raw row with a code."""
    return S.stg_nutrition(load_food(spark, sf), VARIANT_A, collapse=False)


LOOKUP_SQL = """
SELECT code AS product_code,
       get(nutriments.`100g`, array_position(nutriments.name, :nutrient) - 1) AS nutrient_100g
FROM food_raw
WHERE code IS NOT NULL
"""


def sql_text_lookup(spark, sf):
    return IO.run_sql(spark, LOOKUP_SQL, views={"food_raw": load_food(spark, sf)}, nutrient="salt")


QUERIES: dict[str, Query] = {
    "raw_scan_typed": raw_scan_typed,
    "read_paths_source": read_paths_source,
    "stg_products_a": _stg(S.stg_products, VARIANT_A),
    "stg_products_b": _stg(S.stg_products, VARIANT_B),
    "stg_brands_a": _stg(S.stg_brands, VARIANT_A),
    "stg_brands_b": _stg(S.stg_brands, VARIANT_B),
    "stg_categories_a": _stg(S.stg_categories, VARIANT_A),
    "stg_categories_b": _stg(S.stg_categories, VARIANT_B),
    "stg_countries_a": _stg(S.stg_countries, VARIANT_A),
    "stg_countries_b": _stg(S.stg_countries, VARIANT_B),
    "stg_date_a": _stg(S.stg_date, VARIANT_A),
    "stg_date_b": _stg(S.stg_date, VARIANT_B),
    **{f"stg_{n}_default": _stg(getattr(S, f"stg_{n}"), DEFAULT) for n in ("products", "brands", "categories", "countries", "date")},
    "dim_product_default": _gold_table("dim_product", DEFAULT),
    "dim_country_default": _gold_table("dim_country", DEFAULT),
    "stg_nutrition_rows_a": stg_nutrition_rows_a,
    "gold_dim_product": gold_dim_product,
    "layer_view": layer_view,
    **{f.__name__: f for f in (mart_table, food_typed, food_rich_nutrients, food_nutrient_labels, active_products_by_period, bucketed_grades,
                               contract_by_file, write_options, landing_checksum, partition_rerun)},
    "order_nation": order_nation,
    "food_flags": food_flags,
    "run_status": run_status,
    "one_per_customer": one_per_customer,
    "audit_catalog": audit_catalog,
    "schema_drift": schema_drift,
    "date_out_of_range": date_out_of_range,
    "fan_out_csv_first": _fan_out_first("csv", {"header": "true", "sep": "|"}),
    "fan_out_json_first": _fan_out_first("json", {}),
    "stg_nutrition_max": stg_nutrition_max,
    "stg_nutrition_latest": stg_nutrition_latest,
    "dim_product": _gold_table("dim_product", VARIANT_A),
    "dim_product_b": _gold_table("dim_product", VARIANT_B),
    "dim_brand_a": _gold_table("dim_brand", VARIANT_A),
    "dim_brand_b": _gold_table("dim_brand", VARIANT_B),
    "dim_category_a": _gold_table("dim_category", VARIANT_A),
    "dim_category_b": _gold_table("dim_category", VARIANT_B),
    "dim_country_a": _gold_table("dim_country", VARIANT_A),
    "dim_country_b": _gold_table("dim_country", VARIANT_B),
    "dim_date_a": _gold_table("dim_date", VARIANT_A),
    "dim_date_b": _gold_table("dim_date", VARIANT_B),
    "fact_nutrition_a": _gold_table("fact_nutrition", VARIANT_A),
    "fact_nutrition_b": _gold_table("fact_nutrition", VARIANT_B),
    "kpi_active_products": _kpi("kpi_active_products"),
    "kpi_mean_score": _kpi("kpi_mean_score"),
    "kpi_pct_grade_a": _kpi("kpi_pct_grade_a"),
    "kpi_pct_grade_a_products": kpi_pct_grade_a_products,
    "kpi_mean_salt": _kpi("kpi_mean_salt"),
    "kpi_completeness": _kpi("kpi_completeness"),
    "dq_report": dq_report,
    "dim_brand_default": _gold_table("dim_brand", DEFAULT),
    "dim_category_default": _gold_table("dim_category", DEFAULT),
    "dim_date_default": _gold_table("dim_date", DEFAULT),
    "fact_nutrition_default": _gold_table("fact_nutrition", DEFAULT),
    "kpi_mean_score_default": _kpi("kpi_mean_score", DEFAULT),
    "kpi_active_products_default": _kpi("kpi_active_products", DEFAULT),
    "kpi_pct_grade_a_default": _kpi("kpi_pct_grade_a", DEFAULT),
    "kpi_mean_salt_default": _kpi("kpi_mean_salt", DEFAULT),
    "kpi_completeness_default": _kpi("kpi_completeness", DEFAULT),
    "dq_report_b": dq_report_b,
    "document_subset": document_subset,
    "document_top_n": document_top_n,
    "document_subset_basic": document_subset_basic,
    "document_roundtrip": document_roundtrip,
    "star_join_sales": star_join_sales,
    "latest_event_per_user": latest_event_per_user,
    "pct_errors": pct_errors,
    "completeness_labels": completeness_labels,
    "surrogate_key_scalable": surrogate_key_scalable,
    "parquet_roundtrip": parquet_roundtrip,
    "fan_out": fan_out,
    "land_raw": land_raw,
    "audit_append": audit_append,
    "external_table": external_table,
    "schema_contract": schema_contract,
    "sql_text_lookup": sql_text_lookup,
}
