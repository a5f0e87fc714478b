"""Footers, contracts by file, content checksums, partition reruns, catalog and bucketed tables."""

import os

import pytest
from pyspark.sql import functions as F

from larder.config import VARIANT_A
from larder.plans import kpis as K
from larder.plans import warehouse as W
from larder.sources import footers as FT
from larder.sources import io as IO
from larder.sources.testdata import load_food

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture()
def base(tmp_path):
    return str(tmp_path)


# ---- footers and contracts -----------------------------------------------------------------------

def test_one_drifted_file_among_several_is_named(spark, base):
    for k in range(12):
        df = spark.range(20).select(F.col("id").alias("code"), F.lit(1.5).alias("v"))
        IO.write_parquet((df.withColumn("v", F.lit("x")) if k == 7 else df).coalesce(1), f"{base}/t/part_no={k}")
    for via in ("store", "content"):
        found = IO.check_contract(spark, f"{base}/t", {"code": "bigint", "v": "double", "w": "int"}, most=100, via=via)
        assert len([f for f in found if f[1] == "w" and f[3] is None]) == 12
        drifted = [f for f in found if f[1] == "v"]
        assert len(drifted) == 1 and "/part_no=7/" in drifted[0][0] and drifted[0][2:] == ("double", "string")


def test_contract_of_types_and_single_file(spark, base):
    df = spark.sql("""SELECT 1 AS i, 2L AS b, 'x' AS s, 1.5D AS d, array(1) AS a, array(named_struct('k', 'v')) AS st, map('a', 1) AS m,
                      timestamp'2024-01-01 00:00:00' AS ts, timestamp_ntz'2024-01-01 00:00:00' AS tn, date'2024-01-01' AS dt, 1.23BD AS de""")
    IO.write_parquet(df.coalesce(1), f"{base}/types")
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert IO.check_contract(spark, f"{base}/types", types) == []
    file = next(f for f in os.listdir(f"{base}/types") if f.endswith(".parquet"))
    assert len(IO.check_contract(spark, f"{base}/types/{file}", {**types, "i": "bigint"})) == 1
    foreign = IO.check_contract(spark, f"{SF}/lineitem.parquet", {"l_orderkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "l_shipdate": "timestamp_ntz"})
    assert foreign == []


def test_contract_ignores_hidden_files(spark, base):
    IO.write_parquet(spark.range(5), f"{base}/t")
    IO.write_parquet(spark.range(5).select(F.lit("x").alias("id")), f"{base}/t/_commits")
    assert IO.check_contract(spark, f"{base}/t", {"id": "bigint"}) == []
    assert FT.footers(spark, f"{base}/t").agg(F.sum("rows")).first()[0] == 5


def test_unknown_way_to_read_footers(spark, base):
    with pytest.raises(ValueError):
        FT.footers(spark, base, via="ftp")


def test_pipeline_stops_on_a_drifted_file(spark, base):
    food = load_food(spark, SF)
    IO.write_parquet(food.limit(50), f"{base}/raw/a")
    IO.write_parquet(food.limit(50).withColumn("nutriscore_score", F.lit("x")), f"{base}/raw/b")
    with pytest.raises(ValueError, match="nutriscore_score"):
        W.run_pipeline(food, VARIANT_A, out=f"{base}/gold", raw_path=f"{base}/raw", contract=IO.RAW_CONTRACT)


def test_command_line_checks_the_contract(spark, base):
    from larder.__main__ import main
    food = load_food(spark, SF)
    IO.write_parquet(food.withColumn("code", F.lit(1)), f"{base}/raw")
    with pytest.raises(ValueError, match="code"):
        main(["run", "--raw", f"{base}/raw", "--out", f"{base}/gold"])


def test_write_options_are_in_the_footers(spark, base):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    many = li
    for _ in range(6):
        many = many.unionByName(many)
    rows = IO.write_parquet(many.repartition(16), f"{base}/o", codec="gzip", row_group_bytes=64 << 10, file_bytes=2 << 20)
    f = FT.footers(spark, f"{base}/o").collect()
    assert sum(x.rows for x in f) == rows == many.count() and {c for x in f for c in x.codecs} == {"gzip"}
    assert max(x.max_group_bytes for x in f) <= 160 << 10 and sum(x.row_groups for x in f) > len(f)
    assert 2 <= len(f) <= 8
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") != str(2 << 20)


# ---- checksums ------------------------------------------------------------------------------------

def test_checksum_is_free_of_order_and_sees_changes(spark):
    df = spark.createDataFrame([(1, "a", None, [1, None], {"k": 1}), (2, None, "a", [], None), (2, None, "a", [], None)],
                               "i int, s string, t string, a array<int>, m map<string,int>").repartition(3)
    c = IO.content_checksum(df)
    assert c.rows == 3 and c == IO.content_checksum(df.orderBy(F.desc("i")).coalesce(1))
    assert c.digest != IO.content_checksum(df.dropDuplicates(["i"])).digest
    swapped = df.select("i", F.col("t").alias("s"), F.col("s").alias("t"), "a", "m")
    assert IO.content_checksum(swapped).digest != c.digest  # NULLs count with their place
    assert IO.content_checksum(df.withColumn("a", F.when(F.col("i") == 1, F.array(F.lit(None).cast("int"), F.lit(1))).otherwise(F.col("a")))).digest != c.digest
    assert IO.content_checksum(df.filter("i > 5")) == IO.Checksum(0, "0-0")


def test_landing_check_by_content(spark, base):
    food = load_food(spark, SF)
    path, landed = IO.land_checked(food, base, dated=False)
    assert landed == IO.content_checksum(food) and IO.verify_landing(spark, path, landed) == (True, landed.rows)
    IO.write_parquet(food.withColumn("quantity", F.when(F.col("code") == "1", "changed").otherwise(F.col("quantity"))), path + "2")
    assert IO.verify_landing(spark, path + "2", landed.rows) == (True, landed.rows)
    assert IO.verify_landing(spark, path + "2", landed) == (False, landed.rows)


# ---- partitions -----------------------------------------------------------------------------------

def day_rows(spark, day, values):
    return spark.createDataFrame([(day, v) for v in values], "day string, v int")


def test_rerun_of_one_day_replaces_that_day_only(spark, base):
    path, schema = f"{base}/days", day_rows(spark, "", []).schema
    two = day_rows(spark, "d1", [1, 2]).unionByName(day_rows(spark, "d2", [3])).unionByName(day_rows(spark, None, [9]))
    assert IO.overwrite_partitions(two, path, ["day"], "r1") == 4
    assert IO.overwrite_partitions(day_rows(spark, "d2", [4, 5]), path, ["day"], "r2") == 2
    read = lambda: sorted((r.day or "", r.v) for r in spark.read.schema(schema).parquet(path).collect())
    assert read() == [("", 9), ("d1", 1), ("d1", 2), ("d2", 4), ("d2", 5)]
    status = {r.partition: (r.run, r.rows, r.committed) for r in IO.partition_status(spark, path, ["day"], schema).collect()}
    assert status == {'{"day":"d1"}': ("r1", 2, True), '{"day":"d2"}': ("r2", 2, True), '{"day":null}': ("r1", 1, True)}
    broken = day_rows(spark, "d1", [7, 8]).withColumn("v", F.when(F.col("v") == 8, F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="stop"):
        IO.overwrite_partitions(broken, path, ["day"], "r3")
    assert read() == [("", 9), ("d1", 1), ("d1", 2), ("d2", 4), ("d2", 5)]


def test_rows_written_past_the_marker_are_not_committed(spark, base):
    path, schema = f"{base}/days", day_rows(spark, "", []).schema
    IO.overwrite_partitions(day_rows(spark, "d1", [1]).unionByName(day_rows(spark, "d2", [2])), path, ["day"], "r1")
    day_rows(spark, "d2", [6]).select("v").write.mode("append").parquet(f"{path}/day=d2")
    day_rows(spark, "d3", [6]).select("v").write.parquet(f"{path}/day=d3")
    got = {r.partition: r.committed for r in IO.partition_status(spark, path, ["day"], schema).collect()}
    assert got == {'{"day":"d1"}': True, '{"day":"d2"}': False, '{"day":"d3"}': False}


# ---- catalog and buckets --------------------------------------------------------------------------

def test_table_outlives_the_views(spark, base):
    name = "larder_kept_table"
    IO.materialize(spark.range(7), "table", name, f"{base}/kept")
    try:
        assert name in [t.name for t in spark.catalog.listTables() if not t.isTemporary]
        assert spark.newSession().table(name).count() == 7
        IO.materialize(spark.range(3), "table", name, f"{base}/kept")  # a rerun replaces it
        assert spark.table(name).count() == 3
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_bucketed_tables_join_and_group_without_exchange(spark, base):
    g = W.build_gold(load_food(spark, SF), VARIANT_A, f"{base}/gold")
    b = W.bucket_by_product(g, f"{base}/bucketed", 4, "larder_test")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = b["fact_nutrition"].join(b["dim_product"], "product_sk")
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
        assert "Exchange" in plan(g["fact_nutrition"].join(g["dim_product"], "product_sk"))
        share = K.pct_grade_a(b["fact_nutrition"], b["dim_product"])
        assert "hashpartitioning" not in plan(share)
        assert share.first() == K.pct_grade_a(g["fact_nutrition"], g["dim_product"]).first()
        assert joined.count() == g["fact_nutrition"].count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for t in ("fact_nutrition", "dim_product"):
            spark.sql(f"DROP TABLE IF EXISTS larder_test_a_{t}")


def test_run_with_buckets_and_silver_gives_the_same_tables(spark, base):
    food = load_food(spark, SF)
    plain = W.run_pipeline(food, VARIANT_A, out=f"{base}/plain")
    made = W.run_pipeline(food, VARIANT_A, out=f"{base}/made", silver=f"{base}/silver", buckets=3, prefix="larder_run")
    try:
        for name, df in plain.items():
            assert sorted(map(str, made[name].collect())) == sorted(map(str, df.collect())), name
        assert "larder_run_a_fact_nutrition" in [t.name for t in spark.catalog.listTables()]
        assert "stg_brands" in plan(W.DM.dim_brand(food, VARIANT_A, spark.read.parquet(f"{base}/silver/stg_brands")))
    finally:
        for t in ("fact_nutrition", "dim_product"):
            spark.sql(f"DROP TABLE IF EXISTS larder_run_a_{t}")


def test_audit_table_with_a_quote_in_its_path(spark, base):
    from larder.sources import audit as AU
    AU.log_run(spark, f"{base}/it's", "food", "gold/", 10)
    assert AU.audit_table(spark, "larder_quoted_audit", f"{base}/it's").count() == 1
    spark.sql("DROP TABLE larder_quoted_audit")


def test_typed_projection_takes_expressions_and_missing_columns(spark):
    df = spark.createDataFrame([("7", ["a", "b"])], "n string, tags array<string>")
    got = IO.project_typed(df, [("n", "int", "n"), (F.array_join("tags", ","), "string", "tags"), ("gone", "bigint", "gone")])
    assert got.first().asDict() == {"n": 7, "tags": "a,b", "gone": None} and dict(got.dtypes)["gone"] == "bigint"
