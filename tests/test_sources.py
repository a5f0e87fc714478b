"""Sources, sinks, audit log and the whole run order."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from larder.config import VARIANT_A, VARIANT_B
from larder.plans import warehouse as W
from larder.sources import audit as AU
from larder.sources import documents as DOC
from larder.sources import io as IO
from larder.sources.testdata import food_path, load_food

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_write_layer_counts_and_reads_back(spark, tmpdir_session):
    part = spark.read.parquet(f"{SF}/part.parquet")
    n = IO.write_layer(part, tmpdir_session, "silver", "part")
    assert n == part.count() == IO.read_layer(spark, tmpdir_session, "silver", "part").count()


def test_write_parquet_options(spark, tmpdir_session):
    part = spark.read.parquet(f"{SF}/part.parquet")
    path = f"{tmpdir_session}/part_opts"
    IO.write_parquet(part, path, codec="uncompressed", row_group_bytes=1 << 20, max_records=50)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) >= part.count() // 50
    assert spark.read.parquet(path).exceptAll(part).count() == 0


def test_read_paths_keeps_source(spark):
    df = IO.read_paths(spark, [f"{SF}/nation.parquet", f"{SF}/region.parquet"], merge_schema=True)
    got = {r.source_file: r.n for r in df.groupBy("source_file").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"nation.parquet": 25, "region.parquet": 5}


def test_typed_projection_nulls_bad_values(spark):
    df = spark.createDataFrame([("12",), (" 7 ",), ("x",), (None,), ("99999999999",)], "s string")
    got = [r.v for r in IO.project_typed(df, [("s", "int", "v")]).collect()]
    assert got == [12, 7, None, None, None]


def test_fan_out_and_landing(spark, tmpdir_session):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    n = IO.fan_out(ev, [("parquet", f"{tmpdir_session}/fo/p", None), ("json", f"{tmpdir_session}/fo/j", None)])
    back = spark.read.schema(ev.schema).options(**IO.JSON_OPTIONS).json(f"{tmpdir_session}/fo/j")
    assert n == ev.count() and back.exceptAll(ev).count() == 0
    path, rows = IO.land_raw(ev, f"{tmpdir_session}/land", run_date=dt.date(2024, 6, 10))
    assert path.endswith("/food/food_20240610.parquet")
    assert IO.verify_landing(spark, path, rows) == (True, rows)


def test_documents_export(spark, tmpdir_session):
    food = load_food(spark, SF)
    docs = DOC.document_subset(food, n=50, max_energy=900)
    n = DOC.export_documents(docs, f"{tmpdir_session}/docs", records_per_file=20)
    back = DOC.read_documents(spark, f"{tmpdir_session}/docs", docs.schema)
    assert n == min(50, DOC.document_subset(food, max_energy=900).count())
    assert back.exceptAll(docs).count() == 0
    assert back.filter(F.col("energy_kcal") > 900).count() == 0


def test_audit_append_twice(spark, tmpdir_session):
    path = f"{tmpdir_session}/audit"
    AU.log_run(spark, path, "food", "gold/", 10, "SUCCESS", when=dt.datetime(2024, 1, 1, 12, 0, 0))
    AU.log_run(spark, path, "food", "gold/", 11, "FAILED", prefix="GOLD", when=dt.datetime(2024, 1, 2, 12, 0, 0))
    rows = sorted(AU.read_audit(spark, path).collect(), key=lambda r: r.run_id)
    assert [r.run_id for r in rows] == ["GOLD_20240102_120000", "PL_20240101_120000"]
    t = AU.audit_table(spark, "audit_log_test", path)
    assert t.count() == 2


def test_materialize_and_sql(spark, tmpdir_session):
    part = spark.read.parquet(f"{SF}/part.parquet")
    IO.materialize(part, "table", "part_t", f"{tmpdir_session}/part_t")
    got = IO.run_sql(spark, "SELECT count(*) AS n FROM part_t WHERE p_size > :s", s=10).first().n
    assert got == part.filter("p_size > 10").count()
    assert [c for c, *_ in IO.schema_diff(part, {"p_size": "int", "nope": "int"})] == ["p_size", "nope"]


@pytest.mark.parametrize("v", [VARIANT_A, VARIANT_B], ids=lambda v: v.name)
def test_run_pipeline_writes_everything_and_audits(spark, tmpdir_session, v):
    food = load_food(spark, SF)
    out = f"{tmpdir_session}/run-{v.name}"
    res = W.run_pipeline(food, v, out=out, audit_path=f"{out}/pipeline_logs")
    for name in ["dim_product", "dim_brand", "dim_category", "dim_country", "dim_date", "fact_nutrition",
                 "kpi_mean_score", "quality_report"]:
        assert name in res and spark.read.parquet(f"{out}/{name}").count() == res[name].count()
    assert sorted(x for x in os.listdir(out) if not x.startswith(".")) == sorted([*res, "pipeline_logs"])
    with pytest.raises(ValueError, match="contract"):
        W.run_pipeline(food, v, raw_path=food_path(spark, SF), contract={"code": "bigint"})
    report = {(r.table_name, r.check_name, r.column_name): r.violations for r in res["quality_report"].collect()}
    fact = res["fact_nutrition"]
    assert report[("fact_nutrition", "not_null", "category_sk")] == fact.filter("category_sk IS NULL").count()
    assert report[("fact_nutrition", "unique", v.fact_sk)] == 0
    audit = AU.read_audit(spark, f"{out}/pipeline_logs").collect()
    assert len(audit) == 1 and audit[0].statut == "FAILED" and audit[0].nb_lignes_output == fact.count()


def test_command_line_land_and_run(spark, tmpdir_session, capsys):
    import json

    from larder.__main__ import main
    src = f"{tmpdir_session}/cli_food"
    load_food(spark, SF).write.mode("overwrite").parquet(src)
    assert main(["land", "--source", src, "--base", f"{tmpdir_session}/cli_raw", "--fixed-name"]) == 0
    landed = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert landed["verified"] and landed["path"].endswith("/food.parquet")
    assert main(["run", "--raw", landed["path"], "--out", f"{tmpdir_session}/cli_gold", "--variant", "b"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["failed_checks"] > 0   # NULL foreign keys in the test data, as in the source
    assert spark.read.parquet(f"{tmpdir_session}/cli_gold/kpi_mean_score").count() > 0


def test_read_paths_skips_blank_entries(spark):
    df = IO.read_paths(spark, [f"{SF}/region.parquet", "", "  "])
    assert df.count() == 5


def test_run_pipeline_writes_silver(spark, tmpdir_session):
    from larder.plans.warehouse import silver_tables
    food = load_food(spark, SF)
    out = f"{tmpdir_session}/silver-run"
    res = W.run_pipeline(food, VARIANT_B, out=f"{out}/gold", silver=f"{out}/silver")
    for name, df in silver_tables(food, VARIANT_B).items():
        back = spark.read.parquet(f"{out}/silver/{name}")
        assert back.count() == df.count() and back.exceptAll(df).count() == 0
    assert res["fact_nutrition"].count() > 0
