"""Plan properties the design relies on (read from the formatted physical plan)."""

import os

import pytest
from pyspark.sql import functions as F

from larder.config import VARIANT_A, VARIANT_B
from larder.plans import dims as DM
from larder.plans import staging as S
from larder.plans import warehouse as W
from larder.sources.testdata import load_food

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString() + df._sc._jvm.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")


def test_code_filter_pushed_and_nutrients_pruned(spark):
    p = plan(S.stg_nutrition(load_food(spark, SF), VARIANT_B))
    assert "IsNotNull(code)" in p
    assert "nutriments:array<struct<name:string,100g:double>>" in p
    assert "categories_tags" not in p.split("ReadSchema")[1].split("\n")[0]


def test_product_summary_is_one_partial_aggregation(spark):
    p = plan(DM.product_summary(load_food(spark, SF), VARIANT_A))
    assert p.count("Exchange hashpartitioning") == 1 or p.count("Exchange (") == 1
    assert "partial_max" in p
    assert "Window" not in p


def test_latest_row_is_not_a_window(spark):
    p = plan(S.stg_nutrition(load_food(spark, SF), VARIANT_B))
    assert "Window" not in p and "partial_max" in p


def test_fact_has_no_range_sort_and_no_global_window(spark, tmpdir_session):
    from larder.plans import fact as FT
    food = load_food(spark, SF)
    g = W.build_gold(food, VARIANT_A, f"{tmpdir_session}/plan-gold")
    dims = {"product_wide": g["product_wide"], "brand": g["dim_brand"], "category": g["dim_category"],
            "country": g["dim_country"], "date": g["dim_date"]}
    p = plan(FT.fact_nutrition(food, VARIANT_A, dims))
    assert "rangepartitioning" not in p.lower()
    # the only single-partition step is the running sum over one row per bucket of products
    assert p.count("Arguments: SinglePartition") <= 1
    assert FT.fact_nutrition(food, VARIANT_A, dims).count() == g["fact_nutrition"].count()


def test_fact_keys_across_buckets(spark, tmpdir_session, monkeypatch):
    from larder.plans import fact as FT
    monkeypatch.setattr(FT, "BUCKET", 7)
    g = W.build_gold(load_food(spark, SF), VARIANT_B, f"{tmpdir_session}/bucket-gold")
    rows = g["fact_nutrition"].select("nutrition_fact_sk", "product_sk", "country_sk").collect()
    assert sorted(r.nutrition_fact_sk for r in rows) == list(range(1, len(rows) + 1))
    assert [r.nutrition_fact_sk for r in sorted(rows, key=lambda r: (r.product_sk, r.country_sk))] == list(range(1, len(rows) + 1))
    assert g["fact_nutrition"].columns[:10] == ["nutrition_fact_sk", "product_sk", "category_sk", "brand_sk", "country_sk",
                                                 "date_sk", "energy_kcal", "fat_g", "salt_g", "nutriscore_score"]


def test_small_dimensions_are_broadcast_by_the_optimiser(spark, tmpdir_session):
    g = W.build_gold(load_food(spark, SF), VARIANT_A, f"{tmpdir_session}/kpi-gold")
    # their written size decides, no hint does
    k2 = plan(W.kpis(g)["kpi_mean_score"])
    assert k2.count("BroadcastHashJoin") >= 4


def test_run_status_runs_the_checks_once(spark, monkeypatch):
    from larder import catalog
    runs = spark.sparkContext.accumulator(0)

    def seen(n):
        runs.add(1)
        return n

    rows = F.udf(seen, "long")
    monkeypatch.setattr(catalog, "dq_report", lambda spark, sf: spark.range(3).select(rows("id").alias("violations")).withColumn("passed", F.col("violations") < 2))
    assert [tuple(r) for r in catalog.run_status(spark, SF).collect()] == [(1, "FAILED")]
    assert runs.value == 3


def test_lines_are_reduced_to_parts_in_one_exchange(spark, tmp_path):
    from larder.sources.testdata import part_countries
    nations = [(n, f"N_{n:03d}" if n % 50 else None) for n in range(130)] + [(7, "N_007"), (None, "NOWHERE")]  # more than the bits of two numbers
    supplier = [(s, s if s < 130 else None) for s in range(131)]
    line = [(p, s, p * 1000 + s) for p in range(1, 6) for s in range(0, 131, p)] + [(9, 130, 5), (None, 1, 5)]
    for name, rows, schema in (("nation", nations, "n_nationkey int, n_name string"), ("supplier", supplier, "s_suppkey long, s_nationkey int"), ("lineitem", line, "l_partkey long, l_suppkey long, t long")):
        df = spark.createDataFrame(rows, schema)
        if name == "lineitem":
            df = df.select("l_partkey", "l_suppkey", F.timestamp_seconds("t").cast("timestamp_ntz").alias("l_shipdate"))
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    got = part_countries(spark, str(tmp_path))
    assert got._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(l_partkey") == 1
    tag = {n: f"en:n-{n:03d}" for n in range(130) if n % 50}
    for r in got.filter("l_partkey IS NOT NULL").collect():
        mine = [s for p, s, _ in line if p == r.l_partkey and s < 130]
        assert r.tags == sorted([tag[s] for s in mine if s in tag] + [tag[7]] * (7 in mine)) and r.t == r.l_partkey * 1000 + max(mine)
    assert sorted(r.l_partkey for r in got.filter("l_partkey IS NOT NULL").collect()) == [1, 2, 3, 4, 5]


def test_country_rows_are_ranked_narrow_and_not_broadcast(spark, tmpdir_session):
    from larder.plans.fact import fact_nutrition
    food = load_food(spark, SF)
    g = W.build_gold(food, VARIANT_A, f"{tmpdir_session}/rank-gold")
    dims = {"product_wide": g["product_wide"], "brand": g["dim_brand"], "category": g["dim_category"], "country": g["dim_country"], "date": g["dim_date"]}
    fact = fact_nutrition(food, VARIANT_A, dims, countries=S.stg_countries(food, VARIANT_A))
    text = plan(fact)
    assert text.index("SortMergeJoin") < text.index("row_number")  # the window lies below the join
    columns = g["fact_nutrition"].columns
    assert sorted(map(str, fact.select(columns).collect())) == sorted(map(str, g["fact_nutrition"].select(columns).collect()))
