"""Operators: dedup, surrogate keys, top-n, joins, metrics, quality checks."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from larder.operators import keys as K
from larder.operators import quality as Q
from larder.operators.dedup import collapse_max, first_nonnull, latest_per_key
from larder.operators.joins import lookup
from larder.operators.metrics import pct_nonnull, pct_where


def test_latest_per_key_nulls_last_and_ties(spark):
    df = spark.createDataFrame([("p", 100, 1.0), ("p", 200, 2.0), ("p", None, 3.0),
                                ("q", 5, 1.0), ("q", 5, 7.0), ("r", None, 1.0), ("r", None, 4.0)],
                               "k string, t bigint, v double")
    got = {r.k: (r.t, r.v) for r in latest_per_key(df, "k", ["t"]).collect()}
    assert got == {"p": (200, 2.0), "q": (5, 7.0), "r": (None, 4.0)}


def test_collapse_max_and_first_nonnull(spark):
    df = spark.createDataFrame([("a", "x", None), ("a", "y", "t2"), ("a", None, "t1")], "k string, n string, t string")
    assert collapse_max(df, "k", ["n", "t"]).first().asDict() == {"k": "a", "n": "y", "t": "t2"}
    assert first_nonnull(df, "k", "t").first()["t"] == "t1"


def _rownumber(df, order, name):
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_surrogate_key_equals_global_row_number(spark, parts):
    rnd = random.Random(parts)
    rows = [(rnd.choice([None, *range(40)]), f"s{rnd.randrange(500)}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b string, id int").repartition(5)
    order = [K.sort_spec("a"), K.sort_spec("b", descending=True), K.sort_spec("id")]
    got = K.surrogate_key(df, order, "sk", partitions=parts)
    exp = _rownumber(df, [o.order() for o in order], "sk")
    assert got.count() == 3000
    assert got.select("sk", "a", "b", "id").exceptAll(exp.select("sk", "a", "b", "id")).count() == 0


def test_surrogate_key_with_ties_and_hot_key(spark):
    # one value holds a third of the rows; ties are numbered consecutively
    rows = [("hot" if i % 3 == 0 else f"k{i:05d}",) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string")
    got = K.surrogate_key(df, ["k"], "sk", unique=False, partitions=6)
    assert sorted(r.sk for r in got.collect()) == list(range(1, 3001))
    hot = got.filter("k = 'hot'").agg(F.min("sk"), F.max("sk")).first()
    assert hot[1] - hot[0] + 1 == 1000
    exp = _rownumber(df, ["k"], "sk")
    assert got.select("k", "sk").exceptAll(exp.select("k", "sk")).filter("k != 'hot'").count() == 0


def test_surrogate_key_unfolds_equal_rows_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(K, "CHUNK", 7)
    rows = [("hot", 1)] * 100 + [(None, 2)] * 9 + [("a", k % 5) for k in range(20)]
    got = K.surrogate_key(spark.createDataFrame(rows, "k string, v int").repartition(5), ["k"], "sk", unique=False).collect()
    assert sorted(r.sk for r in got) == list(range(1, 130))
    assert sorted((r.k or "", r.v) for r in got) == sorted((k or "", v) for k, v in rows)
    assert max(r.sk for r in got if r.k is None) == 9 and min(r.sk for r in got if r.k == "hot") == 30


def test_surrogate_key_moves_wide_rows_once_and_writes_keys_only(spark):
    df = spark.range(2000).select("id", F.repeat(F.lit("x"), 500).alias("wide"))
    got = K.surrogate_key(df.repartition(3), ["id"], "sk")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan.split("Join")[0] and "ExistingRDD" not in plan and "RDDScan" not in plan
    # what is read back is the narrow table of keys
    assert [ln for ln in plan.splitlines() if "parquet" in ln] and not [ln for ln in plan.splitlines() if "parquet" in ln and "wide" in ln]


@pytest.mark.parametrize("n", [1, 37, 400, 900, 2000])
@pytest.mark.parametrize("desc", [False, True])
def test_top_n_by_counting(spark, monkeypatch, n, desc):
    """Small samples force several rounds; a key with a third of the rows; NULLs; ties cut inside a key."""
    for name, value in (("SAMPLE", 12), ("CUTS", 4), ("SLACK", 5)):
        monkeypatch.setattr(K, name, value)
    rnd = random.Random(n)
    rows = [("hot" if rnd.random() < 0.3 else rnd.choice([None, *"abcdefghijklmnopqrstuvwxyz"]), rnd.randrange(50), rnd.randrange(3)) for _ in range(1000)]
    df = spark.createDataFrame(rows, "k string, b int, c int").repartition(4)
    order = [K.sort_spec("k", descending=desc, nulls_last=True)]
    got = K.top_n(df, order, n)
    want = df.orderBy(order[0].order(), F.col("b").asc_nulls_last(), F.col("c").asc_nulls_last()).limit(n)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_cut_value_keeps_about_n_rows(spark):
    df = spark.range(300_000).select(((F.col("id") * 7919) % 300_007).alias("k"))
    key, below, upto = K.cut_value(df, [K.sort_spec("k")], 100, slack=200)
    rows = below if upto is None else upto
    assert 100 <= rows <= 300
    assert df.filter(F.col("k") < key[0]).count() == below


def test_top_n(spark):
    df = spark.createDataFrame([(i % 50, i) for i in range(1000)], "a int, b int")
    exp = {(a, b) for a, b in sorted([(i % 50, i) for i in range(1000)])[:30]}
    assert {tuple(r) for r in K.top_n(df, ["a"], 30).collect()} == exp


def test_lookup_spreads_null_keys(spark):
    f = spark.createDataFrame([(1, "x"), (2, None), (3, None)], "id int, tag string")
    d = spark.createDataFrame([("x", 10)], "t string, sk int")
    plan = lookup(f, d, ("tag", "t"), ["sk"], spread="id")
    assert sorted((r.id, r.tag, r.sk) for r in plan.collect()) == [(1, "x", 10), (2, None, None), (3, None, None)]
    assert "broadcast" not in plan._jdf.queryExecution().logical().toString().lower()


def test_lookup_keeps_left_rows(spark):
    f = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, tag string")
    d = spark.createDataFrame([("x", 10), ("z", 30)], "tag string, sk int")
    got = sorted(lookup(f, d, "tag", ["sk"]).collect(), key=lambda r: r.id)
    assert [(r.id, r.tag, r.sk) for r in got] == [(1, "x", 10), (2, "y", None), (3, None, None)]


def test_percentages_on_empty_input(spark):
    e = spark.createDataFrame([], "g string, s int")
    row = e.agg(pct_where(F.col("g") == "a", "g").alias("p"), pct_nonnull("s").alias("c")).first()
    assert row.p is None and row.c is None


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, -1.0, -16, "a"), (1, 0.5, -15, "z"), (None, -0.1, 40, None), (2, 1.0, 41, "b")],
                               "sk int, salt double, score int, grade string")
    report = Q.run_checks(df, [Q.not_null("sk"), Q.unique("sk"), Q.Check("unique", "sk", mode="rows", label="u_rows"),
                               Q.at_least("salt", 0), Q.in_range("score", -15, 40),
                               Q.accepted_values("grade", "abcde", where="grade IS NOT NULL")], "t")
    got = {(r.check_name, r.column_name): (r.violations, r.passed) for r in report.collect()}
    assert got == {("not_null", "sk"): (1, False), ("unique", "sk"): (1, False), ("u_rows", "sk"): (1, False),
                   ("positive_values", "salt"): (2, False), ("accepted_range", "score"): (2, False),
                   ("accepted_values", "grade"): (1, False)}
    assert Q.status(report) == "FAILED"
    ok = Q.run_checks(spark.createDataFrame([(1,), (2,)], "sk int"), [Q.unique("sk"), Q.not_null("sk")], "t")
    assert Q.status(ok) == "SUCCESS"


def test_quality_checks_take_one_scan_and_one_grouping(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, None, "x"), (1, 2, "x"), (None, None, "y"), (None, 2, "y"), (3, 2, None)], "a int, b int, c string").write.parquet(path)
    df = spark.read.parquet(path)
    checks = [Q.unique("a"), Q.Check("unique", "a", mode="rows", label="a_rows"), Q.unique("a,b"), Q.Check("unique", "a,b", mode="rows", label="ab_rows"),
              Q.unique("c"), Q.Check("unique", "b", where="c = 'x'", label="b_of_x"), Q.not_null("a"), Q.at_least("b", 3)]
    report = Q.run_checks(df, checks, "t")
    got = {r.check_name + ":" + r.column_name: r.violations for r in report.collect()}
    assert got == {"unique:a": 1, "a_rows:a": 2, "unique:a,b": 0, "ab_rows:a,b": 0, "unique:c": 2, "b_of_x:b": 0, "not_null:a": 2, "positive_values:b": 3}
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 2 and plan.count("hashpartitioning") <= 2  # AQE prints the plan twice at most
    empty = {r.check_name + ":" + r.column_name: r.violations for r in Q.run_checks(df.limit(0), checks, "t").collect()}
    assert set(empty.values()) == {0}


def test_quality_keys_are_grouped_as_typed_columns(spark):
    df = spark.createDataFrame([(1, 2, -1), (1, 2, 5), (2, 1, -3), (None, 1, -1), (None, 1, None)], "a bigint, b int, c int")
    checks = [Q.unique("a,b"), Q.Check("unique", "b,a", mode="rows", label="swapped"), Q.at_least("c", 0), Q.not_null("a"), Q.not_null("c")]
    report = Q.run_checks(df, checks, "t")
    assert [r.violations for r in report.collect()] == [1, 2, 3, 2, 1]
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    # no text of a key, and a key's group carries one count: the row-level checks are a grouping set of their own
    assert "to_json" not in plan and "structstojson" not in plan.lower() and plan.count("Expand") == 1
    many = [Q.at_least("c", k) for k in range(-70, 70)]
    assert [r.violations for r in Q.run_checks(df, many, "t").collect()] == [sum(c is not None and c < k for c in (-1, 5, -3, -1, None)) for k in range(-70, 70)]


def test_quality_keys_do_not_run_together(spark):
    df = spark.createDataFrame([("a,b", "c"), ("a", "b,c"), (None, "x"), ("null", "x")], "p string, q string")
    got = {r.check_name: r.violations for r in Q.run_checks(df, [Q.unique("p,q"), Q.Check("unique", "p,q", mode="rows", label="rows")]).collect()}
    assert got == {"unique": 0, "rows": 0}


def test_bitmaps_count_exactly_and_merge(spark):
    from larder.operators.metrics import bitmap_counts, key_bitmaps, merge_bitmaps
    rnd = random.Random(3)
    rows = [(rnd.choice("xyz"), rnd.randrange(4), rnd.choice([None, *range(1, 400), 32768, 32769, 65536, 65537, 10**10])) for _ in range(5000)]
    df = spark.createDataFrame(rows, "g string, m int, k bigint").repartition(4)
    fine = key_bitmaps(df, "k", ["g", "m"])
    for cols, got in ((["g", "m"], bitmap_counts(fine, ["g", "m"])), (["g"], bitmap_counts(merge_bitmaps(fine, ["g"]), ["g"])), ([], bitmap_counts(merge_bitmaps(fine)))):
        want = df.groupBy(*cols).agg(F.count_distinct("k").alias("n"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert bitmap_counts(key_bitmaps(df.filter("k < 0"), "k")).first()[0] == 0


def test_dedup_keeps_whole_rows_and_the_same_ones(spark):
    from larder.operators.dedup import dedup
    rows = [(k % 7, k, f"v{k}", [k]) for k in range(200)] + [(None, 1, None, None), (None, 2, "z", [])]
    df = spark.createDataFrame(rows, "k int, n int, s string, a array<int>")
    once = sorted(map(str, dedup(df.repartition(5), ["k"]).collect()))
    assert once == sorted(map(str, dedup(df.orderBy(F.desc("n")).coalesce(1), ["k"]).collect())) and len(once) == 8
    assert set(once) <= set(map(str, df.collect()))
    chosen = [r.n for r in dedup(df.filter("k IS NOT NULL"), ["k"]).collect()]
    assert any(n >= 7 for n in chosen) and any(n < 193 for n in chosen)  # neither all first nor all last


def test_lookup_spreads_null_keys_of_any_type(spark):
    f = spark.createDataFrame([(1, 5), (2, None), (3, None), (None, None)], "id int, k int")
    d = spark.createDataFrame([(5, "five"), (None, "never")], "k bigint, name string")
    got = {(r.id, r.k): r.name for r in lookup(f, d, "k", ["name"], spread="id").collect()}
    assert got == {(1, 5): "five", (2, None): None, (3, None): None, (None, None): None}


def test_surrogate_key_adaptive_partitions(spark):
    rnd = random.Random(7)
    rows = [(rnd.randrange(10_000), rnd.choice("xyz")) for _ in range(5000)]
    df = spark.createDataFrame(rows, "a int, b string")
    got = K.surrogate_key(df, ["a", "b"], "sk", unique=False)
    assert sorted(r.sk for r in got.collect()) == list(range(1, 5001))
    exp = _rownumber(df, ["a", "b"], "sk")
    # ties (equal a, b) may swap numbers between identical rows only
    assert got.select("a", "b", "sk").exceptAll(exp.select("a", "b", "sk")).count() == 0
