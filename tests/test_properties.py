"""Property tests against brute force, and the fact-grain invariant."""

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.config import DEFAULT, VARIANT_A, VARIANT_B
from larder.functions.nested import struct_lookup
from larder.operators.dedup import latest_per_key
from larder.plans import staging as S
from larder.plans import warehouse as W
from larder.sources.testdata import load_food

SF = "/root/testdata/sf0.001"
ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.one_of(st.none(), st.integers(0, 5)),
                          st.integers(0, 3)), min_size=1, max_size=25)


def _rank(t, v):
    # desc nulls last on t, then desc on v  ==  max of (t is not None, t, v)
    return (t is not None, t if t is not None else 0, v)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS)
def test_latest_per_key_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, t int, v int")
    got = {r.k: (r.t, r.v) for r in latest_per_key(df, "k", ["t"], payload=["t", "v"]).collect()}
    exp = {}
    for k, t, v in rows:
        if k not in exp or _rank(t, v) > _rank(*exp[k]):
            exp[k] = (t, v)
    assert got == exp


NUTS = st.lists(st.tuples(st.sampled_from(["fat", "salt", "sugars", None]),
                          st.one_of(st.none(), st.floats(0, 10, allow_nan=False))), max_size=5)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(arrays=st.lists(st.one_of(st.none(), NUTS), min_size=1, max_size=10))
def test_struct_lookup_is_first_match(spark, arrays):
    data = [([{"name": n, "100g": x} for n, x in a] if a is not None else None,) for a in arrays]
    df = spark.createDataFrame(data, "n array<struct<name:string,`100g`:double>>")
    got = [r[0] for r in df.select(struct_lookup("n", "name", "salt", "100g")).collect()]
    exp = [None if a is None else next((x for n, x in a if n == "salt"), None) for a in arrays]
    assert got == exp


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("v", [VARIANT_A, VARIANT_B, DEFAULT], ids=lambda v: v.name)
def test_fact_grain(spark, tmpdir_session, v):
    """Fact rows = country rows (distinct (product, country) unless the variant keeps duplicates),
    keys 1..N, and every product key resolves to a product of the dimension."""
    food = load_food(spark, SF)
    g = W.build_gold(food, v, f"{tmpdir_session}/grain-{v.name}")
    fact = g["fact_nutrition"]
    base = S.stg_countries(food, v)
    assert fact.count() == base.count()
    if v.country_distinct:
        assert base.count() == base.select("product_code", "country_tag").distinct().count()
    n = fact.count()
    assert fact.agg(F.min(v.fact_sk), F.max(v.fact_sk), F.count_distinct(v.fact_sk)).first() == (1, n, n)
    assert fact.join(g["dim_product"], "product_sk", "left_anti").count() == 0


BRAND_TEXT = st.one_of(st.none(), st.text(alphabet=" ,aBé", max_size=8))
TAGS = st.one_of(st.none(), st.lists(st.text(alphabet=" aB:-", max_size=5), max_size=3))


def _raw(spark, rows):
    from tests.test_models import raw
    return raw(spark, rows)


def _py_sentence(x):
    return None if x is None else x[:1].upper() + x[1:].lower()


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.sampled_from(["1", "2", None]), BRAND_TEXT, TAGS), min_size=1, max_size=8))
def test_brand_staging_matches_python(spark, rows):
    food = _raw(spark, [{"code": c, "brands": b, "brands_tags": t} for c, b, t in rows])
    def key(t):
        return tuple((v is None, v or "") for v in t)

    got_a = sorted(((r.product_code, r.brand_tag, r.brand_name) for r in S.stg_brands(food, VARIANT_A).collect()),
                   key=key)
    exp_a = []
    for c, b, t in rows:
        if c is None or b is None or b == "":
            continue
        tag = t[0].strip().lower() if t else None
        exp_a.append((c, tag, _py_sentence(b.split(",")[0].strip())))
    assert got_a == sorted(exp_a, key=key)
    got_b = {r.product_code: (r.brand_name, r.brand_tag) for r in S.stg_brands(food, VARIANT_B).collect()}
    exp_b = {}
    for c, b, t in rows:
        name = None if b is None else b.split(",")[0].strip().upper()
        if c is None or not name:
            continue
        tag = t[0].strip().lower() if t else None
        n0, t0 = exp_b.get(c, (None, None))
        exp_b[c] = (max(x for x in (n0, name) if x is not None),
                    max((x for x in (t0, tag) if x is not None), default=None))
    assert got_b == exp_b


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.sampled_from(["1", "2", None]), TAGS), min_size=1, max_size=8))
def test_country_staging_matches_python(spark, rows):
    food = _raw(spark, [{"code": c, "countries_tags": t} for c, t in rows])
    got_a = sorted(tuple(r) for r in S.stg_countries(food, VARIANT_A).collect())
    exp_a = sorted((c, x.strip()) for c, t in rows if c is not None and t for x in t if x)
    assert got_a == exp_a
    got_b = sorted(tuple(r) for r in S.stg_countries(food, VARIANT_B).collect())
    exp_b = sorted({(c, x.strip().lower()) for c, t in rows if c is not None and t for x in t
                    if x.strip().lower() != ""})
    assert got_b == exp_b


CAT_TAGS = st.one_of(st.none(), st.lists(st.text(alphabet=" aB:-x", max_size=7), max_size=2))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.sampled_from(["1", "2", None]), CAT_TAGS, BRAND_TEXT), min_size=1, max_size=8))
def test_category_staging_matches_python(spark, rows):
    import re
    food = _raw(spark, [{"code": c, "categories_tags": t, "categories": txt} for c, t, txt in rows])

    def initcap(x):
        return " ".join(w[:1].upper() + w[1:].lower() for w in x.split(" "))

    got_a = sorted((tuple(r) for r in S.stg_categories(food, VARIANT_A).collect()),
                   key=lambda t: tuple((v is None, v or "") for v in t))
    exp_a = []
    for c, t, txt in rows:
        if c is None or t is None:
            continue
        tag = t[0].strip().lower() if t else None
        exp_a.append((c, tag, _py_sentence(None if txt is None else txt.split(",")[0].strip())))
    assert got_a == sorted(exp_a, key=lambda t: tuple((v is None, v or "") for v in t))
    got_b = {r.product_code: (r.category_tag, r.category_name) for r in S.stg_categories(food, VARIANT_B).collect()}
    exp_b = {}
    for c, t, _ in rows:
        tag = t[0].strip() if t else None
        if c is None or not tag:
            continue
        name = initcap(re.sub("^..:", "", tag).replace("-", " "))
        t0, n0 = exp_b.get(c, (tag, name))
        exp_b[c] = (max(t0, tag), max(n0, name))
    assert got_b == exp_b


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(secs=st.lists(st.integers(0, 2_000_000_000), min_size=1, max_size=12))
def test_date_attributes_match_python(spark, secs):
    import datetime as dt
    from larder.functions.dates import FRENCH_MONTHS
    food = _raw(spark, [{"code": str(i), "last_modified_t": s} for i, s in enumerate(secs)])
    got = {r.product_code: (r.date_sk, r.day_of_week, r.decade, r.month_name, r.is_weekend)
           for r in S.stg_date(food, VARIANT_A).collect()}
    exp = {}
    for i, s in enumerate(secs):
        d = dt.datetime.fromtimestamp(s, dt.timezone.utc).date()
        exp[str(i)] = (d.year * 10000 + d.month * 100 + d.day, d.isoweekday(), d.year // 10 * 10,
                       FRENCH_MONTHS[d.month - 1], d.isoweekday() >= 6)
    assert got == exp
    got_b = {r.product_code: r.day_of_week for r in S.stg_date(food, VARIANT_B).collect()}
    assert got_b == {str(i): dt.datetime.fromtimestamp(s, dt.timezone.utc).date().isoweekday() % 7 + 1
                     for i, s in enumerate(secs)}


NUT_ROW = st.tuples(st.sampled_from(["1", "2"]), st.one_of(st.none(), st.integers(0, 3)),
                    st.lists(st.tuples(st.sampled_from(["salt", "fat"]),
                                       st.one_of(st.none(), st.floats(0, 5, allow_nan=False))), max_size=3))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(NUT_ROW, min_size=1, max_size=8))
def test_nutrition_models_match_python(spark, rows):
    food = _raw(spark, [{"code": c, "last_modified_t": t, "nutriments": [{"name": n, "100g": x} for n, x in nut]}
                        for c, t, nut in rows])

    def first(nut, name):
        return next((x for n, x in nut if n == name), None)

    per_row = [(c, t, first(nut, "salt"), first(nut, "fat")) for c, t, nut in rows]
    got_a = {r.product_code: (r.salt_100g, r.fat_100g, r.last_modified_t)
             for r in S.stg_nutrition(food, VARIANT_A).collect()}
    exp_a = {}
    for c in {r[0] for r in per_row}:
        mine = [r for r in per_row if r[0] == c]

        def mx(vals):
            vals = [v for v in vals if v is not None]
            return max(vals) if vals else None
        exp_a[c] = (mx(r[2] for r in mine), mx(r[3] for r in mine), mx(r[1] for r in mine))
    assert got_a == exp_a

    def rank(r):
        # last_modified_t desc nulls last, then the measures in column order (energy, fat, saturated, sugars,
        # salt, ...), NULLs lowest; only fat and salt vary here
        return (r[1] is not None, r[1] or 0, r[3] is not None, r[3] or 0.0, r[2] is not None, r[2] or 0.0)
    got_b = {r.product_code: (r.salt_g, r.fat_g) for r in S.stg_nutrition(food, VARIANT_B).collect()}
    exp_b = {}
    for r in per_row:
        if r[0] not in exp_b or rank(r) > rank(exp_b[r[0]]):
            exp_b[r[0]] = r
    assert got_b == {c: (r[2], r[3]) for c, r in exp_b.items()}


PROD_ROW = st.tuples(st.sampled_from(["10", "9", "100"]), st.one_of(st.none(), st.integers(0, 2)),
                     st.sampled_from(["a", "b", "unknown", None]), st.sampled_from(["X", "y", None]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(PROD_ROW, min_size=1, max_size=8))
def test_dim_product_rule_matches_python(spark, rows):
    from larder.plans import dims as DM
    food = _raw(spark, [{"code": c, "last_modified_t": t, "nutriscore_grade": g,
                         "product_name": None if n is None else [{"lang": "main", "text": n}]}
                        for c, t, g, n in rows])
    got = {r.product_code: (r.product_sk, r.product_name, r.nutriscore_grade)
           for r in DM.dim_product(food, VARIANT_A).collect()}

    def rank(r):
        grade = r[2] if r[2] in ("a", "b", "c", "d", "e") else None
        return (r[1] is not None, r[1] or 0, r[3] is not None, r[3] or "", grade is not None, grade or "")
    best = {}
    for r in rows:
        if r[0] not in best or rank(r) > rank(best[r[0]]):
            best[r[0]] = r
    exp = {}
    for i, code in enumerate(sorted(best)):
        r = best[code]
        exp[code] = (i + 1, r[3], r[2] if r[2] in ("a", "b", "c", "d", "e") else None)
    assert got == exp


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(vals=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.sampled_from(["a", "b", None])),
                     min_size=1, max_size=40),
       parts=st.integers(1, 5), desc=st.booleans())
def test_surrogate_key_matches_row_number(spark, vals, parts, desc):
    from pyspark.sql import Window
    from larder.operators.keys import sort_spec, surrogate_key
    df = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(vals)], "a int, b string, i int")
    order = [sort_spec("a", descending=desc), sort_spec("b"), sort_spec("i")]
    got = surrogate_key(df, order, "sk", partitions=parts)
    exp = df.withColumn("sk", F.row_number().over(Window.orderBy(*[o.order() for o in order])).cast("bigint"))
    assert sorted(tuple(r) for r in got.select("sk", "i").collect()) == \
        sorted(tuple(r) for r in exp.select("sk", "i").collect())
