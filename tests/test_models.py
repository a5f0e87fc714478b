"""Staging, dimension and fact rules on hand-made raw rows (FIXTURES.md section 3)."""

import pytest

from larder.config import DEFAULT, VARIANT_A, VARIANT_B
from larder.plans import dims as DM
from larder.plans import staging as S
from larder.plans import warehouse as W
from larder.sources.io import RAW_FOOD_SCHEMA


def raw(spark, rows):
    base = {"code": None, "product_name": None, "nutriscore_grade": None, "nutriscore_score": None,
            "nova_group": None, "environmental_score_grade": None, "quantity": None, "brands": None,
            "brands_tags": None, "categories": None, "categories_tags": None, "countries_tags": None,
            "last_modified_t": None, "nutriments": None}
    return spark.createDataFrame([{**base, **r} for r in rows], RAW_FOOD_SCHEMA)


def test_brands_variants(spark):
    food = raw(spark, [
        {"code": "1", "brands": " Nutella , Ferrero", "brands_tags": ["en:nutella"]},
        {"code": "2", "brands": ""}, {"code": "3"},
        {"code": "4", "brands": " , x", "brands_tags": ["X"]},
        {"code": None, "brands": "Ghost"}])
    a = {r.product_code: r.brand_name for r in S.stg_brands(food, VARIANT_A).collect()}
    b = {r.product_code: r.brand_name for r in S.stg_brands(food, VARIANT_B).collect()}
    assert a == {"1": "Nutella", "4": ""}
    assert b == {"1": "NUTELLA"}


def test_countries_variants(spark):
    food = raw(spark, [{"code": "1", "countries_tags": [" EN:France", "en:france", "  "]},
                       {"code": "2", "countries_tags": []}, {"code": "3"}])
    a = sorted(tuple(r) for r in S.stg_countries(food, VARIANT_A).collect())
    b = sorted(tuple(r) for r in S.stg_countries(food, VARIANT_B).collect())
    assert a == [("1", ""), ("1", "EN:France"), ("1", "en:france")]
    assert b == [("1", "en:france")]


def test_categories_empty_and_null(spark):
    food = raw(spark, [{"code": "1", "categories_tags": [], "categories": "x"},
                       {"code": "2", "categories": "y"},
                       {"code": "3", "categories_tags": [" en:sweet-spreads"], "categories": "sweet spreads, z"}])
    a = sorted(S.stg_categories(food, VARIANT_A).collect(), key=lambda r: r.product_code)
    assert [(r.product_code, r.category_tag, r.category_label) for r in a] == [
        ("1", None, "X"), ("3", "en:sweet-spreads", "Sweet spreads")]
    b = S.stg_categories(food, VARIANT_B).collect()
    assert [(r.product_code, r.category_tag, r.category_name) for r in b] == [("3", "en:sweet-spreads", "Sweet Spreads")]


def test_nutrition_latest_and_max(spark):
    def nut(salt):
        return [{"name": "salt", "100g": salt}]
    food = raw(spark, [{"code": "1", "last_modified_t": 100, "nutriments": nut(1.0)},
                       {"code": "1", "last_modified_t": 200, "nutriments": nut(0.5)},
                       {"code": "1", "last_modified_t": None, "nutriments": nut(9.0)}])
    assert S.stg_nutrition(food, VARIANT_B).first().salt_g == 0.5
    assert S.stg_nutrition(food, VARIANT_A).first().salt_100g == 9.0


def test_dates_variants(spark):
    food = raw(spark, [{"code": "1", "last_modified_t": 1718000000}, {"code": "1", "last_modified_t": 1704499200},
                       {"code": None, "last_modified_t": 1704585600}])
    a = S.stg_date(food, VARIANT_A).collect()
    assert len(a) == 3 and {r.date_sk for r in a} == {20240610, 20240106, 20240107}
    b = S.stg_date(food, VARIANT_B).collect()
    assert [(r.product_code, str(r.full_date), r.day_of_week, r.is_weekend) for r in b] == [
        ("1", "2024-06-10", 2, False)]


@pytest.mark.parametrize("v", [VARIANT_A, VARIANT_B, DEFAULT], ids=lambda v: v.name)
def test_fact_grain_and_product_without_country(spark, tmpdir_session, v):
    food = raw(spark, [
        {"code": "1", "countries_tags": ["en:france", "en:spain"], "last_modified_t": 1718000000,
         "brands": "B", "brands_tags": ["b"], "categories_tags": ["en:c"], "categories": "C",
         "nutriscore_score": 3, "nutriments": [{"name": "salt", "100g": 1.0}]},
        {"code": "2", "last_modified_t": 1718000000},
        {"code": "3", "countries_tags": ["en:france"]}])
    g = W.build_gold(food, v, f"{tmpdir_session}/fact-{v.name}")
    fact = g["fact_nutrition"]
    assert fact.count() == 3
    prods = g["dim_product"]
    codes = {r.product_sk: r.product_code for r in prods.collect()}
    assert set(codes.values()) == {"1", "2", "3"}
    assert "2" not in {codes[r.product_sk] for r in fact.collect()}
    assert sorted(r[v.fact_sk] for r in fact.collect()) == [1, 2, 3]


def test_dim_country_names(spark):
    food = raw(spark, [{"code": "1", "countries_tags": ["en:united-states", "fra:cafe"]}])
    a = {r.country_tag: r.country_name for r in DM.dim_country(food, VARIANT_A).collect()}
    b = {r.country_tag: r.country_name for r in DM.dim_country(food, VARIANT_B).collect()}
    assert a == {"en:united-states": "United-states", "fra:cafe": ":cafe"}
    assert b == {"en:united-states": "United States", "fra:cafe": "Fra:cafe"}


def test_variant_rejects_unknown_values():
    with pytest.raises(ValueError):
        DEFAULT.with_(weekday="monday")
    assert VARIANT_B.with_(weekday="iso").weekday == "iso"
