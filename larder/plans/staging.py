"""Staging (silver) models T1-T6: clean and unpack the raw nested rows.

Each model is a lazy DataFrame over the raw table; Catalyst prunes the raw scan
to the columns a model touches and pushes ``code IS NOT NULL`` into it. The
column expressions are exposed separately (``*_expr``) because the fact builder
reuses them inside one per-product aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.config import Variant
from larder.functions import dates as D
from larder.functions.nested import first_item, first_text, measure_names, name_with_fallback, nutrient_columns
from larder.functions.predicates import allow_or_null
from larder.functions.text import apply_case, clean_tag, first_of_list, nonempty, sentence_case
from larder.operators.dedup import collapse_max, latest_per_key

# Accepted nutrition grades.
GRADES = ["a", "b", "c", "d", "e"]

def _code():
    return F.col("code")


# ---- products (T1) -------------------------------------------------------------------------

def product_name_expr(v: Variant) -> Column:
    if v.product_name == "main_fallback":
        return name_with_fallback("product_name")
    return first_text("product_name")


def product_attr_exprs(v: Variant) -> list[Column]:
    return [product_name_expr(v).alias("product_name"),
            allow_or_null("nutriscore_grade", GRADES).alias("nutriscore_grade"),
            F.col("nova_group"), F.col("environmental_score_grade"),
            F.col("quantity").alias(v.product_quantity_col)]


def product_attr_names(v: Variant) -> list[str]:
    return ["product_name", "nutriscore_grade", "nova_group", "environmental_score_grade", v.product_quantity_col]


def stg_products(food: DataFrame, v: Variant) -> DataFrame:
    df = food.filter(_code().isNotNull()).select(_code().alias("product_code"), *product_attr_exprs(v))
    return df.distinct() if v.products_distinct else df


# ---- brands (T2) ---------------------------------------------------------------------------

def brand_tag_expr() -> Column:
    return clean_tag(first_item("brands_tags"), lower=True)


def brand_name_expr(v: Variant) -> Column:
    return apply_case(F.trim(first_of_list("brands")), v.brand_case)


def brand_row_filter(v: Variant) -> Column:
    """Which raw rows give a brand row (code already non-NULL)."""
    if v.brand_filter == "raw":
        return nonempty("brands")
    return nonempty(brand_name_expr(v))


def stg_brands(food: DataFrame, v: Variant) -> DataFrame:
    rows = (food.filter(_code().isNotNull() & brand_row_filter(v))
                .select(_code().alias("product_code"), brand_tag_expr().alias("brand_tag"),
                        brand_name_expr(v).alias("brand_name")))
    if v.brand_collapse == "none":
        return rows
    if v.brand_collapse == "independent":
        return collapse_max(rows, "product_code", ["brand_name", "brand_tag"])
    if v.brand_collapse == "row":
        pair = F.max(F.struct("brand_tag", "brand_name")).alias("_b")
        return rows.groupBy("product_code").agg(pair).select(
            "product_code", F.col("_b.brand_tag").alias("brand_tag"), F.col("_b.brand_name").alias("brand_name"))
    raise ValueError(v.brand_collapse)


# ---- categories (T3) -----------------------------------------------------------------------

def category_tag_expr(v: Variant) -> Column:
    return clean_tag(first_item("categories_tags"), lower=v.category_lower)


def category_label_col(v: Variant) -> str:
    return "category_label" if v.category_label == "first_text" else "category_name"


def category_label_expr(v: Variant, tag: Column | None = None) -> Column:
    if v.category_label == "first_text":
        return sentence_case(F.trim(first_of_list("categories")))
    from larder.functions.text import prettify_tag
    return prettify_tag(category_tag_expr(v) if tag is None else tag)


def category_row_filter(v: Variant) -> Column:
    if v.category_drop_empty:
        return nonempty(category_tag_expr(v))
    return F.col("categories_tags").isNotNull()


def stg_categories(food: DataFrame, v: Variant) -> DataFrame:
    label = category_label_col(v)
    rows = (food.filter(_code().isNotNull() & category_row_filter(v))
                .select(_code().alias("product_code"), category_tag_expr(v).alias("category_tag"),
                        category_label_expr(v).alias(label)))
    if v.category_collapse:
        return collapse_max(rows, "product_code", ["category_tag", label])
    return rows


# ---- countries (T4) ------------------------------------------------------------------------

def stg_countries(food: DataFrame, v: Variant) -> DataFrame:
    exploded = (food.filter(_code().isNotNull())
                    .select(_code().alias("product_code"), F.explode("countries_tags").alias("_raw_tag")))
    if v.country_filter == "raw":
        exploded = exploded.filter(nonempty("_raw_tag"))
    rows = exploded.select("product_code", clean_tag("_raw_tag", lower=v.country_lower).alias("country_tag"))
    if v.country_filter == "clean":
        rows = rows.filter(nonempty("country_tag"))
    # DISTINCT is an aggregation: combined map-side before the shuffle.
    return rows.distinct() if v.country_distinct else rows


# ---- dates (T5) ----------------------------------------------------------------------------

def date_expr() -> Column:
    return D.seconds_to_date("last_modified_t")


def date_attr_exprs(v: Variant, d: Column) -> list[Column]:
    """Calendar attributes of date column ``d``, in output order."""
    if v.date_key == "smart":
        return [d.alias(v.date_col), D.date_key(d).alias("date_sk"), F.year(d).alias("year"),
                F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
                D.weekday(d, v.weekday).alias("day_of_week"), D.decade(d).alias("decade"),
                D.month_name(d).alias("month_name"), D.is_weekend(d).alias("is_weekend")]
    return [d.alias(v.date_col), F.year(d).alias("year"), F.quarter(d).alias("quarter"),
            F.month(d).alias("month"), D.weekday(d, v.weekday).alias("day_of_week"),
            D.is_weekend(d).alias("is_weekend")]


def stg_date(food: DataFrame, v: Variant) -> DataFrame:
    if v.date_rows == "per_row":
        rows = food.filter(F.col("last_modified_t").isNotNull()).select(
            _code().alias("product_code"), date_expr().alias("_d"))
    else:
        rows = (food.filter(_code().isNotNull() & F.col("last_modified_t").isNotNull())
                    .groupBy(_code().alias("product_code")).agg(F.max(date_expr()).alias("_d")))
    return rows.select("product_code", *date_attr_exprs(v, F.col("_d")))


# ---- nutrition (T6) ------------------------------------------------------------------------

def nutrition_rows(food: DataFrame, v: Variant) -> DataFrame:
    """One row per raw row with a code: the seven measures, score and modification time."""
    return food.filter(_code().isNotNull()).select(
        _code().alias("product_code"), F.col("nutriscore_score"), F.col("last_modified_t"),
        *nutrient_columns("nutriments", style=v.measure_names))


def stg_nutrition(food: DataFrame, v: Variant, collapse: bool = True) -> DataFrame:
    """Per product: MAX of every metric (``nutrition='max'``) or the latest row
    (``'latest'``: by last_modified_t desc nulls last, ties broken by the measures)."""
    rows = nutrition_rows(food, v)
    measures = measure_names(v.measure_names)
    if not collapse:
        return rows
    if v.nutrition == "max":
        return collapse_max(rows, "product_code", [*measures, "nutriscore_score", "last_modified_t"])
    latest = latest_per_key(rows, "product_code", ["last_modified_t"],
                            payload=[*measures, "nutriscore_score", "last_modified_t"])
    return latest.select("product_code", *measures, "nutriscore_score",
                         D.seconds_to_date("last_modified_t").alias("last_modified_date"))
