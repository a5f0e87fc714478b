"""Dimensions T7-T11 and the per-product summary the fact is built from.

``product_summary`` is ONE aggregation per product code over the raw rows: the
product's attributes (latest row), its nutrition (max per metric or latest
row), and its category / brand / date bridge values. The source
implementations computed these as five separate staging tables joined back on
the product code; folding them into one grouping means one scan and one
(map-side combined) shuffle instead of five, and no joins between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.config import Variant
from larder.functions import dates as D
from larder.functions.nested import measure_names, nutrient_columns
from larder.functions.text import nonempty, prettify_tag, tag_name_offset
from larder.operators.dedup import collapse_max, first_nonnull, max_row
from larder.operators.keys import small_surrogate_key, surrogate_key
from larder.plans import staging as S

def _code():
    return F.col("code")


# ---- product (T7) --------------------------------------------------------------------------

def brand_bridge_expr(v: Variant) -> Column:
    """The product's brand key value used to find its brand_sk."""
    key = "brand_tag" if v.brand_key == "tag" else "brand_name"
    keep = S.brand_row_filter(v)
    tag, name = S.brand_tag_expr(), S.brand_name_expr(v)
    if v.brand_collapse == "row":
        pair = F.max(F.when(keep, F.struct(tag.alias("brand_tag"), name.alias("brand_name"))))
        return pair.getField(key)
    return F.max(F.when(keep, tag if key == "brand_tag" else name))


def product_summary(food: DataFrame, v: Variant) -> DataFrame:
    """One row per product code: attributes, measures, score and bridge values."""
    measures = measure_names(v.measure_names)
    attrs = S.product_attr_names(v)
    t = F.col("last_modified_t")
    d = D.seconds_to_date(t)
    rows = food.filter(_code().isNotNull()).select(
        _code().alias("product_code"), t, F.col("nutriscore_score"), *S.product_attr_exprs(v),
        *nutrient_columns("nutriments", style=v.measure_names),
        F.when(S.category_row_filter(v), S.category_tag_expr(v)).alias("_cat_row"),
        *[F.col(c) for c in ("brands", "brands_tags")])
    aggs = [max_row([t], attrs).alias("_attrs"), F.max("_cat_row").alias("_cat_tag")]
    # brand bridge is computed from the raw brand columns kept above
    aggs.append(brand_bridge_expr(v).alias("_brand_key"))
    aggs.append(F.max(D.date_key(d) if v.date_key == "smart" else d).alias("_date"))
    if v.nutrition == "max":
        aggs += [F.max(m).alias(m) for m in [*measures, "nutriscore_score"]]
    else:
        aggs.append(max_row([t], [*measures, "nutriscore_score", "last_modified_t"]).alias("_nut"))
    summary = rows.groupBy("product_code").agg(*aggs)
    nut = ([F.col(m) for m in [*measures, "nutriscore_score"]] if v.nutrition == "max"
           else [F.col("_nut").getField(m).alias(m) for m in [*measures, "nutriscore_score"]])
    return summary.select("product_code", *[F.col("_attrs").getField(a).alias(a) for a in attrs],
                          "_cat_tag", "_brand_key", "_date", *nut)


def dim_product_wide(food: DataFrame, v: Variant) -> DataFrame:
    """dim_product plus the hidden bridge / measure columns (prefixed or measure-named)."""
    return surrogate_key(product_summary(food, v), ["product_code"], "product_sk")


def dim_product_columns(v: Variant) -> list[str]:
    return ["product_sk", "product_code", *S.product_attr_names(v)]


def dim_product(food: DataFrame, v: Variant) -> DataFrame:
    return dim_product_wide(food, v).select(*dim_product_columns(v))


# ---- brand (T8) ----------------------------------------------------------------------------

def dim_brand(food: DataFrame, v: Variant, staged: DataFrame | None = None) -> DataFrame:
    """``staged``, here and below: the written staging rows, if at hand (saves a scan of the raw)."""
    stg = S.stg_brands(food, v) if staged is None else staged
    if v.brand_key == "tag":
        d = collapse_max(stg.filter(F.col("brand_tag").isNotNull()), "brand_tag", ["brand_name"])
        return surrogate_key(d, ["brand_tag"], "brand_sk").select(
            "brand_sk", "brand_tag", "brand_name")
    # keyed by name; the smallest tag stands in for "first non-NULL tag" so the result is stable
    d = first_nonnull(stg.filter(nonempty("brand_name")), "brand_name", "brand_tag")
    return surrogate_key(d, ["brand_name"], "brand_sk").select(
        "brand_sk", "brand_name", "brand_tag")


# ---- category (T9) -------------------------------------------------------------------------

def dim_category(food: DataFrame, v: Variant, staged: DataFrame | None = None) -> DataFrame:
    label = S.category_label_col(v)
    stg = S.stg_categories(food, v) if staged is None else staged
    keep = nonempty("category_tag") if v.category_drop_empty else F.col("category_tag").isNotNull()
    d = collapse_max(stg.filter(keep), "category_tag", [label])
    return surrogate_key(d, ["category_tag"], "category_sk").select(
        "category_sk", "category_tag", label)


# ---- country (T10) -------------------------------------------------------------------------

def country_name_expr(v: Variant, tag: Column) -> Column:
    return tag_name_offset(tag) if v.country_name == "offset" else prettify_tag(tag)


def dim_country(food: DataFrame, v: Variant, countries: DataFrame | None = None) -> DataFrame:
    """``countries``: the written staging rows, if at hand (saves a second explode of the raw)."""
    stg = S.stg_countries(food, v) if countries is None else countries
    keep = F.col("country_tag").isNotNull() if v.country_filter == "raw" else nonempty("country_tag")
    d = stg.select("country_tag").filter(keep).distinct()
    d = d.select("country_tag", country_name_expr(v, F.col("country_tag")).alias("country_name"))
    return surrogate_key(d, ["country_tag"], "country_sk").select(
        "country_sk", "country_tag", "country_name")


# ---- date (T11) ----------------------------------------------------------------------------

def dim_date_columns(v: Variant) -> list[str]:
    if v.date_key == "smart":
        return ["date_sk", v.date_col, "decade", "year", "quarter", "month", "day_of_week", "is_weekend"]
    return ["date_sk", v.date_col, "year", "quarter", "month", "day_of_week", "is_weekend"]


def dim_date(food: DataFrame, v: Variant, staged: DataFrame | None = None) -> DataFrame:
    dates = (S.stg_date(food, v) if staged is None else staged).select(v.date_col).filter(F.col(v.date_col).isNotNull()).distinct()
    d = F.col(v.date_col)
    attrs = dates.select(*S.date_attr_exprs(v, d))
    if v.date_key == "smart":
        return attrs.select(*dim_date_columns(v))
    # A calendar is bounded by the number of days covered, not by the data volume:
    # a single-partition row_number is fine here.
    return small_surrogate_key(attrs, [v.date_col], "date_sk").select(*dim_date_columns(v))
