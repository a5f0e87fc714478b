"""Fact table T12: one row per (product, country), five foreign keys, seven measures and the score.

Category, brand and date keys are looked up at product grain, before the country fan-out; only
the country key is looked up after it. The fact key follows (product, country) in every variant, and the
products are numbered in that order already, so it needs no sort of the fact: key = countries of all
earlier products + rank within the product. The first part is a running sum in two levels
(buckets of consecutive product keys), the second a window over the narrow country rows, whose dealing the join takes over.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.config import Variant
from larder.functions.nested import measure_names
from larder.operators.joins import lookup
from larder.plans import staging as S
from larder.session import work_dir

FKS = ["product_sk", "category_sk", "brand_sk", "country_sk", "date_sk"]
#: Products whose running sum one task computes.
BUCKET = 1 << 14


def fact_columns(v: Variant) -> list[str]:
    """Output columns in the order each source writes them."""
    measures = measure_names(v.measure_names)
    if v.measure_names == "g":  # energy, fat, salt, score, then the others
        energy, fat, saturated, sugars, salt, proteins, fiber = measures
        return [v.fact_sk, *FKS, energy, fat, salt, "nutriscore_score", saturated, sugars, fiber, proteins]
    return [v.fact_sk, *FKS, *measures, "nutriscore_score"]


def product_keys(v: Variant, dims: dict[str, DataFrame], countries: DataFrame) -> DataFrame:
    """One row per product that has a country: its keys, measures and number of countries."""
    measures = measure_names(v.measure_names)
    per = countries.groupBy("product_code").agg(F.count(F.lit(1)).alias("_n"))
    prod = dims["product_wide"].select("product_code", "product_sk", "_cat_tag", "_brand_key", "_date", *measures,
                                       "nutriscore_score").join(per, "product_code")
    prod = lookup(prod, dims["category"], ("_cat_tag", "category_tag"), ["category_sk"], spread="product_code")
    brand_key = "brand_tag" if v.brand_key == "tag" else "brand_name"
    prod = lookup(prod, dims["brand"], ("_brand_key", brand_key), ["brand_sk"], spread="product_code")
    if v.date_key == "smart":
        # the smart key is the date itself; every bridge value is in dim_date by construction
        prod = prod.withColumn("date_sk", F.col("_date").cast("int"))
    else:
        prod = lookup(prod, dims["date"], ("_date", v.date_col), ["date_sk"], spread="product_code")
    return prod.select("product_code", "product_sk", "category_sk", "brand_sk", "date_sk", *measures, "nutriscore_score", "_n")


def with_offsets(prod: DataFrame) -> DataFrame:
    """``_base``: the number of countries of all products with a smaller key."""
    bucket = F.floor(F.col("product_sk") / F.lit(BUCKET)).alias("_bucket")
    sums = prod.groupBy(bucket).agg(F.sum("_n").alias("_sum"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row per bucket
    starts = sums.select("_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_bucket").orderBy("product_sk").rowsBetween(Window.unboundedPreceding, -1)
    placed = prod.withColumn("_bucket", bucket).withColumn("_before", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    return placed.join(starts, "_bucket").withColumn("_base", F.col("_start") + F.col("_before")).drop(
        "_bucket", "_start", "_before", "_n")


def fact_nutrition(food: DataFrame, v: Variant, dims: dict[str, DataFrame], countries: DataFrame | None = None) -> DataFrame:
    """``dims`` needs 'product_wide', 'country', 'category', 'brand' and 'date';
    ``countries``: the written country staging rows, if at hand."""
    spark = food.sparkSession
    countries = S.stg_countries(food, v) if countries is None else countries
    path = work_dir(spark, "fact-products", uuid.uuid4().hex[:12])
    product_keys(v, dims, countries).write.parquet(path)  # read twice: sums per bucket, and the join below
    prod = with_offsets(spark.read.parquet(path))
    # Every country row's code is a product code (both come from raw rows with a code), so the
    # sources' two ways to join, from the countries or from the nutrition rows, keep the same rows.
    # Ranked while narrow: the join then finds the rows dealt and sorted by product, and sorts no wide ones. The hint keeps the
    # planner from broadcasting millions of country rows that take little room in their files.
    rank = F.row_number().over(Window.partitionBy("product_code").orderBy("country_tag"))
    fact = countries.select("product_code", "country_tag", rank.alias("_rank")).join(prod.hint("merge"), "product_code").withColumn(
        v.fact_sk, (F.col("_base") + F.col("_rank")).cast("bigint"))
    fact = lookup(fact, dims["country"], "country_tag", ["country_sk"])
    return fact.select(*fact_columns(v))
