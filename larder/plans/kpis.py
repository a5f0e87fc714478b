"""KPI (semantic) tables K1-K5 over the gold star schema.

K3 and K5 are weighted by fact rows (a product counts once per country), as in
the source; ``pct_grade_a(..., per='product')`` gives the per-product share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.joins import lookup, star_join
from larder.operators.metrics import avg_rounded, bitmap_counts, count_distinct, key_bitmaps, merge_bitmaps, pct_nonnull


def active_products(fact: DataFrame) -> DataFrame:
    """K1: number of distinct products in the fact, as bitmaps over the dense product key."""
    return bitmap_counts(key_bitmaps(fact, "product_sk"), name="nb_produits_actifs")


def active_products_by_period(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """K1 per month, per year and over all dated rows. The months' bitmaps are built once from the fact; years and the total are
    merged from them (a product active in several months counts once in its year)."""
    dated = lookup(fact.filter(F.col("date_sk").isNotNull()).select("product_sk", "date_sk"), dim_date, "date_sk", ["year", "month"], how="inner")
    months = key_bitmaps(dated, "product_sk", ["year", "month"])
    years = merge_bitmaps(months, ["year"])
    none = F.lit(None).cast("int")

    def level(name: str, counts: DataFrame, *missing: str) -> DataFrame:
        for c in missing:
            counts = counts.withColumn(c, none)
        return counts.select(F.lit(name).alias("period"), F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"), "nb_produits_actifs")

    n = "nb_produits_actifs"
    return level("month", bitmap_counts(months, ["year", "month"], n)).unionByName(level("year", bitmap_counts(years, ["year"], n), "month")) \
        .unionByName(level("all", bitmap_counts(merge_bitmaps(years), name=n), "year", "month"))


def mean_score(fact: DataFrame, dim_category: DataFrame, dim_brand: DataFrame, dim_country: DataFrame,
               dim_date: DataFrame, label_col: str = "category_label") -> DataFrame:
    """K2: mean score and product count by category, brand, country, year and month.
    Inner joins: fact rows missing any of the four keys drop out."""
    scored = fact.filter(F.col("nutriscore_score").isNotNull()).select(
        "product_sk", "category_sk", "brand_sk", "country_sk", "date_sk", "nutriscore_score")
    joined = star_join(scored, [(dim_category, "category_sk", [label_col]),
                                (dim_brand, "brand_sk", ["brand_name"]),
                                (dim_country, "country_sk", ["country_name"]),
                                (dim_date, "date_sk", ["year", "month"])])
    return joined.groupBy(label_col, "brand_name", "country_name", "year", "month").agg(
        avg_rounded("nutriscore_score", 2).alias("nutriscore_moyen"),
        count_distinct("product_sk").alias("nb_produits"))


def pct_grade_a(fact: DataFrame, dim_product: DataFrame, per: str = "row") -> DataFrame:
    """K3: % of grade 'a' among graded fact rows (``per='row'``) or products (``'product'``).

    The fact is first reduced to one weight per product (map-side combined), so
    the join with the product dimension shuffles products, not fact rows.
    """
    if per == "row":
        weights = fact.groupBy("product_sk").agg(F.count(F.lit(1)).alias("_w"))
    else:
        weights = fact.select("product_sk").distinct().withColumn("_w", F.lit(1).cast("bigint"))
    joined = weights.join(dim_product.select("product_sk", "nutriscore_grade"), "product_sk")
    grade = F.col("nutriscore_grade")
    num = F.sum(F.when(grade == "a", F.col("_w"))).cast("double")
    den = F.sum(F.when(grade.isNotNull(), F.col("_w"))).cast("double")
    pct = F.round(F.lit(100.0) * F.coalesce(num, F.lit(0.0)) / F.nullif(den, F.lit(0.0)), 2)
    return joined.agg(pct.alias("pct_produits_nutriscore_a"))


def mean_salt(fact: DataFrame, dim_category: DataFrame, label_col: str = "category_label",
              salt_col: str = "salt_100g") -> DataFrame:
    """K4: mean salt per category label."""
    salted = fact.filter(F.col(salt_col).isNotNull()).select("category_sk", salt_col)
    joined = lookup(salted, dim_category, "category_sk", [label_col], how="inner")
    return joined.groupBy(label_col).agg(avg_rounded(salt_col, 4).alias("sel_moyen_g"))


def completeness(fact: DataFrame) -> DataFrame:
    """K5: % of fact rows with a score."""
    return fact.agg(pct_nonnull("nutriscore_score").alias("taux_completude_nutriscore"))
