"""Run order: raw -> staging -> dimensions -> fact -> KPIs -> checks -> audit.

Each gold table is written to Parquet in a shared folder and read back, so the
later steps (fact, KPIs, checks) start from written tables: lineage is cut,
a lost executor costs at most the step it was in, and the broadcast size checks
count cheap Parquet scans.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from larder.config import Variant
from larder.operators import quality as Q
from larder.plans import dims as DM
from larder.plans import kpis as K
from larder.plans import staging as S
from larder.plans.fact import FKS, fact_nutrition
from larder.sources.audit import log_run
from larder.sources.io import check_contract, write_bucketed, write_parquet
from larder.session import work_dir


@dataclass
class Gold:
    variant: Variant
    tables: dict[str, DataFrame]
    rows: dict[str, int] = field(default_factory=dict)

    def __getitem__(self, k: str) -> DataFrame:
        return self.tables[k]


def _persist(spark: SparkSession, df: DataFrame, path: str, rows: dict, name: str) -> DataFrame:
    rows[name] = write_parquet(df, path)
    return spark.read.parquet(path)


def silver_tables(food: DataFrame, v: Variant) -> dict[str, DataFrame]:
    """The six staging models (T1-T6) as one would store them in a silver layer."""
    return {"stg_products": S.stg_products(food, v), "stg_brands": S.stg_brands(food, v),
            "stg_categories": S.stg_categories(food, v), "stg_countries": S.stg_countries(food, v),
            "stg_date": S.stg_date(food, v), "stg_nutrition": S.stg_nutrition(food, v, collapse=v.nutrition == "latest")}


def build_gold(food: DataFrame, v: Variant, out: str, parallel: int = 5, silver: str | None = None, buckets: int | None = None,
               prefix: str = "gold") -> Gold:
    """Build and write the five dimensions and the fact under ``out``.

    Tables that do not depend on each other are submitted concurrently (``parallel`` driver threads, one Spark job stream
    each) so fixed per-job costs overlap and idle executor slots are used. The
    country rows are written once and feed both dim_country and the fact. With
    ``silver`` (a folder) the six staging tables are written there first, and the brand, category and date dimensions are
    built from them instead of the raw rows. With ``buckets`` the product dimension and the fact are catalog tables
    (``prefix_variant_name``) dealt alike into that many buckets by product key.
    """
    spark = food.sparkSession
    rows: dict[str, int] = {}
    t: dict[str, DataFrame] = {}
    # Intermediate tables stay out of the gold folder.
    aside = work_dir(spark, "gold-aside", uuid.uuid4().hex[:12])

    def path_of(name: str) -> str:
        if name.startswith("stg_"):
            return f"{silver or aside}/{name}"
        return f"{aside if name == 'dim_product_wide' else out}/{name}"

    def write(builders: dict) -> None:
        def build(name: str) -> tuple[str, DataFrame]:
            return name, _persist(spark, builders[name](), path_of(name), rows, name)

        if parallel > 1:
            with ThreadPoolExecutor(max_workers=parallel, thread_name_prefix="gold") as pool:
                t.update(dict(pool.map(build, builders)))
        else:
            t.update(dict(map(build, builders)))

    def keyed_by_product(df: DataFrame, name: str) -> DataFrame:
        if buckets is None:
            return _persist(spark, df, f"{out}/{name}", rows, name)
        table = write_bucketed(df, f"{prefix}_{v.name}_{name}", f"{out}/{name}", "product_sk", buckets)
        rows[name] = table.count()
        return table

    wide = {"dim_product_wide": lambda: DM.dim_product_wide(food, v)}
    if silver:
        write({**wide, **{n: (lambda df=df: df) for n, df in silver_tables(food, v).items()}})
        write({"dim_brand": lambda: DM.dim_brand(food, v, t["stg_brands"]), "dim_category": lambda: DM.dim_category(food, v, t["stg_categories"]),
               "dim_date": lambda: DM.dim_date(food, v, t["stg_date"]), "dim_country": lambda: DM.dim_country(food, v, t["stg_countries"])})
        countries = t["stg_countries"]
    else:
        write({**wide, "dim_brand": lambda: DM.dim_brand(food, v), "dim_category": lambda: DM.dim_category(food, v),
               "dim_date": lambda: DM.dim_date(food, v), "stg_countries": lambda: S.stg_countries(food, v)})
        countries = t.pop("stg_countries")
        write({"dim_country": lambda: DM.dim_country(food, v, countries)})
    t["product_wide"] = t.pop("dim_product_wide")
    t["dim_product"] = keyed_by_product(t["product_wide"].select(*DM.dim_product_columns(v)), "dim_product")
    dims = {"product_wide": t["product_wide"], "brand": t["dim_brand"], "category": t["dim_category"],
            "country": t["dim_country"], "date": t["dim_date"]}
    t["fact_nutrition"] = keyed_by_product(fact_nutrition(food, v, dims, countries=countries), "fact_nutrition")
    return Gold(v, t, rows)


def bucket_by_product(g: Gold, out: str, buckets: int, prefix: str = "gold") -> Gold:
    """The gold tables with the fact and the product dimension as catalog tables dealt alike into ``buckets`` by product key, so
    that what joins or groups them by product (K1, K3) needs no exchange of either."""
    tables = dict(g.tables)
    for name in ("fact_nutrition", "dim_product"):
        tables[name] = write_bucketed(g[name], f"{prefix}_{g.variant.name}_{name}", f"{out}/{name}", "product_sk", buckets)
    return Gold(g.variant, tables, g.rows)


def kpis(g: Gold) -> dict[str, DataFrame]:
    v, t = g.variant, g.tables
    label = S.category_label_col(v)
    salt = "salt_100g" if v.measure_names == "100g" else "salt_g"
    return {
        "kpi_active_products": K.active_products(t["fact_nutrition"]),
        "kpi_mean_score": K.mean_score(t["fact_nutrition"], t["dim_category"], t["dim_brand"],
                                       t["dim_country"], t["dim_date"], label_col=label),
        "kpi_pct_grade_a": K.pct_grade_a(t["fact_nutrition"], t["dim_product"]),
        "kpi_mean_salt": K.mean_salt(t["fact_nutrition"], t["dim_category"], label_col=label, salt_col=salt),
        "kpi_completeness": K.completeness(t["fact_nutrition"]),
    }


def quality_suite(v: Variant, unique_mode: str = "values") -> dict[str, list[Q.Check]]:
    """The checks both sources declare on the gold tables.

    ``unique_mode``: 'values' counts duplicated values (NULLs ignored, as the SQL
    source's tests do); 'rows' counts rows minus distinct values (the DataFrame
    source's tests)."""
    date_col = v.date_col

    def unique(col: str) -> Q.Check:
        return Q.unique(col, mode=unique_mode)

    return {
        "dim_product": [unique("product_sk"), Q.not_null("product_sk"), Q.not_null("product_code"),
                        Q.accepted_values("nutriscore_grade", S.GRADES, where="nutriscore_grade IS NOT NULL")],
        "dim_category": [unique("category_sk"), Q.not_null("category_sk"), Q.not_null("category_tag")],
        "dim_brand": [unique("brand_sk"), Q.not_null("brand_sk"), Q.not_null("brand_tag")],
        "dim_country": [unique("country_sk"), Q.not_null("country_sk"), Q.not_null("country_tag")],
        "dim_date": [unique("date_sk"), Q.not_null("date_sk"), Q.not_null(date_col)],
        "fact_nutrition": [unique(v.fact_sk), unique("product_sk,country_sk"), Q.not_null(v.fact_sk), *[Q.not_null(c) for c in FKS],
                           Q.at_least("energy_kcal", 0),
                           Q.at_least("salt_100g" if v.measure_names == "100g" else "salt_g", 0),
                           Q.in_range("nutriscore_score", -15, 40)],
    }


def quality_report(g: Gold, unique_mode: str = "values") -> DataFrame:
    return Q.run_suite(g.tables, quality_suite(g.variant, unique_mode))


def run_pipeline(raw: DataFrame, v: Variant, out: str | None = None, audit_path: str | None = None,
                 source_file: str = "food", parallel: int = 6, silver: str | None = None,
                 raw_path: str | None = None, contract: dict[str, str] | None = None, buckets: int | None = None,
                 prefix: str = "gold") -> dict[str, DataFrame]:
    """Whole run. Returns gold tables, KPI tables and the quality report (all written
    under ``out``, dim_product among them); ``contract`` is held against the schema in the files at
    ``raw_path`` first; appends one audit row whose status is FAILED when a check fails
    (a soft failure: the run still completes). The KPI tables and the report are
    independent and are written concurrently. ``buckets``, ``prefix``: see :func:`build_gold`."""
    spark = raw.sparkSession
    if raw_path and contract:
        broken = check_contract(spark, raw_path, contract)
        if broken:
            raise ValueError(f"{raw_path} breaks its schema contract: {broken}")
    out = out or work_dir(spark, "gold", v.name, uuid.uuid4().hex[:12])
    g = build_gold(raw, v, out, parallel=parallel, silver=silver, buckets=buckets, prefix=prefix)
    result = {k: v_ for k, v_ in g.tables.items() if k != "product_wide"}
    finals = {**kpis(g), "quality_report": quality_report(g)}

    def write(item: tuple[str, DataFrame]) -> tuple[str, DataFrame]:
        name, df = item
        return name, _persist(spark, df, f"{out}/{name}", g.rows, name)

    if parallel > 1:
        with ThreadPoolExecutor(max_workers=parallel, thread_name_prefix="gold-out") as pool:
            result.update(dict(pool.map(write, finals.items())))
    else:
        result.update(dict(map(write, finals.items())))
    if audit_path:
        log_run(spark, audit_path, source_file, out, g.rows["fact_nutrition"], Q.status(result["quality_report"]),
                prefix="GOLD")
    return result


# ---- per-session gold cache used by the registered queries ------------------------------------

_GOLD: dict[tuple, Gold] = {}


def gold_for(food: DataFrame, v: Variant, key: str) -> Gold:
    """The gold tables of the raw table landed at ``key`` (a new landing has a new path)."""
    spark = food.sparkSession
    k = (spark.sparkContext.applicationId, key, v)
    if k not in _GOLD:
        _GOLD[k] = build_gold(food, v, work_dir(spark, "gold", uuid.uuid4().hex[:12], v.name))
    return _GOLD[k]
