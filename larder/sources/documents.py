"""Document export (S10 S11): products as JSON documents, written by the executors.

The source implementations pulled the subset onto the driver (``toPandas``) and
inserted it in batches; here each task writes its own part of the JSON-lines
output, so nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder.functions.nested import nutrient_columns
from larder.functions.predicates import cap_filter
from larder.operators.keys import SortBy, top_n
from larder.sources.io import JSON_OPTIONS

DOCUMENT_COLUMNS = ["code", "product_name", "brands", "nutriscore_grade", "nutriscore_score", "nova_group",
                    "environmental_score_grade", "categories_tags", "countries_tags"]


def document_subset(food: DataFrame, n: int | None = None, max_energy: float | None = None,
                    nutrients: bool = True) -> DataFrame:
    """Graded products with chosen columns and the seven nutrients, energy <= ``max_energy`` if given.

    Every match is exported; an explicit ``n`` keeps the first ``n`` by code.
    """
    df = food.filter(F.col("nutriscore_grade").isNotNull())
    cols = [F.col(c) for c in DOCUMENT_COLUMNS]
    if nutrients:
        cols += nutrient_columns("nutriments", style="g")
    df = df.select(*cols)
    if nutrients and max_energy is not None:
        df = df.filter(cap_filter("energy_kcal", max_energy))
    if n is not None:
        df = top_n(df, [SortBy("code", nulls_last=True)], n)
    return df


def export_documents(df: DataFrame, path: str | None, records_per_file: int | None = None,
                     fmt: str = "json", options: dict | None = None) -> int:
    """Truncate-and-write the documents (S10); returns the number written.

    Default: JSON lines under ``path``. With a document-store connector on the
    classpath, pass its ``fmt`` and ``options`` (connection, collection, batch size):
    the executors write to the store directly, in overwrite mode, and Spark retries
    failed tasks. ``path`` may then be None.
    """
    obs = Observation()
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if records_per_file:
        w = w.option("maxRecordsPerFile", str(records_per_file))
    if fmt == "json":
        w = w.options(**JSON_OPTIONS).option("ignoreNullFields", "false")
    w = w.options(**(options or {})).format(fmt)
    w.save(path) if path is not None else w.save()
    return int(obs.get["rows"])


def read_documents(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).options(**JSON_OPTIONS).json(path)
