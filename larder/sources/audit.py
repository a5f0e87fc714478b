"""Pipeline audit log (S15 S18): one appended row per run."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from larder.functions.dates import run_id
from larder.sources.io import sql_text

# nb_lignes_output is a bigint: an int would overflow on a large dump.
# The audit table's column names.
AUDIT_SCHEMA = StructType([
    StructField("run_id", StringType()),
    StructField("run_date", TimestampType()),
    StructField("source_file", StringType()),
    StructField("output_file", StringType()),
    StructField("nb_lignes_output", LongType()),
    StructField("statut", StringType()),
])


def log_run(spark: SparkSession, path: str, source_file: str, output_file: str, rows: int,
            status: str = "SUCCESS", prefix: str = "PL", when: _dt.datetime | None = None) -> DataFrame:
    """Append one run row to the audit table at ``path`` (created by the first append)."""
    # One clock for both columns: Spark's, in the session's zone, unless a time is given.
    now = F.date_trunc("SECOND", F.current_timestamp() if when is None else F.lit(when))
    df = spark.range(1).select(
        run_id(prefix, now).alias("run_id"), now.alias("run_date"), F.lit(source_file).alias("source_file"),
        F.lit(output_file).alias("output_file"), F.lit(int(rows)).cast("bigint").alias("nb_lignes_output"),
        F.lit(status).alias("statut"))
    df.coalesce(1).write.mode("append").parquet(path)
    return df


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)


def audit_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The audit log as a catalog table over its folder."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in AUDIT_SCHEMA.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet LOCATION {sql_text(path)}")
    return spark.table(name).select(*[F.col(f.name) for f in AUDIT_SCHEMA.fields])
