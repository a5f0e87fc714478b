"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(app: str = "larder", master: str | None = None, shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the pipeline relies on.

    * AQE on, so shuffle partitions are coalesced and skewed joins split at run time.
    * UTC session zone; the library's own date maths is zone-free anyway.
    * No UI server; checkpoint files cleaned up when no longer referenced.
    * Object-store settings (S3A endpoint and credentials) only from the environment,
      never from literals: ``LARDER_S3_ENDPOINT``, ``AWS_ACCESS_KEY_ID``,
      ``AWS_SECRET_ACCESS_KEY``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # checkpoint files (surrogate-key placements) are removed once no longer referenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    endpoint = os.environ.get("LARDER_S3_ENDPOINT")
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
        conf["spark.hadoop.fs.s3a.path.style.access"] = "true"
        conf["spark.hadoop.fs.s3a.aws.credentials.provider"] = (
            "com.amazonaws.auth.EnvironmentVariableCredentialsProvider")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, the place lineage is cut.

    On a cluster it must be set (``spark.checkpoint.dir``) to a folder every
    executor and the driver can reach. A local-mode session without one (a notebook, a smoke test) uses a folder in its
    warehouse, which the driver and the local executor threads share.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3) "
                           "so that checkpoints and intermediate tables survive executor loss")
    sc.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir', 'spark-warehouse').rstrip('/')}/larder-checkpoints")
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A folder for intermediate tables, under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    app = spark.sparkContext.applicationId
    return "/".join([base, "larder-tables", app, *parts])


def remove_work(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; for the end of a run, when no DataFrame reads them any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
