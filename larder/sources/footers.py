"""Parquet footers, file by file, read on the executors.

Spark's reader infers a folder's schema from one footer, and merging schemas does not say which file differs. Here the
files are listed by Spark, dealt to tasks, and each task opens the footers of its files: schema, rows, row
groups and codec. Only footers are read where pyarrow knows the store (local, HDFS, S3, GCS, ABFS);
``via="content"`` hands whole files over through Spark's reader instead, for stores only Spark can open.
"""

from __future__ import annotations

import io
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import StructType

FOOTER = ("file string, bytes bigint, rows bigint, row_groups int, max_group_bytes bigint, codecs array<string>, "
          "columns array<struct<name:string,type:string>>")
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
# Hadoop's names of stores whose names differ elsewhere.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss"}


def _open(path: str):
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(_SCHEMES.get(scheme, scheme) + ":" + rest)


def column_types(parquet: pq.ParquetFile) -> list[dict[str, str]]:
    """Top-level columns with Spark's simple type names: Spark's own record of them if the file has one."""
    own = (parquet.metadata.metadata or {}).get(_SPARK_SCHEMA)
    if own:
        return [{"name": f.name, "type": f.dataType.simpleString()} for f in StructType.fromJson(json.loads(own)).fields]
    physical = {parquet.schema.column(i).path: parquet.schema.column(i).physical_type for i in range(len(parquet.schema))}
    out = []
    for f in parquet.schema_arrow:
        zoned = pa.types.is_timestamp(f.type) and physical.get(f.name) == "INT96"  # written in an instant's form
        out.append({"name": f.name, "type": "timestamp" if zoned else from_arrow_type(f.type, prefer_timestamp_ntz=True).simpleString()})
    return out


def _describe(name: str, size: int, source) -> dict:
    with pq.ParquetFile(source) as f:
        meta = f.metadata
        groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
        codecs = sorted({g.column(i).compression.lower() for g in groups for i in range(g.num_columns)})
        return {"file": name, "bytes": size, "rows": meta.num_rows, "row_groups": len(groups),
                "max_group_bytes": max((g.total_byte_size for g in groups), default=0), "codecs": codecs, "columns": column_types(f)}


_ARROW = pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("rows", pa.int64()), ("row_groups", pa.int32()), ("max_group_bytes", pa.int64()),
                    ("codecs", pa.list_(pa.string())), ("columns", pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())])))])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        whole = batch.column("content").to_pylist() if "content" in batch.schema.names else [None] * batch.num_rows
        for path, size, content in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), whole):
            if content is not None:
                rows.append(_describe(path, size, io.BytesIO(content)))
            else:
                store, inner = _open(path)
                with store.open_input_file(inner) as f:
                    rows.append(_describe(path, size, f))
        yield from pa.Table.from_pylist(rows, schema=_ARROW).to_batches()


def footers(spark: SparkSession, path: str, via: str = "store") -> DataFrame:
    """One row per Parquet file below ``path`` (hidden folders and files, such as commit markers, are left out)."""
    if via not in ("store", "content"):
        raise ValueError(f"unknown way to read footers: {via!r}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    hidden = re.escape(path.rstrip("/").rsplit("/", 1)[-1]) + r"/(.*/)?[_.]"
    files = files.filter(~F.col("path").rlike(hidden) & (F.col("path").endswith(".parquet") | (F.regexp_extract("path", "([^/]*)$", 1) == path.rstrip("/").rsplit("/", 1)[-1])))
    return files.select("path", "length", *(["content"] if via == "content" else [])).mapInArrow(_read, FOOTER)


def contract_breaks(spark: SparkSession, path: str, contract: dict[str, str], via: str = "store") -> DataFrame:
    """(file, column_name, expected_type, actual_type, rows): every file and column that breaks the contract ``{column: simple
    type}``; actual_type is NULL for a missing column. Columns beyond the contract are no breach."""
    wanted = F.array(*[F.struct(F.lit(c).alias("name"), F.lit(t).alias("type")) for c, t in contract.items()])
    has = F.map_from_entries("columns")
    held = footers(spark, path, via).select("file", "rows", has.alias("_has"), F.explode(wanted).alias("_w"))
    actual = F.try_element_at("_has", F.col("_w.name"))
    return held.filter(~actual.eqNullSafe(F.col("_w.type"))).select(
        "file", F.col("_w.name").alias("column_name"), F.col("_w.type").alias("expected_type"), actual.alias("actual_type"), "rows")
