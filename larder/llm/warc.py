"""Content-addressed WARC archive.

The archive is two tables in one folder. ``payloads`` has each distinct payload once, under its
SHA-256; ``headers`` has each record's exact header bytes, in the order of the record, with the
digest that names its payload. A payload is checked against its digest when it is read, and an
original record is header + payload, put together by a join.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the largest id is a
response and the others are revisits of it; smaller payloads are always responses (and still stored once).

Only (digest, id) rows are aggregated to choose the response; each chosen record's payload is shuffled
once. The copies of a hot payload meet as small rows in the join, which AQE can split. Repeated
rows: each has a record; rows that repeat the chosen id are responses too. A null id never is the
response of another record (unless all are null) and has no refers_to. A null payload is empty; a
null URI is written as an empty one. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REVISIT_BYTES = 1000
#: The profile URI of a revisit by equal digest, and the line ends of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
WARC_DATE = "2020-01-01T00:00:00Z"


def _record_id(c: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))


def _header() -> Column:
    """The header block of a record, up to and with its empty line. Line ends inside a URI would
    break the block, so they are percent-encoded."""
    uri = F.replace(F.replace(F.coalesce("uri", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = F.col("record_type") == "revisit"
    lines = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), "record_type"),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("id"))),
        F.concat(F.lit("WARC-Target-URI: "), uri), F.lit(f"WARC-Date: {WARC_DATE}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "sha1"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("response_id")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes")).cast("string")),
        F.concat(F.lit("X-Payload-Length: "), F.col("n_bytes").cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
                  revisit_bytes: int = REVISIT_BYTES) -> None:
    """Write ``path/headers`` and ``path/payloads``."""
    spark = pages.sparkSession
    body = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).alias("id"), F.col(uri_col).alias("uri"), body.alias("payload"))
    facts = rows.select("id", "uri", F.sha2("payload", 256).alias("sha256"), F.sha1("payload").alias("sha1"),
                        F.octet_length("payload").cast("bigint").alias("n_bytes"))
    facts.write.parquet(f"{path}/facts")
    facts = spark.read.schema(facts.schema).parquet(f"{path}/facts")
    chosen = facts.groupBy("sha256").agg(F.max("id").alias("response_id"))
    typed = facts.join(chosen, "sha256").withColumn(
        "record_type", F.when((F.col("n_bytes") < revisit_bytes) | F.col("id").eqNullSafe(F.col("response_id")),
                              "response").otherwise("revisit"))
    typed.select("id", "sha256", _header().alias("header")).write.parquet(f"{path}/headers")
    # The chosen record's payload is the stored one; repeated rows of it meet in the aggregation.
    # Grouped by the join's own keys, so the payloads are shuffled once. (A null id is the text "none".)
    named = F.coalesce(F.col("id").cast("string"), F.lit("none")).alias("_id")
    wanted = chosen.select("sha256", F.coalesce(F.col("response_id").cast("string"), F.lit("none")).alias("_id"))
    stored = rows.select(F.sha2("payload", 256).alias("sha256"), named, "payload").join(wanted, ["sha256", "_id"])
    stored = stored.dropDuplicates(["sha256", "_id"]).select("sha256", "payload")
    stored.write.parquet(f"{path}/payloads")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(sha256, payload) of the store; a payload that is not its digest's fails the job."""
    stored = spark.read.parquet(f"{path}/payloads")
    ok = F.sha2("payload", 256) == F.col("sha256")
    return stored.select("sha256", F.when(ok, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match digest "), "sha256"))).alias("payload"))


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)


def _page(text: Column) -> Column:
    return F.regexp_extract(text, "<urn:page:(-?[0-9]+)>", 1).try_cast("bigint")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(id, record_type, uri, payload_digest, refers_to, payload_bytes, sha256) from the header bytes,
    held against the stored payload's own length and SHA-1; a difference fails the job."""
    parsed = spark.read.parquet(f"{path}/headers").select(
        "sha256", _page(_field("WARC-Record-ID")).alias("id"), _field("WARC-Type").alias("record_type"),
        _field("WARC-Target-URI").alias("uri"), F.substring_index(_field("WARC-Payload-Digest"), ":", -1).alias("digest"),
        _page(_field("WARC-Refers-To")).alias("refers_to"), _field("X-Payload-Length").cast("bigint").alias("payload_bytes"))
    stored = read_payloads(spark, path).select(
        F.col("sha256").alias("_sha"), F.sha1("payload").alias("_sha1"), F.octet_length("payload").cast("bigint").alias("_n"))
    joined = parsed.join(stored, F.col("sha256") == F.col("_sha"), "left")
    ok = (F.col("digest") == F.col("_sha1")) & (F.col("payload_bytes") == F.col("_n"))
    return joined.select("id", "record_type", "uri", F.when(ok, F.col("digest")).otherwise(
        F.raise_error(F.concat(F.lit("record without its payload: "), F.coalesce(F.col("id").cast("string"), F.lit("null")))))
        .alias("payload_digest"), "refers_to", "payload_bytes", "sha256")


def original_records(spark: SparkSession, path: str) -> DataFrame:
    """(id, record): the exact bytes of every WARC record, by joining headers and payloads."""
    headers = spark.read.parquet(f"{path}/headers")
    payloads = read_payloads(spark, path)
    body = F.when(_field("WARC-Type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    end = F.lit(CRLF + CRLF).cast("binary")
    return headers.join(payloads, "sha256").select(
        _page(_field("WARC-Record-ID")).alias("id"), F.concat(F.encode("header", "UTF-8"), body, end).alias("record"))


def export_warc(spark: SparkSession, path: str, out: str, compression: str = "none") -> None:
    """Plain .warc part files: the original records one after another. The writer's line end stands for
    the last of a record's closing line ends."""
    record = F.decode("record", "UTF-8")
    value = F.substring(record, F.lit(1), F.length(record) - len(CRLF)).alias("value")
    original_records(spark, path).select(value).write.option("lineSep", CRLF).option("compression", compression).text(out)
