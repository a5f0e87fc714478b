"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread.

quality rules -> line dedup -> n-gram Jaccard join -> benchmark decontamination -> BPE.

Every stage function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the
columns of ``documents``. Rows with a null id cannot be told apart and pass the stage that keeps one
document per class. A repeated id is kept once there, with the text that is judged. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import bpe, decontaminate, jaccard_join, line_dedup, quality
from larder.llm.common import free_name, table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules keep."""
    return quality.quality_filter(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that a larger document id also holds; ``n_chars`` is the new length."""
    done = line_dedup.drop_lines(docs).select(*docs.columns)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class of near copies."""
    classes = jaccard_join.jaccard_classes(docs)
    own, row = (free_name(docs.columns, n) for n in ("_kept_id", "_kept_row"))
    keep = classes.filter(F.col("doc_id") == F.col("class_id")).select(F.col("doc_id").alias(own))
    # of a repeated id's texts the one that is judged stays: the least hash, wordless texts last; join and grouping share one shuffle
    judged = F.struct(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)), F.xxhash64("text"))
    kept = docs.join(keep, F.col("doc_id") == F.col(own), "left_semi")
    kept = kept.groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), judged).alias(row)).select(F.col(f"{row}.*"))
    return kept.unionByName(docs.filter(F.col("doc_id").isNull()))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids): the token ids of every document."""
    coded = bpe.bpe_encode(docs)
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [("quality rules", quality_stage), ("line dedup", line_stage), ("n-gram Jaccard join", near_stage),
          ("benchmark decontamination", benchmark_stage), ("BPE", bpe_stage)]
ORACLE_SQL = None  # compression, chosen paths and BPE have no SQL form; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
