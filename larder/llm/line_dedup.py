"""Line deduplication over levelled sorted runs of line hashes.

The index of lines is a set of *runs*: Parquet tables sorted by the 128-bit hash of the
line key, each row (hash, number of documents, largest document id). A key stands in exactly one run. New
documents come in batches: a batch's own keys are merge-anti-joined with the runs already there; those no run
holds become a sorted run of their own on level 0, the entries of the index, and for the keys that a run holds already the
batch only leaves a *rise* (hash, documents, largest id) on the side. Once a level holds ``fanout`` runs they are
merged into one of the next level, so a key is rewritten once per level and not once per batch; as keys are
disjoint, nothing is added up there. Rises are summed by level in the same way, and the verdict joins each entry with its rises.

A line's key is the line without white space ([\\x20\\x09-\\x0D]) at both ends, A-Z in lower
case. Keys of at least ``min_chars`` characters that ``min_docs`` or more documents hold lose
all their lines, but for those of the largest document id that holds the key.

Everything is DataFrame code. Per-key work is a partially aggregated max / sum; the join that
brings verdicts back to lines has one verdict per key on one side, so a hot key's lines can be
split over tasks (AQE skew join). Only (hash, id, position) rows are shuffled beside one
shuffle of the texts that lose lines.

Null or empty text: one empty line, which is kept. A null id is a document of its own whose id
counts as smaller than any other. Repeated rows are one document, and each row is returned.
Extra columns pass through ``drop_lines``, whatever their names; columns named n_lines or n_dropped are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import SPACE_CHARS, ascii_lower, free_name, remove, scratch

MIN_CHARS, MIN_DOCS, FANOUT, BATCHES = 20, 3, 3, 4
KEY = ["_h1", "_h2"]


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("_h1"), F.xxhash64(F.lit("line"), key).alias("_h2")]


def line_rows(docs: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, text hash, position, two key hashes) of every line whose key is long enough."""
    # Lines short even before stripping are dropped while still inside the array.
    lines = F.filter(F.transform(split_lines(F.col(text_col)),
                                 lambda x, i: F.struct(i.alias("pos"), F.btrim(x, F.lit(SPACE_CHARS)).alias("line"))),
                     lambda s: F.length(s["line"]) >= min_chars)
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_text"), F.inline(lines))
    return rows.select("_id", "_text", "pos", *_hashes(ascii_lower(F.col("line"))))


def _run(rows: DataFrame) -> DataFrame:
    """One run: per key the number of documents and the largest id."""
    per_doc = rows.select("_id", *KEY).distinct()
    return per_doc.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.max("_id").alias("last_id"))


def _summed(rises: DataFrame) -> DataFrame:
    return rises.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("last_id").alias("last_id"))


@dataclass
class LineIndex:
    """Levelled runs of entries, and of rises. ``levels[k]`` are the paths of the runs on level k.

    Batches must not share documents: a document's lines are counted within its batch.
    """

    spark: SparkSession
    fanout: int = FANOUT
    levels: list[list[str]] = field(default_factory=list)
    rises: list[list[str]] = field(default_factory=list)

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.parquet(*paths)

    def _write(self, df: DataFrame, level: int) -> str:
        path = scratch(self.spark, f"line-run-{level}")
        df.sortWithinPartitions(*KEY).write.parquet(path)
        return path

    @staticmethod
    def _all(levels: list[list[str]]) -> list[str]:
        return [p for level in levels for p in level]

    def paths(self) -> list[str]:
        return self._all(self.levels)

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The rows of ``batch`` whose key (columns KEY) no run holds."""
        paths = self.paths()
        return batch.join(self._read(paths).select(*KEY), KEY, "left_anti") if paths else batch

    def seen(self, batch: DataFrame) -> DataFrame:
        return batch.join(self._read(self.paths()).select(*KEY), KEY, "left_semi")

    def add(self, rows: DataFrame) -> None:
        """Add a batch of ``line_rows``: its unseen keys as entries, its counts of the others as rises."""
        run = _run(rows)
        if self.paths():
            path = self._write(run, 0)  # written once: both sides below read it
            own = self._read([path])
            risen, new = self._write(self.seen(own), 0), self._write(self.unseen(own), 0)
            remove(self.spark, path)
            self._push(self.rises, risen, summed=True)
            self._push(self.levels, new)
        else:
            self._push(self.levels, self._write(run, 0))

    def _push(self, levels: list[list[str]], path: str, summed: bool = False) -> None:
        if not levels:
            levels.append([])
        levels[0].append(path)
        for k, level in enumerate(levels):
            if len(level) < self.fanout:
                break
            runs = self._read(level)
            merged = self._write(_summed(runs) if summed else runs.repartition(*KEY), k + 1)
            if k + 1 == len(levels):
                levels.append([])
            for p in level:
                remove(self.spark, p)
            levels[k] = []
            levels[k + 1].append(merged)

    def repeated(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """Keys held by at least ``min_docs`` documents, with the largest holder."""
        entries = self._read(self.paths())
        if rises := self._all(self.rises):
            more = _summed(self._read(rises)).select(*KEY, F.col("n_docs").alias("_more"), F.col("last_id").alias("_later"))
            entries = entries.join(more, KEY, "left").select(
                *KEY, (F.col("n_docs") + F.coalesce("_more", F.lit(0))).alias("n_docs"), F.greatest("last_id", "_later").alias("last_id"))
        return entries.filter(F.col("n_docs") >= min_docs)


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                  min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(_id, _text, _drop): per text that loses lines, the positions of the lost lines.

    The rows are fed to the index in ``batches`` parts (whole documents, by a hash of the id).
    """
    spark = docs.sparkSession
    path = scratch(spark, "line-rows")
    batch = F.pmod(F.xxhash64("_id"), F.lit(batches)).alias("batch")
    line_rows(docs, id_col, text_col, min_chars).select("*", batch).write.partitionBy("batch").parquet(path)
    rows = spark.read.schema("_id {}, _text long, pos int, _h1 long, _h2 long, batch int".format(
        docs.schema[id_col].dataType.simpleString())).parquet(path)
    index = LineIndex(spark, fanout)
    for k in range(batches):
        index.add(rows.filter(F.col("batch") == k))
    lost = rows.join(index.repeated(min_docs), KEY).filter(~F.col("_id").eqNullSafe(F.col("last_id")))
    return lost.groupBy("_id", "_text").agg(F.collect_set("pos").alias("_drop"))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All rows and columns of ``docs``, the text without its dropped lines, plus
    ``n_lines`` and ``n_dropped`` (bigint). ``options`` are those of ``dropped_lines``."""
    cols = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    own, other, drop, mine = (free_name([*docs.columns, "_id", "_text", "_drop"], n) for n in ("_lost_id", "_lost_text", "_lost", "_own_text"))
    drops = dropped_lines(docs, id_col, text_col, **options).select(F.col("_id").alias(own), F.col("_text").alias(other), F.col("_drop").alias(drop))
    left = docs.select(*cols, F.xxhash64(text_col).alias(mine))
    joined = left.join(drops, F.col(id_col).eqNullSafe(F.col(own)) & (F.col(mine) == F.col(other)), "left")
    lines = split_lines(F.col(text_col))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(drop))
    text = F.when(F.col(drop).isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    return joined.select(
        *[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in cols],
        F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(drop), F.lit(0)).cast("bigint").alias("n_dropped"))
