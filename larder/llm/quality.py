"""Quality rules by compression bands.

Ordinary prose compresses within a narrow band that depends on how long the text
is: repetitive text falls below it, random or encoded text above. Each text is
compressed (zstandard) as a whole and in fixed chunks, and every ratio
compressed/raw is held against the limits for that length. Base rules (word count,
repeated three-word windows) come first.

One pass over the table: no shuffle, one text in memory at a time beside its Arrow
batch. A null or empty text has no words and fails the base rules. Null ids, repeated
rows and extra columns pass through; every input row has one output row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"

#: (at least so many bytes, least ratio, most ratio). Texts below the first entry are too short for a ratio to mean anything.
#: Fitted on the documents labelled good (3 409 of them, level 3): the least limit is about two thirds of the
#: smallest ratio found at that length (0.54, 0.51, 0.47, 0.45, 0.43, 0.40), the most limit 0.07 to 0.12 above the greatest
#: (0.73, 0.70, 0.58, 0.52, 0.47, 0.43). Base64 noise lies at 0.95 to 0.75, texts of one repeated phrase below 0.25.
BANDS: Sequence[tuple[int, float, float]] = (
    (256, 0.35, 0.82), (512, 0.33, 0.77), (1024, 0.30, 0.68), (2048, 0.29, 0.62), (4096, 0.28, 0.58), (16384, 0.26, 0.55))
CHUNK = 4096
LEVEL = 3
#: A text is rejected if more than this share of its judged chunks lies outside the band.
BAD_CHUNKS = 0.5

FEATURES = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()), T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()), T.StructField("ratio", T.DoubleType()),
    T.StructField("n_chunks", T.LongType()), T.StructField("n_bad_chunks", T.LongType()),
    T.StructField("reason", T.StringType())])


def repeated_words(words: list[str], n: int = 3) -> int:
    """Words lying in an n-word window that occurs at least twice in the text."""
    windows = list(zip(*(words[k:] for k in range(n))))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = bytearray(len(words))
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered[i:i + n] = b"\x01" * n
    return sum(covered)


def duplicate_lines(text: str) -> int:
    """Lines holding a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(lines) - len(set(lines))


def band(n_bytes: int, bands: Sequence[tuple[int, float, float]]) -> tuple[float, float] | None:
    found = None
    for least, low, high in bands:
        if n_bytes >= least:
            found = (low, high)
    return found


def judge(text: str | None, compress, bands=BANDS, chunk: int = CHUNK, bad_chunks: float = BAD_CHUNKS) -> tuple:
    """The values of FEATURES for one text."""
    text = text or ""
    words = WORD.findall(text)
    repeats = repeated_words(words)
    failed = len(words) < 50 or 100 * repeats > 50 * len(words)
    data = text.encode("utf-8")
    ratio, judged, bad, reason = None, 0, 0, None
    limits = band(len(data), bands)
    if limits:
        ratio = len(compress(data)) / len(data)
        for at in range(0, len(data), chunk) if len(data) > chunk else ():
            part = data[at:at + chunk]
            if part_limits := band(len(part), bands):
                judged += 1
                part_ratio = len(compress(part)) / len(part)
                bad += not part_limits[0] <= part_ratio <= part_limits[1]
        if ratio < limits[0]:
            reason = "repetitive"
        elif ratio > limits[1]:
            reason = "incompressible"
        elif judged and bad > bad_chunks * judged:
            reason = "chunks"
    if failed:
        reason = "base"
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), duplicate_lines(text), repeats,
            failed, reason is None, ratio, judged, bad, reason)


def _judged(batches: Iterator[pa.RecordBatch], column: str, **limits) -> Iterator[tuple[pa.RecordBatch, list]]:
    import zstandard

    compress = zstandard.ZstdCompressor(level=LEVEL).compress
    for batch in batches:
        yield batch, [judge(x.as_py(), compress, **limits) for x in batch.column(column)]


def quality_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row per input row: its id and FEATURES. ``limits`` are those of ``judge``."""
    df = docs.select(id_col, text_col)
    schema = T.StructType([df.schema[id_col], *FEATURES.fields])

    def run(batches):
        for batch, rows in _judged(batches, text_col, **limits):
            kinds = [f for f in _ARROW]
            cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *cols], names=schema.names)

    return df.mapInArrow(run, schema)


_ARROW = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] + [pa.int64()] * 2 + [pa.string()]


def quality_filter(docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """The rows whose text is kept, with all their columns."""
    def run(batches):
        for batch, rows in _judged(batches, text_col, **limits):
            yield batch.filter(pc.equal(pa.array([r[6] for r in rows], pa.bool_()), True))

    return docs.mapInArrow(run, docs.schema)
