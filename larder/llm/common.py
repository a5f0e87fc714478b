"""Shared pieces of the corpus operators: table access, written intermediates, and
vectorised word hashing over Arrow string batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.session import work_dir

# The white space of the operators' contracts, [\x20\x09-\x0D].
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Text bytes handled at once inside a Python task; a longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return work_dir(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written intermediate table by the file system it lies on."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def free_name(columns: Sequence[str], name: str) -> str:
    """``name``, lengthened until no column has it (names differ in more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


# ---- vectorised hashing -----------------------------------------------------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_P = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _P | np.uint64(1), np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def string_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if col.null_count:  # a null slot may still span bytes
        keep = np.asarray(col.is_valid())
        if (np.diff(offsets)[~keep] != 0).any():
            return string_bytes(col.fill_null(b""))
    base = offsets[0] if len(offsets) else 0
    return data[base:offsets[-1]], offsets - base


def chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``most`` bytes in ``column`` (or one row)."""
    if not batch.num_rows:
        return
    _, offsets = string_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def token_spans(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first) of maximal runs of ``member`` bytes that do not cross texts:
    ``first[i]`` is the index of text i's first run, with a closing entry."""
    n = len(member)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0] = False
        before[1:] = member[:-1]
        after[-1] = False
        after[:-1] = member[1:]
    starts = np.flatnonzero(member & (~before | edge[:n]))
    ends = np.flatnonzero(member & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs [start, end), which lie in order and apart."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    pos = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
    body = values[np.repeat(starts, lens) + pos].astype(np.uint64) + np.uint64(1)
    body *= powers(int(lens.max()))[pos]
    heads = np.cumsum(lens) - lens
    return mix(np.add.reduceat(body, heads) + lens.astype(np.uint64))


_IS_WORD = np.ones(256, bool)
_IS_WORD[[ord(c) for c in SPACE_CHARS]] = False
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def word_hashes(col: pa.Array, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs without SPACE_CHARS) of a string column, and the index of
    each text's first word (with a closing entry). ``fold`` lower-cases A-Z."""
    data, offsets = string_bytes(col)
    starts, ends, first = token_spans(_IS_WORD[data], offsets)
    return span_hashes(_FOLD[data] if fold else data, starts, ends), first


def gram_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``n``-word shingles of each text, and the index of each text's first.
    A text of 1 to n-1 words has one shingle, all its words; an empty one none."""
    counts = np.diff(first)
    grams = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    at = np.concatenate([[0], np.cumsum(grams)])
    total = int(at[-1])
    if not total:
        return np.zeros(0, np.uint64), at
    text = np.repeat(np.arange(len(counts)), grams)
    pos = first[:-1][text] + np.arange(total) - at[:-1][text]
    end = np.minimum(pos + n, first[1:][text])
    acc = np.full(total, 0x51ED270B, np.uint64)
    for k in range(n):
        here = pos + k
        inside = here < end
        acc = np.where(inside, acc * _M2 + words[np.minimum(here, len(words) - 1)], acc)
    return mix(acc), at
