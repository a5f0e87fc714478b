"""Removal of repeated byte strings by bucket-pointer refinement.

Every byte covered by a ``LENGTH``-byte string that also starts in a document with a smaller id is
removed. Suffixes are put into buckets by their first bytes and buckets are refined by the bucket
identifiers (pointers) of later offsets, which are reused recursively: the pointer of the first 2k bytes
at i is named by the pair of k-byte pointers at i and i + k, so six refinements reach 50 bytes. Pointers
are 64-bit names made from the pair instead of ranks, so tasks agree on them without a global sort.

Only a sample of suffixes leaves a task, and it loses nothing: of the 16-byte buckets inside a 50-byte
string the one with the least name is its *anchor*, and equal strings have equal anchors. Neighbouring
strings with one anchor form a *stretch*, sent as one row (anchor, fingerprint of the stretch, id, place).

1. Stretches are sorted by (anchor, fingerprint, id). One equal to a stretch of a smaller id is
   covered whole; a bucket (anchor) with several fingerprints is unresolved, and so are its first holders.
2. Only those get their bytes back. Their bucket is refined, string by string, to full length and sorted by
   pointer and id; strings that a smaller id holds are covered. In a bucket with more than HOT
   holders the strings are named in the map task and go through step 1 again under the refined
   pointers themselves: a task sends a string for its least id only, and the sorted rows are streamed.
3. Covered ranges are united per document and cut out.

A task combines its own rows first (a stretch it has seen with a smaller id is covered there and
then), so an often copied passage sends one row per task. Memory: FLUSH stretches or strings in a map
task, one batch and one small bucket in a sort task.

Null or empty text: no bytes. Rows with a null id are returned as they are and cover nothing.
Repeated rows do not cover each other (no smaller id). Matches never cross documents. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import chunks, mix, string_bytes, written

LENGTH, FIRST = 50, 16
#: Most strings in a stretch, stretches held by a map task, holders of an unsplit bucket.
STRETCH, FLUSH, HOT = 64, 2_000_000, 4096
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACE_BITS = 40
_TAG = (1 << 23) - 1


# ---- pointers ---------------------------------------------------------------------------------

def _paired(p: np.ndarray, step: int) -> np.ndarray:
    """Pointers refined by the pointers ``step`` later (the last ones stay unrefined)."""
    out = p.copy()
    if len(p) > step:
        out[:-step] = mix(p[:-step] * _ODD + p[step:])
    return out


def pointers(data: np.ndarray, length: int) -> np.ndarray:
    """Names of the first ``length`` bytes at each offset; only offsets with that many bytes count."""
    p, reach = mix(data.astype(np.uint64) + np.uint64(1)), 1
    while reach * 2 <= length:
        p, reach = _paired(p, reach), reach * 2
    return _paired(p, length - reach) if reach < length else p


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    out, reach = h.copy(), 1
    while reach < width:
        step = min(reach, width - reach)
        out[:-step] = np.minimum(out[:-step], out[step:])
        reach += step
    return out


class _Fingerprints:
    """Fingerprints of byte ranges by prefix sums; tables grow with the longest chunk."""

    def __init__(self):
        self.pw = self.inv = np.ones(1, np.uint64)

    def of(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = len(data) + 1
        if len(self.pw) < n:
            base = int(_ODD) | 1
            for name, x in (("pw", base), ("inv", pow(base, -1, 1 << 64))):
                t = np.full(n, x, np.uint64)
                t[0] = 1
                setattr(self, name, np.cumprod(t, dtype=np.uint64))
        sums = np.zeros(n, np.uint64)
        np.cumsum(mix(data.astype(np.uint64) + np.uint64(7)) * self.pw[:n - 1], dtype=np.uint64, out=sums[1:])
        return mix((sums[end] - sums[begin]) * self.inv[begin] + (end - begin).astype(np.uint64) * _ODD)


def stretches(data: np.ndarray, offsets: np.ndarray, fingerprints: _Fingerprints) -> tuple[np.ndarray, ...]:
    """(anchor, fingerprint, text, place, strings) of all stretches of the texts in ``data``."""
    n = len(data)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.flatnonzero(np.arange(n) + LENGTH <= offsets[1:][text]) if n else np.zeros(0, np.int64)
    if not len(at):
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    least = _sliding_min(pointers(data, FIRST), LENGTH - FIRST + 1)[at]
    head = np.ones(len(at), bool)
    head[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(head)
    count = np.diff(np.append(first, len(at)))
    if (count > STRETCH).any():  # periodic text: one anchor again and again
        parts = -(-count // STRETCH)
        k = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        first = np.repeat(first, parts) + k * STRETCH
        count = np.minimum(np.repeat(count, parts) - k * STRETCH, STRETCH)
    begin = at[first]
    prints = fingerprints.of(data, begin, begin + count + LENGTH - 1)
    where = text[begin]
    return least[first], prints, where, begin - offsets[:-1][where], count


# ---- stage 1: equal stretches -----------------------------------------------------------------

_ROW = "anchor long, print long, doc long, place long, n int"
_NAMES = ["anchor", "print", "doc", "place", "n"]


def _united(doc: np.ndarray, tag: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges per (doc, tag), touching ones united."""
    order = np.lexsort((begin, tag, doc))
    doc, tag, begin, end = doc[order], tag[order], begin[order], end[order]
    if not len(doc):
        return doc, tag, begin, end
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])
    group = np.cumsum(new)
    wide = np.int64(1) << _PLACE_BITS
    reach = np.maximum.accumulate(end + group * wide) - group * wide
    new[1:] |= begin[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    return doc[heads], tag[heads], begin[heads], np.maximum.reduceat(reach, heads)


def _covered(doc: np.ndarray, place: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    """Ranges as rows: n is minus the range's size, the anchor spreads them evenly."""
    wide = np.int64(_PLACE_BITS)
    doc, tag, begin, end = _united(doc, place >> wide, place & ((1 << _PLACE_BITS) - 1), (place & ((1 << _PLACE_BITS) - 1)) + size)
    place = (tag << wide) | begin
    spread = mix(doc.view(np.uint64) ^ mix(place.view(np.uint64))).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(spread), pa.array(np.zeros(len(doc), np.int64)), pa.array(doc), pa.array(place), pa.array((begin - end).astype(np.int32))], names=_NAMES)


def _combined(rows: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    anchor, prints, doc, place, n = (np.concatenate(c) for c in zip(*rows))
    order = np.lexsort((doc, prints, anchor))
    anchor, prints, doc, place, n = anchor[order], prints[order], doc[order], place[order], n[order]
    head = np.ones(len(doc), bool)
    head[1:] = (anchor[1:] != anchor[:-1]) | (prints[1:] != prints[:-1])
    seen = doc > doc[np.flatnonzero(head)][np.cumsum(head) - 1]
    yield _covered(doc[seen], place[seen], n[seen] + LENGTH - 1)
    keep = ~seen
    yield pa.RecordBatch.from_arrays(
        [pa.array(anchor[keep].view(np.int64)), pa.array(prints[keep].view(np.int64)), pa.array(doc[keep]), pa.array(place[keep]),
         pa.array(n[keep].astype(np.int32))], names=_NAMES)


def _sent(docs: DataFrame) -> DataFrame:
    """(doc, tag, text) -> stretch rows, combined within the task, and ranges covered there."""
    def run(batches):
        rows, held, prints = [], 0, _Fingerprints()
        for whole in batches:
            for batch in chunks(whole, "text"):
                data, offsets = string_bytes(batch.column("text"))
                anchor, mark, text, begin, n = stretches(data, offsets, prints)
                doc = batch.column("doc").to_numpy(zero_copy_only=False)[text]
                tag = batch.column("tag").to_numpy(zero_copy_only=False)[text]
                rows.append((anchor, mark, doc, (tag << np.int64(_PLACE_BITS)) | begin, n))
                held += len(n)
                if held >= FLUSH:
                    yield from _combined(rows)
                    rows, held = [], 0
        if held:
            yield from _combined(rows)

    return docs.mapInArrow(run, _ROW)


def _resolved(batches: Iterator[pa.RecordBatch], single: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (anchor, print, doc) -> covered ranges (n < 0) and unresolved stretches (n > 0).
    ``single``: a bucket has one print, so none is unresolved."""
    # The last bucket's tail goes into the next batch: its last stretch's first holder, and
    # whether the bucket is known to have several prints (its holders so far are then out already).
    tail, several = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in _NAMES]
        out = cols[4] < 0
        if out.any():
            yield batch.filter(pa.array(out))
        cols = [c[~out] for c in cols]
        old = 0
        if tail is not None:
            cols, old = [np.concatenate([t, c]) for t, c in zip(tail, cols)], len(tail[0])
        anchor, prints, doc, place, n = cols
        if not len(doc):
            continue
        bucket = np.ones(len(doc), bool)
        bucket[1:] = anchor[1:] != anchor[:-1]
        run_head = bucket.copy()
        run_head[1:] |= prints[1:] != prints[:-1]
        least = doc[np.flatnonzero(run_head)][np.cumsum(run_head) - 1]
        holder = doc == least
        at = np.cumsum(bucket) - 1
        many = np.bincount(at, weights=run_head) > 1
        if several:
            many[0] = True
        is_open = holder & many[at]
        if several:
            is_open[:old] = False
        seen = ~holder
        if seen.any():
            yield _covered(doc[seen], place[seen], n[seen].astype(np.int64) + LENGTH - 1)
        if is_open.any():
            yield pa.RecordBatch.from_arrays([pa.array(c[is_open]) for c in cols], names=_NAMES)
        last = at == at[-1]
        several = bool(many[-1])
        keep = np.flatnonzero(last & holder)
        if several or single:  # only the last print's least id is still needed
            keep = keep[-1:]
        tail = [c[keep] for c in cols]
        if several and not (prints[keep] == prints[-1]).all():
            tail = [c[-1:] for c in cols]


def _sorted_out(sent: DataFrame) -> DataFrame:
    """Covered ranges and unresolved stretches among the stretches sent."""
    placed = sent.repartition("anchor").sortWithinPartitions("anchor", "print", "doc")
    return placed.mapInArrow(_resolved, _ROW)


# ---- stage 2: refinement of unresolved buckets -----------------------------------------------

def _touching(rows: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Strings with one name, places of a text that touch put into one row: a smaller id covers all or none."""
    names, prints, doc, place = (np.concatenate(c) for c in zip(*rows))
    order = np.lexsort((place, doc, names))
    names, doc, place = names[order], doc[order], place[order]
    head = np.ones(len(doc), bool)
    head[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1]) | (place[1:] - place[:-1] > LENGTH)
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(doc)) - 1
    return names[first], prints[first], doc[first], place[first], place[last] - place[first] + 1


def _with_bytes(unresolved: DataFrame, texts: DataFrame) -> DataFrame:
    """Unresolved stretches with their bytes; those of hot buckets string by string, under the string's
    own pointer and without bytes, combined within the task."""
    per_doc = unresolved.groupBy("doc", "tag").agg(F.collect_list(F.struct("anchor", "begin", "n", "hot")).alias("open"))

    def run(batches):
        strings, held = [], 0
        for batch in batches:
            rows = [[], [], [], [], [], []]
            for doc, tag, text, found in zip(*(batch.column(c) for c in ("doc", "tag", "text", "open"))):
                data, doc, tag = text.as_py().encode("utf-8"), doc.as_py(), tag.as_py()
                for x in found.as_py():
                    begin, n = x["begin"], x["n"]
                    body, place = data[begin:begin + n + LENGTH - 1], (tag << _PLACE_BITS) | begin
                    if x["hot"]:
                        names = pointers(np.frombuffer(body, np.uint8), LENGTH)[:n]
                        strings.append((names, np.zeros(n, np.int64), np.full(n, doc, np.int64), place + np.arange(n)))
                        held += n
                        if held >= FLUSH:
                            yield from map(_bare, _combined([_touching(strings)]))
                            strings, held = [], 0
                        continue
                    for c, v in zip(rows, (x["anchor"], 0, doc, place, n, body)):
                        c.append(v)
                if len(rows[0]) > 20_000:
                    yield _batch(rows)
                    rows = [[], [], [], [], [], []]
            if rows[0]:
                yield _batch(rows)
        if held:
            yield from map(_bare, _combined([_touching(strings)]))

    def _bare(t):
        return pa.RecordBatch.from_arrays([*t.columns, pa.nulls(t.num_rows, pa.binary())], names=[*_NAMES, "body"])

    def _batch(rows):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=[*_NAMES, "body"])

    return texts.join(per_doc, ["doc", "tag"]).select("doc", "tag", "text", "open").mapInArrow(run, f"{_ROW}, body binary")


def _refined(opened: DataFrame) -> DataFrame:
    """Covered ranges (doc, tag, begin, end) among the unresolved stretches."""
    placed = opened.repartition("anchor").sortWithinPartitions(F.col("body").isNotNull(), "anchor", "doc")

    def judge(t: pa.RecordBatch) -> pa.RecordBatch | None:
        data, offsets = string_bytes(t.column("body"))
        size = np.diff(offsets)
        bucket, doc, place = (t.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "doc", "place"))
        tag, begin = place >> np.int64(_PLACE_BITS), place & ((1 << _PLACE_BITS) - 1)
        row = np.repeat(np.arange(len(size)), size - LENGTH + 1)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(size - LENGTH + 1) - (size - LENGTH + 1), size - LENGTH + 1)
        name = mix(pointers(data, LENGTH)[offsets[:-1][row] + inside] + mix(bucket.view(np.uint64))[row])
        order = np.lexsort((doc[row], name))
        name, row, inside = name[order], row[order], inside[order]
        head = np.ones(len(name), bool)
        head[1:] = name[1:] != name[:-1]
        least = doc[row[np.flatnonzero(head)]][np.cumsum(head) - 1]
        seen = doc[row] > least
        if not seen.any():
            return None
        row, start = row[seen], begin[row[seen]] + inside[seen]
        cols = _united(doc[row], tag[row], start, start + LENGTH)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["doc", "tag", "begin", "end"])

    def by_kind(batches):
        for batch in batches:
            named = batch.column("body").null_count  # strings of hot buckets come first
            if named:
                yield True, batch.slice(0, named)
            if named < batch.num_rows:
                yield False, batch.slice(named)

    def buckets(batches):
        rest = None
        for batch in batches:
            t = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            bucket = t.column("anchor").to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
            if cut and (found := judge(t.slice(0, cut))) is not None:
                yield found
            rest = t.slice(cut)
        if (found := judge(rest)) is not None:
            yield found

    def strings(batches):
        for t in _resolved((x.select(_NAMES) for x in batches), single=True):
            place = t.column("place").to_numpy()
            begin = pa.array(place & ((1 << _PLACE_BITS) - 1))
            yield pa.RecordBatch.from_arrays(
                [t.column("doc"), pa.array(place >> np.int64(_PLACE_BITS)), begin,
                 pc.subtract(begin, t.column("n").cast(pa.int64()))], names=["doc", "tag", "begin", "end"])

    def run(batches):
        for named, part in groupby(by_kind(batches), lambda x: x[0]):
            yield from (strings if named else buckets)(x for _, x in part)

    return placed.mapInArrow(run, "doc long, tag long, begin long, end long")


# ---- stage 3: cutting -------------------------------------------------------------------------

def _tag(text: Column, needed: bool) -> Column:
    """Tells texts with the same id apart; 0, which takes no room in a row, where no id has several texts."""
    return F.xxhash64(text).bitwiseAND(F.lit(_TAG)) if needed else F.lit(0).cast("bigint")


def _ids_repeat(docs: DataFrame, id_col: str, text_col: str) -> bool:
    """Whether an id stands beside several texts: one narrow aggregation (a hash per id)."""
    hashes = docs.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(F.xxhash64(text_col)).alias("a"), F.max(F.xxhash64(text_col)).alias("b"))
    return not hashes.filter("a <> b").isEmpty()


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tagged: bool = True) -> DataFrame:
    """(doc, tag, begin, end): covered byte ranges; they may touch or overlap. Ids must be integers. ``tagged`` may be
    False if no id stands beside several texts."""
    texts = docs.filter(F.col(id_col).isNotNull() & (F.octet_length(text_col) >= LENGTH)).select(
        F.col(id_col).cast("bigint").alias("doc"), _tag(F.col(text_col), tagged).alias("tag"), F.col(text_col).alias("text"))
    found = written(_sorted_out(_sent(texts)), "stretches", "zstd")
    place = F.col("place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    tag = F.shiftright("place", _PLACE_BITS).alias("tag")
    whole = found.filter("n < 0").select("doc", tag, place.alias("begin"), (place - F.col("n")).alias("end"))
    unresolved = found.filter("n > 0").select("anchor", "doc", tag, place.alias("begin"), "n")
    sizes = unresolved.groupBy("anchor").agg((F.count(F.lit(1)) > HOT).alias("hot"))
    unresolved = unresolved.join(sizes, "anchor")
    parts = written(_refined(_with_bytes(unresolved, texts)), "refined", "zstd")
    return whole.unionByName(parts)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_bytes, n_removed, n_spans, kept (binary), kept_sha256."""
    tagged = _ids_repeat(docs, id_col, text_col)
    ranges = repeated_ranges(docs, id_col, text_col, tagged)
    per_doc = ranges.groupBy("doc", "tag").agg(F.collect_list(F.struct("begin", "end")).alias("_cut"))
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"), _tag(F.col(text_col), tagged).alias("_tag"))
    joined = rows.join(per_doc, (F.col(id_col).cast("bigint") == F.col("doc")) & (F.col("_tag") == F.col("tag")), "left").select(
        id_col, "_text", "_cut")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for whole in batches:
            for batch in chunks(whole, "_text"):
                rows = []
                for text, cut in zip(batch.column("_text"), batch.column("_cut")):
                    data = (text.as_py() or "").encode("utf-8")
                    kept, at, spans, removed = [], 0, 0, 0
                    if cut.is_valid:
                        flat = cut.values
                        begin = flat.field("begin").to_numpy(zero_copy_only=False)
                        end = flat.field("end").to_numpy(zero_copy_only=False)
                        zero = np.zeros(len(begin), np.int64)
                        for b, e in zip(*(c.tolist() for c in _united(zero, zero, begin, end)[2:])):
                            kept.append(data[at:b])
                            removed, spans, at = removed + e - b, spans + 1, e
                    kept.append(data[at:])
                    body = b"".join(kept)
                    rows.append((len(data), removed, spans, body, hashlib.sha256(body).hexdigest()))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id_col), *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]],
                    names=[id_col, "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return joined.mapInArrow(run, f"{id_col} {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
