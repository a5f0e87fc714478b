"""Benchmark decontamination: BM25 over an inverted index of test items with block-max WAND.

Index. Each benchmark item is cut into units of at most UNIT_WORDS words. A posting list per term
holds (unit, impact) in unit order; the impact is the term's BM25 weight in the unit divided by the
unit's own total, so a passage that holds the whole unit scores 1. Lists are cut into blocks of units,
each with its largest impact. Postings are a few numbers per benchmark word; an index is built for
at most INDEX_WORDS words at a time (a shard), so what tasks receive has a fixed bound, and a larger
benchmark takes more passes over the documents. Unit counts, mean length and document frequencies are those of the whole
benchmark, counted by Spark, so the number of shards changes no score.

Query. Every document is cut into passages of PASSAGE_WORDS words that overlap by half, to its end.
A first pass over all words of a batch sums each passage's block maxima (vectorised) and leaves the
blocks whose bound reaches the threshold; block-max WAND then walks the posting lists of those
passages, moving to a pivot unit only if the lists' maxima, then the block maxima at the pivot, can reach
the threshold, and retrieves every unit that does. The bounds are upper bounds, so nothing is lost.

Verification. An item with a retrieved unit is compared with the passages that retrieved one: the
three-word shingles of its question (all but its last ANSWER_SHARE words) and of its answer (those)
must both be found to at least OVERLAP; a shorter question or answer is one shingle of its words. A document is
contaminated if an item passes.

Words are runs of letters and digits (ASCII letters, digits and all non-ASCII characters) of the
lower-cased text; each kana or ideograph is a word. Null or empty texts are clean, null or wordless items are left out, an empty
benchmark leaves all clean; repeated items are items; repeated rows and null ids have their own rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import chunks, free_name, span_hashes, string_bytes, token_spans, written

UNIT_WORDS, PASSAGE_WORDS, THRESHOLD = 24, 48, 0.6
K1, B = 1.2, 0.75
BLOCK_UNITS = 4
#: Most benchmark words in one index shard, and most blocks in the first pass's table.
INDEX_WORDS, MAX_BLOCKS = 200_000, 128
ANSWER_SHARE, OVERLAP, SHINGLE = 0.25, 0.5, 3

_MEMBER = np.zeros(256, bool)
_MEMBER[128:] = True
for _a, _b in (("0", "9"), ("a", "z"), ("A", "Z")):
    _MEMBER[ord(_a):ord(_b) + 1] = True


#: First bytes of the three-byte characters from U+3000 to U+9FFF: kana and ideographs, written without spaces.
_UNSPACED = np.zeros(256, bool)
_UNSPACED[0xE3:0xEA] = True


def words_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (int64) of all words of a string column, and the index of each text's first."""
    data, offsets = string_bytes(pc.utf8_lower(col))
    starts, ends, first = token_spans(_MEMBER[data], offsets)
    alone = np.flatnonzero(_UNSPACED[data])
    if len(alone):  # each character of these scripts is a word, and ends the run before it
        inner = np.unique(np.concatenate([alone, alone + 3]))
        run = np.searchsorted(starts, inner, "right") - 1
        inner = inner[(run >= 0) & (inner > starts[run]) & (inner < ends[run])]
        starts, ends = np.sort(np.concatenate([starts, inner])), np.sort(np.concatenate([ends, inner]))
        first = np.searchsorted(starts, offsets, "left")
    return span_hashes(data, starts, ends).view(np.int64), first


def shingles(words: np.ndarray, n: int = SHINGLE) -> set:
    """The runs of ``n`` words; a shorter text has none."""
    w = words.tolist()
    return set(zip(*(w[k:] for k in range(n))))


def parts_of(words: np.ndarray) -> tuple[set, set]:
    """The shingles of an item's question and answer, of three words or as many as each has. An item of one word is its own
    question and answer."""
    cut = len(words) - max(1, int(len(words) * ANSWER_SHARE))
    question = words[:cut] if cut else words
    answer = words[max(0, min(cut, len(words) - SHINGLE)):]
    return shingles(question, min(SHINGLE, len(question))), shingles(answer, min(SHINGLE, len(answer)))


def units_of(words: np.ndarray) -> list[np.ndarray]:
    """An item's units: equal pieces of at most UNIT_WORDS words."""
    return np.array_split(words, max(1, math.ceil(len(words) / UNIT_WORDS)))


class ItemIndex:
    """The inverted index of one shard of items: ``items`` are (item id, words as hashes). ``stats`` holds what BM25 counts over
    the whole benchmark: units, their mean length, and the number of units that hold each of the shard's words; without
    it the items are the whole benchmark."""

    def __init__(self, items: Sequence[tuple[int, np.ndarray]], threshold: float = THRESHOLD, stats: tuple[int, float, dict[int, int]] | None = None):
        self.threshold = threshold
        self.items = {}
        units: list[tuple[int, np.ndarray]] = []
        for number, (item, words) in enumerate(items):
            self.items[number] = (item, *parts_of(words))
            units += [(number, p) for p in units_of(words)]
        self.item_of = [n for n, _ in units]
        if stats is None:
            stats = len(units), float(np.mean([len(p) for _, p in units])) if units else 1.0, defaultdict(int)
            for _, p in units:
                for t in set(p.tolist()):
                    stats[2][t] += 1
        n_units, mean, holders = stats[0], max(1.0, stats[1]), stats[2]
        self.postings: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for u, (_, p) in enumerate(units):
            terms, tf = np.unique(p, return_counts=True)
            idf = np.array([math.log(1 + (n_units - holders[t] + 0.5) / (holders[t] + 0.5)) for t in terms.tolist()])
            weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(p) / mean))
            weight /= weight.sum()
            for t, x in zip(terms.tolist(), weight.tolist()):
                self.postings[t].append((u, x))
        self.most = {t: max(x for _, x in ps) for t, ps in self.postings.items()}
        # (last unit, largest impact) of each block of a term's postings
        self.blocks = {t: [(ps[min(k + BLOCK_UNITS, len(ps)) - 1][0], max(x for _, x in ps[k:k + BLOCK_UNITS]))
                           for k in range(0, len(ps), BLOCK_UNITS)] for t, ps in self.postings.items()}
        self.terms = np.sort(np.fromiter(self.postings, np.int64, len(self.postings)))
        wide = max(1, math.ceil(len(units) / MAX_BLOCKS))
        self.bound = np.zeros((len(self.terms), max(1, math.ceil(len(units) / wide))), np.float32)
        for row, t in enumerate(self.terms.tolist()):
            for u, x in self.postings[t]:
                self.bound[row, u // wide] = max(self.bound[row, u // wide], x)

    def hopeful(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(passages, 2): begin and end in ``words`` of the passages with a block whose bound
        reaches the threshold. Passages are two cells of half a passage; the last may be shorter."""
        half = PASSAGE_WORDS // 2
        row = np.minimum(np.searchsorted(self.terms, words), max(0, len(self.terms) - 1))
        known = np.flatnonzero(self.terms[row] == words) if len(self.terms) else np.zeros(0, np.int64)
        counts = np.diff(first)
        cells = -(-counts // half)
        base = np.concatenate([[0], np.cumsum(cells)])
        if not len(known):
            return np.zeros((0, 2), np.int64)
        text = np.searchsorted(first, known, "right") - 1
        cell = base[text] + (known - first[text]) // half
        cells_n, step = int(base[-1]), 1 << 14
        reach = np.zeros(cells_n, bool)
        for lo in range(0, cells_n, step):
            # One cell more than the step: the last passage's second half.
            hi = min(lo + step, cells_n)
            a, e = np.searchsorted(cell, [lo, hi + 1])
            if a == e:
                continue
            sums = np.zeros((hi - lo + 1, self.bound.shape[1]), np.float32)
            own, where = np.unique(cell[a:e], return_index=True)
            sums[own - lo] = np.add.reduceat(self.bound[row[known[a:e]]], where, axis=0)
            # (a text's last cell also sees the next text's first: the bound stays an upper bound)
            reach[lo:hi] = (sums[:-1] + sums[1:]).max(1) >= self.threshold - 1e-3
        begin = np.flatnonzero(reach)
        text = np.searchsorted(base, begin, "right") - 1
        start = first[text] + (begin - base[text]) * half
        end = np.minimum(start + PASSAGE_WORDS, first[text + 1])
        return np.stack([start, end], 1)

    def search(self, words: Sequence[int]) -> list[int]:
        """Units scoring at least the threshold for the distinct ``words``: block-max WAND."""
        lists = [(self.postings[t], self.blocks[t], self.most[t]) for t in set(words) if t in self.postings]
        at = [0] * len(lists)
        order = sorted(range(len(lists)), key=lambda k: lists[k][0][0][0])
        found = []
        theta = self.threshold - 1e-9
        while order:
            # The pivot: the first list at which the maxima so far can reach the threshold.
            total, pivot = 0.0, -1
            for n, k in enumerate(order):
                total += lists[k][2]
                if total >= theta:
                    pivot = n
                    break
            if pivot < 0:
                break
            unit = lists[order[pivot]][0][at[order[pivot]]][0]
            while pivot + 1 < len(order) and lists[order[pivot + 1]][0][at[order[pivot + 1]]][0] == unit:
                pivot += 1
            # Shallow move: the maxima of the blocks that hold the pivot unit.
            total, nearest = 0.0, None
            for k in order[:pivot + 1]:
                blocks = lists[k][1]
                b = at[k] // BLOCK_UNITS
                while b < len(blocks) and blocks[b][0] < unit:
                    b += 1
                if b < len(blocks):
                    total += blocks[b][1]
                    nearest = blocks[b][0] if nearest is None else min(nearest, blocks[b][0])
            moved = order[:pivot + 1]
            if total < theta:
                # No unit up to the end of the nearest block, or to the next list's unit, can reach it.
                target = unit + 1 if nearest is None else nearest + 1
                if pivot + 1 < len(order):
                    target = min(target, lists[order[pivot + 1]][0][at[order[pivot + 1]]][0])
                target = max(target, unit + 1)
            elif lists[order[0]][0][at[order[0]]][0] == unit:
                score = sum(lists[k][0][at[k]][1] for k in moved)
                if score >= theta:
                    found.append(unit)
                target = unit + 1
            else:
                target = unit
            for k in moved:
                postings, p = lists[k][0], at[k]
                while p < len(postings) and postings[p][0] < target:
                    p += 1
                at[k] = p
            order = sorted((k for k in order if at[k] < len(lists[k][0])), key=lambda k: lists[k][0][at[k]][0])
        return found

    def verified(self, words: np.ndarray, spans: np.ndarray) -> list[tuple[int, float, float]]:
        """(item id, question overlap, answer overlap) of the items that the passages ``spans`` of
        one text hold."""
        hits: dict[int, set] = defaultdict(set)
        for a, b in spans.tolist():
            passage = np.unique(words[a:b])  # the first pass counts a repeated word each time
            row = np.minimum(np.searchsorted(self.terms, passage), len(self.terms) - 1)
            if self.bound[row[self.terms[row] == passage]].sum(0).max() < self.threshold - 1e-3:
                continue
            for u in self.search(passage.tolist()):
                hits[self.item_of[u]].add((a, b))
        out = []
        for number, where in hits.items():
            item, question, answer = self.items[number]
            # A passage may cut the item: its neighbours belong to the comparison.
            sizes = {len(next(iter(question))), len(next(iter(answer)))}
            have: set = set()
            for a, b in where:
                for n in sizes:
                    have |= shingles(words[max(self._lo, a - PASSAGE_WORDS):min(self._hi, b + PASSAGE_WORDS)], n)
            q, r = len(question & have) / len(question), len(answer & have) / len(answer)
            if q >= OVERLAP and r >= OVERLAP:
                out.append((item, q, r))
        return sorted(out)

    def matches(self, col: pa.Array) -> list[list[tuple[int, float, float]]]:
        """Per text of a string column, its verified items."""
        words, first = words_of(col)
        spans = self.hopeful(words, first)
        out: list[list] = [[] for _ in range(len(col))]
        if len(spans):
            text = np.searchsorted(first, spans[:, 0], "right") - 1
            for t in np.unique(text).tolist():
                self._lo, self._hi = int(first[t]), int(first[t + 1])
                out[t] = self.verified(words, spans[text == t])
        return out


_UNITS = "words array<bigint>, n int"


def _unit_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of every unit, and its length."""
    for whole in batches:
        for batch in chunks(whole, "text"):
            words, first = words_of(batch.column("text"))
            units = [u for a, b in zip(first, first[1:]) if b > a for u in units_of(words[a:b])]
            yield pa.RecordBatch.from_arrays([pa.array([np.unique(u) for u in units], pa.list_(pa.int64())), pa.array([len(u) for u in units], pa.int32())], ["words", "n"])


def shards(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
           index_words: int = INDEX_WORDS) -> Iterator[tuple[list[tuple[int, np.ndarray]], tuple[int, float, dict[int, int]]]]:
    """The benchmark's items in parts of about ``index_words`` words (an item is never cut), each with the statistics of the
    whole benchmark for its words, which are counted by Spark: the number of parts changes no score."""
    items = benchmark.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / 4 / index_words))  # words have four characters or more with their space, mostly
    units = written(items.mapInArrow(_unit_terms, _UNITS), "benchmark-units")
    told = units.agg(F.count(F.lit(1)), F.avg("n")).first()
    counted = written(units.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("holders")), "benchmark-words")
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        own = part.mapInArrow(_unit_terms, _UNITS).select(F.explode("words").alias("word")).distinct()
        holders = counted.join(own, "word", "left_semi").toArrow()  # at most a shard's words
        part = part.toArrow().combine_chunks()
        words, first = words_of(part.column("text"))
        ids = part.column("item_id").to_pylist()
        found = [(i, words[a:b]) for i, a, b in zip(ids, first, first[1:]) if b > a]
        stats = int(told[0]), float(told[1] or 1.0), dict(zip(holders.column("word").to_pylist(), holders.column("holders").to_pylist()))
        yield sorted(found, key=lambda x: (x[0] is not None, x[0] or 0)), stats


_RESULT = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("question", T.DoubleType()),
                                    T.StructField("answer", T.DoubleType())]))
_KIND = pa.list_(pa.struct([("item_id", pa.int64()), ("question", pa.float64()), ("answer", pa.float64())]))


def contaminated_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, items) per row of ``docs``: the verified items as (item_id, question, answer), by item."""
    spark = docs.sparkSession
    name, text = free_name([id_col], "_text"), free_name([id_col], "_digest")
    df = docs.select(id_col, F.col(text_col).alias(name), F.xxhash64(text_col).alias(text))
    schema = T.StructType([df.schema[id_col], df.schema[text], T.StructField("items", _RESULT)])
    parts = []
    for items, stats in shards(benchmark, item_id, item_text):
        index = spark.sparkContext.broadcast(ItemIndex(items, threshold, stats))

        def run(batches, index=index):
            for whole in batches:
                for batch in chunks(whole, name):
                    rows = index.value.matches(batch.column(name))
                    found = pa.array([[{"item_id": i, "question": q, "answer": r} for i, q, r in x] for x in rows], _KIND)
                    yield pa.RecordBatch.from_arrays([batch.column(id_col), batch.column(text), found], names=schema.names)

        parts.append(df.mapInArrow(run, schema))
    if len(parts) == 1:
        return parts[0].drop(text)
    # More shards: a row's items meet again under its id and the digest of its text.
    every = parts[0].filter(F.size("items") > 0)
    for p in parts[1:]:
        every = every.unionByName(p.filter(F.size("items") > 0))
    merged = written(every, "matches").groupBy(F.col(id_col).alias("_id"), F.col(text).alias("_of")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("_items"))
    rows = df.select(id_col, text)
    return rows.join(merged, F.col(id_col).eqNullSafe(F.col("_id")) & F.col(text).eqNullSafe(F.col("_of")), "left").select(
        id_col, F.coalesce("_items", F.array().cast(_RESULT)).alias("items"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                    item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) in which no benchmark item is verified."""
    out = docs
    for items, stats in shards(benchmark, item_id, item_text):
        index = docs.sparkSession.sparkContext.broadcast(ItemIndex(items, threshold, stats))

        def run(batches, index=index):
            for whole in batches:
                for batch in chunks(whole, text_col):
                    rows = index.value.matches(batch.column(text_col))
                    yield batch.filter(pa.array([not x for x in rows], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
