"""Prefix trie of conversations with subtree totals by time-forward processing.

A conversation's turns are ordered by turn (null first; ties by a digest of role and text); null role or text is
empty. Every conversation c is rebuilt from the first h turns of conversation c - c % 20 (h = crc32(decimal c) % 4)
and its own turns after its first h (the remainder has the sign of c, as in SQL). A node is a distinct sequence of first d rebuilt turns; the root has d = 0.

Names. A node is named by 128 bits: four sums, over its turns, of 32-bit parts of two hashes of (place, role, text),
so a name is a running sum and needs no state that is carried from turn to turn. Places come from a
distributed numbering of all turns (``keys.surrogate_key``, nulls first) minus the conversation's first number; running sums are
taken in two levels (blocks of ``SPAN`` places), so that a conversation of any length is spread.

Totals. Nodes are cut into shards. A node's weight is the number of turns its members have below it, an upper bound of
its subtree's size; the limit is ``SHARE`` times the square root of all turns. A subtree whose top is the first on its path
within the limit is a light shard; heavy nodes are cut into stretches of one smallest member and at most as many
levels as the limit. Within a shard nodes are sorted by level, deepest first (Spark's external sort), and
stream through a task: each takes the messages addressed to it from a priority queue, adds its own values and
sends the sum to its parent. The queue keeps ``QUEUE`` messages in memory and spills sorted runs to an anonymous
file of the task. Light totals are final; what their tops send is summed per heavy parent. A stretch's sum then
goes, in the same way, across the tops of the stretches (one small pass: about one row per ``limit`` turns), and a last
pass within the stretches takes in what hangs below them.

``ends_sha256`` streams the sorted ids of a node's ends through one hash, so nothing is gathered.

Odd cases. Rows with a null conv_id belong to no conversation and are left out. Repeated rows are repeated turns. A
conversation whose rebuilt form has no turns ends at the root. Long texts are only hashed and counted. An empty table gives
no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import written
from larder.operators.keys import surrogate_key

#: Places summed in one window.
SPAN = 1024
#: Limit of a shard's weight, in square roots of the number of turns.
SHARE = 16
#: Messages a task's queue keeps in memory.
QUEUE = 1 << 17
NODE, PARENT = ["n1", "n2"], ["p1", "p2"]


class SpillingQueue:
    """Messages in order of their address; beyond ``most`` in memory they go to a file as a sorted run."""

    _ROW = struct.Struct("<5q")

    def __init__(self, most: int = QUEUE):
        self.most, self.heap, self.files = most, [], []

    def push(self, message: tuple[int, int, int, int, int]) -> None:
        heapq.heappush(self.heap, (*message, -1))
        if len(self.heap) > self.most + len(self.files):
            self._spill()

    def _spill(self) -> None:
        """Everything that came in memory becomes a run; the heap keeps the head of each run."""
        heads = [m for m in self.heap if m[5] >= 0]
        run = sorted(m for m in self.heap if m[5] < 0)
        f = tempfile.TemporaryFile()
        f.write(b"".join(self._ROW.pack(*m[:5]) for m in run))
        f.seek(0)
        self.files.append(f)
        self.heap = heads
        heapq.heapify(self.heap)
        self._head(len(self.files) - 1)

    def _head(self, k: int) -> None:
        if body := self.files[k].read(self._ROW.size):
            heapq.heappush(self.heap, (*self._ROW.unpack(body), k))

    def take(self, address: tuple[int, int, int]) -> tuple[int, int]:
        """Sums of the two values of all messages to ``address``, which no waiting address precedes."""
        a = b = 0
        while self.heap and self.heap[0][:3] == address:
            *_, x, y, k = heapq.heappop(self.heap)
            a, b = a + x, b + y
            if k >= 0:
                self._head(k)
        return a, b

    def close(self) -> None:
        for f in self.files:
            f.close()
        self.files, self.heap = [], []


TOTALS = "n1 bigint, n2 bigint, leaves bigint, saved bigint"


def _forward(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(most)
        try:
            for batch in batches:
                cols = [batch.column(c).to_pylist() for c in ("depth", "n1", "n2", "p1", "p2", "inside", "leaves", "saved")]
                leaves, saved = [], []
                for depth, n1, n2, p1, p2, inside, own, tokens in zip(*cols):
                    a, b = queue.take((-depth, n1, n2))
                    leaves.append(a := a + own)
                    saved.append(b := b + tokens)
                    if inside:
                        queue.push((1 - depth, p1, p2, a, b))
                yield pa.RecordBatch.from_arrays([batch.column("n1"), batch.column("n2"), pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())],
                                                 ["n1", "n2", "leaves", "saved"])
        finally:
            queue.close()
    return run


def time_forward(nodes: DataFrame, most: int = QUEUE) -> DataFrame:
    """(n1, n2, leaves, saved) summed over each node's subtree within its shard. ``nodes``: n1, n2, depth, p1, p2, shard
    (two columns s1, s2), inside (the parent is in the shard, one level up), leaves and saved, the node's own."""
    order = ["s1", "s2", F.col("depth").desc(), "n1", "n2"]
    return nodes.repartition("s1", "s2").sortWithinPartitions(*order).mapInArrow(_forward(most), TOTALS)


# ---- rebuilt conversations and their prefixes ---------------------------------------------------

def turns_in_place(df: DataFrame) -> DataFrame:
    """(conv, place, a, b, words): every turn with its place from 1, two hashes of role and text, and its text's words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    words = F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("bigint")
    rows = df.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(11), text, F.lit(5), role).alias("b"), words.alias("words"))
    rows = written(rows, "turns")
    numbered = surrogate_key(rows, ["conv", "turn", "a", "b"], "at", unique=False)
    numbered = written(numbered, "turns-numbered")
    first = numbered.groupBy("conv").agg(F.min("at").alias("_first"), F.count(F.lit(1)).alias("n"))
    return numbered.join(first, "conv").select("conv", (F.col("at") - F.col("_first") + 1).alias("place"), "n", "a", "b", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, place, len, a, b, words) of the rebuilt turns; (conv, len) of all conversations."""
    own = turns.groupBy("conv").agg(F.max("n").alias("n"))
    convs = own.select("conv", "n", (F.col("conv") - F.col("conv") % 20).alias("donor"), (F.crc32(F.col("conv").cast("string")) % 4).alias("h"))
    donors = own.select(F.col("conv").alias("donor"), F.col("n").alias("_dn"))
    convs = convs.join(donors, "donor", "left").withColumn("used", F.least("h", F.coalesce("_dn", F.lit(0)))) \
        .withColumn("len", F.col("used") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).select("conv", "donor", "h", "used", "len")
    convs = written(convs, "conversations")
    heads = turns.filter("place <= 3").select(F.col("conv").alias("donor"), "place", "a", "b", "words")
    taken = convs.filter("used > 0").join(heads, "donor").filter("place <= h").select("conv", "place", "len", "a", "b", "words")
    rest = turns.join(convs.select("conv", "h", "used", "len"), "conv").filter("place > h") \
        .select("conv", (F.col("place") - F.col("h") + F.col("used")).alias("place"), "len", "a", "b", "words")
    return taken.unionByName(rest), convs.select("conv", "len")


_PARTS = ["s1", "s2", "s3", "s4"]


def _name(depth, parts) -> tuple:
    return F.xxhash64(*parts, depth), F.xxhash64(depth, F.lit(3), *reversed(parts))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, len, n1, n2, p1, p2, words): the node of every prefix of every rebuilt conversation, and its parent."""
    low = F.lit(0xFFFFFFFF)
    x, y = F.xxhash64("place", "a", "b"), F.xxhash64("b", "place", F.lit(9), "a")
    rows = turns.select("conv", "place", "len", "words", F.floor(F.col("place") / SPAN).alias("span"),
                        F.shiftrightunsigned(x, 32).alias("g1"), x.bitwiseAND(low).alias("g2"), F.shiftrightunsigned(y, 32).alias("g3"), y.bitwiseAND(low).alias("g4"))
    sums = rows.groupBy("conv", "span").agg(*[F.sum(f"g{k}").alias(f"t{k}") for k in range(1, 5)])
    before = Window.partitionBy("conv").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("conv", "span", *[F.coalesce(F.sum(f"t{k}").over(before), F.lit(0)).alias(f"b{k}") for k in range(1, 5)])
    here = Window.partitionBy("conv", "span").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", *[F.sum(f"g{k}").over(here).alias(f"r{k}") for k in range(1, 5)]).join(bases, ["conv", "span"])
    rows = rows.select("conv", F.col("place").cast("bigint").alias("depth"), "len", "words", *[f"g{k}" for k in range(1, 5)],
                       *[(F.col(f"b{k}") + F.col(f"r{k}")).alias(f"s{k}") for k in range(1, 5)])
    own = _name(F.col("depth"), [F.col(s) for s in _PARTS])
    up = _name(F.col("depth") - 1, [F.col(f"s{k}") - F.col(f"g{k}") for k in range(1, 5)])
    return rows.select("conv", "depth", "len", own[0].alias("n1"), own[1].alias("n2"), up[0].alias("p1"), up[1].alias("p2"), "words")


def _with_roots(paths: DataFrame, convs: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    root = _name(zero, [zero] * 4)
    nothing = F.lit(None).cast("bigint")
    return paths.unionByName(convs.select("conv", zero.alias("depth"), "len", root[0].alias("n1"), root[1].alias("n2"), nothing.alias("p1"),
                                          nothing.alias("p2"), zero.alias("words")))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node of its sorted ids, as they stream by."""
    node, state = None, None

    def told():
        return pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([state.hexdigest()])], ["n1", "n2", "ends"])

    for batch in batches:
        n1, n2, conv = (np.asarray(batch.column(c)) for c in ("n1", "n2", "conv"))
        if not len(n1):
            continue
        cuts = [0, *(np.flatnonzero((n1[1:] != n1[:-1]) | (n2[1:] != n2[:-1])) + 1).tolist(), len(n1)]
        done: list = []
        for a, b in zip(cuts, cuts[1:]):
            ids = ",".join(map(str, conv[a:b].tolist())).encode()
            if node != (n1[a], n2[a]):
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (n1[a], n2[a]), hashlib.sha256(ids)
            else:
                state.update(b"," + ids)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([int(d[0]) for d in done], pa.int64()), pa.array([int(d[1]) for d in done], pa.int64()), pa.array([d[2] for d in done])],
                                             ["n1", "n2", "ends"])
    if node is not None:
        yield told()


def _sharded(nodes: DataFrame, paths: DataFrame, limit: int) -> DataFrame:
    """Light nodes with their shard: the first node within the limit on their smallest member's path."""
    light = nodes.filter(F.col("weight") <= limit).select(*NODE)
    tops = paths.join(light, NODE, "left_semi").groupBy("conv").agg(F.min(F.struct("depth", *NODE)).alias("top")) \
        .select("conv", F.col("top.depth").alias("top"), F.col("top.n1").alias("s1"), F.col("top.n2").alias("s2"))
    return nodes.filter(F.col("weight") <= limit).join(tops, F.col("conv_id") == F.col("conv")).drop("conv") \
        .withColumn("inside", F.col("depth") > F.col("top")).drop("top")


def conversation_trie(df: DataFrame, share: float = SHARE, queue: int = QUEUE) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and the node's
    name (n1, n2)."""
    turns = written(turns_in_place(df), "turns-in-place")
    again, convs = rebuilt(turns)
    paths = written(_with_roots(prefixes(written(again, "rebuilt")), convs), "prefixes")
    nodes = paths.groupBy(*NODE).agg(F.min("conv").alias("conv_id"), F.min("depth").alias("depth"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
                                     F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"), F.sum(F.col("len") - F.col("depth")).alias("weight"))
    nodes = written(nodes, "trie-nodes")
    children = nodes.filter("p1 IS NOT NULL").groupBy(*PARENT).agg(F.count(F.lit(1)).alias("n_children")) \
        .select(F.col("p1").alias("n1"), F.col("p2").alias("n2"), "n_children")
    parents = nodes.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), F.col("weight").alias("parent_weight"))
    nodes = nodes.join(children, NODE, "left").join(parents, PARENT, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("bigint"))
    nodes = written(nodes.withColumn("leaves", (F.col("n_children") == 0).cast("bigint"))
                    .withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "trie-linked")
    total = nodes.filter("depth = 0").agg(F.max("weight")).first()[0] or 0
    limit = math.ceil(share * math.sqrt(total)) + 1

    light = written(time_forward(_sharded(nodes, paths, limit), queue), "trie-light")
    heavy = nodes.filter(F.col("weight") > limit)
    sent = light.join(nodes.filter((F.col("weight") <= limit) & (F.col("parent_weight") > limit)).select(*NODE, *PARENT), NODE) \
        .groupBy(*PARENT).agg(F.sum("leaves").alias("in_leaves"), F.sum("saved").alias("in_saved")) \
        .select(F.col("p1").alias("n1"), F.col("p2").alias("n2"), "in_leaves", "in_saved")
    heavy = _taking(heavy, sent).withColumn("s1", F.col("conv_id")).withColumn("s2", F.floor(F.col("depth") / limit)) \
        .withColumn("u1", F.col("parent_conv_id")).withColumn("u2", F.floor((F.col("depth") - 1) / limit)) \
        .withColumn("inside", F.coalesce((F.col("s1") == F.col("u1")) & (F.col("s2") == F.col("u2")), F.lit(False)))
    heavy = written(heavy, "trie-heavy")
    # across the tops of the stretches: a stretch is a node, its level is how many stretches lie above it
    own = heavy.groupBy("s1", "s2").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    tops = heavy.filter("NOT inside").select("s1", "s2", "u1", "u2", *PARENT, F.col("depth").alias("top")).join(own, ["s1", "s2"])
    across = written(_across(tops, queue), "trie-across")
    hanging = across.join(tops.select("s1", "s2", *PARENT), ["s1", "s2"]).filter("p1 IS NOT NULL") \
        .groupBy(*PARENT).agg(F.sum("leaves").alias("in_leaves"), F.sum("saved").alias("in_saved")) \
        .select(F.col("p1").alias("n1"), F.col("p2").alias("n2"), "in_leaves", "in_saved")
    heavy_totals = time_forward(_taking(heavy, hanging), queue)

    ends = paths.filter("depth = len").select(*NODE, "conv").repartition(*NODE).sortWithinPartitions(*NODE, "conv") \
        .mapInArrow(_ends, "n1 bigint, n2 bigint, ends string")
    totals = light.unionByName(heavy_totals).select(*NODE, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    return nodes.join(totals, NODE).join(ends, NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), *NODE)


def _taking(nodes: DataFrame, sent: DataFrame) -> DataFrame:
    """Own values of ``nodes`` with what is ``sent`` to them."""
    return nodes.join(sent, NODE, "left").withColumn("leaves", F.col("leaves") + F.coalesce("in_leaves", F.lit(0))) \
        .withColumn("saved", F.col("saved") + F.coalesce("in_saved", F.lit(0))).drop("in_leaves", "in_saved")


def _across(tops: DataFrame, most: int) -> DataFrame:
    """(s1, s2, leaves, saved): totals of every stretch with all that hangs below it. A stretch's address is the level of its
    top, then its name; the stretch it hangs on has a higher top, so messages always go forward."""
    above = tops.select(F.col("s1").alias("u1"), F.col("s2").alias("u2"), F.col("top").alias("up"))
    rows = tops.join(above, ["u1", "u2"], "left").select("s1", "s2", "top", "u1", "u2", "up", "leaves", "saved")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(most)
        try:
            for batch in batches:
                out = []
                for s1, s2, top, u1, u2, up, own, tokens in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
                    a, b = queue.take((-top, s1, s2))
                    out.append((s1, s2, a + own, b + tokens))
                    if up is not None:
                        queue.push((-up, u1, u2, a + own, b + tokens))
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(4)], ["s1", "s2", "leaves", "saved"])
        finally:
            queue.close()

    return rows.repartition(1).sortWithinPartitions(F.col("top").desc(), "s1", "s2").mapInArrow(run, "s1 bigint, s2 bigint, leaves bigint, saved bigint")
