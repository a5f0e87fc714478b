"""Hard-negative mining with cover trees over norm-augmented candidates.

Rows become integer vectors (floor(256 * x)); where the id is divisible by ``noise`` the label is moved by one. Each
candidate gets one more coordinate, sqrt(M^2 - |x|^2) with M the greatest norm of all, so that all lie on one sphere;
an anchor gets a zero there, which leaves inner products as they are. Then |<q, x> - <q, c>| <= |q| * dist(c, x): the
covering radius of a tree's node bounds the scores of all that is below it.

Index. The nearest of ``PIVOTS`` rows (those with the smallest hash of their id: a bounded sample) and, in a cell of more
than ``SHARD`` rows, a hash of the id deal every row to a shard. A task builds the cover tree of a shard:
a node covers its points within a radius; points farther than half of it are picked one after another as
children, each with the remaining points within that half; the rest goes on with the half radius. Every row is one node with its
parent and its covering radius; the trees are written as a table, one row per node.

Search. Anchors (ids divisible by ``anchors_mod``) are dealt in blocks; a block meets every shard of its vector length. Per anchor,
descent is best first: of the waiting nodes those with the best bound for a window go on first, their children's scores
are computed exactly, and a subtree is skipped when its bounds lie outside every window or below the
window's current last result. First each anchor's positives are found (same label, no window), then the
negatives of all its windows (other label, low * positive <= 100 * score <= high * positive, in integers). Shards return at most
``keep`` rows a window, merged by rank. No index or search is approximate.

Scores are exact integers: in double precision where the greatest squared norm is below 2^53 (every partial sum then is an integer
below that), else in 64-bit integers. Odd cases: rows with a null id take no part, nor, as the contract says, rows with a
null label or vector or a null or non-finite component; nor rows whose squared norm reaches 2^62, as scores could leave 64
bits. A repeated id counts once, with its largest label, then largest vector. Vectors of another length than the anchor's do not
meet it. Anchors without positives or without rows in a window have no rows. Other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import written
from larder.llm.streams import fixed, packed, runs

#: Rows of a shard, about.
SHARD = 4096
#: Rows whose cells deal the others to shards.
PIVOTS = 256
#: Anchors that meet a shard at once.
BLOCK = 1024
#: Nodes that go on at once for an anchor; doubles from round to round.
FRONT = 64
EXACT = float(1 << 53)


def integer_rows(df: DataFrame, id_col: str, vec_col: str, label_col: str, noise: int, classes: int) -> DataFrame:
    """(id, label, d, vec): rows that take part, vec as the bytes of 64-bit integers."""
    x = F.col(vec_col).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(2.0 ** 31)))
    label = F.col(label_col).cast("bigint")
    moved = F.when(F.col(id_col) % noise == 0, (label + 1) % classes).otherwise(label)
    rows = df.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull()).filter(fine) \
        .select(F.col(id_col).cast("bigint").alias("id"), moved.alias("label"), F.transform(x, lambda c: F.floor(c * 256.0)).alias("vec"))
    once = rows.groupBy("id").agg(F.max(F.struct("label", "vec")).alias("r")).select("id", "r.label", F.size("r.vec").alias("d"), "r.vec")
    norm = F.aggregate("vec", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    return once.withColumn("norm", norm).filter(F.col("norm") < 2.0 ** 62)


def _matrix(column: pa.ChunkedArray, dtype=np.int64) -> np.ndarray:
    return fixed(column, dtype)


def _as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        col = batch.column("vec")
        values = np.ascontiguousarray(col.flatten().to_numpy(zero_copy_only=False), np.int64)
        lens = np.asarray(batch.column("d"), np.int64)
        ends = np.concatenate([[0], np.cumsum(lens)]) * 8
        body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lens), [None, pa.py_buffer(ends), pa.py_buffer(values.tobytes())]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), batch.column("d"), batch.column("norm"), body],
                                         ["id", "label", "d", "norm", "vec"])


def augmented(x: np.ndarray, most: float) -> np.ndarray:
    """Rows with the coordinate that puts them on the sphere of squared radius ``most``."""
    y = x.astype(np.float64)
    return np.concatenate([y, np.sqrt(np.maximum(0.0, most - (y * y).sum(1)))[:, None]], 1)


def _cells(pivots: np.ndarray, most: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("d"))
            cell = np.zeros(batch.num_rows, np.int32)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                own = [p for p in pivots if len(p) == d]
                if own and d:
                    y = augmented(_matrix(batch.column("vec").take(pa.array(at))), most)
                    cell[at] = (y @ augmented(np.stack(own), most).T).argmax(1)  # all on one sphere: nearest = greatest product
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])
    return run


def cover_tree(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, radius): node k of the tree is row order[k]; parents come before their children."""
    n = len(y)
    order, parent, radius = [0], [-1], [0.0]
    all_but = np.arange(1, n)
    work = [(0, all_but, np.sqrt(((y[all_but] - y[0]) ** 2).sum(1)))]
    while work:
        k, points, dist = work.pop()
        radius[k] = max(radius[k], float(dist.max(initial=0.0)))
        while len(points):
            most = float(dist.max())
            if most == 0.0:  # equal points: leaves
                for p in points.tolist():
                    order.append(p)
                    parent.append(k)
                    radius.append(0.0)
                break
            half = most / 2
            far = dist > half
            rest, points, dist = points[far], points[~far], dist[~far]
            while len(rest):
                p, rest = rest[0], rest[1:]
                order.append(int(p))
                parent.append(k)
                radius.append(0.0)
                apart = np.sqrt(((y[rest] - y[p]) ** 2).sum(1))
                near = apart <= half
                if near.any():
                    work.append((len(order) - 1, rest[near], apart[near]))
                    rest = rest[~near]
    return np.array(order), np.array(parent), np.array(radius)


def _trees(most: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["shard"]):
            x = _matrix(group.column("vec")) if group.column("d")[0].as_py() else np.zeros((group.num_rows, 0), np.int64)
            order, parent, radius = cover_tree(augmented(x, most))
            own = group.select(["shard", "d", "id", "label", "vec"]).take(pa.array(order)).combine_chunks()
            own = own.append_column("seq", pa.array(np.arange(len(order)), pa.int32())).append_column("parent", pa.array(parent, pa.int32())) \
                .append_column("radius", pa.array(radius))
            yield from own.combine_chunks().to_batches()
    return run


INDEX = "shard bigint, d int, id bigint, label bigint, vec binary, seq int, parent int, radius double"


def build_index(rows: DataFrame, most: float) -> DataFrame:
    """The written trees of all rows, a row per node."""
    sample = rows.select("vec").orderBy(F.xxhash64("id"), "id").limit(PIVOTS).collect()
    pivots = [np.frombuffer(r["vec"], np.int64) for r in sample]
    celled = written(rows.mapInArrow(_cells(pivots, most), "id bigint, label bigint, d int, norm double, vec binary, cell int"), "negative-cells")
    counts = celled.groupBy("d", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(SHARD)).alias("parts"), F.count(F.lit(1)).alias("_n"))
    # small cells share a shard: consecutive cells of one length, about SHARD rows together
    before = Window.partitionBy("d").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("pack", F.when(F.col("parts") == 1, F.floor(F.coalesce(F.sum(F.when(F.col("parts") == 1, F.col("_n"))).over(before), F.lit(0)) / SHARD)))
    place = F.when(F.col("parts") == 1, F.xxhash64(F.lit("pack"), "d", "pack")) \
        .otherwise(F.xxhash64(F.lit("cell"), "d", "cell", F.pmod(F.xxhash64("id"), "parts")))
    dealt = celled.join(counts.drop("_n"), ["d", "cell"]).withColumn("shard", place).select("shard", "d", "id", "label", "vec")
    return written(dealt.repartition("shard").sortWithinPartitions("shard", "id").mapInArrow(_trees(most), INDEX), "negative-trees")


# ---- search ------------------------------------------------------------------------------------

class Tree:
    """A shard's nodes in order: parents before children."""

    def __init__(self, group: pa.Table, exact: bool):
        self.ids, self.labels, self.radius = (np.asarray(group.column(c)) for c in ("id", "label", "radius"))
        parent = np.asarray(group.column("parent"))
        d = group.column("d")[0].as_py()
        x = _matrix(group.column("vec")) if d else np.zeros((len(parent), 0), np.int64)
        self.x = x.astype(np.float64) if exact else x
        by = np.argsort(parent, kind="stable")
        self.kids, self.first = by, np.searchsorted(parent[by], np.arange(len(parent) + 1))

    def children(self, nodes: np.ndarray) -> np.ndarray:
        a, b = self.first[nodes], self.first[nodes + 1]
        n = b - a
        total = int(n.sum())
        return self.kids[np.repeat(a - (np.cumsum(n) - n), n) + np.arange(total)] if total else np.zeros(0, np.int64)

    def scores(self, nodes: np.ndarray, q: np.ndarray) -> np.ndarray:
        return np.rint(self.x[nodes] @ q).astype(np.int64) if self.x.dtype == np.float64 else self.x[nodes] @ q

    def search(self, q: np.ndarray, fits, low: np.ndarray, high: np.ndarray, keep: int) -> list[list[tuple[int, int, int]]]:
        """For each window [low, high] the best ``keep`` (score, id, node) among the nodes that ``fits`` admits."""
        reach = math.sqrt(float((q.astype(np.float64) ** 2).sum())) * (1 + 1e-9)
        last = low.astype(np.float64)  # a result below it cannot enter a window
        found: list = [(np.zeros(0, np.int64),) * 3 for _ in low]
        wait, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        nodes, front = np.zeros(1, np.int64), FRONT
        while len(nodes) or len(wait):
            if len(nodes):
                s = self.scores(nodes, q)
                admitted = fits(nodes)
                for w in range(len(low)):
                    hit = admitted & (s >= last[w]) & (s <= high[w])
                    if hit.any():
                        both = [np.concatenate([old, new]) for old, new in zip(found[w], (s[hit], self.ids[nodes[hit]], nodes[hit]))]
                        best = np.lexsort((both[1], -both[0]))[:keep]
                        found[w] = tuple(b[best] for b in both)
                        if len(best) == keep:
                            last[w] = max(last[w], float(found[w][0][-1]))
                inner = self.first[nodes + 1] > self.first[nodes]
                wait, score = np.concatenate([wait, nodes[inner]]), np.concatenate([score, s[inner]])
            wide = reach * self.radius[wait] + 1.0
            top, bottom = score + wide, score - wide
            # best bound a waiting node can give any window that it may still reach
            reachable = (top[:, None] >= last[None, :]) & (bottom[:, None] <= high[None, :])
            gain = np.where(reachable, np.minimum(top[:, None], high[None, :]) - last[None, :], -1.0).max(1, initial=-1.0)
            open_ = reachable.any(1)
            wait, score, gain = wait[open_], score[open_], gain[open_]
            if not len(wait):
                break
            go = np.argpartition(-gain, front - 1)[:front] if len(wait) > front else np.arange(len(wait))
            nodes = self.children(wait[go])
            stay = np.ones(len(wait), bool)
            stay[go] = False
            wait, score, front = wait[stay], score[stay], front * 2
        return [list(zip(*(c.tolist() for c in f))) for f in found]


_ANCHOR = "shard bigint, d int, id bigint, label bigint, vec binary, seq int, parent int, radius double, block int, positives array<bigint>, wanted array<bigint>"
FOUND = "anchor_id bigint, positive_id bigint, positive_score bigint, found_id bigint, score bigint"
TOP = float(1 << 62)


def _search(exact: bool, keep: int, low: int | None, high: int | None):
    """Positives where ``low`` is None, else negatives of each positive's window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["shard", "block"]):
            is_anchor = np.asarray(group.column("parent")) == -2
            anchors, rows = group.filter(pa.array(is_anchor)), group.filter(pa.array(~is_anchor))
            if not anchors.num_rows or not rows.num_rows:
                continue
            tree, out = Tree(rows, exact), []
            d = group.column("d")[0].as_py()
            vecs = _matrix(anchors.column("vec")) if d else np.zeros((anchors.num_rows, 0), np.int64)
            asked = zip(vecs.astype(tree.x.dtype), *(anchors.column(c).to_pylist() for c in ("id", "label", "positives", "wanted")))
            for q, a, label, positives, wanted in asked:
                if low is None:
                    same = (tree.labels == label) & (tree.ids != a)
                    hits = tree.search(q, lambda nodes, same=same: same[nodes], np.array([-TOP]), np.array([TOP]), keep)[0]
                    out += [(a, None, None, i, s) for s, i, _ in hits]
                    continue
                goal = [(p, s, -((-low * s) // 100), high * s // 100) for p, s in zip(positives, wanted)]
                goal = [g for g in goal if g[2] <= g[3]]
                if goal:
                    other = tree.labels != label
                    windows = np.array([[g[2] for g in goal], [g[3] for g in goal]], np.int64)
                    for g, hits in zip(goal, tree.search(q, lambda nodes, other=other: other[nodes], windows[0], windows[1], keep)):
                        out += [(a, g[0], g[1], i, s) for s, i, _ in hits]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["anchor_id", "positive_id", "positive_score", "found_id", "score"])
    return run


def _meet(index: DataFrame, anchors: DataFrame, blocks: int, run) -> DataFrame:
    """Every block of anchors with every shard of its length."""
    shards = index.select("shard", "d").distinct()
    nothing = F.lit(None).cast("array<bigint>")
    nodes = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("positives", nothing).withColumn("wanted", nothing)
    asked = anchors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).join(shards, "d").select(
        "shard", "d", "id", "label", "vec", F.lit(-1).alias("seq"), F.lit(-2).alias("parent"), F.lit(0.0).alias("radius"), "block", "positives", "wanted")
    both = nodes.select(*asked.columns).unionByName(asked)
    return both.repartition("shard", "block").sortWithinPartitions("shard", "block", "seq").mapInArrow(run, FOUND)


def hard_negatives(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", anchors_mod: int = 100,
                   noise: int = 7, classes: int = 10, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); see the module's docstring."""
    rows = written(integer_rows(df, id_col, vec_col, label_col, noise, classes)
                   .mapInArrow(_as_bytes, "id bigint, label bigint, d int, norm double, vec binary"), "negative-rows")
    some = rows.agg(F.max("norm").alias("most"), F.count_if(F.col("id") % anchors_mod == 0).alias("n")).first()
    most, blocks = float(some["most"] or 0.0), max(1, math.ceil((some["n"] or 0) / BLOCK))
    index, exact = build_index(rows, most), most < EXACT
    none = F.lit(None).cast("array<bigint>")
    anchors = rows.filter(F.col("id") % anchors_mod == 0).select("id", "label", "d", "vec")
    near = written(_meet(index, anchors.withColumn("positives", none).withColumn("wanted", none), blocks, _search(exact, positives, None, None)), "positives-found")
    best = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "found_id")
    near = near.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= positives)
    asked = near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("k", "found_id", "score"))).alias("p"))  # at most ``positives`` each
    asked = anchors.join(asked, F.col("id") == F.col("anchor_id")).select("id", "label", "d", "vec", F.col("p.found_id").alias("positives"), F.col("p.score").alias("wanted"))
    found = written(_meet(index, written(asked, "anchors"), blocks, _search(exact, negatives, low, high)), "negatives-found")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("score").desc(), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
