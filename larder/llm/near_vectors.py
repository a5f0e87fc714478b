"""Near copies among embeddings: randomised-rotation binary codes with correction factors.

Method. Every distinct valid vector x (unit length, double) is a node. Under a random rotation R it has
the code s = sign(Rx) / sqrt(d), one bit a dimension, and the stored factor f = <s, Rx>. For a unit
vector y, <s, Ry> / f is an unbiased estimate of <x, y>; its error is sqrt(1 - <x, y>^2) * sqrt((1 - f^2) / f^2)
times a coordinate of a random unit vector of d - 1 dimensions. So a pair whose true product reaches the
threshold T lies below T - sqrt(1 - T^2) * sqrt((1 - f^2) / f^2) * EPSILON / sqrt(d - 1) with a probability of
about 3e-5 (EPSILON = 4 deviations); pairs below are dropped, the others are computed again exactly. The
rotated y travels as one signed byte a dimension, and what that rounding can change at most is stored and
added to the bound. Both directions of a pair must pass.

Candidates. A pair is estimated if both vectors share a bucket in one of several tables. A bucket is
named by the nearest of 256 directions (both ends of 128 rotated axes), taken k times; k grows with the
logarithm of the number of nodes (about ``BUCKET`` unrelated vectors in a bucket), and the number of tables
follows from the chance, measured on random pairs at the threshold, that such a pair shares a bucket:
it finds a pair at the threshold with a probability of 1 - ``MISS`` (0.99); closer pairs more surely.

Spark. Codes (about three bytes a dimension) are dealt by bucket; a bucket of more than ``BLOCK`` rows is dealt
as pairs of blocks, so no task holds more than two blocks. A task names the vectors with a pair
that is not dropped and whose first shared table it is; only these vectors' full values are dealt
to the same places, where the exact products are computed. Neither pass emits pairs: the second returns a row per
vector with the number of its links and its least linked neighbour in the block, a forest from which
components are built. Exact copies are one node with a size, whatever their number.

Odd cases. Null ids: the row links with nothing, has 0 links, a null component and is not kept. Null, empty or zero
vectors, or such with a null or non-finite component: 0 links, own id as component, kept. Vectors of unlike length
never link. Repeated rows (same id or not) are separate rows and link with each other. Components are double;
other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import written
from larder.llm.graph import connected_components
from larder.llm.streams import fixed, packed, runs

#: Rows of a bucket compared at once; larger buckets are dealt as pairs of blocks.
BLOCK = 1024
#: Unrelated vectors expected in a bucket.
BUCKET = 32
#: Chance that a pair at the threshold shares no bucket.
MISS = 0.01
#: Deviations of the estimate that are allowed for.
EPSILON = 4.0
#: Axes of one bucket name (two directions each).
AXES = 128
#: Encoded rows handled at once.
SLICE = 1024


@lru_cache(maxsize=64)
def rotation(d: int, rows: int, seed: int) -> np.ndarray:
    """``rows`` x ``d``: random rotations of d dimensions, one below the other."""
    rng = np.random.default_rng([seed, d])
    parts = []
    for _ in range(-(-rows // d)):
        q, r = np.linalg.qr(rng.standard_normal((d, d)))
        parts.append(q * np.sign(np.diag(r)))
    return np.concatenate(parts)[:rows]


def directions(x: np.ndarray, seed: int) -> np.ndarray:
    """The nearest of the 2 * AXES directions of a seed, for every row."""
    y = x @ rotation(x.shape[1], AXES, seed).T
    at = np.abs(y).argmax(1)
    return (2 * at + (y[np.arange(len(y)), at] < 0)).astype(np.int64)


def bucket_keys(x: np.ndarray, names: int, tables: int) -> np.ndarray:
    """rows x tables: the bucket of every row, ``names`` directions each."""
    out = np.zeros((len(x), tables), np.int64)
    for t in range(tables):
        for k in range(names):
            out[:, t] = out[:, t] * (2 * AXES) + directions(x, 1 + t * names + k)
    return out


def shape(nodes: int, d: int, threshold: float) -> tuple[int, int]:
    """(directions per bucket name, tables) for so many nodes of ``d`` dimensions."""
    names = max(1, math.ceil(math.log2(max(nodes, 2) / BUCKET) / math.log2(2 * AXES)))
    if d < 2:
        return names, 1
    rng = np.random.default_rng(d)
    a, b = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in rng.standard_normal((2, 4000, d)))
    b -= (a * b).sum(1, keepdims=True) * a
    b = threshold * a + math.sqrt(1 - threshold ** 2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    same = min(0.999, max(0.05, float((directions(a, 0) == directions(b, 0)).mean() - 0.02)))
    return names, max(1, math.ceil(math.log(MISS) / math.log1p(-same ** names)))


def unit_rows(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) of the valid rows of a list<double> column, by length."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    lens = np.asarray(pa.compute.list_value_length(col).fill_null(0))
    values = np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64)
    starts = np.cumsum(lens) - lens
    for d in np.unique(lens[lens > 0]):
        at = np.flatnonzero(lens == d)
        x = values[starts[at][:, None] + np.arange(d)]
        fine = np.isfinite(x).all(1) & (x != 0).any(1)
        at, x = at[fine], x[fine]
        x = x / np.abs(x).max(1, keepdims=True)
        yield at, x / np.linalg.norm(x, axis=1, keepdims=True)


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, node, d, vec): node is a digest of the unit vector; null for what cannot link."""
    for batch in batches:
        n = batch.num_rows
        node, vec, dims = [None] * n, [None] * n, np.zeros(n, np.int32)
        valid = np.asarray(batch.column("id").is_valid())
        for at, x in unit_rows(batch.column("vec")):
            for i, row in zip(at.tolist(), x):
                if valid[i]:
                    vec[i] = row.tobytes()
                    node[i] = hashlib.blake2b(vec[i], digest_size=16).digest()
                    dims[i] = len(row)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(node, pa.binary()), pa.array(dims), pa.array(vec, pa.binary())],
                                         ["id", "node", "d", "vec"])


def encode(x: np.ndarray) -> np.ndarray:
    """Bytes of each unit row: bits of the code, then f, the scale and the rounding bound as floats,
    then the rotated vector in signed bytes."""
    d = x.shape[1]
    y = x @ rotation(d, d, 0).T
    f = np.abs(y).sum(1) / math.sqrt(d)
    scale = np.abs(y).max(1) / 127.0
    q = np.rint(y / scale[:, None]).astype(np.int8)
    off = np.abs(y - q * scale.astype(np.float32).astype(np.float64)[:, None]).sum(1) / math.sqrt(d)
    floats = np.stack([f, scale, off], 1).astype(np.float32)
    return np.concatenate([np.packbits(y >= 0, axis=1), floats.view(np.uint8), q.view(np.uint8)], 1)


def _codes(names: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("d"))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                for k in range(0, len(at), SLICE):
                    part = batch.take(pa.array(at[k:k + SLICE]))
                    x = fixed(part.column("vec"), np.float64)
                    keys = bucket_keys(x, names, tables)
                    spread = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, tables), pa.int32()), pa.array(keys.ravel()))
                    yield pa.RecordBatch.from_arrays([part.column("node"), part.column("d"), packed(encode(x)), spread],
                                                     ["node", "d", "body", "keys"])
    return run


def likely(d: int, body: np.ndarray, threshold: float) -> np.ndarray:
    """Square matrix: pairs that the confidence bounds do not rule out."""
    bits = -(-d // 8)
    s = np.unpackbits(body[:, :bits], axis=1, count=d).astype(np.float32) * np.float32(2) - np.float32(1)
    f, scale, off = (np.ascontiguousarray(body[:, bits:bits + 12]).view(np.float32)[:, k] for k in range(3))
    q = np.ascontiguousarray(body[:, bits + 12:]).view(np.int8).astype(np.float32) * scale[:, None]
    estimate = (s @ q.T) / (np.float32(math.sqrt(d)) * f[:, None])
    wide = math.sqrt(max(0.0, 1 - threshold ** 2)) * np.sqrt(np.maximum(0, 1 - f * f)) / f * EPSILON / math.sqrt(max(d - 1, 1))
    # the estimate may pass 1 and float32 rounds: a small allowance on top
    passed = estimate >= threshold - wide[:, None] - off[None, :] / f[:, None] - 1e-4
    return passed & passed.T


def _own_pairs(group: pa.Table, keys: np.ndarray) -> np.ndarray:
    """Pairs this group answers for: across its two blocks (or within one), a < b, in no earlier table together."""
    block, i, j, t = (np.asarray(group.column(c)) for c in ("b", "i", "j", "t"))
    m = len(block)
    mine = np.triu(np.ones((m, m), bool), 1)
    if i[0] != j[0]:
        mine &= block[:, None] != block[None, :]
    for k in range(int(t[0])):
        mine &= keys[:, k][:, None] != keys[:, k][None, :]
    return mine


PLACE = ["t", "key", "d", "i", "j"]


def _list_matrix(column: pa.ChunkedArray) -> np.ndarray:
    col = column.combine_chunks()
    return np.asarray(col.flatten()).reshape(len(column), -1)


def _hopeful(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, PLACE):
            if group.num_rows < 2:
                continue
            mine = _own_pairs(group, _list_matrix(group.column("keys")))
            if not mine.any():
                continue
            mine &= likely(int(group.column("d")[0].as_py()), fixed(group.column("body"), np.uint8), threshold)
            some = np.flatnonzero(mine.any(0) | mine.any(1))
            if len(some):
                yield from group.select([*PLACE, "b", "node"]).take(pa.array(some)).combine_chunks().to_batches()
    return run


def local_roots(linked: np.ndarray) -> np.ndarray:
    """For a symmetric matrix, the least row number that each row reaches."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(label)).min(1)
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _exact(threshold: float, names: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, PLACE):
            x = fixed(group.column("vec"), np.float64)
            mine = _own_pairs(group, bucket_keys(x, names, tables)) & likely(x.shape[1], encode(x), threshold)
            linked = mine & (x @ x.T >= threshold)
            linked |= linked.T
            some = np.flatnonzero(linked.any(1))
            if not len(some):
                continue
            size = np.asarray(group.column("size"))
            nodes = group.column("node").combine_chunks()
            roots = local_roots(linked)
            yield pa.RecordBatch.from_arrays(
                [nodes.take(pa.array(some)), pa.array((linked[some] * size[None, :]).sum(1), pa.int64()), nodes.take(pa.array(roots[some]))],
                ["node", "linked", "root"])
    return run


def near_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """(id, n_links, component_id, kept) for every row; see the module's docstring."""
    rows = written(df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
                   .mapInArrow(_named, "id bigint, node binary, d int, vec binary"), "vectors")
    valid = rows.filter("node IS NOT NULL")
    nodes = written(valid.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("low"), F.first("d").alias("d"),
                                              F.first("vec").alias("vec")), "vector-nodes")
    sizes = nodes.groupBy("d").count().orderBy(F.desc("count"), "d").limit(1).collect()
    result = rows.select("id", "node")
    if sizes:
        names, tables = shape(nodes.count(), sizes[0]["d"], threshold)
        found = written(_linked(nodes, names, tables, threshold), "vector-links")
        roots = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
        counts = found.groupBy("node").agg(F.sum("linked").alias("linked"))
        told = nodes.select("node", "size", "low").join(counts, "node", "left").join(roots, "node", "left") \
            .withColumn("root", F.coalesce("root", "node"))
        lowest = told.groupBy("root").agg(F.min("low").alias("component"))
        told = told.join(lowest, "root").select("node", (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component")
        result = result.filter("node IS NOT NULL").join(told, "node").select("id", "n_links", "component") \
            .unionByName(result.filter("node IS NULL").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component")))
    else:
        result = result.select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component"))
    return result.select(F.col("id").alias(id_col), "n_links", F.col("component").alias("component_id"),
                         F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))


def _linked(nodes: DataFrame, names: int, tables: int, threshold: float) -> DataFrame:
    """(node, linked, root): links found in each block, by their members."""
    coded = written(nodes.select("node", "d", "vec").mapInArrow(_codes(names, tables), "node binary, d int, body binary, keys array<bigint>"),
                    "vector-codes")
    spread = coded.select("node", "d", F.posexplode("keys").alias("t", "key"))
    counts = spread.groupBy("t", "key", "d").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"), F.count(F.lit(1)).alias("n")) \
        .filter("n > 1").drop("n")
    placed = coded.select("*", F.posexplode("keys").alias("t", "key")).join(counts, ["t", "key", "d"]) \
        .withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")) \
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumn("i", F.least("b", "o")).withColumn("j", F.greatest("b", "o")).select(*PLACE, "b", "node", "body", "keys")
    hopeful = written(placed.repartition(*PLACE).sortWithinPartitions(*PLACE).mapInArrow(
        _hopeful(threshold), "t int, key bigint, d int, i int, j int, b int, node binary"), "vector-hopeful")
    whole = hopeful.join(nodes.select("node", "size", "vec"), "node")
    return whole.repartition(*PLACE).sortWithinPartitions(*PLACE).mapInArrow(
        _exact(threshold, names, tables), "node binary, linked bigint, root binary")
