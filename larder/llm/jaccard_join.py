"""N-gram Jaccard self-join by chosen paths.

A text is the set of its five-word shingles (words are runs without white space, A-Z folded;
a text of one to four words is one shingle, an empty one no set). Texts with equal sets are one
*class*; only its smallest document id takes part, with the class's size as weight.

Search. A set is embedded as ``COORDINATES`` MinHash values. In each run a tree is grown: a node
draws coordinates at random (by a hash of the node), and a set follows each drawn coordinate to
the child named by its value there, so sets sharing that sampled token go down together and
sharply different sets part. A child small enough is searched by brute force over the embeddings;
in a larger one every set is compared with a few leaders first (so a bucket of near copies is not
passed down again and again), and the sets not as close as the threshold to one are split again, down
to ``DEPTH``; what is left there is compared pair by pair, in parts. Agreement on coordinates is a metric,
so a set may leave with a leader if all sets that may be close to it are tied to that leader too: the limit for a
tie is lowered by as much as the leader's farthest leaving set lies from it, and a pair that a small
bucket would tie is tied in a large one. Runs repeat with other draws: a pair at the threshold
survives a level with probability 1 - exp(-BRANCH * 0.8), and the number of runs follows from the
recall asked for.

Found ties only gather sets into *pools* (components of likely ties). Exact similarities are then
computed between all sets of a pool on their whole shingle sets: in blocks, so that a pool of any
size is spread over many tasks and no pair becomes a row. Two sets tie if Jaccard >= ``threshold``;
the classes returned are components of exact ties, the link counts exact counts of tied documents.

Bounded memory: a brute-forced bucket has at most LEAF sets, a block at most BLOCK sets and about
BLOCK_TOKENS shingles. Null ids: returned with null class and no links. Repeated rows are one
document; of an id's different texts that with the least hash is judged. Empty or null texts: a class of their own, no links. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import chunks, gram_hashes, mix, word_hashes, written
from larder.llm.graph import connected_components

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.999
COORDINATES, BRANCH, DEPTH, LEAF, LEADERS = 64, 2.5, 3, 48, 4
#: A tie is likely if the embeddings agree on this much less than the threshold (four standard
#: deviations of the estimate at 64 coordinates).
SLACK = 0.2
BLOCK, BLOCK_TOKENS = 256, 1 << 20
#: Sets of a large bucket that a task compares with the bucket's leaders at once, about.
SUB = 1024


def runs_for(recall: float, threshold: float = THRESHOLD, branch: float = BRANCH, depth: int = 2) -> int:
    """Runs after which a pair at ``threshold`` has met with probability ``recall``, if buckets
    are small after ``depth`` levels."""
    meet = 1.0
    for _ in range(depth):
        meet = 1 - math.exp(-branch * threshold * meet)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


# ---- sets -------------------------------------------------------------------------------------

def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(1, 2 * n + 1, dtype=np.uint64)
    h = mix(at * np.uint64(0x9E3779B97F4A7C15))
    return (h[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (h[n:] >> np.uint64(32)).astype(np.uint32)


def minhashes(grams: np.ndarray, at: np.ndarray, n: int = COORDINATES) -> np.ndarray:
    """(sets, n) MinHash values, uint32. ``grams[at[i]:at[i+1]]`` are set i, not empty."""
    mul, add = _seeds(n)
    low = (grams >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(at) - 1, n), np.uint32)
    for k in range(n):
        h = low * mul[k] + add[k]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        out[:, k] = np.minimum.reduceat(h, at[:-1])
    return out


def distinct_sorted(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each set's values sorted and without repetition, with new offsets."""
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    values, text = values[keep], text[keep]
    return values, np.searchsorted(text, np.arange(len(at)))


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, n: int = WORDS) -> DataFrame:
    """(id, k1, k2, n_grams, sketch, hash) per text that has a shingle; (k1, k2) names the set, hash the text."""
    df = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash"))

    def run(batches: Iterator[pa.RecordBatch]):
        for whole in batches:
            for batch in chunks(whole, "text"):
                words, first = word_hashes(batch.column("text"))
                grams, at = gram_hashes(words, first, n)
                grams, at = distinct_sorted(grams, at)
                some = np.flatnonzero(np.diff(at))
                if not len(some):
                    continue
                begin = at[:-1][some]
                edges = np.append(begin, len(grams))
                k1 = np.add.reduceat(grams, begin)
                k2 = np.add.reduceat(mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)), begin)
                sketch = minhashes(grams, edges)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(some)), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)),
                     pa.array(np.diff(edges).astype(np.int32)), pa.array([r.tobytes() for r in sketch], pa.binary()),
                     batch.column("hash").take(pa.array(some))],
                    names=["id", "k1", "k2", "n_grams", "sketch", "hash"])

    kind = df.schema["id"].dataType.simpleString()
    return df.mapInArrow(run, f"id {kind}, k1 long, k2 long, n_grams int, sketch binary, hash long")


# ---- chosen paths -----------------------------------------------------------------------------

def _children(sketch: np.ndarray, node: np.ndarray, branch: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child) for every coordinate that a row's node draws: each with probability
    branch / coordinates, at least one (the coordinate of the least draw)."""
    rows, n = sketch.shape
    coords = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    draw = mix(node[:, None] ^ coords[None, :]) >> np.uint64(11)
    taken = draw < np.uint64(int(branch / n * 2.0**53))
    taken[np.arange(rows), draw.argmin(1)] = True
    row, col = np.nonzero(taken)
    child = mix(mix(node[row] + coords[col]) + sketch[row, col].astype(np.uint64))
    return row, child


def _descend(nodes: DataFrame, branch: float) -> DataFrame:
    """(node, id, sketch) -> (node, id): the children each row goes to."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sketch = _matrix(batch.column("sketch"))
            node = batch.column("node").to_numpy(zero_copy_only=False).view(np.uint64)
            row, child = _children(sketch, node, branch)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(child.view(np.int64)), batch.column("id").take(take)], names=["node", "id"])

    return nodes.mapInArrow(run, nodes.select("node", "id").schema)


def _matrix(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint32).reshape(len(col), -1)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with equal ``keys``, from batches sorted by them."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        cols = [t.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(t.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield t.slice(a, b - a)
        rest = t.slice(cuts[-1])
        rest = pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in rest.columns], schema=rest.schema)
    if rest is not None:
        yield rest


def _forest(n: int, pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs."""
    root = list(range(n))
    out = []

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _brute(leaves: DataFrame, least: float) -> DataFrame:
    """Edges (u, v) among the sets of each small bucket whose embeddings agree enough."""
    kind = leaves.schema["id"].dataType.simpleString()

    def run(batches):
        us, vs = [], []
        for g in _groups(batches, ["node"]):
            m = _matrix(g.column("sketch"))
            agree = (m[:, None, :] == m[None, :, :]).mean(2) >= least if g.num_rows <= LEAF * 2 else None
            if agree is None:  # equal ids that met again; handled row by row
                pairs = ((i, int(j)) for i in range(len(m)) for j in np.flatnonzero((m[i + 1:] == m[i]).mean(1) >= least) + i + 1)
            else:
                pairs = zip(*(x.tolist() for x in np.nonzero(np.triu(agree, 1))))
            ids = g.column("id").to_pylist()
            for a, b in _forest(len(m), pairs):
                us.append(ids[a])
                vs.append(ids[b])
            if len(us) > 20000:
                yield pa.RecordBatch.from_pydict({"u": pa.array(us, g.column("id").type), "v": pa.array(vs, g.column("id").type)})
                us, vs = [], []
        if us:
            yield pa.RecordBatch.from_pydict({"u": pa.array(us, g.column("id").type), "v": pa.array(vs, g.column("id").type)})

    placed = leaves.select("node", "id", "sketch").repartition("node").sortWithinPartitions("node")
    return placed.mapInArrow(run, f"u {kind}, v {kind}")


def _buckets(slim: DataFrame, leaders: int, leaf: int) -> DataFrame:
    """(node, size, lead, id): every row whose node holds more than one set, with the node's size
    and, in a large one, its leaders: the least ids under ``leaders`` orders, which differ from node to
    node. One aggregation with a row per node, one join."""
    orders = [F.min_by("id", F.xxhash64(F.lit(k), "node", "id")).alias(f"l{k}") for k in range(leaders)]
    shape = slim.groupBy("node").agg(F.count(F.lit(1)).alias("size"), *orders).filter("size > 1").select(
        "node", "size", F.when(F.col("size") > leaf, F.array(*[f"l{k}" for k in range(leaders)])).alias("lead"))
    return slim.join(shape, "node").select("node", "size", "lead", "id")


def _with_leaders(big: DataFrame, enough: float) -> DataFrame:
    """(id, node, size, sketch, lead, agree, best, done) of every set of a large bucket: the bucket's leaders,
    how far its embedding agrees with each, the best of them, and whether that one agrees to
    ``enough``. A bucket is dealt out in parts of about SUB sets, each with a copy of the few leaders."""
    kind = big.schema["id"].dataType.simpleString()
    parts = F.ceil(F.col("size") / F.lit(SUB)).cast("int")
    members = big.select(
        "node", F.pmod(F.xxhash64("id"), parts).cast("int").alias("part"), F.lit(1).alias("member"), "id", "size", "sketch")
    lead = big.filter(F.array_contains("lead", F.col("id"))).select(
        "node", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(0).alias("member"), "id", "size", "sketch")
    placed = members.unionByName(lead).repartition("node", "part").sortWithinPartitions("node", "part", "member", "id")

    def run(batches):
        for g in _groups(batches, ["node", "part"]):
            member = g.column("member").to_numpy() == 1
            if not member.any():
                continue
            sketch, own = _matrix(g.column("sketch")), pa.array(member)
            first = np.flatnonzero(~member)
            agree = np.stack([(sketch[member] == sketch[k]).mean(1) for k in first], 1)
            n = len(agree)
            each = pa.array(np.arange(n + 1, dtype=np.int32) * len(first))
            lead = pa.ListArray.from_arrays(each, g.column("id").take(pa.array(np.tile(first, n))))
            yield pa.RecordBatch.from_arrays(
                [*[g.column(c).filter(own) for c in ("id", "node", "size", "sketch")], lead,
                 pa.ListArray.from_arrays(each, pa.array(agree.ravel())), pa.array(agree.argmax(1).astype(np.int32)),
                 pa.array(agree.max(1) >= enough)],
                names=["id", "node", "size", "sketch", "lead", "agree", "best", "done"])

    return placed.mapInArrow(
        run, f"id {kind}, node long, size long, sketch binary, lead array<{kind}>, agree array<double>, best int, done boolean")


def _leader_ties(led: DataFrame, least: float, enough: float, leaders: int) -> DataFrame:
    """Edges (u, v) that join sets to their buckets' leaders. The limit for a leader is ``least``, less
    the distance of the farthest set that leaves with it: what agrees to ``least`` with a set that
    leaves agrees that far with the leader, by the triangle inequality. As sets leave from ``enough`` on, only what
    agrees to between ``least + enough - 1`` and ``least`` needs its bucket's limits. A set gives one edge, to the first
    leader near it; that its other near leaders belong together is said once per bucket."""
    sure, floor = least - 1e-9, least + enough - 1 - 1e-9
    others = F.filter(F.arrays_zip("lead", "agree"), lambda x: x["lead"] != F.col("id"))
    open_ = F.exists(others, lambda x: (x["agree"] < sure) & (x["agree"] >= floor))
    near = F.transform(F.filter(others, lambda x: x["agree"] >= sure), lambda x: x["lead"])
    settled = led.filter(~open_).select("id", near.alias("near"))
    reach = led.filter("done").groupBy("node").agg(*[
        F.coalesce(F.min(F.when(F.col("best") == k, F.get("agree", F.lit(k)))), F.lit(1.0)).alias(f"r{k}") for k in range(leaders)])
    limits = reach.select("node", F.array(*[F.col(f"r{k}") + (least - 1 - 1e-9) for k in range(leaders)]).alias("limit"))
    inside = F.filter(F.arrays_zip("lead", "agree", "limit"), lambda x: (x["agree"] >= x["limit"]) & (x["lead"] != F.col("id")))
    unsettled = led.filter(open_).select("node", "id", "lead", "agree").join(limits, "node", "left")
    unsettled = unsettled.select("id", F.when(F.col("limit").isNull(), near).otherwise(F.transform(inside, lambda x: x["lead"])).alias("near"))
    met = settled.unionByName(unsettled).filter(F.size("near") > 0)
    first = F.get("near", F.lit(0))
    edges = met.select(F.array(F.struct(F.col("id").alias("u"), first.alias("v"))).alias("e"), "near")
    both = F.concat("e", F.transform(F.slice("near", F.lit(2), F.size("near")), lambda x: F.struct(first.alias("u"), x.alias("v"))))
    return edges.select(F.inline(both)).distinct()


def _in_parts(rest: DataFrame, least: float) -> DataFrame:
    """Edges (u, v) among the sets that are left in large buckets after the last level: all are
    compared, a pair of parts of about SUB sets at a time."""
    kind = rest.schema["id"].dataType.simpleString()
    parts = F.ceil(F.col("size") / F.lit(SUB)).cast("int")
    dealt = rest.select("node", "id", "sketch", parts.alias("parts"), F.pmod(F.xxhash64("id"), parts).cast("int").alias("part"))
    placed = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("with")).select(
        "node", F.least("part", "with").alias("left"), F.greatest("part", "with").alias("right"), "part", "id", "sketch")
    placed = placed.repartition("node", "left", "right").sortWithinPartitions("node", "left", "right")

    def run(batches):
        us, vs = [], []
        t = None
        for g in _groups(batches, ["node", "left", "right"]):
            m, part, ids = _matrix(g.column("sketch")), g.column("part").to_numpy(), g.column("id").to_pylist()
            left, right = g.column("left")[0].as_py(), g.column("right")[0].as_py()
            first, second = np.flatnonzero(part == left), np.flatnonzero(part == right)
            other, t = m[second], g.column("id").type
            pairs = ((i, j) for i in first.tolist() for j in second[(other == m[i]).mean(1) >= least].tolist() if i != j)
            for a, b in _forest(len(m), pairs):
                us.append(ids[a])
                vs.append(ids[b])
            if len(us) > 20000:
                yield pa.RecordBatch.from_pydict({"u": pa.array(us, t), "v": pa.array(vs, t)})
                us, vs = [], []
        if us:
            yield pa.RecordBatch.from_pydict({"u": pa.array(us, t), "v": pa.array(vs, t)})

    return placed.mapInArrow(run, f"u {kind}, v {kind}")


def likely_ties(sets: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, branch: float = BRANCH,
                depth: int = DEPTH, leaf: int = LEAF) -> DataFrame:
    """Edges (u, v) that join, directly or through others, the sets that are likely ties.
    ``sets``: (id, sketch), a written table."""
    least = threshold - SLACK
    runs = runs_for(recall, threshold, branch)
    start = sets.select(F.explode(F.sequence(F.lit(1), F.lit(runs))).alias("run"), "id", "sketch")
    frontier = start.select(F.xxhash64(F.lit("run"), "run").alias("node"), "id", "sketch")
    edges = None
    for level in range(1, depth + 1):
        # Names of children first, without the sketches: lone sets go no further.
        slim = written(_descend(frontier, branch), f"paths-{level}")
        met = _buckets(slim, LEADERS, leaf).join(sets.select("id", "sketch"), "id")
        met = written(met, f"buckets-{level}")
        big = met.filter(F.col("size") > leaf)
        led = written(_with_leaders(big, threshold), f"led-{level}")
        for f in (_brute(met.filter(F.col("size") <= leaf), least), _leader_ties(led, least, threshold, LEADERS)):
            edges = f if edges is None else edges.unionByName(f)
        # A set close to a leader leaves: the leader's ties hold all that may be close to the set.
        rest = led.filter(~F.col("done"))
        frontier = rest.select("node", "id", "sketch")
    return edges.unionByName(_in_parts(rest, least))


# ---- exact ties -------------------------------------------------------------------------------

def _exact(blocks: DataFrame, threshold: float) -> DataFrame:
    """Rows (u, v, w) of each pair of blocks: w > 0: u has ties to documents of weight w in that
    block; w = 0: an edge of the pair's spanning forest."""
    kind = blocks.schema["id"].dataType.simpleString()

    def run(batches):
        rows = [[], [], []]
        for g in _groups(batches, ["pool", "left", "right"]):
            ids, weight = g.column("id").to_pylist(), g.column("weight").to_numpy()
            block = g.column("block").to_numpy()
            same = g.column("left")[0].as_py() == g.column("right")[0].as_py()
            grams = [np.frombuffer(x, np.int64) for x in g.column("grams").to_pylist()]
            size = np.array([len(x) for x in grams])
            _, ranks = np.unique(np.concatenate(grams), return_inverse=True)
            at = np.concatenate([[0], np.cumsum(size)])
            first = np.flatnonzero(block == g.column("left")[0].as_py())
            second = first if same else np.flatnonzero(block != g.column("left")[0].as_py())
            if not len(second):
                continue
            pool = np.concatenate([ranks[at[j]:at[j + 1]] for j in second])
            heads = np.concatenate([[0], np.cumsum(size[second])])[:-1]
            mark = np.zeros(int(ranks.max()) + 1, np.int32)
            links = np.zeros(len(ids), np.int64)

            def pairs():
                for i in first.tolist():
                    own = ranks[at[i]:at[i + 1]]
                    mark[own] = 1
                    common = np.add.reduceat(mark[pool], heads)
                    mark[own] = 0
                    tied = second[common >= threshold * (size[i] + size[second] - common) - 1e-9]
                    tied = tied[tied != i]
                    links[i] += int(weight[tied].sum())
                    if not same:
                        links[tied] += weight[i]
                    for j in tied.tolist():
                        yield i, j

            for a, b in _forest(len(ids), pairs()):
                rows[0].append(ids[a])
                rows[1].append(ids[b])
                rows[2].append(0)
            for i in np.flatnonzero(links).tolist():
                rows[0].append(ids[i])
                rows[1].append(ids[i])
                rows[2].append(int(links[i]))
            if len(rows[0]) > 20000:
                yield _rows(rows, g.column("id").type)
                rows = [[], [], []]
        if rows[0]:
            yield _rows(rows, g.column("id").type)

    def _rows(rows, t):
        return pa.RecordBatch.from_pydict({"u": pa.array(rows[0], t), "v": pa.array(rows[1], t), "w": pa.array(rows[2], pa.int64())})

    return blocks.mapInArrow(run, f"u {kind}, v {kind}, w long")


def _grams_of(docs: DataFrame, id_col: str, text_col: str, members: DataFrame, n: int) -> DataFrame:
    """The members' whole shingle sets: (id, pool, weight, n_grams, grams as bytes)."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(members, "id")

    def run(batches):
        for whole in batches:
            for batch in chunks(whole, "text"):
                words, first = word_hashes(batch.column("text"))
                grams, at = distinct_sorted(*gram_hashes(words, first, n))
                k1 = np.array([grams[a:b].sum(dtype=np.uint64) for a, b in zip(at, at[1:])], np.uint64).view(np.int64)
                ok = k1 == batch.column("k1").to_numpy(zero_copy_only=False)  # an id's other texts are not the member
                body = pa.array([grams[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in ("id", "pool", "weight", "n_grams")] + [body],
                    names=["id", "pool", "weight", "n_grams", "grams"]).filter(pa.array(ok))

    kind = members.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"id {kind}, pool {kind}, weight long, n_grams int, grams binary").dropDuplicates(["id"])


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS,
                    threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(id, class_id, n_links, set_id): one row per document. ``class_id`` is the least id of
    its component of ties, ``n_links`` the number of other documents it ties with, ``set_id`` the
    least id among the documents with its very set of shingles."""
    spark = docs.sparkSession
    # of an id's several texts with shingles, that with the least hash is judged
    sets = shingle_sets(docs, id_col, text_col, n).groupBy("id").agg(F.min_by(F.struct("k1", "k2", "n_grams", "sketch"), F.struct("hash", "k1")).alias("s"))
    sets = written(sets.select("id", "s.*"), "sets")
    classes = written(sets.groupBy("k1", "k2").agg(F.min("id").alias("set_id"), F.count(F.lit(1)).alias("weight")), "classes")
    leaders = sets.join(classes.select(F.col("set_id").alias("id"), "weight"), "id").select("id", "k1", "n_grams", "sketch", "weight")
    leaders = written(leaders, "leaders")
    pools = connected_components(written(likely_ties(leaders, threshold, recall), "likely"))
    members = leaders.join(pools.select(F.col("node").alias("id"), F.col("root").alias("pool")), "id").select(
        "id", "pool", "weight", "n_grams", "k1")
    grams = written(_grams_of(docs, id_col, text_col, members, n), "grams")
    shape = grams.groupBy("pool").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)), F.ceil(F.sum("n_grams") / F.lit(BLOCK_TOKENS)), F.lit(1))
        .cast("int").alias("blocks"))
    blocked = grams.join(shape, "pool").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    blocked = blocked.select("*", other.alias("with")).select(
        "pool", F.least("block", "with").alias("left"), F.greatest("block", "with").alias("right"), "block", "id", "weight", "grams")
    placed = blocked.repartition("pool", "left", "right").sortWithinPartitions("pool", "left", "right")
    exact = written(_exact(placed, threshold), "ties")
    links = exact.filter("w > 0").groupBy(F.col("u").alias("set_id")).agg(F.sum("w").alias("links"))
    roots = connected_components(exact.filter("w = 0").select("u", "v"))
    named = classes.join(links, "set_id", "left").join(
        roots.select(F.col("node").alias("set_id"), "root"), "set_id", "left").select(
        "k1", "k2", "set_id", F.coalesce("root", "set_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    found = sets.select("id", "k1", "k2").join(named, ["k1", "k2"]).select("id", "class_id", "n_links", "set_id")
    ids = docs.select(F.col(id_col).alias("_id")).filter(F.col("_id").isNotNull()).distinct()
    every = ids.join(found, F.col("_id") == F.col("id"), "left").select(
        F.col("_id").alias(id_col), F.coalesce("class_id", "_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("set_id", "_id").alias("set_id"))
    nulls = docs.filter(F.col(id_col).isNull()).select(
        F.col(id_col), F.lit(None).cast(docs.schema[id_col].dataType).alias("class_id"), F.lit(0).cast("bigint").alias("n_links"),
        F.lit(None).cast(docs.schema[id_col].dataType).alias("set_id"))
    return every.unionByName(nulls)
