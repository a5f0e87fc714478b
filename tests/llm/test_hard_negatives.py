"""Hard negatives against exhaustive scoring in plain Python integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from larder.llm import hard_negatives as hn


def brute(rows, mod=100, positives=5, negatives=10, low=30, high=90):
    known = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or not all(x is not None and math.isfinite(x) for x in v):
            continue
        moved = (label + 1) % 10 if i % 7 == 0 else label
        known[i] = max(known.get(i, (-1, [])), (moved, [math.floor(256 * x) for x in v]))
    out = []
    for a, (label, v) in known.items():
        if a % mod:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in known.items() if i != a and len(w) == len(v)}
        first = sorted((i for i in score if known[i][0] == label), key=lambda i: (-score[i], i))[:positives]
        for p in first:
            fit = sorted((i for i in score if known[i][0] != label and low * score[p] <= 100 * score[i] <= high * score[p]), key=lambda i: (-score[i], i))
            out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(fit[:negatives])]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, label, None if v is None else [None if x is None else float(x) for x in v], "x") for i, label, v in rows],
                               "vec_id bigint, label int, embedding array<double>, rank string").repartition(3)
    got = hn.hard_negatives(df, **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def sample(n, d, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, d))
    return [(k, int(rng.integers(10)), ((centres[rng.integers(12)] * rng.integers(1, 3) + 0.4 * rng.standard_normal(d)) * scale).tolist()) for k in range(n)]


@pytest.mark.parametrize("shard, block, pivots", [(4096, 1024, 256), (40, 2, 8), (7, 1, 1)])
def test_equals_exhaustive_scoring(spark, monkeypatch, shard, block, pivots):
    monkeypatch.setattr(hn, "SHARD", shard)
    monkeypatch.setattr(hn, "BLOCK", block)
    monkeypatch.setattr(hn, "PIVOTS", pivots)
    rows = sample(600, 6, 1)
    assert run(spark, rows, anchors_mod=50) == brute(rows, mod=50)


def test_ties_copies_and_negative_scores(spark):
    v = [0.5, -0.25, 0.125]
    rows = [(k, k % 3, v) for k in range(60)] + [(100 + k, k % 4, [-x for x in v]) for k in range(20)] + [(200 + k, k % 5, [0.4, -0.2, 0.1]) for k in range(30)]
    rows += [(400, 1, [0.0, 0.0, 0.0]), (500, 9, [1.0, 1.0, 1.0])]
    got = run(spark, rows)
    assert got == brute(rows) and got


def test_odd_rows(spark):
    rows = sample(150, 4, 2) + [(None, 1, [1.0] * 4), (300, None, [1.0] * 4), (400, 2, None), (500, 2, [1.0, None, 1.0, 1.0]),
                                (600, 2, [1.0, float("nan"), 1.0, 1.0]), (700, 2, [float("inf")] * 4), (800, 3, [1.0, 2.0]), (801, 3, [1.0, 2.0]),
                                (802, 4, [0.5, 1.0]), (900, 1, []), (901, 1, []), (902, 2, []), (100, 1, [0.1] * 4), (100, 1, [0.1] * 4)]
    assert run(spark, rows) == brute(rows)


def test_large_components_stay_exact(spark):
    rows = sample(120, 3, 5, scale=250_000.0)
    assert run(spark, rows, anchors_mod=20) == brute(rows, mod=20)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_cover_tree_covers():
    rng = np.random.default_rng(3)
    y = np.concatenate([rng.standard_normal((200, 5)), np.repeat(rng.standard_normal((1, 5)), 30, 0)])
    order, parent, radius = hn.cover_tree(y)
    assert sorted(order.tolist()) == list(range(230)) and parent[0] == -1 and (parent[1:] < np.arange(1, 230)).all()
    for k in range(1, 230):
        up = parent[k]
        while up >= 0:
            assert np.linalg.norm(y[order[k]] - y[order[up]]) <= radius[up] + 1e-9
            up = parent[up]


def test_search_skips_subtrees(spark, monkeypatch):
    """Tight groups far outside the window are not scored."""
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((10, 8)) * 4
    rows = [(k, k % 10, (centres[k % 10] + 0.001 * rng.standard_normal(8)).tolist()) for k in range(800)]
    x = np.floor(256 * np.array([v for _, _, v in rows])).astype(np.int64)
    most = float((x.astype(float) ** 2).sum(1).max())
    order, parent, radius = hn.cover_tree(hn.augmented(x, most))
    import pyarrow as pa
    from larder.llm.streams import packed
    tree = hn.Tree(pa.table({"id": order, "label": order % 10, "radius": radius, "parent": parent, "d": [8] * 800, "vec": packed(x[order])}), True)
    scored = []
    plain = tree.scores
    tree.scores = lambda nodes, q: scored.append(len(nodes)) or plain(nodes, q)
    q = tree.x[0]
    hits = tree.search(q, lambda nodes: np.ones(len(nodes), bool), np.array([-hn.TOP]), np.array([hn.TOP]), 5)[0]
    exact = sorted(((int(s), int(i)) for s, i in zip(tree.x @ q, tree.ids)), key=lambda t: (-t[0], t[1]))[:5]
    assert [(s, i) for s, i, _ in hits] == exact and sum(scored) < 400
