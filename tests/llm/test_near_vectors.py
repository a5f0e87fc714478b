"""Near copies among embeddings against all pairs compared in plain numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest

from larder.llm import near_vectors as nv


def brute(rows, threshold=0.95):
    """{row number: (links, component)} of (id, vector) rows."""
    def fine(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    units = {k: np.array(v) / np.linalg.norm(v) for k, (i, v) in enumerate(rows) if i is not None and fine(v)}
    near = {k: [m for m, y in units.items() if m != k and len(x) == len(y) and x @ y >= threshold] for k, x in units.items()}
    out = {}
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for m in near.get(todo.pop(), []):
                if m not in seen:
                    seen.add(m)
                    todo.append(m)
        out[k] = (i, len(near.get(k, [])), min(rows[m][0] for m in seen) if i is not None else None)
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x") for i, v in rows],
                               "vec_id bigint, embedding array<double>, n_links string").repartition(4)
    got = nv.near_vectors(df, **kw)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return got.collect()


def same(got, want):
    key = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key) == sorted(want.values(), key=key)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def around(rng, centre, cosine):
    """A unit vector with the given cosine to ``centre``."""
    e = rng.standard_normal(len(centre))
    e -= (e @ centre) * centre
    return cosine * centre + math.sqrt(1 - cosine ** 2) * e / np.linalg.norm(e)


def test_odd_rows(spark):
    base = [1.0, 2.0, 3.0]
    rows = [(7, base), (3, base), (3, base), (9, [2 * x for x in base]), (None, base), (11, None), (12, []), (13, [0.0, 0.0]),
            (14, [1.0, None]), (15, [1.0, float("nan")]), (16, [float("inf"), 1.0]), (17, [1.0, 2.0]), (18, [1e200, 2e200]), (19, [-1.0, -2.0, -3.0]),
            (20, [5.0]), (21, [0.1]), (22, [-1.0]), (23, [1e-300, 2e-300])]
    want = brute([(i, [x / 1e200 for x in v] if i == 18 else [x * 1e300 for x in v] if i == 23 else v) for i, v in rows])
    same(run(spark, rows), want)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_all_invalid(spark):
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in run(spark, [(1, None), (2, [])])) == [(1, 0, 1, True), (2, 0, 2, True)]


@pytest.mark.parametrize("block", [1024, 16])
def test_groups_and_recall(spark, monkeypatch, block):
    """A large group of near copies, exact copies, a chain and pairs just above the threshold; blocks that split the group."""
    monkeypatch.setattr(nv, "BLOCK", block)
    rng = np.random.default_rng(4)
    unit = lambda: (lambda v: v / np.linalg.norm(v))(rng.standard_normal(48))
    rows, centre = [], unit()
    rows += [(k, around(rng, centre, 0.985)) for k in range(150)]
    rows += [(1000 + k, rows[3][1]) for k in range(40)]
    chain = [unit()]
    for _ in range(12):
        chain.append(around(rng, chain[-1], 0.96))
    rows += [(2000 + k, v) for k, v in enumerate(chain)]
    for k in range(150):  # the hard case: exactly at the threshold, seen through the rounding of cosines
        v = unit()
        rows += [(3000 + 2 * k, v), (3001 + 2 * k, around(rng, v, 0.9502))]
    rows += [(5000 + k, unit()) for k in range(300)]
    got, want = run(spark, rows), brute(rows)
    found, true = sum(r.n_links for r in got), sum(w[1] for w in want.values())
    assert 0.99 * true <= found <= true
    linked = {r.vec_id: r.n_links for r in got}
    assert all(linked[i] <= n for i, n, _ in want.values())
    pairs = sum(linked[3000 + 2 * k] for k in range(150))
    assert pairs >= 0.95 * 150
    assert all(linked[5000 + k] == 0 for k in range(300))


def test_bounds_keep_true_pairs():
    """The confidence bounds rule out far pairs and none at the threshold."""
    rng = np.random.default_rng(1)
    a = rng.standard_normal((500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = np.stack([around(rng, v, 0.95) for v in a])
    x = np.concatenate([a, b])
    maybe = nv.likely(64, nv.encode(x), 0.95)
    assert maybe[np.arange(500), 500 + np.arange(500)].mean() >= 0.995
    assert maybe[:500, :500][~np.eye(500, dtype=bool)].mean() < 0.001


def test_estimate_is_unbiased():
    rng = np.random.default_rng(2)
    x, errors = rng.standard_normal((200, 64)), []
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for seed in range(40):
        y = x @ nv.rotation(64, 64, seed).T
        s, f = np.sign(y) / 8, np.abs(y).sum(1) / 8
        errors.append((s @ y.T) / f[:, None] - x @ x.T)
    assert abs(np.mean(errors)) < 0.002


def test_shape_grows_slowly():
    assert nv.shape(500, 64, 0.95)[0] == 1 and nv.shape(10**9, 64, 0.95)[0] <= 4 and nv.shape(10**9, 64, 0.95)[1] < 80
