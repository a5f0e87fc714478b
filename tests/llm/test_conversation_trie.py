"""The prefix trie against a trie built in plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import pytest

from larder.llm import conversation_trie as ct

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    convs = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    new = {}
    for c, v in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        new[c] = tuple(convs.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:])
    nodes, kids = {}, {}
    for c, v in new.items():
        for k in range(len(v) + 1):
            nodes.setdefault(v[:k], []).append(c)
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) if below else 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p] = (len(nodes[p]) - 1) * words + sum(saved[k] for k in below)
    out = []
    for p, m in nodes.items():
        ends = ",".join(map(str, sorted(c for c in m if new[c] == p)))
        out.append((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def check(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, depth int, n1 string").repartition(3)
    got = ct.conversation_trie(df, **kw)
    assert got.columns[:8] == COLUMNS
    key = lambda t: tuple(-1 if x is None else x for x in t)
    assert sorted((tuple(r)[:8] for r in got.collect()), key=key) == sorted(brute(rows), key=key)


def sample(seed, convs, longest, words=3):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(r.randrange(1, longest)):
            rows.append((c, t, r.choice(["user", "bot"]) if t % 5 else "user", " ".join(r.choice("ab") for _ in range(r.randrange(words)))))
    return rows


def test_odd_rows(spark):
    rows = [(0, 1, "user", "a b"), (0, None, "user", "first"), (0, 2, None, None), (1, 0, "user", "x"), (5, 0, "", ""), (6, 0, None, None), (3, 9, "u", "é \t\n w"),
            (19, 0, "user", "one"), (19, 1, "user", "two"), (19, 2, "user", "three"), (19, 3, "user", "four"), (40, 0, "q", "r"), (41, 0, "q", "r"),
            (None, 0, "user", "lost"), (-7, 0, "user", "below"), (77, 0, "u", "dup"), (77, 0, "u", "dup"), (78, 0, "u", "word " * 200_000)]
    check(spark, rows)


def test_role_and_text_do_not_run_together(spark):
    check(spark, [(100, 0, "ab", "c"), (101, 0, "a", "bc"), (102, 0, "", "abc"), (103, 0, "abc", "")])


def test_empty_table(spark):
    check(spark, [])


@pytest.mark.parametrize("share, queue", [(16, 1 << 17), (0.05, 3), (0.5, 1)])
def test_shards_and_spilling(spark, share, queue):
    check(spark, sample(3, 120, 9), share=share, queue=queue)


def test_one_long_conversation(spark, monkeypatch):
    """A conversation with most of the rows is spread over spans and stretches."""
    monkeypatch.setattr(ct, "SPAN", 16)
    rows = [(0, t, "user", f"t{t} w") for t in range(700)] + [(c, t, "user", f"t{t} w") for c in range(1, 30) for t in range(c)]
    check(spark, rows, share=0.2, queue=4)


def test_queue_orders_messages_through_files():
    r = random.Random(1)
    sent = [(-r.randrange(20), r.randrange(5), r.randrange(3), r.randrange(9), r.randrange(9)) for _ in range(800)]
    queue = ct.SpillingQueue(most=7)
    for m in sent:
        queue.push(m)
    assert len(queue.files) > 5 and len(queue.heap) <= 8 + len(queue.files)
    for address in sorted({m[:3] for m in sent}):
        mine = [m for m in sent if m[:3] == address]
        assert queue.take(address) == (sum(m[3] for m in mine), sum(m[4] for m in mine))
    assert queue.take((0, 9, 9)) == (0, 0)
    queue.close()
