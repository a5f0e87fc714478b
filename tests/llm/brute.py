"""Plain Python versions of the operators' contracts."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def kept_lines(docs: dict) -> dict:
    """id -> (n_lines, n_dropped, kept text)."""
    holders = defaultdict(set)
    key = lambda x: x.strip(SPACE).translate(LOWER)
    for i, t in docs.items():
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                holders[key(x)].add(i)
    out = {}
    for i, t in docs.items():
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 3 or max(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def shingle_set(text: str | None, n: int = 5) -> frozenset:
    w = [x.translate(LOWER) for x in WORD.findall(text or "")]
    return frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def near_classes(docs: dict, threshold: float = 0.8) -> dict:
    """id -> (class, links) by comparing all sets that share a shingle."""
    sets = {i: shingle_set(t) for i, t in docs.items()}
    by = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            by[g].append(i)
    root = {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = Counter()
    for i, s in sets.items():
        common = Counter(j for g in s for j in by[g] if j != i)
        for j, c in common.items():
            if c >= threshold * (len(s) + len(sets[j]) - c) - 1e-9:
                links[i] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (find(i), links[i]) for i in docs}


def without_repeats(docs: dict, length: int = 50) -> dict:
    """id -> (n_bytes, n_removed, n_spans, kept sha)."""
    first: dict[bytes, int] = {}
    for i in sorted(docs):
        data = (docs[i] or "").encode()
        for k in range(len(data) - length + 1):
            first.setdefault(data[k:k + length], i)
    out = {}
    for i, t in docs.items():
        data = (t or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if first[data[k:k + length]] < i:
                gone[k:k + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(data), sum(gone), spans, sha(kept))
    return out


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
BASE = [("assign", ASSIGN, 2, 8), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile("[0-9a-f]+"), 0, 32)]


def base_spans(text: str | None) -> list[tuple[int, int, str, int]]:
    return sorted((m.start(), k, kind, m.end()) for k, (kind, p, g, least) in enumerate(BASE)
                  for m in p.finditer(text or "") if len(m[g]) >= least)


def host_path(url: str | None) -> tuple[str, str]:
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    m = re.match(r"(?s)([^/?#]*)([^?#]*)", rest)
    return m[1].translate(LOWER), m[2]
