"""BPE encoding and decoding by an index of pair occurrences.

Text is normalised and cut into words as the vocabulary file says (NFC, white space to one space,
lower case; contractions, letter runs, single digits, other runs), and the distinct words of a
batch of the partition are encoded together: every word starts as byte symbols, an index maps each
adjacent pair to all its positions, and active merge ranks are applied in ascending order, each
to all positions of its pair at once; only the position lists of the neighbouring pairs are
updated. A merge can only make pairs of higher rank (checked when the file is loaded), so one
ascending pass over the ranks equals merging word by word.

Special tokens standing in a text become their ids, as the tokenizers library does by default.
Decoding looks ids up in a column of tokens and joins them with spaces (the file names no decoder), a bounded
number of ids at once; it loads the tokens alone.

Map only: no shuffle. The memory of words already encoded is bounded by CACHE_WORDS; beyond it
the memory starts anew. A null text is empty: no tokens, empty decoded text. Ids, repeated rows and
extra columns are carried along; one output row per input row.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import cached_property, lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

VOCABULARY = "word_bpe_49k.json"
CACHE_WORDS = 400_000
# How the vocabulary file cuts words, and its end-of-word mark.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"
_SPACE = re.compile(r"[^\S\x1c-\x1f]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: Characters on which every Unicode version since 6 agrees; a text with others is normalised and
#: cut by the tokenizers library, whose tables may be newer than Python's.
_SETTLED = re.compile("[\\x00-\u0557\u2010-\u2027\u20a0-\u20b5\u3001-\u3096\u30a1-\u30fa\u4e00-\u9fcb\uac00-\ud7a3]*")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 bytes stand for
    themselves, the others for the characters from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def normalise(text: str) -> str:
    """NFC and lower case; white space stays for the cut into runs."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    # lower() maps a final sigma by its context; the file's rule maps each character alone
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


class Vocabulary:
    """Tokens, merges and special tokens of a tokenizer file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids = model["vocab"]
        self.tokens = {i: t for t, i in ids.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {(ids[a], ids[b]): (r, ids[a + b]) for r, (a, b) in enumerate(pairs)}
        made = {c: r for r, c in self.rank.values()}
        self.merge = {a << 20 | b: (r, c) for (a, b), (r, c) in self.rank.items()}
        if len(made) != len(self.rank) or any(made.get(x, -1) >= r for pair, (r, _) in self.rank.items() for x in pair):
            raise ValueError("a merge makes a pair of lower rank; one ascending pass would not be exact")
        symbols = byte_symbols()
        self.path = path
        self.value = {s: b for b, s in enumerate(symbols)}
        self.byte = [ids[s] for s in symbols]
        self.last = [ids[s + END] for s in symbols]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.words = regex.compile(WORDS).findall

    def encode_words(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after another and where each word's ids end, by the pair
        occurrence index over all of them. A pair (a, b) is named a << 20 | b."""
        sym: list[int] = []
        ends = []
        byte, last = self.byte.__getitem__, self.last
        for w in words:
            data = w.encode("utf-8")
            sym.extend(map(byte, data))
            sym[-1] = last[data[-1]]
            ends.append(len(sym))
        n = len(sym)
        prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
        at = 0
        for e in ends:
            prev[at] = nxt[e - 1] = -1
            at = e
        merge = self.merge
        where: dict[int, list[int]] = {}
        for i, j in enumerate(nxt):
            if j >= 0:
                pair = sym[i] << 20 | sym[j]
                if pair in where:
                    where[pair].append(i)
                elif pair in merge:
                    where[pair] = [i]
        active = [(merge[p][0], p) for p in where]
        heapq.heapify(active)
        while active:
            _, pair = heapq.heappop(active)
            positions = where.pop(pair)
            a, b = pair >> 20, pair & 0xFFFFF
            made = merge[pair][1]
            if a == b:
                positions.sort()  # overlapping occurrences merge from the left
            for i in positions:
                j = nxt[i]
                if sym[i] != a or j < 0 or sym[j] != b:
                    continue  # a neighbour's merge has taken a part of it
                k, h = nxt[j], prev[i]
                sym[i] = made
                sym[j] = -1
                nxt[i] = k
                if k >= 0:
                    prev[k] = i
                    new = made << 20 | sym[k]
                    if new in where:
                        where[new].append(i)
                    elif new in merge:
                        where[new] = [i]
                        heapq.heappush(active, (merge[new][0], new))
                if h >= 0:
                    new = sym[h] << 20 | made
                    if new in where:
                        where[new].append(h)
                    elif new in merge:
                        where[new] = [h]
                        heapq.heappush(active, (merge[new][0], new))
        left = np.array(sym, np.int32) >= 0
        counts = np.cumsum(left)
        return np.array(sym, np.int32)[left], counts[np.array(ends, np.int64) - 1] if ends else np.zeros(0, np.int64)

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def runs(self, text: str) -> list[str | tuple[str, ...]]:
        """The runs between spaces in the normalised text; where the library cut the text, tuples of words."""
        if _SETTLED.fullmatch(text):
            # split() also cuts at these four, which the file's rule takes for ordinary characters
            if _SEPARATORS.search(text):
                return [x for x in _SPACE.sub(" ", normalise(text)).split(" ") if x]
            return normalise(text).split()
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [(bytes(map(self.value.__getitem__, w)).decode("utf-8"),) for w, _ in cut]

    def pieces(self, text: str) -> list[str | int | tuple[str, ...]]:
        """Runs of the text and ids of special tokens, in order."""
        if self.split_special is None or "<|" not in text:
            return self.runs(text)
        out: list = []
        for part in self.split_special.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out.extend(self.runs(part))
        return out


class Memo:
    """Keys and their id lists, laid one after another in one array. When more than ``most`` keys
    are held, those used once are forgotten, and the least used down to half of ``most``."""

    def __init__(self, most: int = CACHE_WORDS):
        self.most = most
        self._fill([], np.zeros(0, np.int32), np.zeros(0, np.int64))
        self.uses = np.zeros(0, np.int64)

    def _fill(self, keys: list, ids: np.ndarray, ends: np.ndarray) -> None:
        self.at: dict = {}
        self.ids, self.ends = array("i"), array("q", [0])
        self._extend(keys, ids, ends)

    def _extend(self, keys: Sequence, ids: np.ndarray, ends: np.ndarray) -> None:
        base, first = len(self.ids), len(self.at)
        self.at.update(zip(keys, range(first, first + len(keys))))
        self.ids.frombytes(np.ascontiguousarray(ids, np.int32).tobytes())
        self.ends.frombytes((np.asarray(ends, np.int64) + base).tobytes())

    def _forget(self) -> None:
        kept = np.argsort(-self.uses, kind="stable")[:self.most // 2]
        kept = kept[self.uses[kept] > 1]
        keys = list(self.at)
        self._fill([keys[k] for k in kept.tolist()], *self.gather(kept))
        self.uses = self.uses[kept] // 2

    def gather(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the entries ``index``, one after another, and where each entry's end."""
        ids = np.frombuffer(self.ids, np.int32) if self.ids else np.zeros(0, np.int32)
        ends = np.frombuffer(self.ends, np.int64)
        begin = ends[index]
        sizes = ends[index + 1] - begin
        to = np.cumsum(sizes)
        return ids[np.repeat(begin - to + sizes, sizes) + np.arange(int(to[-1]) if len(to) else 0)], to

    def look_up(self, keys: Sequence, encode) -> tuple[np.ndarray, np.ndarray]:
        """``gather`` of the keys; ``encode(new keys)`` gives the ids and ends of those not held."""
        if len(self.at) > self.most:
            self._forget()
        index = np.fromiter(map(self.at.get, keys, repeat(-1)), np.int64, len(keys))
        missed = np.flatnonzero(index < 0).tolist()
        if missed:
            new = list(dict.fromkeys([keys[i] for i in missed]))
            first = len(self.at)
            self._extend(new, *encode(new))
            index[missed] = range(first, len(self.at)) if len(new) == len(missed) else [self.at[keys[i]] for i in missed]
        uses = np.bincount(index, minlength=len(self.at))
        uses[:len(self.uses)] += self.uses
        self.uses = uses
        return self.gather(index)


class Encoder:
    """Encodes texts batch by batch, remembering words and the runs between spaces (no word
    crosses a space)."""

    def __init__(self, vocabulary: Vocabulary, cache_words: int = CACHE_WORDS):
        self.v, self.runs, self.words = vocabulary, Memo(cache_words), Memo(cache_words)

    def _cut(self, run) -> Sequence[str | int]:
        if isinstance(run, str):
            return (run,) if run.isalpha() else self.v.words(run)
        return run if isinstance(run, tuple) else (run,)

    def _encode_words(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        special = [w for w in words if isinstance(w, int)]
        if not special:
            return self.v.encode_words(words)
        each = [[w] if isinstance(w, int) else self.v.encode_words([w])[0].tolist() for w in words]
        return np.array(list(chain.from_iterable(each)), np.int32), np.cumsum([len(x) for x in each])

    def _encode_runs(self, runs: list) -> tuple[np.ndarray, np.ndarray]:
        cut = [self._cut(x) for x in runs]
        ids, to = self.words.look_up(list(chain.from_iterable(cut)), self._encode_words)
        return ids, np.concatenate([[0], to])[np.cumsum([len(c) for c in cut], dtype=np.int64)]

    def encode(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and offsets: text i has ids[offsets[i]:offsets[i + 1]]."""
        pieces = [self.v.pieces(t or "") for t in texts]
        ids, to = self.runs.look_up(list(chain.from_iterable(pieces)), self._encode_runs)
        return ids, np.concatenate([[0], to])[np.cumsum([0, *map(len, pieces)], dtype=np.int64)]

    def decode(self, ids: Sequence[int]) -> str:
        return " ".join(map(self.v.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker, so its memory of words serves all the worker's tasks."""
    return Encoder(Vocabulary(path))


def default_path() -> str:
    """Where the executor has the public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def bpe_encode(docs: DataFrame, carry: Sequence[str] = ("doc_id",), text_col: str = "text",
               path: str | None = None, texts_at_once: int = 200) -> DataFrame:
    """The ``carry`` columns and ``ids`` (array<int>) of every row's text."""
    df = docs.select(*dict.fromkeys([*carry, text_col]))
    schema = T.StructType([*[df.schema[c] for c in carry], T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]):
        bpe = encoder(path or default_path())
        for whole in batches:
            for k in range(0, whole.num_rows, texts_at_once):
                batch = whole.slice(k, texts_at_once)
                flat, offsets = bpe.encode(batch.column(text_col).to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], ids], names=schema.names)

    return df.mapInArrow(run, schema)


def bpe_decode(encoded: DataFrame, carry: Sequence[str] = ("doc_id",), ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """The ``carry`` columns, ``ids`` and ``decoded`` text of every row of ``bpe_encode``. Null ids give null."""
    df = encoded.select(*dict.fromkeys([*carry, ids_col]))
    schema = T.StructType([*[df.schema[c] for c in carry], T.StructField("ids", df.schema[ids_col].dataType),
                           T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]):
        tokens = token_table(path or default_path())
        for whole in batches:
            for batch in _id_slices(whole, ids_col):
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], batch.column(ids_col), joined(batch.column(ids_col), tokens)],
                                                 names=schema.names)

    return df.mapInArrow(run, schema)


#: Ids decoded at once (a longer document is a slice of its own).
IDS_AT_ONCE = 1 << 19


@lru_cache(maxsize=2)
def token_table(path: str) -> pa.Array:
    """The token of every id, all that decoding needs of a vocabulary; ids the file lacks are null."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    tokens = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return pa.array([tokens.get(i) for i in range(max(tokens, default=-1) + 1)], pa.large_string())


def _id_slices(batch: pa.RecordBatch, ids_col: str) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(batch.column(ids_col)), 0)))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + IDS_AT_ONCE, "right"))
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def joined(ids: pa.ListArray, tokens: pa.Array) -> pa.Array:
    """The tokens of every list, joined by spaces; an id without a token is an error, a null list null."""
    lens = np.asarray(pc.fill_null(pc.list_value_length(ids), 0), np.int64)
    flat = tokens.take(ids.flatten())
    if flat.null_count:
        raise KeyError("an id that the vocabulary does not have")
    lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)])), flat)
    texts = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
    return pc.if_else(ids.is_valid(), texts, pa.scalar(None, pa.string())) if ids.null_count else texts
