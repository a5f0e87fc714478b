"""Token files: canonical length-limited Huffman codes over independent blocks.

Documents are tokenised once (ids written to the shared folder with a histogram per batch); the
histograms add up to global counts, from which package-merge makes code lengths of at most MAX_BITS.
Codes are canonical, so the file stores only a length per id. Every document is packed on its own
from a byte boundary, with the bit offset of each MARK-th id; the packed documents are range-partitioned
by id and gathered into blocks, each of which can be decoded alone.

Format. ``codes``: one row, a length (byte) per id. ``blocks``: one row per block: ``part`` and
``block`` (their order is the documents' order), ``before`` (ids of the part in earlier blocks), ``n_ids``
and ``data``: magic, document count, then per document id-is-null, id, id count, payload
bytes; then all marks (uint32, bits from the document's start) and all payloads.

Decoding looks MAX_BITS bits up in a table and runs all marks of a batch as parallel lanes. A lane
has MARK ids, so a long document is no serial chain.

Memory: a table of 2^MAX_BITS entries, a block (about BLOCK_IDS ids or one document) at a time. What
passes the driver is one number per id and one row per part. Null text: only the end id. Null ids
come first, repeated ids stay side by side, each row its own document. Extra columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from larder.llm.bpe import Memo
from larder.llm.common import chunks, remove, scratch

VOCABULARY, END_ID = "byte_bpe_50k.json", 2
MAX_BITS, MARK, BLOCK_IDS, TEXTS_AT_ONCE, JOINED = 20, 128, 1 << 18, 256, 512
#: Text bytes encoded at once, and units remembered: a batch's distinct units are looked up once each.
TEXT_BYTES, UNITS = 8 << 20, 600_000
MAGIC = b"LHUF0001"

# ---- tokenising -------------------------------------------------------------------------------

#: White space beside a space that is not single: there the library's cut depends on what follows.
_SPACE = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"  # as str.isspace
_MIXED = f"[{_SPACE}] (?:[{_SPACE}]|$)"


class UnitEncoder:
    """Encodes texts with the tokenizers library, each distinct space-led unit once.

    The vocabulary's cut never joins the text before a space with that after it, unless white space
    meets white space there; such texts and those with special tokens go to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.n_ids = self.library.get_vocab_size(with_added_tokens=True)
        self.joins = self.library.normalizer is None and not any(" " in s for s in self.special)
        self.n_bytes = np.zeros(self.n_ids, np.int64)  # a character of a token stands for a byte
        for token, i in self.library.get_vocab(with_added_tokens=True).items():
            self.n_bytes[i] = len(token)
        self.memo = Memo(UNITS)

    def _whole(self, texts: pa.Array) -> np.ndarray:
        found = pc.match_substring_regex(texts, _MIXED)
        for s in self.special:
            found = pc.or_(found, pc.match_substring(texts, s))
        return found.to_numpy(zero_copy_only=False)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids and offsets, as ``bpe.Encoder.encode`` gives them. The texts are cut and their
        units numbered by Arrow; only the distinct units of the batch become Python strings."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = self._whole(texts)
        cut = pc.split_pattern(pc.if_else(pa.array(whole), "", texts) if whole.any() else texts, " ")
        first = cut.offsets.to_numpy()
        units = cut.flatten().dictionary_encode()
        # A text's first unit has no space before it: key 2 * unit, the others' 2 * unit + 1.
        key = units.indices.to_numpy().astype(np.int64) * 2 + 1
        key[first[:-1]] -= 1
        there = np.zeros(2 * len(units.dictionary), bool)
        there[key] = True
        keys = np.flatnonzero(there)
        words = units.dictionary.take(pa.array(keys >> 1)).to_numpy(zero_copy_only=False).tolist()
        for i in np.flatnonzero((keys & 1) == 0).tolist():  # no unit has a space: one before it marks a text's first
            words[i] = " " + words[i]
        ids, to = self.memo.look_up(words, lambda new: self._encode_units([w[1:] if w[:1] == " " else " " + w for w in new]))
        to = np.concatenate([[0], to])
        index = (np.cumsum(there) - 1)[key]
        if whole.any():  # one entry each behind the units
            more, ends = self._encode_each(texts.filter(pa.array(whole)).to_pylist())
            index[first[:-1][whole]] = len(keys) + np.arange(len(ends) - 1)
            ids, to = np.concatenate([ids, more]), np.concatenate([to, ends[1:] + len(ids)])
        flat, ends = picked(ids, to, index)
        return flat, ends[first]

    def _encode_each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and offsets."""
        ids = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(ids), np.int32), np.cumsum([0, *map(len, ids)], dtype=np.int64)

    def _encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and ends. Units the library cuts apart anyway go to it as joined texts, whose ids are
        dealt out by the tokens' byte lengths; a joined text that does not come apart so goes singly."""
        ids, to, order = [], [np.zeros(1, np.int64)], []
        joined = np.array([self.joins and u[:1] == " " and not u[-1].isspace() for u in units], bool)
        for at, whole in ((np.flatnonzero(joined), True), (np.flatnonzero(~joined), False)):
            for k in range(0, len(at), JOINED):
                here = [units[i] for i in at[k:k + JOINED].tolist()]
                found, ends = self._encode_joined(here) if whole else self._encode_each(here)
                ids.append(found)
                to.append(ends[1:] + to[-1][-1])
            order.append(at)
        back = np.argsort(np.concatenate(order))
        flat, ends = picked(np.concatenate(ids) if ids else np.zeros(0, np.int32), np.concatenate(to), back)
        return flat, ends[1:]

    def _encode_joined(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = np.array(self.library.encode_batch_fast(["".join(units)], add_special_tokens=False)[0].ids, np.int32)
        length = np.concatenate([[0], np.cumsum(self.n_bytes[found])])
        want = np.cumsum([0, *map(len, map(str.encode, units))])
        ends = np.searchsorted(length, want)
        if length[-1] != want[-1] or (length[ends] != want).any():
            return self._encode_each(units)
        return found, ends


def picked(ids: np.ndarray, to: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries ``index`` of entries laid one after another from offsets ``to``, with their offsets."""
    sizes = (to[1:] - to[:-1])[index]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return ids[np.repeat(to[index] - ends[:-1], sizes) + np.arange(int(ends[-1]))], ends


@lru_cache(maxsize=1)
def unit_encoder(path: str) -> UnitEncoder:
    return UnitEncoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _tokenised(docs: DataFrame, id_col: str, text_col: str, path: str | None, end_id: int) -> DataFrame:
    """Rows (id, ids) and, with ``counts`` set, histogram rows (uint32 id, count pairs)."""
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = df.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        encoder = unit_encoder(path or default_path())
        id_type = None
        total = np.zeros(max(encoder.n_ids, end_id + 1), np.int64)
        for whole in batches:
            for batch in chunks(whole, "text", TEXT_BYTES):
                flat, offsets = encoder.encode(batch.column("text"))
                flat = np.insert(flat, offsets[1:], end_id).astype("<u4")
                offsets = offsets + np.arange(len(offsets))
                total += np.bincount(flat, minlength=len(total))
                body = [flat[a:b].astype("<u2" if len(total) <= 65536 else "<u4").tobytes() for a, b in zip(offsets, offsets[1:])]
                id_type = batch.column("id").type
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(body, pa.binary()), pa.nulls(batch.num_rows, pa.binary())], names=["id", "ids", "counts"])
        if id_type is not None:
            used = np.flatnonzero(total)
            counts = np.stack([used, total[used]], 1).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, id_type), pa.nulls(1, pa.binary()), pa.array([counts], pa.binary())], names=["id", "ids", "counts"])

    return df.mapInArrow(run, f"id {kind}, ids binary, counts binary")


def _global_counts(tokenised: DataFrame) -> dict[int, int]:
    """Count of every id, summed by Spark; the driver gets one row per id in use."""
    def run(batches):
        for batch in batches:
            for x in batch.column("counts").to_pylist():
                pairs = np.frombuffer(x, "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["token", "n"])

    pairs = tokenised.filter(F.col("counts").isNotNull()).select("counts").mapInArrow(run, "token long, n long")
    return {r.token: r.n for r in pairs.groupBy("token").agg(F.sum("n").alias("n")).toLocalIterator()}


# ---- codes ------------------------------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 for unused ids."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) == 1:
        out[used] = 1
    if len(used) < 2:
        return out
    if len(used) > 1 << limit:
        raise ValueError("more ids than codes of this length")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    level, coins = weights, [np.ones(len(weights), bool)]
    for _ in range(limit - 1):
        packages = level[:len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, packages])
        by = np.argsort(both, kind="stable")
        level = both[by]
        coins.append(by < len(weights))
    take = 2 * len(weights) - 2
    for is_coin in reversed(coins):
        n_coins = int(is_coin[:take].sum())
        out[order[:n_coins]] += 1
        take = 2 * (take - n_coins)
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: shorter first, ids in order."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        size = lengths[order].astype(np.int64)
        width = int(size[-1])
        step = np.left_shift(np.int64(1), width - size)
        codes[order] = (np.concatenate([[0], np.cumsum(step)[:-1]]) >> (width - size)).astype(np.uint32)
    return codes


def decode_table(lengths: np.ndarray, limit: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(id, length) for each value of the next ``limit`` bits."""
    codes = canonical_codes(lengths)
    ids, sizes = np.zeros(1 << limit, np.int32), np.ones(1 << limit, np.uint8)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        span = np.left_shift(np.int64(1), limit - lengths[order].astype(np.int64))
        filled = int(span.sum())
        ids[:filled] = np.repeat(order, span)
        sizes[:filled] = np.repeat(lengths[order], span)
    assert not len(order) or codes[order[0]] == 0
    return ids, sizes


def pack(flat: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray, list[np.ndarray]]:
    """(payloads one after another, each text's first byte with a closing entry, each text's marks)."""
    size = lengths[flat].astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(size)])
    n_bytes = (ends[offsets[1:]] - ends[offsets[:-1]] + 7) >> 3
    first = np.concatenate([[0], np.cumsum(n_bytes)])
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = ends[:-1] - ends[offsets[:-1]][text]
    bit = 8 * first[:-1][text] + inside
    # Codes as big-endian 32-bit words: each lies in one word or two, and bits of neighbours add up.
    value = codes[flat].astype(np.uint64) << (64 - size - (bit & 31)).astype(np.uint64)
    word = bit >> 5
    heads = np.flatnonzero(np.diff(word, prepend=-1))
    out = np.zeros((int(first[-1]) >> 2) + 2, np.uint64)
    if len(heads):
        out[word[heads]] += np.add.reduceat(value >> np.uint64(32), heads)
        out[word[heads] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), heads)
    body = out.astype(">u4").tobytes()[:int(first[-1])]
    marks = [inside[a:b:MARK].astype("<u4") for a, b in zip(offsets, offsets[1:])]
    return body, first, marks


def unpack(data: np.ndarray, bits: np.ndarray, sizes: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Decode lanes: lane i has ``sizes[i]`` <= MARK ids from bit ``bits[i]``; all ids one after another.
    ``data`` has four spare bytes."""
    ids, lens = table
    out = np.empty(int(sizes.sum()), np.int32)
    order = np.argsort(-sizes, kind="stable")  # lanes that end drop off the end
    at, to, left = bits[order].astype(np.int64), (np.cumsum(sizes) - sizes)[order], sizes[order]
    mask = (1 << MAX_BITS) - 1
    # the 32 bits from each byte on, so that a step looks once
    window = data[:-3].astype(np.uint32) << 24 | data[1:-2].astype(np.uint32) << 16 | data[2:-1].astype(np.uint32) << 8 | data[3:]
    live = len(left)
    for step in range(int(left[0]) if len(left) else 0):
        while live and left[live - 1] <= step:
            live -= 1
        p = at[:live]
        look = (window[p >> 3] >> (32 - MAX_BITS - (p & 7))) & mask
        out[to[:live] + step] = ids[look]
        p += lens[look]
    return out


# ---- files ------------------------------------------------------------------------------------

_DOC = np.dtype([("null", "u1"), ("id", "<i8"), ("n_ids", "<i8"), ("n_bytes", "<i8")])


def _blocks(tokenised: DataFrame, lengths: bytes, block_ids: int) -> DataFrame:
    """Documents in order of their ids (then of their number of ids, then of the ids), packed and gathered into blocks. The ids
    are dealt out before they are packed: Spark's sample of the range keys then reads a table and runs no packing."""
    from pyspark import TaskContext

    df = tokenised.filter(F.col("ids").isNotNull()).select("id", "ids")
    placed = df.repartitionByRange("id").sortWithinPartitions("id", F.octet_length("ids"), "ids")
    shared = df.sparkSession.sparkContext.broadcast(lengths)

    def run(batches):
        sizes = np.frombuffer(shared.value, np.uint8)
        codes = canonical_codes(sizes)
        width = "<u2" if len(sizes) <= 65536 else "<u4"
        part, block, before = TaskContext.get().partitionId(), 0, 0
        docs, payloads, marks, n = [], [], [], 0

        def row():
            data = b"".join([MAGIC, struct.pack("<q", len(docs)), np.array(docs, _DOC).tobytes(), *marks, *payloads])
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()), "before": pa.array([before], pa.int64()),
                "n_ids": pa.array([n], pa.int64()), "data": pa.array([data], pa.binary())})

        for whole in batches:
            for k in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(k, TEXTS_AT_ONCE)
                parts = [np.frombuffer(x, width) for x in batch.column("ids").to_pylist()]
                offsets = np.cumsum([0, *map(len, parts)])
                payload, first, bits = pack(np.concatenate(parts).astype(np.int64), offsets, sizes, codes)
                for i, m, a, b, at in zip(batch.column("id").to_pylist(), np.diff(offsets).tolist(), first.tolist(), first[1:].tolist(), bits):
                    docs.append((i is None, i or 0, m, b - a))
                    payloads.append(payload[a:b])
                    marks.append(at.tobytes())
                    n += m
                    if n >= block_ids:
                        yield row()
                        before, block = before + n, block + 1
                        docs, payloads, marks, n = [], [], [], 0
        if docs:
            yield row()

    return placed.mapInArrow(run, "part int, block int, before long, n_ids long, data binary")


def write_token_files(docs: DataFrame, out: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                      end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Write ``out/codes`` and ``out/blocks``. Ids must be integers (or null)."""
    spark = docs.sparkSession
    raw = scratch(spark, "token-ids")
    _tokenised(docs, id_col, text_col, path, end_id).write.option("compression", "zstd").parquet(raw)
    tokenised = spark.read.parquet(raw)
    counts = _global_counts(tokenised)
    flat = np.zeros(max(counts, default=end_id) + 1, np.int64)
    flat[list(counts)] = list(counts.values())
    lengths = code_lengths(flat).tobytes()
    spark.createDataFrame([(bytearray(lengths),)], "lengths binary").write.parquet(f"{out}/codes")
    _blocks(tokenised, lengths, block_ids).write.option("compression", "uncompressed").parquet(f"{out}/blocks")
    remove(spark, raw)


def _open_block(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(documents, payload bytes with spare, lane bits, lane sizes) of one block."""
    if data[:8] != MAGIC:
        raise ValueError("not a token block")
    n = struct.unpack_from("<q", data, 8)[0]
    docs = np.frombuffer(data, _DOC, n, 16)
    lanes = -(-docs["n_ids"] // MARK)
    at = 16 + n * _DOC.itemsize
    marks = np.frombuffer(data, "<u4", int(lanes.sum()), at).astype(np.int64)
    body = np.frombuffer(data, np.uint8, offset=at + 4 * len(marks))
    first = np.cumsum(docs["n_bytes"]) - docs["n_bytes"]
    bits = marks + np.repeat(8 * first, lanes)
    sizes = np.full(len(marks), MARK, np.int64)
    sizes[np.cumsum(lanes)[lanes > 0] - 1] = (docs["n_ids"] - MARK * (lanes - 1))[lanes > 0]
    return docs, np.concatenate([body, np.zeros(4, np.uint8)]), bits, sizes


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, decoded from the files."""
    blocks = spark.read.parquet(f"{path}/blocks")
    lengths = spark.read.parquet(f"{path}/codes").first()[0]  # a byte per id of the vocabulary
    shared = spark.sparkContext.broadcast(bytes(lengths))
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    base = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))  # a row per part
    placed = blocks.join(base, "part").select((F.col("base") + F.col("before")).alias("start"), "data")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType(), False))

    def run(batches):
        table = decode_table(np.frombuffer(shared.value, np.uint8))
        for batch in batches:
            for start, data in zip(batch.column("start").to_pylist(), batch.column("data")):
                docs, body, bits, sizes = _open_block(data.as_py())
                flat = unpack(body, bits, sizes, table)
                offsets = np.concatenate([[0], np.cumsum(docs["n_ids"])])
                raw = flat.astype("<u4")
                crc = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
                cols = [pa.array(docs["id"], mask=docs["null"].astype(bool)), pa.array(start + offsets[:-1]),
                        pa.array(docs["n_ids"]), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return placed.mapInArrow(run, schema)
