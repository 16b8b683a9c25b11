"""Operator 1: token ids as one wavelet matrix per shard.

`write_token_shards` range-partitions documents by doc_id, encodes each text,
appends the end id and packs about `shard_tokens` ids into one shard file: for
each bit of the ids (highest first) a bit-plane of the ids stably partitioned
by the bits above, with rank counts every 512 bits.  `WaveletMatrix` answers
access, rank, select and count from the bytes of one such file.

A shard file is one value of the `file` column of a Parquet table in the
shared folder: Spark's committer makes it appear once whatever task attempts
were lost, and it works on any store Spark can write; `bytes -> path` is a
plain copy.

Edge cases: a null text is empty and has the end id alone; rows with equal or
null doc_id keep one entry each (null ids first, ties by text); an empty table
gives no shards; extra columns are ignored; a document never spans two shards.
"""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import IdCache, ascii_lower, prepare, span_hash, staged, text_slices, texts, word_spans

MAGIC = b"WVM1"
BLOCK = 512  # bits for each rank count
SHARD_TOKENS = 1 << 20


class WaveletMatrix:
    """Succinct sequence of unsigned ids: `bits` planes of n bits each."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros
        self.ranks = []
        for p in planes:
            ones = np.bitwise_count(p.view(np.uint64)).reshape(-1, BLOCK // 64).sum(1, dtype=np.int64)
            self.ranks.append(np.concatenate([[0], np.cumsum(ones)]))

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        x, planes, zeros = ids, [], []
        width = -(-(len(ids) + 1) // BLOCK) * BLOCK // 8
        for b in range(bits - 1, -1, -1):
            bit = ((x >> x.dtype.type(b)) & x.dtype.type(1)).astype(bool)
            plane = np.zeros(width, np.uint8)
            packed = np.packbits(bit, bitorder="little")
            plane[:len(packed)] = packed
            planes.append(plane)
            low = np.compress(~bit, x)
            zeros.append(len(low))
            x = np.concatenate([low, np.compress(bit, x)])
        return cls(len(ids), planes, zeros)

    # -- queries --
    def _rank1(self, level: int, i: np.ndarray) -> np.ndarray:
        """Set bits of a plane before position i."""
        words = self.planes[level].view(np.uint64)
        block, word = i // BLOCK, i // 64
        out = self.ranks[level][block]
        for k in range(BLOCK // 64):  # whole words between the block and i
            at = block * (BLOCK // 64) + k
            out = out + np.where(at < word, np.bitwise_count(words[np.minimum(at, len(words) - 1)]), 0)
        rest = (np.uint64(1) << (i % 64).astype(np.uint64)) - np.uint64(1)
        return out + np.bitwise_count(words[word] & rest)

    def access(self, i) -> np.ndarray:
        """The ids at positions i."""
        i = np.atleast_1d(np.asarray(i, np.int64))
        if len(i) and (i.min() < 0 or i.max() >= self.n):
            raise IndexError("position outside the shard")
        out = np.zeros(len(i), np.uint32)
        for level, z in enumerate(self.zeros):
            bit = (self.planes[level][i >> 3] >> (i & 7).astype(np.uint8)) & 1
            ones = self._rank1(level, i)
            i = np.where(bit == 1, z + ones, i - ones)
            out = (out << np.uint32(1)) | bit
        return out

    def rank(self, symbol: int, i: int) -> int:
        """Occurrences of symbol before position i."""
        lo, hi = self._interval(symbol, i)
        return hi - lo

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def _interval(self, symbol: int, i: int) -> tuple[int, int]:
        if symbol < 0 or symbol >> len(self.zeros):
            return 0, 0
        lo, hi = 0, min(max(i, 0), self.n)
        for level, z in enumerate(self.zeros):
            a, b = self._rank1(level, np.array([lo, hi]))
            if symbol >> (len(self.zeros) - 1 - level) & 1:
                lo, hi = z + int(a), z + int(b)
            else:
                lo, hi = lo - int(a), hi - int(b)
        return lo, hi

    def locate(self, symbol: int) -> np.ndarray:
        """All positions of symbol, ascending."""
        lo, hi = self._interval(symbol, self.n)
        i = np.arange(lo, hi)
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.n, bitorder="little")
            one = symbol >> (len(self.zeros) - 1 - level) & 1
            places = np.flatnonzero(bit == one)
            i = places[i - self.zeros[level] * one]
        return i

    def select(self, symbol: int, k: int) -> int:
        """Position of the k-th occurrence (from 0) of symbol, or -1."""
        lo, hi = self._interval(symbol, self.n)
        if not 0 <= k < hi - lo:
            return -1
        i = lo + k
        for level in range(len(self.zeros) - 1, -1, -1):
            one = symbol >> (len(self.zeros) - 1 - level) & 1
            i = self._select_bit(level, one, i - self.zeros[level] * one)
        return i

    def _select_bit(self, level: int, one: int, k: int) -> int:
        before = self.ranks[level]
        if not one:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before, k, "right")) - 1
        part = self.planes[level][block * BLOCK // 8:(block + 1) * BLOCK // 8]
        bit = np.unpackbits(part, bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bit == one)[k - before[block]])

    def decode(self) -> np.ndarray:
        """All ids in order, from the lowest plane upwards."""
        x = np.zeros(self.n, np.uint16 if len(self.zeros) <= 16 else np.uint32)
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.n, bitorder="little").astype(bool)
            z, up = self.zeros[level], np.empty_like(x)
            up[np.flatnonzero(~bit)] = x[:z]
            up[np.flatnonzero(bit)] = x[z:] | x.dtype.type(1 << (len(self.zeros) - 1 - level))
            x = up
        return x

    # -- file --
    def to_bytes(self) -> bytes:
        """Header and one zstd frame for each plane; rank counts are rebuilt
        from the planes when the file is opened."""
        pack = zstandard.ZstdCompressor(level=1)
        frames = [pack.compress(p.tobytes()) for p in self.planes]
        head = MAGIC + struct.pack("<QI", self.n, len(frames))
        head += b"".join(struct.pack("<QQ", z, len(f)) for z, f in zip(self.zeros, frames))
        return head + b"".join(frames)

    @classmethod
    def from_bytes(cls, raw: bytes) -> WaveletMatrix:
        if raw[:4] != MAGIC:
            raise ValueError("not a wavelet shard")
        n, bits = struct.unpack_from("<QI", raw, 4)
        at, planes, zeros = 16 + 16 * bits, [], []
        unpack = zstandard.ZstdDecompressor()
        for level in range(bits):
            z, size = struct.unpack_from("<QQ", raw, 16 + 16 * level)
            planes.append(np.frombuffer(unpack.decompress(raw[at:at + size]), np.uint8))
            zeros.append(z)
            at += size
        return cls(n, planes, zeros)


# ---- encoding --------------------------------------------------------------

_WORD = np.ones(256, bool)
_WORD[[9, 10, 13, 32]] = False
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True


class WordEncoder:
    """The tokenizers library over pieces of a text, each distinct piece once.

    The vocabulary's pattern never matches across white space, and a run of
    letters ends before an ASCII mark, so the ids of a text are those of its
    pieces one after another.  Pieces are lower-cased in ASCII (the normaliser
    does so anyway).  A slice with "<|" in it, where a special token may stand,
    is cut at white space only and keeps its case.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.cache = IdCache(np.uint32)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each document, all ids) of one slice."""
        bar = np.flatnonzero(data[1:] == 124)
        if (data[bar] == 60).any():
            start, end, doc = word_spans(data, offsets, _WORD)
        else:
            data = ascii_lower(data)
            cut = np.zeros(len(data), bool)
            cut[1:] = _LETTER[data[:-1]] & _MARK[data[1:]]
            start, end, doc = word_spans(data, offsets, _WORD, cut)

        def missing(at):
            pieces = [data[s:e].tobytes().decode() for s, e in zip(start[at], end[at])]
            ids = [None] * len(pieces)
            plain = [k for k, p in enumerate(pieces) if p.isalpha()]
            for k in range(0, len(plain), 500):
                group = plain[k:k + 500]
                got = np.array(self._encode([" ".join(pieces[i] for i in group)])[0], np.uint32)
                parts = np.split(got, np.flatnonzero(self.ends[got]) + 1)
                if len(parts) == len(group) + 1 and not len(parts[-1]):
                    for i, part in zip(group, parts):
                        ids[i] = part
            rest = [k for k, x in enumerate(ids) if x is None]
            for k, x in zip(rest, self._encode([pieces[i] for i in rest])):
                ids[k] = np.array(x, np.uint32)
            return np.array([len(x) for x in ids], np.int64), np.concatenate(ids)

        length, ids = self.cache.encode(span_hash(data, start, end), missing)
        return np.bincount(doc, length, len(offsets) - 1).astype(np.int64), ids

    def _encode(self, some: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


# ---- the Spark jobs --------------------------------------------------------

SHARDS = "shard long, n_docs long, n_tokens long, doc_ids array<long>, lengths array<long>, file binary"


def write_token_shards(docs: DataFrame, tokenizer: str, end_id: int = 2,
                       shard_tokens: int = SHARD_TOKENS, name: str = "token-shards") -> DataFrame:
    """Shard files in ascending doc_id order, written to the shared folder and
    read back. `shard` ascends with doc_id (range partition, then a counter)."""
    prepare(docs.sparkSession)

    def pack(batches):
        encode, base, count = encoder(tokenizer), TaskContext.get().partitionId() << 32, 0
        ids, lengths, parts, held = [], [], [], 0

        def shard():
            tokens = np.concatenate(parts)
            tokens = tokens.astype(np.uint16) if tokens.max() < 1 << 16 else tokens
            return pa.RecordBatch.from_pylist([{
                "shard": base + count, "n_docs": len(ids), "n_tokens": len(tokens), "doc_ids": list(ids),
                "lengths": list(lengths), "file": WaveletMatrix.build(tokens).to_bytes()}], schema=_shard_schema())

        for doc_ids, data, offsets in text_slices(batches):
            n, flat_ids = encode(data, offsets)
            to = np.cumsum(n)
            for k, doc in enumerate(doc_ids):
                parts += [flat_ids[to[k] - n[k]:to[k]], np.array([end_id], np.uint32)]
                ids.append(doc)
                lengths.append(int(n[k]) + 1)
                held += lengths[-1]
                if held >= shard_tokens:
                    yield shard()
                    ids, lengths, parts, held, count = [], [], [], 0, count + 1
        if ids:
            yield shard()

    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return staged(ordered.mapInArrow(pack, SHARDS), name)


def _shard_schema() -> pa.Schema:
    return pa.schema([("shard", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
                      ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("file", pa.binary())])


def shard_starts(shards: DataFrame) -> DataFrame:
    """(shard, shard_start): ids in all shards before. Two levels: shards of
    one range partition, then one row for each of those partitions."""
    group = F.shiftright("shard", 32)
    inner = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    rows = shards.select("shard", group.alias("part"), "n_tokens")
    parts = (rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("part_start")))
    return (rows.withColumn("inner_start", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)))
            .join(parts, "part").select("shard", (F.col("part_start") + F.col("inner_start")).alias("shard_start")))


def token_documents(shards: DataFrame) -> DataFrame:
    """Per document, from the shard files: doc_id, start, n_tokens, ids_crc32."""
    def unpack(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = WaveletMatrix.from_bytes(row["file"]).decode().astype("<u4")
                to = np.cumsum(row["lengths"])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(row["doc_ids"], pa.int64()), "shard": [row["shard"]] * len(to),
                    "inner_start": (to - row["lengths"]).astype(np.int64), "n_tokens": np.array(row["lengths"], np.int64),
                    "ids_crc32": np.array([zlib.crc32(ids[b - n:b]) for b, n in zip(to, row["lengths"])], np.int64)})

    spark = shards.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    rows = shards.select("shard", "doc_ids", "lengths", "file").mapInArrow(
        unpack, "doc_id long, shard long, inner_start long, n_tokens long, ids_crc32 long")
    return (rows.join(shard_starts(shards), "shard")
            .select("doc_id", (F.col("shard_start") + F.col("inner_start")).alias("start"), "n_tokens", "ids_crc32"))
