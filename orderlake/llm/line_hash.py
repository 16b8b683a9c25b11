"""Operator 12: line dedup by a sharded minimal perfect hash.

A text is split at line breaks.  A line's key is the line without white space
at both ends and with A-Z in lower case; keys shorter than `least_chars` code
points never repeat in this sense.  Each document sends the 128-bit hash of
each of its keys once; they are counted over all documents (partial
aggregation, so a line of a third of all documents is one row for each task).

The distinct hashes of the lines of two documents or more are dealt into
shards of about `SHARD_KEYS`; one owner task writes each shard as a file of
flat arrays: the bits of a minimal perfect hash (level by level, a key has the
bit that no other key of its level wants; its number is the rank of that bit),
and by that number a fingerprint, the number of documents and the largest
doc_id.  A line of one document only has no entry: whatever number the hash
gives it, its fingerprint is not there.  The number of shards follows the
number of entries, so the memory of an owner does not grow with the input.

Documents then probe the arrays, memory-mapped by the tasks from the shared
folder, and drop the lines found in `least_docs` documents or more, except in
that with the largest doc_id.  No line and no text is shuffled, and no
document waits for another one.

The files need a mounted shared folder (`spark.checkpoint.dir`); a file is
there whole or not at all, so an owner that runs twice does no harm.

Edge cases: a null or empty text is one empty line; rows are documents, also
with equal doc_ids (those that share the largest id all keep the line); a null
doc_id is smaller than all others; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import is_local, local_path, unique_path
from .common import U64, mix, prepare, staged, texts
from .kneser_ney import _mapped, _write

LEAST_CHARS, LEAST_DOCS = 40, 5
#: Entries of a shard, some 20 bytes each.
SHARD_KEYS = 1 << 18
#: Slots of a level for each key that is left.
GAMMA = 2.0
NO_ID = -(1 << 63)

_BLANK = b" \t\n\x0b\x0c\r"
_WORDS = 8  # 64-bit words between two stored ranks
SHARD_FILE = ("<i8", "<u8", "<u8", "<u8", "u1", "<i8", "<i8", "<i8")


def line_keys(lines: list[bytes], least_chars: int = LEAST_CHARS) -> tuple[list[int], list[bytes]]:
    """(numbers, 128-bit hashes) of the lines with a key of enough code points."""
    at, keys = [], []
    for i, line in enumerate(lines):
        if len(line) >= least_chars:
            key = line.strip(_BLANK).lower()
            if len(key) >= least_chars and (key.isascii() or len(key.decode()) >= least_chars):
                at.append(i)
                keys.append(xxhash.xxh3_128_digest(key))
    return at, keys


def _halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(keys), ">u8").astype(U64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys (two 64-bit halves)."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, ranks: np.ndarray):
        self.sizes, self.bits, self.ranks = sizes, bits, ranks

    @staticmethod
    def _slot(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix(mix(high + U64(level + 1) * U64(0x9E3779B97F4A7C15)) ^ low) % U64(size)

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        sizes, planes = [], []
        while len(high):
            size = -int(-GAMMA * len(high) // 64) * 64
            slot = cls._slot(high, low, len(sizes), size).astype(np.int64)
            alone = np.bincount(slot, minlength=size) == 1
            sizes.append(size)
            planes.append(np.packbits(alone, bitorder="little"))
            left = ~alone[slot]
            high, low = high[left], low[left]
        bits = np.concatenate(planes).view("<u8") if planes else np.zeros(0, U64)
        ones = np.r_[0, np.cumsum(np.bitwise_count(bits), dtype=np.int64)]
        return cls(np.array(sizes, "<i8"), bits, ones[::_WORDS].astype("<u8"))

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The number of each key: 0 to n - 1, each once, for the n keys of the
        hash; for other keys any of these, or -1."""
        out = np.full(len(high), -1, np.int64)
        open_, first = np.arange(len(high)), 0
        for level, size in enumerate(self.sizes):
            slot = self._slot(high[open_], low[open_], level, int(size)).astype(np.int64) + first
            word, bit = slot >> 6, (slot & 63).astype(U64)
            here = (self.bits[word] >> bit) & U64(1) == 1
            word, bit = word[here], bit[here]
            rank = self.ranks[word // _WORDS].astype(np.int64)
            for back in range(1, _WORDS):
                inside = word % _WORDS >= back
                rank[inside] += np.bitwise_count(self.bits[word[inside] - back])
            rank += np.bitwise_count(self.bits[word] & ((U64(1) << bit) - U64(1)))
            out[open_[here]] = rank
            open_, first = open_[~here], first + int(size)
            if not len(open_):
                break
        return out


def shard_arrays(high: np.ndarray, low: np.ndarray, docs: np.ndarray, last: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays of one shard file, in the order of SHARD_FILE."""
    index = PerfectHash.build(high, low)
    at = np.empty(len(high), np.int64)
    at[index.find(high, low)] = np.arange(len(high))
    docs, last = docs[at], last[at]
    big = np.flatnonzero(docs >= 255)
    return {"sizes": index.sizes, "bits": index.bits.astype("<u8"), "ranks": index.ranks,
            "fingerprints": low[at].astype("<u8"), "docs": np.minimum(docs, 255).astype("u1"),
            "big": big.astype("<i8"), "big_docs": docs[big].astype("<i8"), "last": last.astype("<i8")}


class LineIndex:
    """The shard files: how many documents hold a line, and the last of them."""

    def __init__(self, folder: str, shards: int):
        self.folder, self.shards = folder, shards

    def probe(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, largest doc_id) of each key; 0 for keys without an entry."""
        docs, last = np.zeros(len(high), np.int64), np.zeros(len(high), np.int64)
        shard = (high % U64(self.shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order])) + 1
        for at in np.split(order, cuts) if len(order) else []:
            sizes, bits, ranks, prints, count, big, big_docs, final = _mapped(
                f"{self.folder}/lines-{shard[at[0]]:07d}", SHARD_FILE)
            place = PerfectHash(sizes, bits, ranks).find(high[at], low[at])
            at, place = at[place >= 0], place[place >= 0]
            mine = prints[place] == low[at]
            at, place = at[mine], place[mine]
            n = count[place].astype(np.int64)
            many = np.flatnonzero(n == 255)
            n[many] = big_docs[np.searchsorted(big, place[many])]
            docs[at], last[at] = n, final[place]
        return docs, last


def build_index(docs: DataFrame, least_chars: int = LEAST_CHARS, shard_keys: int = SHARD_KEYS,
                name: str = "lines") -> LineIndex:
    """Count the lines of `docs` and write the index of those that repeat."""
    spark = docs.sparkSession
    prepare(spark)
    path = unique_path(spark, name)
    if not is_local(path):
        raise ValueError("documents memory-map the index: spark.checkpoint.dir must be a mounted folder")
    folder = local_path(path)
    os.makedirs(folder, exist_ok=True)

    def emit(batches):
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                mine = set(line_keys(text.as_buffer().to_pybytes().split(b"\n"), least_chars)[1])
                ids += [NO_ID if doc_id is None else doc_id] * len(mine)
                keys += mine
            high, low = _halves(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(high.view(np.int64)), pa.array(low.view(np.int64)), pa.array(ids, pa.int64())],
                ["high", "low", "doc_id"])

    def write(key, table):
        high, low, n, last = (table.column(c).to_numpy() for c in ("high", "low", "docs", "last"))
        _write(f"{folder}/lines-{key[0].as_py():07d}", shard_arrays(high.view(U64), low.view(U64), n, last))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "entries": pa.array([len(n)], pa.int64())})

    repeated = staged(texts(docs).mapInArrow(emit, "high long, low long, doc_id long")
                      .groupBy("high", "low").agg(F.count("*").alias("docs"), F.max("doc_id").alias("last"))
                      .where("docs > 1"), name + "-entries")
    shards = max(1, -(-repeated.count() // shard_keys))
    # The halves are unsigned: a signed remainder is brought back to it.
    shard = F.pmod(F.pmod("high", F.lit(shards))
                   + F.when(F.col("high") < 0, F.lit((1 << 64) % shards)).otherwise(F.lit(0)), F.lit(shards))
    staged(repeated.groupBy(shard.alias("shard")).applyInArrow(write, "shard long, entries long"), name + "-shards")
    return LineIndex(folder, shards)


def drop_lines(docs: DataFrame, index: LineIndex, least_chars: int = LEAST_CHARS,
               least_docs: int = LEAST_DOCS) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, text (the lines that stay)."""
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            ids, lines, at, keys = batch.column("doc_id").to_pylist(), [], [], []
            for text in batch.column("text"):
                lines.append(text.as_buffer().to_pybytes().split(b"\n"))
                where, mine = line_keys(lines[-1], least_chars)
                at.append(where)
                keys += mine
            n, last = index.probe(*_halves(keys))
            holder = np.repeat(np.array([NO_ID if i is None else i for i in ids], np.int64), [len(a) for a in at])
            gone = (n >= least_docs) & (last != holder)
            dropped, out, first = [], [], 0
            for text, where in zip(lines, at):
                hit = gone[first:first + len(where)]
                first += len(where)
                dropped.append(int(hit.sum()))
                if dropped[-1]:
                    drop = set(np.asarray(where)[hit].tolist())
                    text = [line for i, line in enumerate(text) if i not in drop]
                out.append(b"\n".join(text).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in lines], pa.int64()),
                 pa.array(dropped, pa.int64()), pa.array(out, pa.string())],
                ["doc_id", "n_lines", "n_dropped", "text"])

    return texts(docs).mapInArrow(run, "doc_id long, n_lines long, n_dropped long, text string")


def remove_repeated_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS,
                          shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Index the lines of `docs`, then drop those that repeat (see `drop_lines`)."""
    if least_docs < 2:
        raise ValueError("lines of one document are not indexed: least_docs must be 2 or more")
    return drop_lines(docs, build_index(docs, least_chars, shard_keys), least_chars, least_docs)
