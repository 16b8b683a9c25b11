"""Helpers shared by the operators: staged tables, Arrow access, text scans.

Text scans work on UTF-8 bytes with numpy: a batch of documents is one flat
byte array plus offsets, and words, hashes and counts are computed for the
whole batch at once.  Documents are handled in slices of about 1 MB (a longer
document is a slice of its own), so memory follows the longest document.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import unique_path

SLICE_BYTES = 1 << 20
U64 = np.uint64


def prepare(spark: SparkSession) -> None:
    """Runtime settings of the Python stages: small Arrow batches, so that a
    batch of very long texts still fits in a worker, and skew-aware joins."""
    for key, value in {
        "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }.items():
        spark.conf.set(key, value)
    # Python workers import this package; where it is not installed on the
    # machines (a checkout, a shared folder), they find it beside the driver's.
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): a null text is an empty one; other columns are dropped."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage, and
    a lost executor costs nothing that was finished."""
    path = unique_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_name(doc_id, text):
    """A row named by its doc_id and text, as different texts may share a doc_id."""
    return F.xxhash64(doc_id, text)


def spare_column(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, in any case of its letters."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---- Arrow -----------------------------------------------------------------

def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column without nulls as (bytes, n + 1 offsets)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    n = len(column)
    if n == 0 or column.buffers()[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents [i, j) of at most `limit` bytes, one document at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def text_slices(batches, limit: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(doc_ids, bytes, offsets) for slices of Arrow batches (doc_id, text)."""
    for batch in batches:
        ids = np.asarray(batch.column("doc_id").to_pylist(), dtype=object)
        data, offsets = flat(batch.column("text"))
        for i, j in slices(offsets, limit):
            yield ids[i:j], data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]


# ---- words and hashes ------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all bits are usable (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


_BASE = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, base, U64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end) of one slice."""
    up, down = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, U64)
        np.cumsum(_BYTE[data] * up[:len(data)], out=total[1:])
        h = (total[end] - total[start]) * down[start]
        return mix(h + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray,
               cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of maximal runs of word bytes; a run never
    crosses a document, nor a position where `cut` is true."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    if cut is not None:
        edge[:-1] |= cut
    w = is_word[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = w[:-1]
    start = np.flatnonzero(w & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = w[1:]
    end = np.flatnonzero(w & (~after | edge[1:])) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    return start, end, doc


#: Words of the shingle operators: maximal runs of ASCII letters or digits and
#: of bytes beyond ASCII, after lower-casing.
SHINGLE_WORD = np.zeros(256, bool)
SHINGLE_WORD[128:] = True
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    SHINGLE_WORD[_a:_b] = True
SHINGLE_PATTERN = r"[0-9A-Za-z\u0080-\U0010ffff]+"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def ascii_lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def shingles(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of every run of `size` words within one document."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    with np.errstate(over="ignore"):
        h = np.zeros(n, U64)
        for k in range(size):
            h = h * U64(0x9DDFEA08EB382D69) + hashes[k:k + n]
    at = np.flatnonzero(doc[:n] == doc[size - 1:])
    return at, mix(h[at])


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenated ranges start[i] .. start[i] + length[i] - 1."""
    total = int(length.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    first = np.cumsum(length) - length
    return np.repeat(start - first, length) + np.arange(total)


class IdCache:
    """Hash of a text piece -> its token ids, as sorted arrays; bounded: when
    it holds `limit` pieces it starts anew."""

    def __init__(self, dtype, limit: int = 1_500_000):
        self.dtype, self.limit = dtype, limit
        self.clear()

    def clear(self) -> None:
        self.keys, self.off = np.zeros(0, U64), np.zeros(0, np.int64)
        self.len, self.ids, self.used = np.zeros(0, np.int32), np.zeros(1 << 16, self.dtype), 0

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return at, (self.keys[at] == keys) if len(self.keys) else np.zeros(len(keys), bool)

    def add(self, keys: np.ndarray, length: np.ndarray, ids: np.ndarray) -> None:
        """keys ascending and not yet present; their ids one after another."""
        need = self.used + len(ids)
        if need > len(self.ids):
            grown = np.zeros(max(need, 2 * len(self.ids)), self.dtype)
            grown[:self.used] = self.ids[:self.used]
            self.ids = grown
        self.ids[self.used:need] = ids
        off = self.used + np.cumsum(length) - length
        at = np.searchsorted(self.keys, keys)
        self.keys, self.off = np.insert(self.keys, at, keys), np.insert(self.off, at, off)
        self.len, self.used = np.insert(self.len, at, length), need

    def encode(self, keys: np.ndarray, encode_missing) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids per key, ids of all keys). encode_missing gets the
        positions of first occurrences of unknown keys and returns (lengths, ids)."""
        if len(keys) == 0:
            return np.zeros(0, np.int64), np.zeros(0, self.dtype)
        uniq, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        at, known = self.find(uniq)
        if not known.all():
            if len(self.keys) + int((~known).sum()) > self.limit:
                self.clear()
                known[:] = False
            self.add(uniq[~known], *encode_missing(first[~known]))
            at, known = self.find(uniq)
        length = self.len[at].take(inverse).astype(np.int64)
        return length, self.ids.take(ranges(self.off[at].take(inverse), length))
