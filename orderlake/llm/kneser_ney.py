"""Operator 8: interpolated modified Kneser-Ney bigram model.

Counting is a Spark job in three steps: (1) every task counts the bigrams of
its training texts and sends each distinct one once, by a bucket of (context,
last word mod SALT), so a frequent context is spread and a frequent bigram
arrives once per task; (2) each bucket merges its bigrams, writes them as one
sorted hash array, and reports partial counts per word; (3) each word bucket
merges those and writes the word table.  Model files lie in the shared folder
of the session; a task writes to a temporary name and renames, so repeated or
lost attempts leave one whole file.  Scoring tasks memory-map the files.

The order is two: the distinct trigrams of a corpus are nearly as many as its
tokens, and their keys alone, with both shorter histories each needs for its
continuation counts, exceed the disk that the check tool allows.

Words are identified by 64-bit hashes (contexts inside the bigram table by 48
bits).  The model sums to one over the training words and one unknown word.

Edge cases: a null text is empty and has the end token alone; a null doc_id
counts as id "" (a training text); equal rows are scored each; if there is no
training text every probability is uniform; extra columns are ignored.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, ascii_lower, mix, prepare, partitions, span_hash, staged, text_slices, texts, word_spans
from ..session import is_local, local_path, unique_path

SALT = 8
FLUSH_TOKENS = 3_000_000
WORD = np.ones(256, bool)
WORD[[9, 10, 11, 12, 13, 32]] = False
BEGIN, END = (int(x) for x in mix(np.array([1, 2], U64)))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, word before, document) of every token of a slice; each document
    ends with END, and BEGIN comes before its first token."""
    data = ascii_lower(data)
    start, end, doc = word_spans(data, offsets, WORD)
    docs = len(offsets) - 1
    to = np.cumsum(np.bincount(doc, minlength=docs) + 1)
    word = np.full(int(to[-1]) if docs else 0, END, U64)
    word[np.arange(len(doc)) + doc] = span_hash(data, start, end)
    before = np.full(len(word), BEGIN, U64)
    before[1:] = word[:-1]
    before[to[:-1]] = BEGIN
    return word, before, np.repeat(np.arange(docs), np.diff(np.r_[0, to]))


def bigram_key(before48: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(before48 * U64(0x9DDFEA08EB382D69) + word)


def bucket_of(before48: np.ndarray, word: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(before48 * U64(SALT) + word % U64(SALT)) % U64(n)).astype(np.int64)


def word_bucket(word48: np.ndarray, n: int) -> np.ndarray:
    return (mix(word48) % U64(n)).astype(np.int64)


def summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """(positions of one row of each distinct key, sums of the values by key)."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    return (order[first], *(np.add.reduceat(v[order], first) if len(k) else v for v in values))


# Rows between the steps: one blob of columns for each (task, bucket).



def pack(*columns: tuple[np.ndarray, int]) -> bytes:
    """Columns of (values, bytes kept), byte plane by byte plane, zstd."""
    import zstandard
    n = len(columns[0][0])
    planes = [v.astype("<u8").view(np.uint8).reshape(n, 8)[:, :k].T.tobytes() for v, k in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(blob: bytes, n: int, *sizes: int) -> list[np.ndarray]:
    import zstandard
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    out, at = [], 0
    for k in sizes:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :k] = raw[at:at + k * n].reshape(k, n).T
        out.append(wide.view("<u8").reshape(n))
        at += k * n
    return out


def width(values: np.ndarray) -> int:
    return max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1


def _write(path: str, arrays: dict[str, np.ndarray]) -> None:
    """One model file of the shared folder: whole or not there."""
    temporary = f"{path}.{uuid.uuid4().hex}"
    with open(temporary, "wb") as f:
        np.array([len(a) for a in arrays.values()], "<i8").tofile(f)
        for a in arrays.values():
            f.write(b"\0" * (-f.tell() % 8))
            a.tofile(f)
    os.replace(temporary, path)


def _map(path: str, kinds: tuple[str, ...]) -> list[np.ndarray]:
    """The arrays of a model file, memory-mapped; empty ones if it has no file."""
    if not os.path.exists(path):
        return [np.zeros(0, k) for k in kinds]
    raw = np.memmap(path, np.uint8, "r")
    sizes, at, out = raw[:8 * len(kinds)].view("<i8"), 8 * len(kinds), []
    for k, n in zip(kinds, sizes):
        at += -at % 8
        size = int(n) * np.dtype(k).itemsize
        out.append(raw[at:at + size].view(k))
        at += size
    return out


BIGRAM_FILE = ("<u8", "u1", "<i8", "<i8")  # keys, counts up to 255, places and counts of larger ones
WORD_FILE = ("<u8", "<u8", "<u8", "<u4", "<u4", "<u4")  # hash, count, contexts, followers seen 1, 2, 3+ times


def discounts(t: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts for counts 0, 1, 2, 3+ from the numbers
    of keys with counts 1 to 4; half a count where one of those is missing."""
    if min(t) == 0:
        return [0.0, 0.5, 0.5, 0.5]
    y = t[0] / (t[0] + 2 * t[1])
    raw = [k - (k + 1) * y * t[k] / t[k - 1] for k in (1, 2, 3)]
    return [0.0] + [min(max(d, 0.01), k) for k, d in zip((1, 2, 3), raw)]


class Model:
    """A trained model: its folder and the few totals of the corpus."""

    def __init__(self, folder: str, buckets: int, totals: dict):
        self.folder, self.buckets, self.totals = folder, buckets, totals
        self.d2, self.d1 = discounts(totals["bigram_t"]), discounts(totals["cont_t"])
        #: What counts plus one are divided by in the base score.
        self.base_total = (totals["tokens"] + 1) * (totals["words"] + 1)

    def _of(self, kind: str, kinds: tuple[str, ...], bucket: np.ndarray):
        """For each bucket that occurs: its places in the query, its arrays."""
        order = np.argsort(bucket, kind="stable")
        at = np.flatnonzero(np.r_[True, np.diff(bucket[order]) > 0]) if len(order) else []
        for group in np.split(order, at[1:]) if len(order) else []:
            yield group, _mapped(f"{self.folder}/{kind}-{bucket[group[0]]:05d}", kinds)

    def bigrams(self, before48: np.ndarray, word: np.ndarray) -> np.ndarray:
        key, out = bigram_key(before48, word), np.zeros(len(word), np.int64)
        for at, (keys, count, big, big_count) in self._of("bigrams", BIGRAM_FILE,
                                                          bucket_of(before48, word, self.buckets)):
            if not len(keys):
                continue
            at = at[np.argsort(key[at])]
            place = np.minimum(np.searchsorted(keys, key[at]), len(keys) - 1)
            hit = keys[place] == key[at]
            c = count[place].astype(np.int64)
            large = np.flatnonzero(hit & (c == 255))
            if len(large):
                c[large] = big_count[np.searchsorted(big, place[large])]
            out[at] = np.where(hit, c, 0)
        return out

    def words(self, word48: np.ndarray, word: np.ndarray | None = None) -> np.ndarray:
        """Rows (count, contexts, n1, n2, n3) of words; zeros if not seen."""
        out = np.zeros((len(word48), 5), np.int64)
        for at, columns in self._of("words", WORD_FILE, word_bucket(word48, self.buckets)):
            keys = columns[0]
            if not len(keys):
                continue
            want = word48[at] << U64(16) if word is None else word[at]
            place = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            hit = (keys[place] >> U64(16) == word48[at]) if word is None else (keys[place] == want)
            for k, column in enumerate(columns[1:]):
                out[at, k] = np.where(hit, column[place], 0)
        return out

    def score(self, word: np.ndarray, before: np.ndarray):
        """(c of each token, log10 base probability, log10 probability)."""
        t = self.totals
        uniq, inverse = np.unique(word, return_inverse=True)
        row = self.words(uniq >> U64(16), uniq)
        c = row[:, 0]
        base = np.log10((c + 1) / self.base_total)
        uniform = 1.0 / (t["words"] + 1)
        if not t["tokens"]:
            return c[inverse], base[inverse], np.full(len(word), np.log10(uniform))
        d1, cont = np.array(self.d1), row[:, 1]
        spare = sum(d1[min(k, 3)] * n for k, n in zip((1, 2, 3), t["cont_n"])) / t["bigrams"]
        low = (cont - d1[np.minimum(cont, 3)]) / t["bigrams"] + spare * uniform
        u48 = before >> U64(16)
        ctx, ctx_inverse = np.unique(u48, return_inverse=True)
        h = self.words(ctx)
        total = np.where(ctx == U64(BEGIN >> 16), t["documents"], h[:, 0])
        follow = h[:, 2:].copy()
        follow[ctx == U64(BEGIN >> 16)] = t["begin_n"]
        d2 = np.array(self.d2)
        with np.errstate(divide="ignore", invalid="ignore"):
            back = np.where(total > 0, (follow * d2[1:]).sum(1) / total, 1.0)
        both, first, both_inverse = np.unique(bigram_key(u48, word), return_index=True, return_inverse=True)
        n = self.bigrams(u48[first], word[first])
        total_of = np.maximum(total[ctx_inverse[first]], 1)
        p = (n - d2[np.minimum(n, 3)]) / total_of + back[ctx_inverse[first]] * low[inverse[first]]
        return c[inverse], base[inverse], np.log10(p)[both_inverse]


_MAPPED: dict[str, list] = {}


def _mapped(path: str, kinds: tuple[str, ...]):
    if path not in _MAPPED:
        if len(_MAPPED) > 4096:
            _MAPPED.clear()
        _MAPPED[path] = _map(path, kinds)
    return _MAPPED[path]


def train(docs: DataFrame, name: str = "kneser-ney") -> Model:
    """Count the texts of `docs` (doc_id, text) and write the model files."""
    spark = docs.sparkSession
    prepare(spark)
    path = unique_path(spark, name)
    if not is_local(path):
        raise ValueError("scoring memory-maps the model: spark.checkpoint.dir must be a mounted folder")
    folder, n = local_path(path), partitions(spark)
    os.makedirs(folder, exist_ok=True)

    def count(batches):
        held, size = [], 0

        def flush():
            word, before = (np.concatenate(x) for x in zip(*held))
            before = before >> U64(16)
            at, c = summed(bigram_key(before, word), np.ones(len(word), np.int64))
            word, before = word[at], before[at]
            bucket = bucket_of(before, word, n)
            order = np.lexsort((before, bucket))
            bounds = np.searchsorted(bucket[order], np.arange(n + 1))
            for b in np.flatnonzero(np.diff(bounds)):
                i = order[bounds[b]:bounds[b + 1]]
                wide = width(c[i])
                yield {"bucket": int(b), "n": len(i), "wide": wide,
                       "blob": pack((before[i], 6), (word[i], 8), (c[i], wide))}

        for _, data, offsets in text_slices(batches):
            word, before, _ = tokens(data, offsets)
            held.append((word, before))
            size += len(word)
            if size >= FLUSH_TOKENS:
                yield _rows(flush())
                held, size = [], 0
        if size:
            yield _rows(flush())

    def _rows(rows):
        return pa.RecordBatch.from_pylist(list(rows), schema=_BLOBS)

    def merge(key, table):
        parts = [unpack(r["blob"], r["n"], 6, 8, r["wide"]) for r in table.select(["blob", "n", "wide"]).to_pylist()]
        before, word, c = (np.concatenate(x) for x in zip(*parts))
        at, c = summed(bigram_key(before, word), c.astype(np.int64))
        before, word = before[at], word[at]
        keys = bigram_key(before, word)  # ascending, as `summed` sorts by it
        big = np.flatnonzero(c >= 255)
        _write(f"{folder}/bigrams-{key[0].as_py():05d}", {
            "keys": keys, "count": np.minimum(c, 255).astype(np.uint8), "big": big, "big_count": c[big]})
        i, cw, cont = summed(word, c, np.ones(len(c), np.int64))
        j, *n123 = summed(before, *[(c == k if k < 3 else c >= 3).astype(np.int64) for k in (1, 2, 3)])
        wb, ub = word_bucket(word[i] >> U64(16), n), word_bucket(before[j], n)
        rows = []
        for kind, bucket, columns in ((0, wb, [word[i], cw, cont]), (1, ub, [before[j], *n123])):
            order = np.lexsort((columns[0], bucket))
            bounds = np.searchsorted(bucket[order], np.arange(n + 1))
            for b in np.flatnonzero(np.diff(bounds)):
                at = order[bounds[b]:bounds[b + 1]]
                wide = [width(col[at]) for col in columns[1:]]
                rows.append({"bucket": int(b), "kind": kind, "n": len(at), "wides": wide, "types": 0, "t": [],
                             "blob": pack((columns[0][at], 8), *zip((col[at] for col in columns[1:]), wide))})
        rows.append({"bucket": -1, "kind": 2, "n": 0, "wides": [], "types": len(keys),
                     "t": [int((c == k).sum()) for k in (1, 2, 3, 4)], "blob": b""})
        return pa.Table.from_pylist(rows, schema=_PARTS)

    def finish(key, table):
        if key[0].as_py() < 0:
            return pa.Table.from_pylist([], schema=_TOTALS)
        got = {0: [], 1: []}
        for r in table.select(["kind", "n", "wides", "blob"]).to_pylist():
            got[r["kind"]].append(unpack(r["blob"], r["n"], 8, *r["wides"]))
        word, c, cont = (np.concatenate(x) for x in zip(*got[0])) if got[0] else (np.zeros(0, U64),) * 3
        at, c, cont = summed(word, c.astype(np.int64), cont.astype(np.int64))
        keys, n123, begin = word[at], np.zeros((3, len(at)), np.int64), [0, 0, 0]
        if got[1]:
            u, *counts = (np.concatenate(x) for x in zip(*got[1]))
            i, *counts = summed(u, *(x.astype(np.int64) for x in counts))
            is_begin = u[i] == U64(BEGIN >> 16)
            begin = [int(x[is_begin].sum()) for x in counts]
            place = np.searchsorted(keys >> U64(16), u[i])
            ok = ~is_begin
            for k in range(3):
                n123[k, place[ok]] = counts[k][ok]
        if len(keys):
            _write(f"{folder}/words-{key[0].as_py():05d}", {
                "keys": keys, "c": c.astype("<u8"), "cont": cont.astype("<u8"),
                "n1": n123[0].astype("<u4"), "n2": n123[1].astype("<u4"), "n3": n123[2].astype("<u4")})
        return pa.Table.from_pylist([{
            "words": len(keys), "tokens": int(c.sum()), "documents": int(c[keys == U64(END)].sum()),
            "begin1": begin[0], "begin2": begin[1], "begin3": begin[2],
            "c1": int((cont == 1).sum()), "c2": int((cont == 2).sum()), "c3": int((cont == 3).sum()),
            "c4": int((cont == 4).sum()), "c3up": int((cont >= 3).sum())}], schema=_TOTALS)

    blobs = docs.select("doc_id", "text").mapInArrow(count, "bucket int, n int, wide int, blob binary")
    parts = staged(blobs.groupBy("bucket").applyInArrow(
        merge, "bucket int, kind int, n int, wides array<int>, types long, t array<long>, blob binary"), name + "-words")
    sums = parts.where("bucket < 0").agg(
        F.coalesce(F.sum("types"), F.lit(0)).alias("bigrams"),
        *[F.coalesce(F.sum(F.col("t")[k]), F.lit(0)).alias(f"t{k + 1}") for k in range(4)]).first()
    w = parts.where("bucket >= 0").groupBy("bucket").applyInArrow(finish, ", ".join(
        f"{f.name} long" for f in _TOTALS)).agg(*[F.coalesce(F.sum(f.name), F.lit(0)).alias(f.name)
                                                  for f in _TOTALS]).first()
    return Model(folder, n, {
        "tokens": w["tokens"], "words": w["words"], "documents": w["documents"], "bigrams": sums["bigrams"],
        "bigram_t": [sums[f"t{k}"] for k in (1, 2, 3, 4)], "cont_t": [w[f"c{k}"] for k in (1, 2, 3, 4)],
        "cont_n": [w["c1"], w["c2"], w["c3up"]], "begin_n": [w["begin1"], w["begin2"], w["begin3"]]})


_BLOBS = pa.schema([("bucket", pa.int32()), ("n", pa.int32()), ("wide", pa.int32()), ("blob", pa.binary())])
_PARTS = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("n", pa.int32()), ("wides", pa.list_(pa.int32())),
                    ("types", pa.int64()), ("t", pa.list_(pa.int64())), ("blob", pa.binary())])
_TOTALS = pa.schema([(c, pa.int64()) for c in ("words", "tokens", "documents", "begin1", "begin2", "begin3",
                                               "c1", "c2", "c3", "c4", "c3up")])


def held_out_column():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2


def score(docs: DataFrame, m: Model) -> DataFrame:
    """Per document: n_tokens, n_known, train_tokens, base_score, score."""
    prepare(docs.sparkSession)

    def run(batches):
        for doc_ids, data, offsets in text_slices(batches, 4 << 20):
            word, before, doc = tokens(data, offsets)
            c, base, p = m.score(word, before)
            k = len(doc_ids)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(list(doc_ids), pa.int64()),
                "n_tokens": np.bincount(doc, minlength=k).astype(np.int64),
                "n_known": np.bincount(doc, c > 0, k).astype(np.int64),
                "train_tokens": np.full(k, m.totals["tokens"], np.int64),
                "base_score": np.bincount(doc, base, k), "score": np.bincount(doc, p, k)})

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def train_and_score(docs: DataFrame, add_one: bool = False) -> DataFrame:
    """Train on the documents that are not held out and score all; with
    ``add_one`` the base score is the add-one estimate, whose probabilities
    (c + 1) / (N + V + 1) sum to one over the training words and an unknown one."""
    rows = texts(docs)
    m = train(rows.where(~held_out_column()))
    if add_one:
        m.base_total = m.totals["tokens"] + m.totals["words"] + 1
    return score(rows, m).select("doc_id", held_out_column().alias("held_out"), "n_tokens", "n_known",
                                 "train_tokens", "base_score", "score")
