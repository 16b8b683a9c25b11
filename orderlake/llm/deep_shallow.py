"""Operator 3: exact substring dedup by deep-shallow suffix sorting.

`deep_shallow_sort` orders suffixes by their first `length` bytes: a multikey
quicksort (three-way, on 8-byte characters, all groups of one depth at a time)
down to a shallow depth, then blind tries for the groups that are still equal.

`remove_repeats` removes every byte covered by a `length`-byte string that also
starts in a document with a smaller doc_id.  Documents are dealt into chunks,
ranges of doc_id, so "in a smaller doc_id" is "in an earlier chunk, or here".

1. Copies of a whole text are found by hash; only the first takes part.
2. Each window of `length` bytes names its anchor, the smallest hash of the
   GRAM-byte strings in it.  Neighbouring windows with one anchor are a run.
   A chunk sends each distinct anchor once, with a hash of the run's bytes;
   the owner of the anchor answers: nowhere else / the same run in an earlier
   chunk / the same run, here first / other runs.
3. Windows under anchors with other runs are suffixes to be sorted; each
   distinct one is sent once as a 96-bit fingerprint, and its owner answers
   whether an earlier chunk has it.  What the sort settles within the chunk,
   the bytes already covered and the windows still open, goes along as ranges,
   so that windows are found and sorted once.
4. Chunks mark the open windows by the answers and cut the covered bytes.

A chunk sends an anchor or string once however often it holds it, so a passage
that every document shares costs one entry for each chunk.  Answers come in
the order of the questions, two bits or less each.  The texts are shuffled
once; the three passes over them read the same exchange.

Edge cases: null and empty texts, and texts shorter than `length`, keep all
bytes; rows with equal doc_id are not earlier than each other, and copies are
told by doc_id and text, so another text of a reused doc_id is judged on its
own; a null doc_id is smaller than any other; an empty table gives an empty
result; extra columns are ignored.  Chunks are cut by bytes: a text weighs one
and one more for each UNIT_BYTES of it, so long texts of near ids are dealt into
several chunks.  A very long text is cut into blocks for hashing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, flat, mix, partitions, prepare, ranges, span_hash, texts

LENGTH = 50
GRAM = 24
CHUNK_BYTES = 4 << 20
UNIT_BYTES = 4 << 10
OWNER_BYTES = 32 << 20
BLOCK = 1 << 20
SHALLOW = 32
VARIED = (1 << 40) - 1
NO_ID = -(1 << 63)


# ---- deep-shallow sorting --------------------------------------------------

def _characters(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as one big-endian number."""
    out = np.zeros(len(at), U64)
    for k in range(8):
        out = (out << U64(8)) | text[at + k]
    return out


def deep_shallow_sort(text: np.ndarray, starts: np.ndarray, length: int = LENGTH,
                      shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(order, class): `starts[order]` ascends by text[s:s + length], and equal
    strings have equal class numbers (ascending in that order)."""
    n = len(starts)
    padded = np.concatenate([text, np.zeros(length + 8, np.uint8)])
    order = np.arange(n)
    new = np.zeros(n, bool)  # a new string begins at this place of the order
    if n:
        new[0] = True
    group = np.zeros(n, np.int64)  # of places that are still equal
    place = np.arange(n)
    shallow = min(shallow, length) // 8 * 8
    for depth in range(0, shallow, 8) if n else ():
        value = _characters(padded, starts[order[place]] + depth)
        place, group = _split(order, new, place, group, value)
        if not len(place):
            break
    if len(place):
        _blind_tries(padded, starts, order, new, place, group, shallow, length)
    return order, np.cumsum(new) - 1


def _split(order, new, place, group, value):
    """Three-way partition of every group by one character, again and again,
    until each group has one character; returns those of two or more."""
    done_place, done_group, serial = [], [], 0
    while len(place):
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        size = np.diff(np.r_[first, len(group)])
        pivot = np.repeat(value[first + size // 2], size)
        side = (value > pivot) * 2 + (value == pivot) * 1
        index = np.repeat(np.arange(len(first)), size)
        part = index * 3 + side
        move = np.argsort(part, kind="stable")
        order[place] = order[place[move]]
        value, part = value[move], part[move]
        head = np.r_[True, part[1:] != part[:-1]]
        new[place[head]] = True
        begin = np.flatnonzero(head)
        span = np.diff(np.r_[begin, len(part)])
        many = np.repeat(span > 1, span)
        equal = part % 3 == 1
        keep = many & equal
        done_place.append(place[keep])
        done_group.append(serial + part[keep])
        serial += 3 * len(first)
        keep = many & ~equal
        place, value, group = place[keep], value[keep], part[keep]
    place, group = np.concatenate(done_place), np.concatenate(done_group)
    back = np.argsort(place)
    return place[back], group[back]


class _BlindTrie:
    """Strings of one length; inner nodes keep a place and the byte there."""

    def __init__(self, first: bytes, item: int):
        self.root = [None, first, [item]]  # a leaf: no place, its string, its items

    def add(self, string: bytes, item: int) -> None:
        node = self.root
        while node[0] is not None:  # blind descent: only the branching bytes are read
            node = node[1].get(string[node[0]]) or next(iter(node[1].values()))
        other = node[1]
        if other == string:
            node[2].append(item)
            return
        lcp = next(k for k in range(len(string)) if string[k] != other[k])
        leaf = [None, string, [item]]
        parent, node = None, self.root
        while node[0] is not None and node[0] < lcp:
            parent, node = node, node[1][string[node[0]]]
        if node[0] == lcp:
            node[1][string[lcp]] = leaf
            return
        branch = [lcp, {other[lcp]: node, string[lcp]: leaf}]
        if parent is None:
            self.root = branch
        else:
            parent[1][string[parent[0]]] = branch

    def leaves(self):
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node[0] is None:
                yield node[2]
            else:
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]


def _blind_tries(padded, starts, order, new, place, group, depth, length) -> None:
    """Order the groups that share their first `depth` bytes."""
    at = starts[order[place]]
    tail = padded[(at[:, None] + np.arange(depth, length)[None, :])]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, len(group)])
    same = (tail == np.repeat(tail[first], size, axis=0)).all(1)
    open_groups = np.flatnonzero(~np.logical_and.reduceat(same, first))
    raw, width = tail.tobytes(), length - depth
    for g in open_groups:
        a, b = int(first[g]), int(first[g] + size[g])
        trie = _BlindTrie(raw[a * width:(a + 1) * width], a)
        for k in range(a + 1, b):
            trie.add(raw[k * width:(k + 1) * width], k)
        sorted_items, p = [], a
        for items in trie.leaves():
            new[place[p]] = True
            sorted_items += items
            p += len(items)
        order[place[a:b]] = order[place[np.array(sorted_items)]]


# ---- anchors ---------------------------------------------------------------

def window_runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(first start, last start, anchor hash, run hash, document) of the runs
    of windows with one anchor, window starts within one document."""
    out = []
    width = length - gram + 1
    short = np.minimum(np.diff(offsets), length - 1)
    fits = np.ones(len(data), bool)  # a window from here ends within the document
    fits[ranges(offsets[1:] - short, short)] = False
    for b in range(0, max(0, len(data) - length + 1), BLOCK):
        part = data[b:b + BLOCK + length - 1]
        h, n, base, kept = part.astype(U64) + U64(1), 1, U64(0x9E3779B97F4A7C15), {}
        with np.errstate(over="ignore"):
            kept[1], power = h, {1: base}
            while n * 2 <= gram:
                h = h[:-n] * power[n] + h[n:]
                power[2 * n] = power[n] * power[n]
                n *= 2
                if gram & n:
                    kept[n] = h
            rest = gram - n
            while rest:
                step = 1 << (rest.bit_length() - 1)
                m = len(part) - n - step + 1
                h = h[:m] * power[step] + kept[step][n:n + m]
                n, rest = n + step, rest - step
        h = mix(h)
        at = np.arange(len(h), dtype=U64)
        low = (h & U64((1 << 64) - (1 << 21))) | at  # a tie goes to the left
        n = 1
        while n * 2 <= width:
            low, n = np.minimum(low[:-n], low[n:]), n * 2
        if n < width:
            low = np.minimum(low[:len(low) - (width - n)], low[width - n:])
        anchor = (low & U64((1 << 21) - 1)).astype(np.int64)
        s = np.flatnonzero(fits[b:b + len(anchor)])
        if not len(s):
            continue
        a = anchor[s]
        # An anchor lies within its window, so within one document.
        head = np.r_[True, (a[1:] != a[:-1]) | (s[1:] != s[:-1] + 1)]
        i = np.flatnonzero(head)
        lo, hi = s[i], s[np.r_[i[1:], len(s)] - 1]
        run = mix(span_hash(part, lo, hi + length) + (a[i] - lo).astype(U64))
        out.append((lo + b, hi + b, h[a[i]], run))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z.astype(U64), z.astype(U64), z
    lo, hi, key, run = (np.concatenate(x) for x in zip(*out))
    return lo, hi, key, run, np.searchsorted(offsets, lo, "right") - 1


# ---- questions and answers -------------------------------------------------

def _pack(*columns: np.ndarray) -> bytes:
    """The low bytes of 64-bit columns [(values, bytes)], plane by plane."""
    return b"".join(v.astype("<u8").view(np.uint8).reshape(len(v), 8)[:, :k].T.tobytes() for v, k in columns)


def _unpack(raw: bytes, *sizes: int) -> list[np.ndarray]:
    planes = np.frombuffer(raw, np.uint8)
    n, at, out = len(planes) // sum(sizes), 0, []
    for k in sizes:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :k] = planes[at:at + k * n].reshape(k, n).T
        out.append(wide.view("<u8").reshape(n))
        at += k * n
    return out


_QUESTION = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("raw", pa.binary())])
_ANSWER = pa.schema([("chunk", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("raw", pa.binary())])
QUESTION, ANSWER = "bucket int, chunk int, raw binary", "chunk int, kind int, bucket int, raw binary"
COPIES, CODES, EARLIER, SETTLED = 0, 1, 2, 3


def _by_bucket(chunk: int, bucket: np.ndarray, buckets: int, columns) -> pa.Table:
    """One question row for each bucket; rows ascend by bucket already."""
    cut = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = [{"bucket": b, "chunk": chunk, "raw": _pack(*((v[cut[b]:cut[b + 1]], k) for v, k in columns))}
            for b in np.flatnonzero(np.diff(cut)).tolist()]
    return pa.Table.from_pylist(rows, schema=_QUESTION)


def _owner(kind: int, sizes: tuple[int, ...], answer):
    """The task that owns a bucket: all questions sorted by key and chunk."""
    def run(key, table):
        if key[0].as_py() < 0:  # no questions, but what a chunk tells itself
            return pa.Table.from_pylist([{**r, "kind": SETTLED} for r in table.to_pylist()], schema=_ANSWER)
        rows = sorted(table.select(["chunk", "raw"]).to_pylist(), key=lambda r: r["chunk"])
        parts = [_unpack(r["raw"], *sizes) for r in rows]
        n = [len(p[0]) for p in parts]
        columns = [np.concatenate(x) for x in zip(*parts)]
        order = np.lexsort(columns[::-1]) if kind == EARLIER else np.argsort(columns[0], kind="stable")
        sorted_columns = [c[order] for c in columns]
        out = np.zeros(sum(n), np.uint8)
        out[order] = answer(sorted_columns)
        cut = np.r_[0, np.cumsum(n)]
        return pa.Table.from_pylist([{"chunk": r["chunk"], "kind": kind, "bucket": key[0].as_py(),
                                      "raw": np.packbits(np.stack([out[a:b] & 1, out[a:b] >> 1])).tobytes()}
                                     for r, a, b in zip(rows, cut[:-1], cut[1:])], schema=_ANSWER)
    return run


def _codes(columns):
    """0: nowhere else, 1: same run in an earlier chunk, 2: same run, here
    first, 3: other runs."""
    key, run = columns
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, len(key)])
    same = (np.minimum.reduceat(run, first) == np.maximum.reduceat(run, first)) & (run[first] != U64(VARIED))
    out = np.repeat(np.where(size == 1, 0, np.where(same, 1, 3)), size).astype(np.uint8)
    out[first[(size > 1) & same]] = 2
    return out


def _earlier(columns):
    a, b = columns
    return np.r_[False, (a[1:] == a[:-1]) & (b[1:] == b[:-1])].astype(np.uint8)


def _bits(raw: bytes, n: int) -> np.ndarray:
    bit = np.unpackbits(np.frombuffer(raw, np.uint8), count=2 * n).reshape(2, n)
    return bit[0] | bit[1] << 1


def _short_name(text: bytes) -> int:
    """The first 15 hexadecimal digits of the MD5, as Spark's conv gives them."""
    return int(hashlib.md5(text).hexdigest()[:15], 16)


def _edges(mask: np.ndarray) -> np.ndarray:
    """Start, end, start, end, ... of the ranges where the mask is true."""
    return np.flatnonzero(np.diff(np.r_[False, mask, False]))


def _marks(data: np.ndarray, starts: np.ndarray, buckets: int):
    """Distinct 96-bit fingerprints of the windows, ascending: (bucket, first
    64 bits, last 32 bits, number of the fingerprint of each window)."""
    a, b = span_hash_blocks(data, starts, LENGTH)
    b >>= U64(32)
    order = np.argsort(a)
    x, y = a[order], b[order]
    if ((x[1:] == x[:-1]) & (y[1:] != y[:-1])).any():
        order = np.lexsort((b, a))
        x, y = a[order], b[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    of = np.empty(len(x), np.int64)
    of[order] = np.cumsum(new) - 1
    x, y = x[new], y[new]
    return ((x >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64), x, y, of


class _Chunk:
    """The texts of a chunk that take part, and all answers."""

    def __init__(self, docs: pa.Table, answers: pa.Table, buckets: int):
        self.buckets = buckets
        self.answers = {}
        copies = set()  # (doc_id, start of the MD5) of the rows that take no part
        for r in answers.select(["kind", "bucket", "raw"]).to_pylist():
            if r["kind"] == COPIES:
                copies.update(map(tuple, np.frombuffer(r["raw"], "<i8").reshape(-1, 2).tolist()))
            elif r["kind"] == SETTLED:
                self.settled = r["raw"]
            else:
                self.answers[r["kind"], r["bucket"]] = r["raw"]
        docs = docs.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        ids = docs.column("doc_id").to_numpy()
        self.all_ids, self.text = ids, docs.column("text")
        self.is_copy = np.zeros(len(ids), bool)
        if copies:
            for k in np.flatnonzero(np.isin(ids, np.array([i for i, _ in copies], np.int64))).tolist():
                self.is_copy[k] = (int(ids[k]), _short_name(self.text[k].as_py())) in copies
        mine = np.flatnonzero(~self.is_copy)
        self.ids = ids[mine]
        self.data, self.offsets = flat(self.text.take(pa.array(mine)).combine_chunks())

    def find_runs(self) -> None:
        """The runs of windows and their distinct anchors."""
        self.lo, self.hi, key, run, self.doc = window_runs(self.data, self.offsets)
        bucket = key % U64(self.buckets)
        place = (bucket << U64(40)) | (key >> U64(24))
        self.anchor, self.of = np.unique(place, return_inverse=True)
        run = run >> U64(25)  # below VARIED
        order = np.argsort(self.of, kind="stable")
        first = np.searchsorted(self.of[order], np.arange(len(self.anchor)))
        if len(first):
            low, high = (f.reduceat(run[order], first) for f in (np.minimum, np.maximum))
            self.least = np.minimum.reduceat(self.ids[self.doc[order]], first)
            self.most = np.maximum.reduceat(self.ids[self.doc[order]], first)
        else:
            low = high = run
            self.least = self.most = np.zeros(0, np.int64)
        self.varied, self.run = low != high, np.where(low != high, U64(VARIED), low)

    def questions(self, chunk: int) -> pa.Table:
        self.find_runs()
        return _by_bucket(chunk, (self.anchor >> U64(40)).astype(np.int64), self.buckets,
                          [(self.anchor & U64(VARIED), 5), (self.run, 5)])

    def _answered(self, kind: int, bucket: np.ndarray) -> np.ndarray:
        cut = np.searchsorted(bucket, np.arange(self.buckets + 1))
        out = np.zeros(len(bucket), np.uint8)
        for b in np.flatnonzero(np.diff(cut)).tolist():
            if (kind, b) in self.answers:
                out[cut[b]:cut[b + 1]] = _bits(self.answers[kind, b], int(cut[b + 1] - cut[b]))
        return out

    def sort_windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Sort the windows under anchors with several runs.  Returns the bytes
        known to be covered, and the first starts of the windows that an
        earlier chunk may have, each as a mask over the bytes."""
        self.find_runs()
        codes = self._answered(CODES, (self.anchor >> U64(40)).astype(np.int64))
        abroad = codes == 3
        local = self.varied & (codes != 1)
        runs = np.flatnonzero((abroad | (local & (self.least < self.most)))[self.of])
        size = self.hi[runs] - self.lo[runs] + 1
        starts = ranges(self.lo[runs], size)
        win_ids, is_abroad = np.repeat(self.ids[self.doc[runs]], size), np.repeat(abroad[self.of[runs]], size)
        order, cls = deep_shallow_sort(self.data, starts)
        starts, win_ids = starts[order], win_ids[order]
        cover = np.zeros(len(self.data) + 1, np.int32)
        still = np.zeros(len(self.data), bool)
        if len(cls):
            first = np.flatnonzero(np.r_[True, cls[1:] != cls[:-1]])
            late = win_ids > np.minimum.reduceat(win_ids, first)[cls]
            still[starts[~late & np.logical_or.reduceat(is_abroad[order], first)[cls]]] = True
            np.add.at(cover, starts[late], 1)
            np.add.at(cover, starts[late] + LENGTH, -1)
        # Runs that are the same everywhere need no sorting.
        same = ~abroad & ~local
        gone = same[self.of] & ((codes[self.of] == 1) | (self.ids[self.doc] > self.least[self.of]))
        np.add.at(cover, self.lo[gone], 1)
        np.add.at(cover, self.hi[gone] + LENGTH, -1)
        return np.cumsum(cover)[:-1] > 0, still

    def fingerprints(self, chunk: int) -> pa.Table:
        covered, still = self.sort_windows()
        bucket, mark, mark2, _ = _marks(self.data, np.flatnonzero(still), self.buckets)
        covered, still = _edges(covered), _edges(still)
        own = {"bucket": -1 - chunk, "chunk": chunk, "raw": _pack((np.r_[len(covered), covered, still], 5))}
        return pa.concat_tables([_by_bucket(chunk, bucket, self.buckets, [(mark, 8), (mark2, 4)]),
                                 pa.Table.from_pylist([own], schema=_QUESTION)])

    def result(self) -> pa.Table:
        edges = _unpack(self.settled, 5)[0].astype(np.int64)
        covered, still = edges[1:edges[0] + 1], edges[edges[0] + 1:]
        starts = ranges(still[::2], still[1::2] - still[::2])
        bucket, _, _, of = _marks(self.data, starts, self.buckets)
        early = self._answered(EARLIER, bucket) & 1 == 1
        s = starts[early[of]]
        cover = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(cover, covered[::2], 1)
        np.add.at(cover, covered[1::2], -1)
        np.add.at(cover, s, 1)
        np.add.at(cover, s + LENGTH, -1)
        removed = np.cumsum(cover)[:-1] > 0
        sums = np.r_[0, np.cumsum(removed)]
        head = removed.copy()
        head[1:] &= ~removed[:-1]
        edge = self.offsets[:-1][np.diff(self.offsets) > 0]
        head[edge] = removed[edge]
        heads = np.r_[0, np.cumsum(head)]
        out, mine, raw = [], 0, self.text
        for k, doc in enumerate(self.all_ids.tolist()):
            doc = None if doc == NO_ID else doc
            if self.is_copy[k]:
                text = raw[k].as_py()
                n = len(text) if len(text) >= LENGTH else 0
                out.append((doc, len(text), n, int(n > 0), hashlib.sha256(b"" if n else text).hexdigest()))
                continue
            a, b = self.offsets[mine], self.offsets[mine + 1]
            kept = self.data[a:b][~removed[a:b]]
            out.append((doc, int(b - a), int(sums[b] - sums[a]), int(heads[b] - heads[a]),
                        hashlib.sha256(kept.tobytes()).hexdigest()))
            mine += 1
        columns = list(zip(*out)) if out else [[]] * 5
        return pa.table([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.string()])],
                        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def span_hash_blocks(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the strings of `length` bytes from `starts`."""
    half, n = length // 2, len(starts)
    middle = starts + half
    both = span_hash(data, np.r_[starts, middle], np.r_[middle, starts + length])
    a, b = both[:n], both[n:]
    with np.errstate(over="ignore"):
        return mix(a * U64(0x9DDFEA08EB382D69) + b), mix(mix(a ^ U64(0xD6E8FEB86659FD93)) * U64(0xC2B2AE3D27D4EB4F) + mix(b))


# ---- the Spark jobs --------------------------------------------------------

def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spark = docs.sparkSession
    prepare(spark)
    rows = texts(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.col("text").cast("binary").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(partitions(spark), -(-size // CHUNK_BYTES))
    at = [k / chunks for k in range(1, chunks)]
    units = rows.select("doc_id", F.explode(F.sequence(F.lit(0), F.floor(F.octet_length("text") / UNIT_BYTES).cast("int"))))
    cuts = units.agg(F.percentile_approx("doc_id", at, 20 * chunks)).first()[0] or []
    splits = [-float("inf"), *(sorted({float(c) + 0.5 for c in cuts}) or [-1e300]), float("inf")]
    rows = Bucketizer(splits=splits, inputCol="number", outputCol="part").transform(
        rows.withColumn("number", F.col("doc_id").cast("double")))
    rows = rows.select(F.col("part").cast("int").alias("chunk"), "doc_id", "text")
    # An owner task holds the questions on OWNER_BYTES of text, whatever the input.
    buckets = max(min(partitions(spark), len(splits) - 1), -(-size // OWNER_BYTES))

    # Copies of a whole text: only the rows of its smallest doc_id take part.
    names = rows.select("chunk", "doc_id", F.md5("text").alias("name"), F.xxhash64("text").alias("hash"))
    first = names.groupBy("name", "hash").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = (names.join(first, ["name", "hash"]).where("doc_id > first").groupBy("chunk")
              .agg(F.collect_set(F.struct("doc_id", F.conv(F.substring("name", 1, 15), 16, 10).cast("long"))).alias("ids")))
    copies = copies.mapInArrow(_pack_ids, ANSWER)

    def ask(key, left, right):
        return _Chunk(left, right, buckets).questions(key[0].as_py())

    def ask_windows(key, left, right):
        return _Chunk(left, right, buckets).fingerprints(key[0].as_py())

    def finish(key, left, right):
        return _Chunk(left, right, buckets).result()

    def both(right, f, schema):
        def run(key, left, right):
            if not left.num_rows:
                return _EMPTY[schema]
            return f(key, left, right)
        return rows.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(run, schema)

    codes = both(copies, ask, QUESTION).groupBy("bucket").applyInArrow(_owner(CODES, (5, 5), _codes), ANSWER)
    known = copies.unionByName(codes)
    early = both(known, ask_windows, QUESTION).groupBy("bucket").applyInArrow(_owner(EARLIER, (8, 4), _earlier), ANSWER)
    return both(copies.unionByName(early), finish, RESULT)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_EMPTY = {QUESTION: pa.Table.from_pylist([], schema=_QUESTION),
          RESULT: pa.Table.from_pylist([], schema=pa.schema(
              [(c, pa.int64()) for c in ("doc_id", "n_bytes", "n_removed", "n_spans")] + [("kept_sha256", pa.string())]))}


def _pack_ids(batches):
    for batch in batches:
        yield pa.RecordBatch.from_pylist(
            [{"chunk": c, "kind": COPIES, "bucket": -1, "raw": np.array([tuple(i.values()) for i in ids], "<i8").tobytes()}
             for c, ids in zip(batch.column("chunk").to_pylist(), batch.column("ids").to_pylist())], schema=_ANSWER)
