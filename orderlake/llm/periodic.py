"""Operator 13: periodic runs of words, found by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and a length of at least `least_words` and `least_periods` * q
that no neighbouring word extends.  So every word of a run occurs at least
`least_periods` times in it.  A word that occurs less often within a segment
can join no run there: it splits the segment, and the parts are counted anew,
until no segment has such a word.  Segments too short for a run go.

What survives is scanned lag by lag.  A run of period q holds two neighbouring
blocks of q words that begin at multiples of q (counted from the segment's
start) and are equal, as its words agree q apart over 2 * q words at least.
So a segment of m words needs m / q comparisons of block hashes for lag q,
m * log(m) for all lags.  Blocks that repeat a shorter period are left out
(that lag has them); the others are extended to both sides by binary search
over hashed prefixes.  Every run found is compared word by word; if hashes
ever lied, the segment is scanned without them.

A document is read whole by one task and meets no other, so there is no
shuffle; documents are handled in slices of about 1 MB (a longer document is a
slice of its own).

Edge cases: null and empty texts and texts of white space have no words and no
run; rows with equal or null doc_ids are documents of their own; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from fractions import Fraction
from itertools import chain, compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, flat, mix, prepare, ranges, slices, texts

LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Comparisons held in memory at once by the lag scan.
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15


def split_segments(ids: np.ndarray, start: np.ndarray, end: np.ndarray, least_words: int = LEAST_WORDS,
                   least_periods: int = LEAST_PERIODS) -> tuple[np.ndarray, np.ndarray]:
    """The parts of the segments [start, end) in which every word occurs at
    least `least_periods` times.  Each round counts only segments that the
    round before changed."""
    done: list[tuple[np.ndarray, np.ndarray]] = []
    n_ids = int(ids.max()) + 1 if len(ids) else 1
    while True:
        long = end - start >= least_words
        start, end = start[long], end[long]
        if not len(start):
            break
        size = end - start
        segment = np.repeat(np.arange(len(start)), size)
        at = ranges(start, size)
        _, inverse, times = np.unique(segment * n_ids + ids[at], return_inverse=True, return_counts=True)
        rare = times[inverse] < least_periods
        changed = np.bincount(segment, rare, len(start)) > 0
        done.append((start[~changed], end[~changed]))
        live = changed[segment]
        at, segment, rare = at[live], segment[live], rare[live]
        if not len(at):
            break
        # Maximal stretches without a rare word inside one segment.
        fresh = np.r_[True, segment[1:] != segment[:-1]]
        first = ~rare & (fresh | np.r_[True, rare[:-1]])
        last = ~rare & (np.r_[fresh[1:], True] | np.r_[rare[1:], True])
        start, end = at[first], at[last] + 1
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(a)
    return a[order], b[order]


class _Hashed:
    """Prefix hashes of a word sequence, and powers of their base."""

    def __init__(self, ids: np.ndarray):
        with np.errstate(over="ignore"):
            self.power = np.full(len(ids) + 1, _BASE, U64)
            self.power[0] = 1
            self.power = np.multiply.accumulate(self.power)
            self.prefix = np.zeros(len(ids) + 1, U64)
            np.cumsum(mix(ids.astype(U64) + U64(1)) * self.power[:-1], out=self.prefix[1:])

    def same(self, at: np.ndarray, lag: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether [at, at + size) equals the words `lag` further right."""
        p = self.prefix
        with np.errstate(over="ignore"):
            return (p[at + size] - p[at]) * self.power[lag] == p[at + lag + size] - p[at + lag]


def _reach(low: np.ndarray, high: np.ndarray, holds) -> np.ndarray:
    """For each row the largest value in [low, high] for which `holds`, which
    is true at `low` and never true again once it is false."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_] + 1) >> 1
        ok = holds(open_, middle)
        low[open_[ok]] = middle[ok]
        high[open_[~ok]] = middle[~ok] - 1


def _prime_factors(top: int) -> list[np.ndarray]:
    """Arrays f with f[q] a prime factor of q (or 1): all those of q <= top."""
    small = np.ones(top + 1, np.int64)
    for p in range(2, int(top ** 0.5) + 1):
        if small[p] == 1:
            at = np.arange(p * p, top + 1, p)
            at = at[small[at] == 1]
            small[at] = p
    small[2:] = np.where(small[2:] == 1, np.arange(2, top + 1), small[2:]) if top >= 2 else small[2:]
    out, rest = [], np.arange(top + 1)
    while (factor := np.where(rest > 1, small[np.maximum(rest, 0)], 1)).max() > 1:
        out.append(factor)
        rest = rest // factor
    return out


def lag_scan(ids: np.ndarray, start: np.ndarray, end: np.ndarray, least_words: int = LEAST_WORDS,
             least_periods: int = LEAST_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs inside the segments [start, end)."""
    if least_periods < 3:
        raise ValueError("a run is found by two equal blocks at multiples of its period: least_periods must be 3 or more")
    lags = (end - start) // least_periods
    z = np.zeros(0, np.int64)
    if not len(start) or not lags.max():
        return z, z, z
    words = _Hashed(ids)
    factors = _prime_factors(int(lags.max()))
    segment = np.repeat(np.arange(len(start)), lags)
    lag = ranges(np.ones(len(start), np.int64), lags)
    blocks = (end - start)[segment] // lag - 1
    bounds = np.r_[0, np.cumsum(blocks)]
    hits = []
    at = 0
    while at < len(lag):
        to = max(int(np.searchsorted(bounds, bounds[at] + CHUNK, "right")) - 1, at + 1)
        row = np.repeat(np.arange(at, to), blocks[at:to])
        x = start[segment[row]] + ranges(np.zeros(to - at, np.int64), blocks[at:to]) * lag[row]
        ok = words.same(x, lag[row], lag[row])
        row, x = row[ok], x[ok]
        for factor in factors:
            f = factor[lag[row]]
            part = lag[row] // f
            shorter = (f > 1) & words.same(x, part, 2 * lag[row] - part)
            row, x = row[~shorter], x[~shorter]
        # Blocks that follow each other lie in one run: the first stands for them.
        head = np.r_[True, (row[1:] != row[:-1]) | (x[1:] != x[:-1] + lag[row[1:]])] if len(row) else np.zeros(0, bool)
        hits.append((segment[row[head]], lag[row[head]], x[head]))
        at = to
    segment, lag, x = (np.concatenate(h) for h in zip(*hits))
    right = _reach(lag, end[segment] - lag - x, lambda i, size: words.same(x[i], lag[i], size))
    left = _reach(np.zeros(len(x), np.int64), x - start[segment],
                  lambda i, size: words.same(x[i] - size, lag[i], size))
    a, b = x - left, x + right + lag
    ok = b - a >= np.maximum(least_words, least_periods * lag)
    # One row for a stretch: that of its smallest period.
    order = np.lexsort((lag[ok], b[ok], a[ok]))
    a, b, lag, segment = (v[ok][order] for v in (a, b, lag, segment))
    once = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
    a, b, lag, segment = a[once], b[once], lag[once], segment[once]
    wrong = np.unique(segment[~_holds(ids, a, b, lag)])
    if len(wrong):
        right_ones = ~np.isin(segment, wrong)
        plain = [_plain_scan(ids, int(start[s]), int(end[s]), least_words, least_periods) for s in wrong]
        a, b, lag = (np.concatenate([v[right_ones], *p]) for v, p in zip((a, b, lag), zip(*plain)))
    order = np.lexsort((lag, a))
    return a[order], b[order], lag[order]


def _holds(ids: np.ndarray, a: np.ndarray, b: np.ndarray, lag: np.ndarray) -> np.ndarray:
    """Whether the words of each run agree `lag` apart, compared one by one."""
    out = np.ones(len(a), bool)
    bounds = np.r_[0, np.cumsum(b - a - lag)]
    at = 0
    while at < len(a):
        to = max(int(np.searchsorted(bounds, bounds[at] + CHUNK, "right")) - 1, at + 1)
        size = (b - a - lag)[at:to]
        x = ranges(a[at:to], size)
        row = np.repeat(np.arange(at, to), size)
        out[row[ids[x] != ids[x + lag[row]]]] = False
        at = to
    return out


def _plain_scan(ids: np.ndarray, start: int, end: int, least_words: int, least_periods: int):
    """`lag_scan` of one segment without hashes."""
    found: dict[tuple[int, int], int] = {}
    for lag in range(1, (end - start) // least_periods + 1):
        same = np.r_[False, ids[start:end - lag] == ids[start + lag:end], False]
        edge = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edge[::2], edge[1::2] + lag):
            if b - a >= max(least_words, least_periods * lag):
                found.setdefault((start + int(a), start + int(b)), lag)
    rows = np.array([(a, b, q) for (a, b), q in found.items()], np.int64).reshape(-1, 3)
    return rows[:, 0], rows[:, 1], rows[:, 2]


def find_runs(ids: np.ndarray, offsets: np.ndarray, least_words: int = LEAST_WORDS,
              least_periods: int = LEAST_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of the documents ids[offsets[i]:offsets[i + 1]]."""
    offsets = np.asarray(offsets, np.int64)
    segments = split_segments(ids, offsets[:-1], offsets[1:], least_words, least_periods)
    return lag_scan(ids, *segments, least_words, least_periods)


RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _collapse(least_words: int, least_periods: int):
    def run(batches):
        for batch in batches:
            doc_ids = batch.column("doc_id")
            data, offsets = flat(batch.column("text"))
            for i, j in slices(offsets):
                # bytes.split() cuts at the six ASCII white-space characters.
                words = [data[offsets[d]:offsets[d + 1]].tobytes().split() for d in range(i, j)]
                cut = np.r_[0, np.cumsum([len(w) for w in words])].astype(np.int64)
                number: dict[bytes, int] = defaultdict(count().__next__)
                ids = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, cut[-1])
                a, b, lag = find_runs(ids, cut, least_words, least_periods)
                cover = np.zeros(cut[-1] + 1, np.int64)
                np.add.at(cover, a + lag, 1)
                np.add.at(cover, b, -1)
                keep = np.cumsum(cover)[:-1] == 0
                of = np.searchsorted(a, cut)
                left = [b" ".join(compress(words[d], keep[cut[d]:cut[d + 1]])).decode() for d in range(j - i)]
                doc = np.repeat(np.arange(j - i), np.diff(of))
                values = pa.StructArray.from_arrays(
                    [pa.array(a - cut[doc]), pa.array(b - a), pa.array(lag)], fields=list(_RUN))
                yield pa.RecordBatch.from_arrays(
                    [doc_ids[i:j], pa.array(np.diff(cut)),
                     pa.ListArray.from_arrays(pa.array(of.astype(np.int32)), values), pa.array(left, pa.string())],
                    ["doc_id", "n_words", "runs", "text"])
    return run


def collapse_runs(docs: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """Per document: doc_id, n_words, its runs by start, then period, and the
    text in which each run is its first period (words joined by one space)."""
    prepare(docs.sparkSession)
    return texts(docs).mapInArrow(_collapse(least_words, least_periods),
                                  f"doc_id long, n_words long, runs {RUNS}, text string")


def run_digests(collapsed: DataFrame) -> DataFrame:
    """Of each document its number of runs, the run repeated most often (exact
    length / period; ties: smallest start, then period) and digests."""
    def run(batches):
        for batch in batches:
            rows = []
            for d in batch.to_pylist():
                runs = [(r["start"], r["length"], r["period"]) for r in d["runs"]]
                lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
                rows.append({
                    "doc_id": d["doc_id"], "n_runs": len(runs), "start": top[0], "length": top[1], "period": top[2],
                    "exponent_milli": 1000 * top[1] // top[2] if runs else None,
                    "runs_sha256": hashlib.sha256(lines.encode()).hexdigest(),
                    "collapsed_sha256": hashlib.sha256(d["text"].encode()).hexdigest()})
            yield pa.RecordBatch.from_pylist(rows, schema=_DIGESTS)

    return collapsed.mapInArrow(run, "doc_id long, n_runs long, start long, length long, period long, "
                                     "exponent_milli long, runs_sha256 string, collapsed_sha256 string")


_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                      ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()),
                      ("collapsed_sha256", pa.string())])


def with_planted_loops(docs: DataFrame) -> DataFrame:
    """The documents with a loop planted in one of ten: with h = crc32 of the
    decimal doc_id and g = h / 10, a document of n words whose h ends in 0
    repeats, from word a = g % n on, its 1 + (n - a) / (3 + g % 8) words there."""
    rows = texts(docs)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def looped(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        places = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.array_join(F.transform(places, lambda i: F.get(
            w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    # The words of a document are cut once, in a column of their own.
    cut = rows.withColumn("words", F.when((h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), words))
    return cut.select("doc_id", F.when(F.col("words").isNull(), F.col("text"))
                      .otherwise(looped(F.col("words"))).alias("text"))
