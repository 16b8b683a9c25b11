"""Operator 5: quality by importance resampling.

Two hashed n-gram models (words and marks, single and in pairs) are fitted on
labelled rows: target text is what the labels accept (quality 1, not toxic),
raw text is all of it.  Both count in how many documents an n-gram occurs once
or more, twice or more, 3, 5, 9, ... times or more.  The pairs of a word said
twice are one n-gram, whose count is that of the longest run, which does not
grow with the length of the text.  A document's log weight is the sum of
log(target / raw) over its n-grams, each at the highest level its count
reaches on which the two models clearly differ; n-grams with no such level (a
ratio within e^2, or less than `deviations` standard errors) count as equal.  Documents are sampled by Gumbel top-k: the
key is log weight / temperature + a Gumbel value drawn from the doc_id, k is
the number of documents whose log weight reaches `reject_below`.

Fitting uses at most `sample_rows` labelled rows (those with the smallest
hash of doc_id), and of labelled near copies (same smallest or largest
five-word shingle) only one, so that one text can't pass for a frequent word;
the sample, its ids and the model are bounded by that parameter.  Weights,
k and the k-th key are computed over all documents.

Edge cases: a null or empty text has log weight 0; a null doc_id draws one
fixed Gumbel value; rows tied with the k-th key are all selected; without
labelled rows on both sides every weight is 0 and all rows are selected; an
empty table gives an empty result; columns are passed through unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (SHINGLE_WORD, U64, ascii_lower, flat, mix, prepare, shingles, slices, spare_column, span_hash, staged,
                     text_slices, texts, word_spans)

SAMPLE_ROWS = 20_000
DEVIATIONS = 4.5
LEAST_RATIO = 2.0
REJECT_BELOW = -2.0
TEMPERATURE = 0.1
WEIGHT = "log_weight__"
TWICE = U64(1)  # a word said twice, whichever it is

_CLASS = np.zeros(256, np.uint8)  # 1: word bytes, 2: ASCII marks
_CLASS[33:127] = 2
_CLASS[SHINGLE_WORD] = 1


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, n-gram of the slice, level hash) of each level that the count
    of an n-gram in its document reaches, by n-gram and level, and two
    signatures of each document: its smallest and largest five-word shingle
    (0: shorter)."""
    data = ascii_lower(data)
    docs = len(offsets) - 1
    kind = _CLASS[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = kind[1:] != kind[:-1]
    start, end, doc = word_spans(data, offsets, _CLASS > 0, cut)
    word = span_hash(data, start, end)
    at, pair = shingles(word, doc, 2)
    pair = np.where(word[at] == word[at + 1], TWICE, pair)
    key, of = np.concatenate([word, pair]), np.concatenate([doc, doc[at]])
    _, first, n = np.unique(mix(key + mix(of.astype(U64))), return_index=True, return_counts=True)
    key, of = key[first], of[first]
    # Doubled words grow with the length of a text, the longest run of one does not.
    once = key != TWICE
    runs = np.flatnonzero(np.r_[True, (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])]) if len(word) else doc
    longest = np.zeros(docs, np.int64)
    np.maximum.at(longest, doc[runs], np.diff(np.r_[runs, len(word)]))
    long = np.flatnonzero(longest > 1)
    key, of = np.r_[key[once], np.full(len(long), TWICE)], np.r_[of[once], long]
    n = np.r_[n[once], longest[long] - 1]
    levels = np.ceil(np.log2(n)).astype(np.int64) + 1
    gram = np.repeat(np.arange(len(key)), levels)
    level = np.arange(len(gram)) - np.repeat(np.cumsum(levels) - levels, levels)
    reached = np.where(level > 0, mix(key[gram] + mix(level.astype(U64))), key[gram])
    signature = np.zeros((2, docs), U64)
    at5, five = shingles(word, doc, 5)
    if len(at5):
        of5 = doc[at5]
        begin = np.flatnonzero(np.r_[True, of5[1:] != of5[:-1]])
        signature[0, of5[begin]] = np.minimum.reduceat(five, begin)
        signature[1, of5[begin]] = np.maximum.reduceat(five, begin)
    return of[gram], gram, reached, signature


class Model:
    """N-grams that differ (hashes ascending) and their log ratios."""

    def __init__(self, keys: np.ndarray, ratio: np.ndarray):
        self.keys, self.ratio = keys, ratio

    def weights(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        doc, gram, key, _ = grams(data, offsets)
        out = np.zeros(len(offsets) - 1)
        if len(self.keys) and len(key):
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = np.flatnonzero(self.keys[at] == key)
            hit = hit[np.r_[gram[hit][1:] != gram[hit][:-1], np.ones(min(1, len(hit)), bool)]]  # the highest level
            out += np.bincount(doc[hit], self.ratio[at[hit]], len(out))
        return out


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS,
        deviations: float = DEVIATIONS, least_ratio: float = LEAST_RATIO) -> Model:
    """labels: doc_id, quality, toxic (a null in either: not accepted)."""
    prepare(docs.sparkSession)
    accepted = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
    sample = (labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(accepted.cast("int")).alias("accept"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    # At most sample_rows pairs of numbers: a bound that does not follow the data.
    known = staged(texts(docs).join(F.broadcast(sample), "doc_id"), "labelled")

    def sign(batches):
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            got = [grams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])[3] for i, j in slices(offsets)]
            low, high = np.concatenate(got, axis=1) if got else np.zeros((2, 0), U64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(low.view(np.int64)),
                                              pa.array(high.view(np.int64))], ["doc_id", "low", "high"])

    signed = staged(known.mapInArrow(sign, "doc_id long, low long, high long").where("low != 0"), "signatures")
    for side in ("low", "high"):
        signed = signed.join(signed.groupBy(side).agg(F.min("doc_id").alias(f"{side}_first")), side)
    keep = signed.where("doc_id = low_first and doc_id = high_first").select("doc_id").distinct()

    def count(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            accept = batch.column("accept").to_numpy(zero_copy_only=False)
            for i, j in slices(offsets):
                doc, _, key, _ = grams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                held.append((key, accept[i:j][doc].astype(np.int64)))
        if held:
            key, yes = (np.concatenate(x) for x in zip(*held))
            uniq, inverse, n = np.unique(key, return_inverse=True, return_counts=True)
            good = np.bincount(inverse, yes, len(uniq)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(uniq.view(np.int64)), pa.array(good), pa.array(n)],
                                             ["gram", "good", "n"])

    chosen = known.join(F.broadcast(keep), "doc_id").select("accept", "text")
    size = known.join(F.broadcast(keep), "doc_id").agg(F.sum("accept").alias("good"), F.count("*").alias("n")).first()
    if not size["n"] or size["good"] in (0, size["n"]):
        return Model(np.zeros(0, U64), np.zeros(0))
    share = size["good"] / size["n"]
    expected = F.col("n") * F.lit(share)
    ratio = F.log((F.col("good") + 0.5 * share) / (expected + 0.5 * share))
    error = F.sqrt(expected * F.lit(1 - share) + 0.25)
    rows = (chosen.mapInArrow(count, "gram long, good long, n long").groupBy("gram")
            .agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
            .select("gram", ratio.alias("ratio"), (F.abs(F.col("good") - expected) / error).alias("z"))
            .where((F.abs("ratio") >= least_ratio) & (F.col("z") >= deviations)).toPandas())
    keys = rows["gram"].to_numpy(np.int64).view(U64)
    order = np.argsort(keys)
    return Model(keys[order], rows["ratio"].to_numpy(float)[order])


def weighted(docs: DataFrame, model: Model, text_col: str = "text", weight: str = WEIGHT) -> DataFrame:
    """The documents, all columns, and their weight under the name given."""
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            text = pa.compute.fill_null(batch.column(text_col).cast(pa.string()), "")
            data, offsets = flat(text)
            got = [model.weights(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                   for i, j in slices(offsets)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(got) if got else np.zeros(0))],
                names=[*batch.schema.names, weight])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(weight, T.DoubleType())]))


def gumbel_key(doc_id="doc_id", temperature: float = TEMPERATURE, seed: int = 5, weight: str = WEIGHT):
    """log weight / temperature + Gumbel value of the doc_id."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.col(doc_id), F.lit(seed)), 11) + 0.5) * F.lit(2.0 ** -53)
    return F.col(weight) / temperature - F.log(-F.log(uniform))


def kth_largest(values: DataFrame, column: str, k: int, cells: int = 1024) -> float:
    """The k-th largest value: histograms of ever smaller ranges, each one job
    over all rows that returns at most `cells` counts."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    while low is not None and low < high:
        width = (high - low) / cells
        if low + width == low or high - width == high:
            break
        cell = F.least(F.floor((F.col(column) - low) / width), F.lit(cells - 1))
        rows = (values.where(F.col(column).between(low, high)).groupBy(cell.alias("cell"))
                .agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect())
        for r in sorted(rows, key=lambda r: -r["cell"]):
            if k <= r["n"]:
                low, high = r["low"], r["high"]
                break
            k -= r["n"]
    return low


def select_documents(docs: DataFrame, labels: DataFrame, reject_below: float = REJECT_BELOW,
                     temperature: float = TEMPERATURE) -> DataFrame:
    """doc_id, log_weight, gumbel_key, selected for every document."""
    model = fit(docs, labels)
    rows = staged(weighted(texts(docs), model).select("doc_id", F.col(WEIGHT).alias("log_weight"),
                                                     gumbel_key(temperature=temperature).alias("gumbel_key")), "weights")
    k = rows.where(F.col("log_weight") >= reject_below).count()
    least = kth_largest(rows, "gumbel_key", k) if k else None
    return rows.withColumn("selected", F.col("gumbel_key") >= least if k else F.lit(False))


def keep_selected(docs: DataFrame, labels: DataFrame, reject_below: float = REJECT_BELOW,
                  temperature: float = TEMPERATURE) -> DataFrame:
    """The selected documents with all their columns. The weights are computed
    a second time beside the texts, which costs less than a join with them."""
    model = fit(docs, labels)
    keys = weighted(docs.select("doc_id", "text"), model)
    keys = staged(keys.select(F.col(WEIGHT), gumbel_key(temperature=temperature).alias("key")), "weights")
    k = keys.where(F.col(WEIGHT) >= reject_below).count()
    if not k:
        return docs.limit(0)
    least = kth_largest(keys, "key", k)
    name = spare_column(docs, WEIGHT)
    return (weighted(docs, model, weight=name).where(gumbel_key(temperature=temperature, weight=name) >= least)
            .select(*docs.columns))
