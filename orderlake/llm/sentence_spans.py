"""Operator 2: substring dedup by sliding sentence spans.

A sentence ends with ".", "!" or "?" before white space, or with a line break;
it carries the white space after it.  From every sentence one span runs
forwards and one backwards: the shortest run of at least two sentences and
`least_words` words.  By default there is no such floor: the spans are all
runs of two sentences, which cover every run of several, as a run repeats
only where each of its pairs does.  With a floor each sentence of a longer
repeated passage lies in a span inside the passage.  Spans are hashed (64 bits, sentences lower-cased in ASCII and trimmed) and
aggregated over all documents; a span that also occurs in a document with a
smaller doc_id, or earlier in its own, is removed with all its sentences.

Edge cases: null and empty texts have no sentence; rows with equal doc_id are
one document for this purpose (none is earlier); null doc_ids come before all
others; a text with a single sentence is kept; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, ascii_lower, flat, mix, prepare, slices, span_hash, staged, texts

LEAST_WORDS = 0
NO_ID = -(1 << 63)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STOP = np.zeros(256, bool)
_STOP[[33, 46, 63]] = True


def sentences(data: np.ndarray, offsets: np.ndarray):
    """(start, trimmed end, words, document) of the sentences of a slice."""
    z = np.zeros(0, np.int64)
    if not len(data):
        return z, z, z, z
    space = _SPACE[data]
    head = np.zeros(len(data) + 1, bool)
    head[offsets] = True
    before = np.r_[True, space[:-1]] | head[:-1]
    word_start = np.flatnonzero(~space & before)
    if not len(word_start):
        return z, z, z, z
    after = np.r_[space[1:], True] | head[1:]
    word_end = np.flatnonzero(~space & after) + 1
    doc = np.searchsorted(offsets, word_start, "right") - 1
    lines = np.r_[0, np.cumsum(data == 10)]
    new = np.ones(len(word_start), bool)
    new[1:] = ((doc[1:] != doc[:-1]) | _STOP[data[word_end[:-1] - 1]]
               | (lines[word_start[1:]] > lines[word_end[:-1]]))
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(new)] - 1
    return word_start[first], word_end[last], last - first + 1, doc[first]


def spans(data: np.ndarray, offsets: np.ndarray, least_words: int = LEAST_WORDS):
    """(hash, first sentence, last sentence, document) of the spans of a slice,
    sentences numbered within the slice, and the sentences."""
    start, end, words, doc = found = sentences(data, offsets)
    n = len(start)
    z = np.zeros(0, np.int64)
    if n < 2:
        return (np.zeros(0, U64), z, z, z), found
    h = span_hash(ascii_lower(data), start, end)
    total = np.r_[0, np.cumsum(words)]
    i = np.arange(n)
    forward = np.maximum(np.searchsorted(total, total[:-1] + least_words) - 1, i + 1)
    backward = np.minimum(np.searchsorted(total, total[1:] - least_words, "right") - 1, i - 1)
    a, b = np.r_[i, backward], np.r_[forward, i]
    ok = (a >= 0) & (b < n)
    a, b = a[ok], b[ok]
    ok = (doc[a] == doc[b]) & (total[b + 1] - total[a] >= least_words)
    a, b = np.unique(np.stack([a[ok], b[ok]]), axis=1) if ok.any() else (z, z)
    base = U64(0x9DDFEA08EB382D69)
    with np.errstate(over="ignore"):
        up = np.multiply.accumulate(np.r_[U64(1), np.full(n, base)])
        down = np.multiply.accumulate(np.r_[U64(1), np.full(n, U64(pow(int(base), -1, 1 << 64)))])
        sums = np.r_[U64(0), np.cumsum(h * up[:n])]
        key = mix((sums[b + 1] - sums[a]) * down[a] + (b - a).astype(U64))
    return (key, a, b, doc[a]), found


def _emit(batches, least_words):
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        data, offsets = flat(batch.column("text"))
        for i, j in slices(offsets):
            (key, _, _, doc), _ = spans(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], least_words)
            # Each span once for a document; which sentences it has is found
            # again beside the text.
            _, at = np.unique(mix(key + mix(doc.astype(U64))), return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(key[at].view(np.int64)), pa.array(ids[i:j][doc[at]], pa.int64())],
                                             ["span", "doc_id"])


def _remove(batches, least_words):
    for batch in batches:
        ids = batch.column("doc_id")
        data, offsets = flat(batch.column("text"))
        repeats, at = flat(batch.column("repeated"))
        for i, j in slices(offsets):
            part, inner = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            (key, a, b, doc), (start, end, words, of) = spans(part, inner, least_words)
            rows = repeats[at[i]:at[j]].view(U64) if at[j] > at[i] else np.zeros(0, U64)
            row_doc = np.repeat(np.arange(j - i), np.diff(at[i:j + 1]) // 8)
            hit = np.isin(mix(key + mix(doc.astype(U64))), mix(rows + mix(row_doc.astype(U64))))
            # Later occurrences within the document (spans are in text order).
            _, first = np.unique(mix(key + mix(doc.astype(U64))), return_index=True)
            later = np.ones(len(key), bool)
            later[first] = False
            hit |= later
            cover = np.zeros(len(start) + 1, np.int64)
            np.add.at(cover, a[hit], 1)
            np.add.at(cover, b[hit] + 1, -1)
            gone = np.cumsum(cover)[:-1] > 0
            first_of = np.searchsorted(of, np.arange(j - i + 1))
            out = []
            for d in range(j - i):
                p, q = first_of[d], first_of[d + 1]
                if not gone[p:q].any():
                    out.append(part[inner[d]:inner[d + 1]].tobytes().decode())
                    continue
                edge = np.r_[start[p:q], inner[d + 1]]
                keep = [part[edge[k]:edge[k + 1]] for k in range(q - p) if not gone[p + k]]
                lead = part[inner[d]:edge[0]]
                out.append(np.concatenate([lead, *keep]).tobytes().decode() if keep else "")
            yield pa.RecordBatch.from_arrays([
                ids[i:j], pa.array(np.diff(first_of).astype(np.int64)),
                pa.array(np.bincount(of, gone, j - i).astype(np.int64)), pa.array(out, pa.string())],
                ["doc_id", "n_sentences", "n_removed", "text"])


def remove_repeated_spans(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Per document: doc_id, n_sentences, n_removed, text (what is left)."""
    prepare(docs.sparkSession)
    rows = texts(docs)
    found = rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text").mapInArrow(
        partial(_emit, least_words=least_words), "span long, doc_id long")
    first = (found.groupBy("span").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
             .where("first < last").select("span", "first"))
    repeated = (found.join(first, "span").where("doc_id > first").groupBy("doc_id")
                .agg(F.collect_set("span").alias("spans")))
    # As one binary value: eight bytes, little end first, for each span.
    packed = repeated.mapInArrow(_pack, "doc_id long, repeated binary")
    joined = rows.join(staged(packed, "repeated"), "doc_id", "left").select(
        "doc_id", "text", F.coalesce("repeated", F.lit(b"")).alias("repeated"))
    return joined.mapInArrow(partial(_remove, least_words=least_words), "doc_id long, n_sentences long, n_removed long, text string")


def _pack(batches):
    for batch in batches:
        column = batch.column("spans")
        values = column.flatten().to_numpy()
        cut = np.r_[0, np.cumsum(column.value_lengths().to_numpy())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([values[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
            ["doc_id", "repeated"])
