"""Operator 7: benchmark decontamination by greedy string tiling.

Seeds are runs of `least` words; an item of fewer words is tiled whole, its one
seed being all of it.  A bitmap of fixed size, filled from the
seeds of all test items, lets scanning tasks drop document seeds that no item
has; the rest meet the items in a join.  A pair of document and item whose
joined seeds could cover `coverage` of the item's words goes on to tiling:
repeatedly the longest non-overlapping common runs of unmarked words (found by
Karp-Rabin hashes) are marked, down to `least` words.  Marked words of the item
over its length are its coverage, so passages in another order count in full.

Only words under seeds that passed the bitmap travel (any common run of
`least` words lies under them), never the texts.

Edge cases: a text or item without any word (null, empty) gives no match; an
item shorter than `least` words matches where all its words follow one another;
equal items tie to the smallest item_id; equal rows are judged each; an empty
table on either side gives clean documents or no rows; extra columns are
ignored or, in `keep_clean`, passed through, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (SHINGLE_WORD, U64, flat, mix, prepare, ranges, row_name, shingles, slices, spare_column, span_hash,
                     staged, texts, word_spans)

LEAST = 5
COVERAGE = 0.5
BITMAP_BITS = 22  # 512 KB, whatever the number of items


def lower_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of the words of lower-cased texts."""
    start, end, doc = word_spans(data, offsets, SHINGLE_WORD)
    return span_hash(data, start, end), doc


def _seeds(benchmark: DataFrame, least: int) -> DataFrame:
    """item_id, n_words, least (words a match has), words, seeds of each item."""
    def run(batches):
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            word, doc = lower_words(data, offsets)
            n = len(offsets) - 1
            words = np.bincount(doc, minlength=n)
            at, seed = shingles(word, doc, least)
            for size in range(1, least):  # items that are one seed
                more, key = shingles(word, doc, size)
                short = words[doc[more]] == size
                at, seed = np.concatenate([at, more[short]]), np.concatenate([seed, key[short]])
            order = np.argsort(at, kind="stable")
            at, seed = at[order], seed[order]
            cut = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
            cut_seed = np.searchsorted(doc[at], np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("item_id"), pa.array(np.diff(cut).astype(np.int64)),
                pa.ListArray.from_arrays(cut, pa.array(word.view(np.int64))),
                pa.ListArray.from_arrays(cut_seed, pa.array(seed.view(np.int64)))],
                ["item_id", "n_words", "words", "seeds"])

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    found = items.mapInArrow(run, "item_id long, n_words long, words array<long>, seeds array<long>").where("n_words > 0")
    return staged(found.withColumn("least", F.least("n_words", F.lit(least).cast("long"))), "items")


def _bitmap(items: DataFrame) -> np.ndarray:
    """One bit for each seed hash that an item has: merged from the set places
    of each task, at most 2^BITMAP_BITS of them."""
    place = F.shiftrightunsigned(F.col("seed"), 64 - BITMAP_BITS)
    rows = items.select(F.explode("seeds").alias("seed")).select(place.alias("place")).distinct().toPandas()
    bits = np.zeros(1 << BITMAP_BITS, bool)
    bits[rows["place"].to_numpy(np.int64)] = True
    return np.packbits(bits)


def _marked(docs: DataFrame, bitmap: np.ndarray, sizes: list[int]) -> DataFrame:
    """row, doc_id, words (with 0 between runs), seeds of documents with a
    seed, of any of the sizes, that passes the bitmap. row tells repeated
    doc_ids apart."""
    def run(batches):
        for batch in batches:
            ids, rows = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
            data, offsets = flat(batch.column("text"))
            for i, j in slices(offsets):
                word, doc = lower_words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                # Words under the seeds; a 0 closes each run.
                under = np.zeros(len(word) + 1, np.int32)
                ats, seeds = [], []
                for size in sizes:
                    at, seed = shingles(word, doc, size)
                    place = seed >> U64(64 - BITMAP_BITS)
                    hit = (bitmap[place >> U64(3)] >> (U64(7) - (place & U64(7))).astype(np.uint8)) & 1 == 1
                    ats.append(at[hit])
                    seeds.append(seed[hit])
                    np.add.at(under, at[hit], 1)
                    np.add.at(under, at[hit] + size, -1)
                at, seed = np.concatenate(ats), np.concatenate(seeds)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, seed = at[order], seed[order]
                on = np.cumsum(under)[:-1] > 0
                last = on.copy()
                last[:-1] &= ~on[1:] | (doc[1:] != doc[:-1])
                where = np.flatnonzero(on)
                size = np.where(last[where], 2, 1)
                run_words = np.repeat(word[where], size)
                run_words[np.cumsum(size)[size == 2] - 1] = 0
                run_doc = np.repeat(doc[where], size)
                seed_doc = doc[at]
                for d in np.unique(seed_doc):
                    a, b = np.searchsorted(run_doc, [d, d + 1])
                    p, q = np.searchsorted(seed_doc, [d, d + 1])
                    yield pa.RecordBatch.from_pydict({
                        "row": [rows[i + d]], "doc_id": pa.array([ids[i + d]], pa.int64()),
                        "words": [run_words[a:b].view(np.int64)], "seeds": [np.unique(seed[p:q]).view(np.int64)]})

    rows = docs.select("row", "doc_id", F.lower("text").alias("text"))
    return rows.mapInArrow(run, "row long, doc_id long, words array<long>, seeds array<long>")


def tile(text: np.ndarray, item: np.ndarray, least: int) -> int:
    """Words of the item that greedy string tiling marks (0 in text: a break)."""
    text, item = text.copy(), item.copy()
    marked = 0
    # Marked or broken places never match: each gets a value of its own.
    fresh = iter(range(1, 1 << 62))
    text[text == 0] = np.array([next(fresh) for _ in range(int((text == 0).sum()))], text.dtype)
    size = min(len(item), len(text))
    while size >= least:
        # The longest common run of unmarked words: search by Karp-Rabin sums.
        low, high = least, size
        if not len(_common(text, item, least)):
            break
        while low < high:
            mid = (low + high + 1) // 2
            if len(_common(text, item, mid)):
                low = mid
            else:
                high = mid - 1
        size = low
        pairs = _common(text, item, size)
        used_text, used_item = np.zeros(len(text), bool), np.zeros(len(item), bool)
        for i, j in pairs:
            if not used_text[i:i + size].any() and not used_item[j:j + size].any():
                used_text[i:i + size] = used_item[j:j + size] = True
                marked += size
        for words, used in ((text, used_text), (item, used_item)):
            words[used] = np.array([next(fresh) for _ in range(int(used.sum()))], words.dtype)
    return marked


def _common(text: np.ndarray, item: np.ndarray, size: int) -> np.ndarray:
    """(place in text, place in item) of equal runs of `size` words, by the
    place in the item; the runs found by hash are compared word by word."""
    if min(len(text), len(item)) < size:
        return np.zeros((0, 2), np.int64)
    one = np.zeros(len(text), np.int64), np.zeros(len(item), np.int64)
    a, b = shingles(text, one[0], size)[1], shingles(item, one[1], size)[1]
    order = np.argsort(a, kind="stable")
    left, right = np.searchsorted(a[order], b, "left"), np.searchsorted(a[order], b, "right")
    n = right - left
    j = np.repeat(np.arange(len(b)), n)
    i = order[ranges(left, n)]
    same = np.ones(len(i), bool)
    for k in range(size):
        same &= text[i + k] == item[j + k]
    return np.stack([i[same], j[same]], 1)


def coverages(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """row, doc_id, item_id, covered, n_words for pairs that reach `coverage`.
    docs: row, doc_id, text."""
    prepare(docs.sparkSession)
    items = _seeds(benchmark, least)
    sizes = sorted(r[0] for r in items.select("least").distinct().collect()) or [least]  # `least` numbers at most
    marked = staged(_marked(docs, _bitmap(items), sizes), "marked")
    item_seeds = items.select("item_id", "n_words", "least", F.posexplode("seeds").alias("place", "seed"))
    # An item's words under the seeds it shares with the document: what tiling
    # can cover at most.
    shared = (marked.select("row", F.explode("seeds").alias("seed")).join(item_seeds, "seed")
              .groupBy("row", "item_id", "n_words", "least").agg(F.sort_array(F.collect_set("place")).alias("places")))
    reach = F.aggregate(F.sequence(F.lit(1), F.size("places") - 1),
                        F.col("least"), lambda s, i: s + F.least("least", (F.col("places")[i] - F.col("places")[i - 1]).cast("long")))
    reach = F.when(F.size("places") == 1, F.col("least")).otherwise(reach)
    pairs = (shared.where(reach >= F.col("n_words") * coverage).select("row", "item_id")
             .join(marked.select("row", "doc_id", "words"), "row")
             .join(items.select("item_id", "n_words", F.col("words").alias("item_words")), "item_id"))

    def run(batches):
        for batch in batches:
            covered = [tile(np.array(t, np.int64).view(U64), np.array(w, np.int64).view(U64), min(least, len(w)))
                       for t, w in zip(batch.column("words").to_pylist(), batch.column("item_words").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("item_id"), batch.column("n_words"),
                 pa.array(covered, pa.int64())], ["row", "doc_id", "item_id", "n_words", "covered"])

    return (pairs.select("row", "doc_id", "item_id", "n_words", "words", "item_words")
            .mapInArrow(run, "row long, doc_id long, item_id long, n_words long, covered long")
            .where(F.col("covered") >= F.col("n_words") * coverage))


def _numbered(docs: DataFrame) -> DataFrame:
    """Rows named by doc_id and text, so that repeated ids are told apart and
    equal rows share their verdict."""
    return texts(docs).withColumn("row", row_name("doc_id", "text"))


def contamination(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """Per document: doc_id, contaminated, item_id (best covered), covered,
    item_words, n_items."""
    rows = _numbered(docs)
    pairs = staged(coverages(rows, benchmark, least, coverage), "pairs")
    share = F.col("covered") / F.col("n_words")
    best = pairs.groupBy("row").agg(
        F.max(F.struct(share, (-F.col("item_id")).alias("item"), "covered", "n_words")).alias("best"),
        F.countDistinct("item_id").alias("n_items"))
    return (rows.select("row", "doc_id").join(best, "row", "left")
            .select("doc_id", F.col("best").isNotNull().alias("contaminated"), (-F.col("best.item")).alias("item_id"),
                    F.col("best.covered").alias("covered"), F.col("best.n_words").alias("item_words"),
                    F.coalesce("n_items", F.lit(0)).alias("n_items")))


def keep_clean(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """The documents that cover no item, with all their columns."""
    bad = staged(coverages(_numbered(docs), benchmark, least, coverage).select("row").distinct(), "contaminated")
    name = spare_column(docs, "name")
    key = row_name(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.withColumn(name, key).join(bad.withColumnRenamed("row", name), name, "left_anti").select(*docs.columns)
