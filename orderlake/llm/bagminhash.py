"""Operator 4: near duplicates by BagMinHash, banding and exact verification.

A document is the multiset of its five-word shingles.  Every distinct shingle
owns one Poisson process for each dyadic block of its count, (0, 1], (1, 2],
(2, 4], ...: points come in the order of time with rate SLOTS x block width,
each with a random slot and a random level in the block, all drawn from the
shingle's hash.  A document sees a point if its count reaches the point's
level.  The first seen time of each slot is the signature: two documents agree
in a slot with the probability of their weighted Jaccard similarity.  Processes
stop at the latest first time of the document, so nearly all shingles draw one
or two numbers.

Equal shingle multisets are one class with one representative.  Signatures are
cut into BANDS of ROWS slots; with 40 bands of 5 a pair of similarity 0.8 has
no band in common once in ten million.  In each band every member is compared
with one centre (linear in the size of a group, whatever it is); bands choose
their centres by eight different orders, so that copies of a common text that
are too far from one of them meet another.  Verified pairs join classes.

Members of one band that are still in several classes are compared within their
band where their lengths and signatures allow the threshold, in rounds.  The
first round takes the first EARLY bands, which join most of a group, the second
the others; both tell a forest over the classes: fewer pairs than classes, not
one for each two members.  The pairs are verified and join classes.  A task whose
pairs all hold is done, since its candidates lie inside classes then; one with a
pair that fails is looked at again without it, now by the overlap of the shingle
hashes of its members, and with the best few candidates of each two classes,
GROWTH times as many in each round, until none fails: no candidate between two
classes is left out.  A large group is dealt into blocks,
and each pair of blocks is a task of its own, so no task holds a whole group.  A
pair counts only if the overlap of the two multisets reaches the threshold.

Edge cases: documents of fewer than five words are one shingle of all their
words; those without any word (null, empty) are equal to each other only; ties
go to the smallest doc_id; a row is named by a 64-bit hash of its doc_id and text,
so different texts under one doc_id are documents of their own, and rows that
repeat both are one; a null doc_id is dropped from the result, as it cannot name
a class, and stays in `keep_one`; an empty table gives an empty result; extra
columns are ignored or, in `keep_one`, passed through, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, flat, mix, prepare, row_name, shingles, slices, spare_column, staged, texts
from .tiling import lower_words

SHINGLE = 5
BANDS, ROWS = 40, 5
SLOTS = BANDS * ROWS
THRESHOLD = 0.8
LEAST_AGREEMENT = 0.68  # of slots; at similarity 0.8 less has probability 2e-5
CELLS = 2048  # of the counts that bound the overlap of two documents from above
EARLY = 4  # bands of the first round
KEYS = 4096  # shingles of a text whose hashes go along in the later rounds; longer ones go without
GROWTH = 8  # times as many candidates of two classes in each further round
TASK = ["band", "hash", "low", "high"]  # two blocks of a group
BLOCK = 2000  # members of a group that one task holds twice at most
CENTRES = 8  # orders of the documents; each band takes its smallest member by one of them


def multiset(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle hash, count), by document and hash, of lower-cased texts."""
    word, doc = lower_words(data, offsets)
    at, key = shingles(word, doc, SHINGLE)
    of = doc[at]
    n = np.bincount(doc, minlength=len(offsets) - 1)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        first = np.cumsum(n) - n
        with np.errstate(over="ignore"):
            extra = [mix(np.array([np.bitwise_xor.reduce(mix(word[first[d]:first[d] + n[d]] + mix(np.arange(n[d], dtype=U64))))
                                   + U64(n[d])]))[0] for d in short]
        of, key = np.concatenate([of, short]), np.concatenate([key, np.array(extra, U64)])
    order = np.lexsort((key, of))
    of, key = of[order], key[order]
    first = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (key[1:] != key[:-1])]) if len(of) else np.zeros(0, int)
    return of[first], key[first], np.diff(np.r_[first, len(of)])


def signatures(doc: np.ndarray, key: np.ndarray, count: np.ndarray, docs: int, slots: int = SLOTS) -> np.ndarray:
    """First seen times (docs x slots) of the documents' multisets."""
    out = np.full((docs, slots), np.inf)
    if not len(doc):
        return out
    # One process for each block (2^(b-1), 2^b] that a count reaches into.
    blocks = np.ceil(np.log2(count)).astype(np.int64) + 1
    of = np.repeat(np.arange(len(doc)), blocks)
    block = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    width = np.where(block == 0, 1.0, 2.0 ** (block - 1))
    low = np.where(block == 0, 0.0, width)
    seed, d, level = mix(key[of] + mix(block.astype(U64))), doc[of], count[of]
    time, last = np.zeros(len(of)), np.full(docs, np.inf)
    step = 0
    while len(d):
        with np.errstate(over="ignore"):
            draw = mix(seed + U64(step) * U64(0x9E3779B97F4A7C15))
        time = time + -np.log(((draw >> U64(11)).astype(float) + 0.5) * 2.0 ** -53) / (width * slots)
        alive = time < last[d]
        seed, d, level, time, width, low, draw = (x[alive] for x in (seed, d, level, time, width, low, draw))
        if not len(d):
            break
        more = mix(draw + U64(0xD6E8FEB86659FD93))
        slot = ((more >> U64(32)) % U64(slots)).astype(np.int64)
        seen = low + width * ((more & U64(0xFFFFFFFF)).astype(float) + 0.5) * 2.0 ** -32 <= level
        # The smallest time of each (document, slot): sort and take the first.
        place = (d * slots + slot)[seen]
        order = np.argsort(time[seen], kind="stable")[::-1]
        flat_out = out.reshape(-1)
        best = np.full(0, 0.0)
        p, t = place[order], time[seen][order]
        better = t < flat_out[p]
        flat_out[p[better]] = t[better]  # ascending times are written last
        step += 1
        if step % 4 == 0 or step < 12:
            last = out.max(1)
    return out


def cells(doc: np.ndarray, key: np.ndarray, count: np.ndarray, docs: int) -> np.ndarray:
    """Shingle counts by CELLS classes of the hash, one byte each; a document
    with a larger count has 255 everywhere, which bounds nothing beside a
    document of smaller counts; two such documents are not tested by it."""
    out = np.bincount(doc * CELLS + (key % U64(CELLS)).astype(np.int64), count, docs * CELLS).reshape(docs, CELLS)
    out[out.max(1) >= 255] = 255
    return out.astype(np.uint8)


def _scan(docs: DataFrame) -> DataFrame:
    """doc_id, own_id, size, set hash, bands, signature, cells of each row."""
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            data, offsets = flat(batch.column("text"))
            for i, j in slices(offsets):
                n = j - i
                doc, key, count = multiset(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                size = np.bincount(doc, count, n).astype(np.int64)
                whole = np.zeros((n, 2), U64)
                with np.errstate(over="ignore"):
                    for k in (0, 1):
                        np.add.at(whole[:, k], doc, mix(mix(key + U64(k)) * count.astype(U64)))
                sign = (signatures(doc, key, count, n).view(U64) >> U64(20)).astype(np.uint32)
                with np.errstate(over="ignore"):
                    band = np.zeros((n, BANDS), U64)
                    for r in range(ROWS):
                        band = mix(band * U64(31) + sign[:, r::ROWS])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids[i:j], pa.int64()), "own_id": batch.column("own_id")[i:j], "size": size,
                    "set_a": whole[:, 0].view(np.int64), "set_b": whole[:, 1].view(np.int64),
                    "bands": pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * BANDS,
                                                      pa.array(band.reshape(-1).view(np.int64))),
                    "signature": [s.tobytes() for s in sign],
                    "cells": [c.tobytes() for c in cells(doc, key, count, n)]})

    rows = docs.select("doc_id", "own_id", F.lower("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, own_id long, size long, set_a long, set_b long, bands array<long>, signature binary, cells binary")


def _verified(pairs: DataFrame, text: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of the distinct pairs whose multisets overlap enough. text: doc_id
    (unique), text in lower case."""
    both = (pairs.join(text.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
            .join(text.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b"))

    def run(batches):
        for batch in batches:
            data_a, at_a = flat(batch.column("text_a"))
            data_b, at_b = flat(batch.column("text_b"))
            ok = np.zeros(batch.num_rows, bool)
            for i, j in slices(at_a + at_b):
                da, ka, ca = multiset(data_a[at_a[i]:at_a[j]], at_a[i:j + 1] - at_a[i])
                db, kb, cb = multiset(data_b[at_b[i]:at_b[j]], at_b[i:j + 1] - at_b[i])
                n = j - i
                with np.errstate(over="ignore"):
                    xa, xb = mix(ka + mix(da.astype(U64))), mix(kb + mix(db.astype(U64)))
                order = np.argsort(xb)
                at = np.minimum(np.searchsorted(xb[order], xa), max(0, len(xb) - 1))
                hit = (xb[order][at] == xa) if len(xb) else np.zeros(len(xa), bool)
                both_n = np.bincount(da[hit], np.minimum(ca[hit], cb[order][at[hit]]), n) if hit.any() else np.zeros(n)
                total = np.bincount(da, ca, n) + np.bincount(db, cb, n) - both_n
                ok[i:j] = both_n >= threshold * total - 1e-9
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(doc_id, class_id) of linked documents but those that name their class;
    class_id is the smallest id.

    Alternates two steps: each node hands the smallest of its neighbours to all
    its larger ones, then to all its smaller ones, until only stars are left:
    each node points to one other, which points nowhere."""
    edges = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    while True:
        ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up")).unionByName(edges.select(F.col("b").alias("n"), F.lit(0).alias("up")))
        chained = ends.groupBy("n").agg(F.sum("up").alias("up"), F.count("*").alias("k")).where("up > 1 or (up = 1 and k > 1)")
        if chained.count() == 0:
            return edges.select(F.col("a").alias("doc_id"), F.col("b").alias("class_id"))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Larger neighbours of each node go to its smallest neighbour.
        large = staged(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .where("a <> b").distinct(), "large-star")
        # Smaller neighbours of each node, and the node, go to the smallest.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = staged(small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .unionByName(small.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "small-star")


def _forest(cls, size, block, sign, cell, band, one_block, threshold, known=None, most=1, keys=None):
    """Candidate pairs (places in the arrays, sorted by size): such that they
    join all classes which any candidate joins, each member with its best in
    every class that it is not joined to yet; or, if `known` has pairs (place x
    members + place) that are no links, the best `most` others of each two classes."""
    n, root = len(cls), np.unique(cls, return_inverse=True)[1]
    full = (cell == 255).all(1)  # their counts do not fit: two of those have no bound
    out, marks = [np.zeros((0, 2), np.int64)], [np.zeros(0)]
    for i in range(n - 1):
        j = int(np.searchsorted(size, size[i] / threshold + 1e-9, "right"))
        other = np.arange(i + 1, j)
        other = other[(root[other] != root[i]) & (one_block | (block[other] != block[i]))]
        if not len(other):
            continue
        same = sign[other] == sign[i]
        agree = same.mean(1)
        near = agree >= LEAST_AGREEMENT
        other, agree, same = other[near], agree[near], same[near]
        # A pair belongs to the first band that it shares.
        least = threshold / (1 + threshold) * (size[i] + size[other]) - 1e-6
        bound = np.minimum(cell[other], cell[i]).sum(1, dtype=np.int64)
        near = ((bound >= least) | (full[other] & full[i])) & (same.reshape(len(other), BANDS, ROWS).all(2).argmax(1) == band)
        other, agree = other[near], agree[near]
        if keys is not None and len(other) and len(keys[i]):
            # No more hashes in common than these: an upper bound again.
            length = np.array([len(keys[k]) for k in other])
            theirs = np.concatenate([keys[k] for k in other])
            at = np.minimum(np.searchsorted(keys[i], theirs), len(keys[i]) - 1)
            hits = np.bincount(np.repeat(np.arange(len(other)), length), keys[i][at] == theirs, len(other))
            near = (length == 0) | (hits >= threshold / (1 + threshold) * (size[i] + size[other]) - 1e-6)
            other, agree = other[near], agree[near]
        if not len(other):
            continue
        if known is None:
            order = np.argsort(-agree, kind="stable")
            best = order[np.unique(root[other[order]], return_index=True)[1]]
            other, agree = other[best], agree[best]
            root[np.isin(root, root[other])] = root[i]
        out.append(np.stack([np.full(len(other), i), other], 1))
        marks.append(agree)
    pairs, agree = np.concatenate(out), np.concatenate(marks)
    if known is None or not len(pairs):
        return pairs
    new = ~np.isin(pairs[:, 0] * n + pairs[:, 1], known)
    pairs, agree = pairs[new], agree[new]
    ends = np.sort(root[pairs], 1)
    order = np.lexsort((-agree, ends[:, 1], ends[:, 0]))
    ends = ends[order]
    first = np.flatnonzero(np.r_[True, (ends[1:] != ends[:-1]).any(1)]) if len(ends) else np.zeros(0, int)
    rank = np.arange(len(ends)) - np.repeat(first, np.diff(np.r_[first, len(ends)]))
    return pairs[order[rank < most]]


def _dealt(members: DataFrame) -> DataFrame:
    """Each member once for every pair of its block with a block of its group."""
    blocks = F.ceil(F.col("n") / BLOCK)
    return (members.withColumn("block", F.pmod(F.xxhash64("doc_id"), blocks))
            .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
            .withColumn("low", F.least("block", "with")).withColumn("high", F.greatest("block", "with")).drop("n", "with"))


def _apart(members: DataFrame, threshold: float, failed: DataFrame | None = None, most: int = 1,
          tasks: DataFrame | None = None) -> DataFrame:
    """(task, a, b): candidate pairs of one band whose classes differ and whose
    lengths and signatures allow the threshold: a forest over the classes, or in
    tasks with failed pairs the best `most` of each two classes. members: band, hash, n (members of the
    group), doc_id, class_id, size, signature, cells (their common counts are at
    least the overlap). failed: (task, a, b) that are no links;
    tasks: those to look at (None: all)."""
    def run(key, table, without):
        if not table.num_rows:
            return pa.table({**{k: pa.array([], v.type) for k, v in zip(TASK, key)},
                             "a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        rows = table.to_pandas().sort_values(["size", "doc_id"])
        doc, cls, size, block = (rows[c].to_numpy(np.int64) for c in ("doc_id", "class_id", "size", "block"))
        sign = np.frombuffer(b"".join(rows["signature"]), np.uint32).reshape(len(rows), SLOTS)
        cell = np.frombuffer(b"".join(rows["cells"]), np.uint8).reshape(len(rows), CELLS)
        place = dict(zip(doc.tolist(), range(len(doc))))
        known = np.array([min(x, y) * len(doc) + max(x, y) for a, b in zip(without.column("a").to_pylist(), without.column("b").to_pylist())
                          for x, y in [(place[a], place[b])]], np.int64)
        band, low, high = (key[k].as_py() for k in (0, 2, 3))
        keys = [np.frombuffer(k, np.uint32) for k in rows["keys"]] if "keys" in rows else None
        told = _forest(cls, size, block, sign, cell, band, low == high, threshold, known if len(known) else None, most, keys)
        ends = doc[told]
        return pa.table({**{k: pa.array([v.as_py()] * len(told), v.type) for k, v in zip(TASK, key)},
                         "a": ends.min(1, initial=np.iinfo(np.int64).max), "b": ends.max(1, initial=np.iinfo(np.int64).min)})

    if failed is None:
        failed = members.sparkSession.range(0).selectExpr("int(id) band", "id hash", "id low", "id high", "id a", "id b")
    dealt = _dealt(members) if tasks is None else _dealt(members).join(tasks, TASK, "left_semi")
    return dealt.groupBy(*TASK).cogroup(failed.groupBy(*TASK)).applyInArrow(
        run, "band int, hash long, low long, high long, a long, b long")


def _keys(rows: DataFrame) -> DataFrame:
    """doc_id, keys: 32-bit hashes, ascending, of the shingles, each with its
    number among equal ones; none for texts of more than KEYS shingles."""
    def run(batches):
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            out = []
            for i, j in slices(offsets):
                doc, key, count = multiset(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                of = np.repeat(np.arange(len(doc)), count)
                number = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                with np.errstate(over="ignore"):
                    each = (mix(key[of] + mix(number.astype(U64))) >> U64(32)).astype(np.uint32)
                cut = np.searchsorted(doc[of], np.arange(j - i + 1))
                out += [np.sort(each[a:b]).tobytes() if b - a <= KEYS else b"" for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "keys"])

    return rows.select("doc_id", "text").mapInArrow(run, "doc_id long, keys binary")


def _picked(rows: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """One row of each of some documents, written: later steps shuffle these and
    not the whole table. The join is a merge at every size, and its order serves
    to drop rows that repeat doc_id and text, which have one name."""
    return staged(rows.join(ids.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id"]), name)


def _named(docs: DataFrame) -> DataFrame:
    """(doc_id, own_id, text): rows named by their own doc_id and text."""
    return texts(docs).where("doc_id is not null").select(row_name("doc_id", "text").alias("doc_id"),
                                                          F.col("doc_id").alias("own_id"), "text")


def _classes(rows: DataFrame, threshold: float) -> DataFrame:
    """Per row of _named: doc_id, own_id, size, class (name of one member),
    verified_links (of its representative)."""
    spark = rows.sparkSession
    prepare(spark)
    signed = staged(_scan(rows), "signatures")
    same = ["size", "set_a", "set_b"]
    first = signed.groupBy(*same).agg(F.min("doc_id").alias("rep"))
    member = staged(signed.select("doc_id", "own_id", *same).join(first, same).select("doc_id", "own_id", "size", "rep"), "members")
    reps = staged(member.where("doc_id = rep").groupBy("doc_id").agg(F.max("size").alias("size")), "representatives")
    bands = _picked(signed.select("doc_id", "bands"), reps.where("size > 0").select("doc_id"), "bands")

    banded = bands.select("doc_id", F.posexplode("bands").alias("band", "hash"))
    # An order of the names for each eighth of the bands: the smallest name
    # after flipping some of its bits.
    order = F.shiftrightunsigned(F.xxhash64(F.col("band") % CENTRES), 2)
    groups = (banded.groupBy("band", "hash").agg(F.min(F.col("doc_id").bitwiseXOR(order)).alias("a"), F.count("*").alias("n"))
              .where("n > 1").select("band", "hash", F.col("a").bitwiseXOR(order).alias("a")))
    groups = staged(groups, "groups")
    in_group = staged(banded.select("band", "hash", "doc_id").join(groups, ["band", "hash"]), "in-group")
    stars = staged(in_group.where("doc_id <> a").select(F.least("a", "doc_id").alias("a"),
                                                        F.greatest("a", "doc_id").alias("b")).distinct(), "stars")
    # Only documents that share a band are looked at from here on.
    near = staged(in_group.select("doc_id").distinct(), "near")
    signed = _picked(signed.select("doc_id", "size", "signature", "cells"), near, "near-signatures")
    text = _picked(rows.select("doc_id", F.lower("text").alias("text")), near, "near-texts")
    links = staged(_verified(stars, text, threshold), "star-links")
    classes = staged(reps.select("doc_id").join(components(links), "doc_id", "left")
                     .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id")), "classes")

    # Groups whose members are still in several classes, in rounds.
    failed = spark.range(0).selectExpr("int(id) band", "id hash", "id low", "id high", "id a", "id b")
    part, most = 0, 1
    while True:
        placed = in_group.join(classes, "doc_id")
        open_groups = (placed.groupBy("band", "hash").agg(F.min("class_id").alias("x"), F.max("class_id").alias("y"), F.count("*").alias("n"))
                       .where("x <> y and n > 2").select("band", "hash", "n"))
        members = placed.join(open_groups, ["band", "hash"]).select("band", "hash", "n", "doc_id", "class_id")
        # The early bands, the late ones, then tasks with failures among both.
        if part < 2:
            members = members.where(F.col("band") < EARLY if part == 0 else F.col("band") >= EARLY)
        else:
            tasks = failed.select(*TASK).distinct()
            members = members.join(tasks.select("band", "hash").distinct(), ["band", "hash"], "left_semi")
        members = staged(members, "open-members")
        ids = staged(members.select("doc_id").distinct(), "open-ids")
        members = members.join(signed.join(ids, "doc_id", "left_semi"), "doc_id")
        if part < 2:
            told = _apart(members, threshold)
        else:
            keys = _keys(text.join(ids, "doc_id", "left_semi"))
            told = _apart(members.join(staged(keys, "keys"), "doc_id"), threshold, failed, most, tasks)
            most *= GROWTH
        told = staged(told, "candidates")
        pairs = staged(told.select("a", "b").distinct(), "pairs")
        ends = staged(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ends")
        more = staged(_verified(pairs, text.join(ends, "doc_id", "left_semi"), threshold), "more-links")
        links = links.unionByName(more)
        # Links join whole classes: only the classes are followed further.
        of = lambda end: classes.select(F.col("doc_id").alias(end), F.col("class_id").alias(f"of_{end}"))
        between = more.join(of("a"), "a").join(of("b"), "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
        joined = components(between).select(F.col("doc_id").alias("class_id"), F.col("class_id").alias("whole"))
        classes = staged(classes.join(joined, "class_id", "left").select("doc_id", F.coalesce("whole", "class_id").alias("class_id")), "classes")
        again = staged(told.join(more, ["a", "b"], "left_anti").select(*told.columns), "failed")
        if part >= 2:
            # Tasks without a new failure are done: only the others stay.
            still = failed.join(again.select(*TASK).distinct(), TASK, "left_semi").select(*told.columns)
            failed = staged(again.unionByName(still), "failed")
        else:
            failed = staged(failed.unionByName(again), "failed")
        part += 1
        if part >= 2 and failed.isEmpty():
            break

    degree = links.distinct().select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n"))
    # Classes are told for the representatives; their copies take them over.
    told = (classes.withColumnRenamed("doc_id", "rep").join(degree, "rep", "left")
            .select("rep", F.col("class_id").alias("class"), F.coalesce("n", F.lit(0)).alias("verified_links")))
    return staged(member.join(told, "rep").select("doc_id", "own_id", "size", "class", "verified_links"), "told")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, class_id (smallest doc_id of its class),
    verified_links (links of its representative that were compared in full; links
    inside a class that is joined already are not), class_size."""
    told = _classes(_named(docs), threshold)
    sizes = told.groupBy("class").agg(F.min("own_id").alias("class_id"), F.count("*").alias("class_size"))
    return told.join(sizes, "class").select(F.col("own_id").alias("doc_id"), "class_id", "verified_links", "class_size")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, that with the smallest doc_id, with all its
    columns. Documents without any word or doc_id all stay."""
    told = _classes(_named(docs), threshold).where("size > 0")
    first = told.groupBy("class").agg(F.min(F.struct("own_id", "doc_id")).alias("first"), F.count("*").alias("n"))
    shared = first.where("n > 1").select("class", F.col("first.doc_id").alias("stays"))
    gone = told.join(shared, "class").select("doc_id", "stays")
    name = spare_column(docs, "name")
    key = F.when(F.col("doc_id").isNotNull(), row_name(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))))
    named = docs.withColumn(name, key)
    dropped = staged(gone.where("doc_id <> stays").select(F.col("doc_id").alias(name)).distinct(), "dropped")
    # Rows that repeat the doc_id and text of the one that stays.
    again = staged(gone.where("doc_id = stays").groupBy(F.col("doc_id").alias(name)).count().where("count > 1").select(name), "again")
    stay = named.join(dropped, name, "left_anti")
    if not again.isEmpty():
        stay = stay.join(again, name, "left_anti").unionByName(stay.join(again, name, "left_semi").dropDuplicates([name]))
    return stay.select(*docs.columns)
