"""Operator 10: exact dedup by an extendible-hash index on shared files.

DataFrame operations only.  The directory is built over the distinct 64-bit
hashes: it starts at the depth that their number asks for and doubles while a
bucket holds more than `capacity` of them; only overfull buckets split, on the
next bit of the hash.  Texts find their bucket in the directory and travel to
it: buckets are range-partitioned, so that an owner task holds a range of keys.
There the texts of one hash are compared byte by byte and chained: a chain has
one link for each distinct text, which carries the id that stays and the size of
the group.  The index lies in the shared folder; documents look up their bucket
in the directory and their link, by SHA-256, in the chain.

Copies of one text are merged on the way, first where they are read and then in
PARTS parts by the split they came from, so an owner gets at most PARTS rows of
a text however often it occurs.

Edge cases: a null text equals an empty one; of equal texts the largest doc_id
stays (null ids never do unless all of a group are null); rows repeated with
the same doc_id and text are one document for `kept` (all carry the flag), and
`keep_documents` returns one of them; different texts that share a doc_id, or
have none, are documents of their own; an empty table gives an empty result;
extra columns are ignored or, in `keep_documents`, passed through, whatever
their names.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, prepare, spare_column, staged, texts

CAPACITY = 4096
PARTS = 32


def _prefix(depth: int):
    """The first `depth` bits of the hash as a number."""
    return F.shiftrightunsigned("hash", 64 - depth) if depth else F.lit(0).cast("long")


def build_directory(entries: DataFrame, capacity: int = CAPACITY, most_depth: int = 40) -> DataFrame:
    """(cell, bucket, depth) with one row for each cell of the final directory:
    a bucket of local depth d owns 2^(global - d) neighbouring cells."""
    spark = entries.sparkSession
    n = entries.count()
    depth = max(0, math.ceil(math.log2(max(1, n / capacity))))
    counts = staged(entries.groupBy(_prefix(depth).alias("prefix")).agg(F.count("*").alias("n")), "cells")
    leaves = []
    while True:
        full = counts.where(F.col("n") > capacity) if depth < most_depth else counts.limit(0)
        leaves.append((depth, counts.where(F.col("n") <= capacity) if depth < most_depth else counts))
        if full.isEmpty():
            break
        parent = F.shiftrightunsigned("prefix", 1)
        depth += 1
        split = entries.groupBy(_prefix(depth).alias("prefix")).agg(F.count("*").alias("n"))
        counts = staged(split.withColumn("parent", parent)
                        .join(full.select(F.col("prefix").alias("parent")), "parent", "left_semi").drop("parent"), "cells")
    out = None
    for d, leaf in leaves:
        spread = 1 << (depth - d)
        first = F.col("prefix") * spread
        rows = leaf.select(F.explode(F.sequence(first, first + (spread - 1))).alias("cell"),
                           first.alias("bucket"), F.lit(d).alias("depth"))
        out = rows if out is None else out.unionByName(rows)
    return staged(out, "directory")


def _global_depth(directory: DataFrame) -> int:
    return directory.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]


def _in_buckets(rows: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """Rows with a hash, with the bucket that the directory names for it."""
    return rows.withColumn("cell", _prefix(depth)).join(directory.select("cell", "bucket"), "cell").drop("cell")


def build_index(docs: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame, int]:
    """(index, directory, global depth) of the documents. The index has one row
    for each distinct text: bucket, hash, chain (its number among the texts of
    that hash), text_sha256, keep_id, group_size."""
    prepare(docs.sparkSession)
    rows = texts(docs).withColumn("hash", F.xxhash64("text"))
    directory = build_directory(staged(rows.select("hash").distinct(), "keys"), capacity)
    depth = _global_depth(directory)
    parts = (rows.withColumn("part", F.spark_partition_id() % PARTS).groupBy("hash", "text", "part")
             .agg(F.max("doc_id").alias("last"), F.count("*").alias("n")))
    owned = _in_buckets(parts, directory, depth).repartitionByRange(partitions(docs.sparkSession), "bucket", "hash")
    links = (owned.groupBy("bucket", "hash", "text").agg(F.max("last").alias("keep_id"), F.sum("n").alias("group_size"))
             .select("bucket", "hash", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"))
    chain = Window.partitionBy("bucket", "hash").orderBy("text_sha256")
    return staged(links.withColumn("chain", F.row_number().over(chain)), "index"), directory, depth


def look_up(rows: DataFrame, index: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """Rows with (hash, text_sha256) and the link that the index has for them."""
    return _in_buckets(rows, directory, depth).join(index, ["bucket", "hash", "text_sha256"])


def exact_groups(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256."""
    keys = texts(docs).select("doc_id", F.xxhash64("text").alias("hash"), F.sha2("text", 256).alias("text_sha256"))
    return look_up(keys, *build_index(docs, capacity)).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One whole row of each distinct text: that with the largest doc_id."""
    groups = staged(exact_groups(docs, capacity).where("group_size > 1"), "groups")
    sha = spare_column(docs, "sha")
    named = docs.withColumn(sha, F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    # Rows that go by their id and text, so that others under the same id stay.
    gone = (groups.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_sha")).distinct())
    stay = named.join(gone, named["doc_id"].cast("long").eqNullSafe(gone["gone_id"]) & (named[sha] == gone["gone_sha"]), "left_anti")
    # A text whose last id is repeated: one of its rows.
    again = staged(groups.where("kept").groupBy(F.col("text_sha256").alias(sha)).count().where("count > 1").select(sha), "again")
    if not again.isEmpty():
        stay = stay.join(again, sha, "left_anti").unionByName(stay.join(again, sha, "left_semi").dropDuplicates([sha]))
    return stay.select(*docs.columns)
