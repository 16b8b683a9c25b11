"""Operator 6: licence scan by sparse TF-IDF cosine and directory inheritance.

DataFrame operations only.  The units of a file are its lines, its sentences
(over line breaks), the runs of as many words as a template has (over lines and
sentences), and the whole text of a licence file.  Every unit is compared with
the licence templates by the cosine of their TF-IDF vectors; the document
frequencies of all terms are counted over all files.  Units are made only in
files that hold a term without which no cosine can reach the threshold, and
each holds such a term: of each template the heaviest terms, as many as leave
the rest of its vector shorter than threshold x its length (Cauchy-Schwarz).
Equal units are scored once.

A file with a unit of its own that reaches the threshold has that licence.
Licence files (LICENSE, LICENCE, COPYING, by name) give theirs to their
directory; every other file inherits from the nearest directory above it: its
ancestor directories, the root too, are joined with the licensed ones, the
deepest wins.

Edge cases: null texts and paths are empty; an empty text or path has no
licence of its own; ties go to the alphabetically first licence; repeated rows
get one row each; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, staged

THRESHOLD = 0.7

# The sentence by which each licence is usually stated.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "Copyright. All rights reserved.",
}
TERM = "[^a-z0-9]+"
SENTENCE = r"(?<=[.!?])\s+|\n\s*\n"
LICENCE_FILE = r"(?i)^(licen[sc]e|copying)(\..*)?$"


def _terms(text):
    return F.filter(F.split(F.lower(text), TERM), lambda t: t != "")


def _template_terms(text: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for c in "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in text.lower()).split():
        out[c] = out.get(c, 0) + 1
    return out


def scan(files: DataFrame, threshold: float = THRESHOLD, templates: dict[str, str] | None = None) -> DataFrame:
    """files: file_id, path, text. Per file: file_id, path, licence, how
    (header, file, inherited or none), cosine, from_dir."""
    spark = files.sparkSession
    prepare(spark)
    terms = {name: _template_terms(t) for name, t in (templates or TEMPLATES).items()}
    vocabulary = sorted({t for counts in terms.values() for t in counts})
    rows = files.select(F.col("file_id").cast("long").alias("file_id"),
                        F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("file_id", "path", "text"))
    rows = rows.withColumn("dir", F.regexp_extract("path", r"^(.*)/[^/]*$", 1))
    rows = rows.withColumn("is_licence", F.regexp_extract("path", r"([^/]*)$", 1).rlike(LICENCE_FILE))

    # Document frequencies of all terms, over all files.
    n = rows.count()
    seen = staged(rows.select(F.explode(F.array_distinct(_terms("text"))).alias("term"))
                  .groupBy("term").agg(F.count("*").alias("n")), "term-files")
    df = {r["term"]: r["n"] for r in seen.where(F.col("term").isin(vocabulary)).collect()}
    idf = {t: math.log((n + 1) / (df.get(t, 0) + 1)) + 1 for t in vocabulary}
    weights = seen.select("term", (F.log(F.lit(n + 1) / (F.col("n") + 1)) + 1).alias("idf"))
    length = {name: math.sqrt(sum((k * idf[t]) ** 2 for t, k in counts.items())) for name, counts in terms.items()}
    needed: set[str] = set()
    for name, counts in terms.items():
        rest = length[name] ** 2
        for t in sorted(counts, key=lambda t: (-counts[t] * idf[t], t)):
            if math.sqrt(max(rest, 0)) < threshold * length[name]:
                break
            needed.add(t)
            rest -= (counts[t] * idf[t]) ** 2
    # A small table of the templates' terms: its size is that of the list above.
    vectors = F.broadcast(spark.createDataFrame(
        [(name, t, k * idf[t] / length[name]) for name, c in terms.items() for t, k in c.items()],
        "licence string, term string, weight double"))

    holds = f"(?i)(^|[^a-z0-9])({'|'.join(sorted(needed))})([^a-z0-9]|$)"
    some = rows.where(F.col("text").rlike(holds)).select("row", "text", "is_licence", _terms("text").alias("all"))
    # Written once: a place or a run must not split the text anew.
    some = staged(some.dropDuplicates(["row"]), "licence-texts")
    pieces = some.select("row", F.explode(F.split("text", "\n")).alias("unit")).unionByName(
        some.select("row", F.explode(F.split("text", SENTENCE)).alias("unit"))).unionByName(
        some.where("is_licence").select("row", F.col("text").alias("unit")))
    units = pieces.where(F.col("unit").rlike(holds)).select("row", _terms("unit").alias("terms"))
    place = F.transform("all", lambda t, i: F.when(t.isin(sorted(needed)), i + 1))
    places = staged(some.select("row", "all", F.filter(place, lambda i: i.isNotNull()).alias("at")), "licence-places")
    for k in sorted({sum(c.values()) for c in terms.values()}):
        last = F.size("all") - (k - 1)
        starts = F.array_distinct(F.flatten(F.transform("at", lambda i: F.sequence(
            F.least(F.greatest(i - (k - 1), F.lit(1)), last), F.least(i, last)))))
        runs = F.transform(starts, lambda i: F.slice("all", i, F.lit(k)))
        units = units.unionByName(places.where((F.size("all") >= k) & (F.size("at") > 0)).select("row", F.explode(runs).alias("terms")))
    units = units.withColumn("unit", F.xxhash64("terms"))
    units = staged(units.groupBy("row", "unit").agg(F.first("terms").alias("terms")), "licence-units")
    tf = (units.groupBy("unit").agg(F.first("terms").alias("terms")).select("unit", F.explode("terms").alias("term"))
          .groupBy("unit", "term").agg(F.count("*").alias("tf")).join(weights, "term")
          .select("unit", "term", (F.col("tf") * F.col("idf")).alias("w")))
    tf = staged(tf, "licence-terms")
    norms = tf.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    cosines = (tf.join(vectors, "term").groupBy("unit", "licence").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
               .join(norms, "unit").select("unit", "licence", F.round(F.col("dot") / F.col("norm"), 6).alias("cosine"))
               .where(F.col("cosine") >= threshold))
    scored = cosines.groupBy("unit").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("best"))
    best = units.select("row", "unit").join(scored, "unit").groupBy("row").agg(F.min("best").alias("best"))
    own = staged(best.select("row", F.col("best.licence").alias("licence"), (-F.col("best.c")).alias("cosine")), "own-licence")

    keys = rows.select("row", "file_id", "path", "dir", "is_licence").join(own, "row", "left")
    keys = staged(keys, "files")
    licensed = (keys.where(F.col("is_licence") & F.col("licence").isNotNull()).groupBy("dir")
                .agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("best"))
                .select(F.col("dir").alias("above"), F.col("best.licence").alias("dir_licence"),
                        (-F.col("best.c")).alias("dir_cosine")))
    # Ancestors of a directory: the root, a, a/b, a/b/c with their depths.
    parts = F.split("dir", "/")
    bare = keys.where(F.col("licence").isNull()).select("dir").distinct()
    steps = bare.select("dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth"))
    found = (steps.withColumn("above", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/")).join(licensed, "above")
             .groupBy("dir").agg(F.max(F.struct("depth", "above", "dir_licence", "dir_cosine")).alias("near")))
    how = (F.when(F.col("licence").isNotNull() & F.col("is_licence"), "file").when(F.col("licence").isNotNull(), "header")
           .when(F.col("near").isNotNull(), "inherited").otherwise("none"))
    return (keys.join(found, "dir", "left")
            .select("file_id", "path", F.coalesce("licence", "near.dir_licence").alias("licence"), how.alias("how"),
                    F.coalesce("cosine", "near.dir_cosine").alias("cosine"),
                    F.when(F.col("licence").isNull(), F.col("near.above")).alias("from_dir")))


def document_files(docs: DataFrame) -> DataFrame:
    """The documents as files of a tree: source / thousand / hundred of ids.
    Every tenth id plays the licence file of its directory, every hundredth
    that of the thousand, every thousandth that of the source."""
    i = F.col("doc_id").cast("long")
    name = F.when(i % 10 == 0, F.concat(F.lit("LICENSE."), i.cast("string"))).otherwise(
        F.concat(i.cast("string"), F.lit(".txt")))
    place = [F.col("source"), F.when(i % 1000 != 0, F.floor(i / 1000).cast("string")),
             F.when(i % 100 != 0, F.floor(i / 100).cast("string"))]
    return docs.select(i.alias("file_id"), F.concat_ws("/", *place, name).alias("path"), F.col("text"))
