"""File-level gates: a raw file is published whole or not at all.

Everything here works on the classified rows as they were written once to the
shared folder, and on a small per-segment table derived from them: a segment
is the rows of one file read by one task (``source_file``, ``block_start``),
so the table has at most one row per input split. It is built with one hash
aggregation over numbers (no shuffle of rows, no skew even when one file holds
a third of the data) and then gives:

* the file outcomes (poison, no valid rows, header failures) — dead letters;
* the row number of any row in its file (the reference numbers rows from 1);
* which rows belong to failed files.

Rows meet this table by segment, never by file, so no join key is larger than
one input split. The table is a Parquet folder of known size; the planner
alone decides whether to broadcast it.

The header is record 0 of its file. Read as a row it is never accepted: where
there is an order date its text is "OrderDate", a rejected date; where there
is none, it and all rows after it poison the file. ``segment_stats`` takes it
out of the counts, and it has no row number of 1 or more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .classify import ACCEPTED, POISON, REJECTED

# Fixed value: the reference's error for a file without one accepted row.
NO_VALID_ROWS_ERROR = "No valid rows found after cleaning"

SEGMENT = ["source_file", "block_start"]


def segment_stats(classified: DataFrame) -> DataFrame:
    """Numbers only, so the aggregation is by hash and sorts nothing.

    ``rows`` counts records, the header too; the other counts leave it out."""
    st = F.col("status")
    raw = classified.groupBy(*SEGMENT).agg(
        F.min("mid").alias("first_mid"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(st == ACCEPTED).alias("accepted"),
        F.count_if(st == REJECTED).alias("skipped"),
        F.min(F.when(st == POISON, F.col("mid"))).alias("poison_mid"))
    has_header = F.col("block_start") == 0
    header_poisons = has_header & (F.col("poison_mid") == F.col("first_mid"))
    header_poisons = F.coalesce(header_poisons, F.lit(False))
    return raw.select(
        *SEGMENT, "first_mid", "rows", "accepted",
        (F.col("skipped") - (has_header & ~header_poisons).cast("long")).alias("skipped"),
        F.when(~header_poisons, F.col("poison_mid"))
         .when(F.col("rows") > 1, F.col("first_mid") + 1).alias("poison_mid"))


def with_row_offsets(segments: DataFrame) -> DataFrame:
    """Add ``rows_before``: rows of the same file in earlier segments.

    The window is per file over segment rows only (one row per split), never
    over data rows.
    """
    w = (Window.partitionBy("source_file").orderBy("block_start")
         .rowsBetween(Window.unboundedPreceding, -1))
    return segments.withColumn("rows_before", F.coalesce(F.sum("rows").over(w), F.lit(0)))


def _row(mid: str):
    return F.col("rows_before") + F.col(mid) - F.col("first_mid")


def file_outcomes(offsets: DataFrame, poison: DataFrame, checks: DataFrame) -> DataFrame:
    """One row per listed file with its counts, first poison row and error.

    ``poison``: the poisoning rows (segment, mid, poison_error). Error
    precedence follows the reference: decoding and header problems first,
    then the first poison row in file order, then no valid rows.
    """
    per_file = offsets.groupBy("source_file").agg(
        F.sum("accepted").alias("rows_accepted"),
        F.sum("skipped").alias("rows_skipped"),
        (F.sum("rows") - 1).alias("rows_read"),
        F.min(_row("poison_mid")).alias("poison_row"))
    # The text of a segment's first poison row; at most one row per segment.
    texts = (poison.withColumnRenamed("mid", "poison_mid").join(offsets, [*SEGMENT, "poison_mid"])
             .select("source_file", _row("poison_mid").alias("poison_row"), "poison_error"))
    joined = (checks.select("source_file", "file_size", "chars", "utf8_ok", F.col("error").alias("check_error"))
              .join(per_file, "source_file", "left")
              .join(texts, ["source_file", "poison_row"], "left"))
    zero = F.lit(0).cast("long")
    error = (F.when(F.col("check_error").isNotNull(), F.col("check_error"))
             .when(F.col("poison_row").isNotNull(), F.col("poison_error"))
             .when(F.coalesce(F.col("rows_accepted"), zero) == 0, F.lit(NO_VALID_ROWS_ERROR)))
    return joined.select(
        "source_file", "file_size", "chars", "utf8_ok",
        F.coalesce("rows_accepted", zero).alias("rows_accepted"),
        F.coalesce("rows_skipped", zero).alias("rows_skipped"),
        F.coalesce("rows_read", zero).alias("rows_read"),
        "poison_row",
        F.col("check_error").isNull().alias("readable"),
        error.alias("error"))


def segments_with_outcome(offsets: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Per segment: what numbering and gating its rows needs."""
    return offsets.select(*SEGMENT, "first_mid", "rows_before").join(
        outcomes.select("source_file", "poison_row", F.col("error").isNotNull().alias("failed")),
        "source_file")


def publishable(classified: DataFrame, segments: DataFrame) -> DataFrame:
    """Accepted rows of files that did not fail."""
    good = segments.where(~F.col("failed")).select(*SEGMENT)
    return classified.where(F.col("status") == ACCEPTED).join(good, SEGMENT, "left_semi")


def logged_before_failure(rows: DataFrame, segments: DataFrame,
                          inclusive: bool = False) -> DataFrame:
    """Add ``row`` (1-based position in the file) and keep the row events the
    reference logs: those before the file's poison row (``inclusive``: and on
    it). Processing stops there; later rows are never seen.
    """
    numbered = rows.join(segments, SEGMENT).withColumn("row", _row("mid")).where("row > 0")
    before = (F.col("row") <= F.col("poison_row")) if inclusive else (F.col("row") < F.col("poison_row"))
    return numbered.where(F.col("poison_row").isNull() | before)
