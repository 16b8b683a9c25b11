"""Batch ingest of a landing folder of raw order CSVs (the cleaner stage).

``ingest`` parses the raw text once and writes the classified rows, with their
position in the split they were read from, to the shared folder; the per-file
checks, the per-segment table and the outcomes are written there too. Every
output is derived from these tables. The raw files are never planned again, so
row numbers do not depend on how a later scan would be split.

    text scan ─► segment checks ─► file checks
    text scan ─► records ─► columns by name ─► classify ─► classified rows (written once)
                                                    │
                    segments, outcomes ◄────────────┴──► published / rejects / repairs
"""

from __future__ import annotations

import os
import re
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gates
from ..operators.classify import POISON, REJECTED, classify, error_type
from ..schemas import CLEAN_COLUMNS
from ..session import ensure_conf, staged
from ..sinks import object_key, write_file_objects
from ..sources import raw_csv

# Fixed value: the reference's success message.
SUCCESS_MESSAGE = "File processed successfully"

def qualify(path: str) -> str:
    """Local paths as Spark reports them (``file:/abs``); URIs unchanged."""
    if "://" in path or path.startswith("file:"):
        return re.sub("^file:/*", "file:/", path).rstrip("/")
    return "file:" + os.path.abspath(path).rstrip("/")


@dataclass
class Ingest:
    spark: SparkSession
    landing: str
    checks: DataFrame
    classified: DataFrame
    segments: DataFrame
    outcomes: DataFrame
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    #: UTC time of the run, in the names of the processed objects.
    stamp: datetime = field(default_factory=lambda: datetime.now(timezone.utc).replace(tzinfo=None))

    # ---- row outputs -------------------------------------------------------
    def published(self, with_source: bool = False) -> DataFrame:
        """Clean rows of the files that did not fail."""
        extra = ["source_file"] if with_source else []
        return gates.publishable(self.classified, self.segments).select(*extra, *CLEAN_COLUMNS)

    def rejects(self) -> DataFrame:
        """source_file, row, reason, value, detail, raw_order_id."""
        rows = self.classified.where(F.col("status") == REJECTED).select(
            "source_file", "block_start", "mid", "reason", "value", "detail", "raw_order_id")
        return gates.logged_before_failure(rows, self.segments).select(
            "source_file", "row", "reason", "value", "detail", "raw_order_id")

    def repairs(self) -> DataFrame:
        """Rows whose total was computed (source_file, row, order_id, computed)."""
        rows = self.classified.where(F.col("total_was_computed")).select(
            "source_file", "block_start", "mid", "raw_order_id",
            F.col("computed_total").alias("computed"))
        return gates.logged_before_failure(rows, self.segments, inclusive=True).select(
            "source_file", "row", "raw_order_id", "computed")

    # ---- file outputs ------------------------------------------------------
    def metrics(self) -> DataFrame:
        """Per file that finished the row loop: rows_accepted, rows_skipped, size."""
        return (self.outcomes.where(F.col("poison_row").isNull() & F.col("readable"))
                .select("source_file", "rows_accepted", "rows_skipped", "file_size"))

    def dead_letters(self, as_of=None, request_id: str | None = None) -> DataFrame:
        """One message per failed file: bucket, key, error, its type, timestamp, request_id."""
        return dead_letters(self.outcomes, self.landing, as_of, request_id or self.run_id)

    def write_objects(self, path: str) -> str:
        """The published rows as one stamped CSV object per input file."""
        return write_file_objects(self.published(with_source=True), path, self.stamp)

    def run_summary(self) -> DataFrame:
        """Per published file: message, output_key (see ``write_objects``), rows_written."""
        return (self.outcomes.where(F.col("error").isNull())
                .select("source_file", F.lit(SUCCESS_MESSAGE).alias("message"),
                        object_key(F.col("source_file"), self.stamp).alias("output_key"),
                        F.col("rows_accepted").alias("rows_written")))


def file_key(landing: str) -> Column:
    """The file's name below the landing folder."""
    prefix = landing + "/"
    return F.when(F.col("source_file").startswith(prefix), F.substring("source_file", len(prefix) + 1, 1 << 30)
                  ).otherwise(F.col("source_file"))


def dead_letters(outcomes: DataFrame, landing: str, as_of=None, request_id: str | None = None) -> DataFrame:
    """Messages (schema ``DEAD_LETTER``) of the files with an error."""
    ts = (F.lit(as_of).cast("timestamp_ntz") if as_of is not None
          else F.convert_timezone(None, F.lit("UTC"), F.localtimestamp()))
    return (outcomes.where(F.col("error").isNotNull())
            .select(F.lit(landing).alias("bucket"), file_key(landing).alias("key"), "source_file", "error",
                    error_type(F.col("error")).alias("error_type"), ts.alias("timestamp"),
                    F.lit(request_id).cast("string").alias("request_id")))


def ingest(spark: SparkSession, landing: str, glob: str | None = "*.csv",
           text: DataFrame | None = None, files: DataFrame | None = None) -> Ingest:
    """Run the cleaner over every file under ``landing``; or over the lines of
    ``text``, a text-source frame of some of them, and the empty ones of
    ``files`` (a listing; without it empty files are not looked for)."""
    ensure_conf(spark)
    if text is None:
        text, files = raw_csv.raw_text(spark, landing, glob), raw_csv.listing(spark, landing, glob)
    parts = staged(raw_csv.segment_checks(text), "segment-checks")
    checks = staged(raw_csv.file_checks(parts), "file-checks")
    raw, checks = raw_csv.scan_raw(text, parts, checks)
    classified = staged(classify(raw), "classified")
    if files is not None:
        checks = staged(checks.unionByName(raw_csv.empty_files(files, checks)), "all-checks")
    offsets = staged(gates.with_row_offsets(gates.segment_stats(classified)), "offsets")
    poison = classified.where(F.col("status") == POISON).select(*gates.SEGMENT, "mid", "poison_error")
    outcomes = staged(gates.file_outcomes(offsets, poison, checks), "outcomes")
    segments = staged(gates.segments_with_outcome(offsets, outcomes), "segments")
    return Ingest(spark, qualify(landing), checks, classified, segments, outcomes)
