"""Incremental file arrival (SRC-3) and incremental re-runs (JOB-2).

Structured Streaming's file source keeps the set of files already processed
in its checkpoint, so each run only sees new ``*.csv`` files. Each
micro-batch is handed to the batch cleaner (``plans.ingest``): the
micro-batch's text rows give each file's header and encoding check, and the
files are then read by header signature. A file never spans micro-batches,
so file-level gating inside ``foreachBatch`` is sound.

Every micro-batch is published as a whole (``plans.incremental``): its outputs,
partial sums and orders become visible with its manifest, together with the
rollups refreshed from the partial sums of all batches. A replayed micro-batch
replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.incremental import CURRENT, SCHEMAS, publish_stream_batch
from ..plans.ingest import dead_letters, ingest, qualify
from ..schemas import DEAD_LETTER
from ..session import ensure_conf
from ..sinks.manifest import Published
from ..sources import raw_csv

#: The batch of the dead letters of empty files.
EMPTY = "empty"


def ingest_stream(spark: SparkSession, landing: str, out_root: str, checkpoint: str,
                  glob: str = "*.csv", max_files_per_trigger: int | None = None,
                  available_now: bool = True, as_of=None):
    """Start the arrival stream; returns the StreamingQuery (already finished
    when ``available_now``; otherwise call ``sweep_empty_files`` at times)."""
    ensure_conf(spark)
    reader = (spark.readStream.format("text").option("pathGlobFilter", glob).option("lineSep", "\n")
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(landing).select("value", "_metadata")
    out = out_root.rstrip("/")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        ing = ingest(batch.sparkSession, landing, text=batch)
        publish_stream_batch(Published(batch.sparkSession, out), f"s{batch_id:08d}", ing, as_of)

    trigger = {"availableNow": True} if available_now else {"processingTime": "30 seconds"}
    q = (lines.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(**trigger).start())
    if available_now:
        q.awaitTermination()
        sweep_empty_files(spark, landing, out, glob, as_of)
    return q


def read_stream_output(spark: SparkSession, out_root: str, name: str = "clean") -> DataFrame:
    """One output of all published micro-batches, and their ``batch_id``."""
    return Published(spark, out_root).read(name, SCHEMAS[name], with_batch=True)


def clean_rows(spark: SparkSession, out_root: str) -> DataFrame:
    return read_stream_output(spark, out_root, "clean").drop("batch_id", "source_file")


def read_rollup(spark: SparkSession, out_root: str, name: str) -> DataFrame | None:
    """A rollup over all published micro-batches (None before the first one)."""
    folders = [e.folder for e in Published(spark, out_root).current()[1] if (e.output, e.batch) == (name, CURRENT)]
    return spark.read.parquet(*folders) if folders else None


def sweep_empty_files(spark: SparkSession, landing: str, out_root: str, glob: str = "*.csv",
                      as_of=None) -> None:
    """Dead letters of the zero-byte files, which never reach a micro-batch.

    All of them are published anew each time, so a repeated sweep adds nothing
    and a file that has got its content in the meantime loses its letter."""
    pub = Published(spark, out_root)
    version, entries = pub.current()
    seen = pub.read("ledger", SCHEMAS["ledger"], entries)
    empty = raw_csv.empty_files(raw_csv.listing(spark, landing, glob), seen)
    letters = pub.write("dead_letters", EMPTY, dead_letters(empty, qualify(landing), as_of).select(*DEAD_LETTER.names))
    pub.commit(version, [e for e in entries if e.batch != EMPTY] + [letters])
