"""Incremental runs (JOB-2): only new and changed files are read; the rollups
are merged from partial sums, the orders dataset follows its source.

The state of a work folder is what its manifest lists (``sinks.manifest``).
For every batch it holds

    ledger       the files of the batch, with size and time
    clean        published rows with their source_file
    orders       the same rows by date, the final dataset's layout
    partials     sums per rollup and key, not rounded: they merge by adding
    rejects, repairs, metrics, dead_letters

A file that comes again with another size or time is read again, and the batch
that held it is written anew without it: its rows leave the orders dataset,
also the days that only they had, and its partial sums are taken again over
what is left. Nothing is ever subtracted, so NaN totals do no harm. When more
than ``fold_after`` batches are live, they become one in the same way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rollups
from ..schemas import CLEAN, CLEAN_COLUMNS, DEAD_LETTER, FINAL_ORDERS
from ..session import ensure_conf, staged
from ..sinks import write_orders_parquet, write_rollup_parquet
from ..sinks.manifest import Entry, Published
from ..sources import raw_csv
from .ingest import Ingest, ingest

LEDGER = "source_file string, file_size long, modified timestamp"
CLEAN_ROWS = "source_file string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CLEAN.fields)
SCHEMAS = {
    "ledger": LEDGER,
    "clean": CLEAN_ROWS,
    "rejects": "source_file string, row long, reason string, value string, detail string, raw_order_id string",
    "repairs": "source_file string, row long, raw_order_id string, computed double",
    "metrics": "source_file string, rows_accepted long, rows_skipped long, file_size long",
    "dead_letters": DEAD_LETTER,
    "partials": "rollup string, group_key string, amount double, units long, order_count long",
    "orders": FINAL_ORDERS,
}
#: Outputs whose rows belong to one file each.
BY_FILE = ("ledger", "clean", "rejects", "repairs", "metrics", "dead_letters")
#: Live batches beyond which they are folded into one.
FOLD_AFTER = 64
CURRENT = "current"


def _derived(pub: Published, batch: str, clean: DataFrame) -> list[Entry]:
    """The outputs that follow from a batch's clean rows."""
    out = [pub.write("partials", batch, rollups.partial_sums(clean))]
    folder = pub.new_folder("orders", batch)
    if not clean.isEmpty():  # a partitioned write of no rows leaves no schema behind
        out.append(Entry("orders", batch, write_orders_parquet(clean.select(*CLEAN_COLUMNS), folder)))
    return out


def write_batch(pub: Published, batch: str, ing: Ingest, ledger: DataFrame, as_of=None) -> list[Entry]:
    """Every output of one batch; visible once a manifest lists the entries."""
    outputs = {
        "ledger": ledger.select("source_file", "file_size", "modified"),
        "clean": ing.published(with_source=True), "rejects": ing.rejects(), "repairs": ing.repairs(),
        "metrics": ing.metrics(), "dead_letters": ing.dead_letters(as_of=as_of),
    }
    out = [pub.write(name, batch, df) for name, df in outputs.items()]
    return out + _derived(pub, batch, pub.read("clean", CLEAN_ROWS, out))


def rewrite(pub: Published, entries: list[Entry], old: set[str], batch: str,
            without: DataFrame | None = None) -> list[Entry]:
    """The batches ``old`` as one batch, without the files of ``without``."""
    mine = [e for e in entries if e.batch in old]
    out = []
    for name in BY_FILE:
        rows = pub.read(name, SCHEMAS[name], mine)
        if without is not None:
            rows = rows.join(without.select("source_file"), "source_file", "left_anti").select(*rows.columns)
        out.append(pub.write(name, batch, rows))
    return out + _derived(pub, batch, pub.read("clean", CLEAN_ROWS, out))


def current_rollups(pub: Published, entries: list[Entry]) -> list[Entry]:
    """The ranked rollups of all live batches, from their partial sums."""
    merged = rollups.merge_partials(pub.read("partials", SCHEMAS["partials"], entries)).checkpoint(eager=True)
    return [Entry(name, CURRENT, write_rollup_parquet(df, pub.new_folder(name, CURRENT)))
            for name, df in rollups.split_one_pass(merged).items()]


@dataclass
class Refresh:
    """What a run did: the files it read, the version that is now current."""
    version: int
    entries: list[Entry]
    ingest: Ingest | None
    files_read: int


def new_files(spark: SparkSession, landing: str, ledger: DataFrame, glob: str = "*.csv") -> tuple[DataFrame, DataFrame]:
    """(listing, those of its files that the ledger lacks or knows with
    another size or time), both staged."""
    files = staged(raw_csv.listing(spark, landing, glob), "listing")
    same = [files["source_file"] == ledger["source_file"], files["file_size"] == ledger["file_size"],
            files["modified"].eqNullSafe(ledger["modified"])]
    return files, staged(files.join(ledger, same, "left_anti"), "new-files")


def batch_text(spark: SparkSession, landing: str, files: DataFrame, fresh: DataFrame, glob: str = "*.csv") -> DataFrame:
    """The text of the fresh files: of the folder if all are fresh, else by
    their paths, as Spark's reader takes paths from the driver. So only the
    paths of one batch's arrivals pass there."""
    paths = fresh.where("file_size > 0")
    if files.where("file_size > 0").count() == paths.count():
        return raw_csv.raw_text(spark, landing, glob)
    found = [r["path"] for r in paths.select("path").collect()]
    if not found:
        return raw_csv.no_text(spark)
    return raw_csv.raw_text(spark, found, glob=None, recursive=False)


def refresh(spark: SparkSession, landing: str, work_dir: str, as_of=None, glob: str = "*.csv",
            fold_after: int = FOLD_AFTER) -> Refresh:
    """Read what is new in ``landing`` and publish the new state of ``work_dir``."""
    ensure_conf(spark)
    pub = Published(spark, work_dir)
    version, entries = pub.current()
    ledger = pub.read("ledger", LEDGER, entries)
    files, fresh = new_files(spark, landing, ledger, glob)
    n = fresh.count()
    if not n and entries:
        return Refresh(version, entries, None, 0)
    ing = ingest(spark, landing, text=batch_text(spark, landing, files, fresh, glob), files=fresh)
    batch = f"b{version + 1:08d}"
    # Batches that hold an earlier form of a fresh file.
    known = pub.read("ledger", LEDGER, entries, with_batch=True)
    stale = known.join(fresh.select("source_file"), "source_file", "left_semi").select("batch_id").distinct()
    live = [e for e in entries if e.batch != CURRENT]
    for old in sorted(r["batch_id"] for r in stale.collect()):
        live = [e for e in live if e.batch != old] + rewrite(pub, live, {old}, old, without=fresh)
    batches = {e.batch for e in live}
    if len(batches) >= fold_after:
        live = rewrite(pub, live, batches, f"f{version + 1:08d}")
    live += write_batch(pub, batch, ing, fresh, as_of)
    live += current_rollups(pub, live)
    return Refresh(pub.commit(version, live), live, ing, n)


def publish_stream_batch(pub: Published, batch: str, ing: Ingest, as_of=None) -> int:
    """One micro-batch; a batch that comes again replaces itself."""
    version, entries = pub.current()
    ledger = ing.checks.select("source_file", "file_size", F.lit(None).cast("timestamp").alias("modified"))
    live = [e for e in entries if e.batch not in (batch, CURRENT)] + write_batch(pub, batch, ing, ledger, as_of)
    return pub.commit(version, live + current_rollups(pub, live))
