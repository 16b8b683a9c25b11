"""End-to-end run (JOB-3): new files → validate → state → rollups → tables.

Spark calls are synchronous, so the orchestration is a plain function over an
incremental refresh. Everything a run makes becomes visible with its manifest;
then the tables are views of the folders that the manifest lists, each
replaced in one statement. A run that fails changes nothing that readers see;
its error is kept as a dead letter, which later runs leave alone, and raised.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import monitor
from ..operators.rollups import ROLLUP_KEYS
from ..schemas import CLEAN, DEAD_LETTER, FINAL_ORDERS
from ..sinks.manifest import Entry, Published
from ..sources import catalog
from .incremental import SCHEMAS, Refresh, refresh
from .ingest import Ingest, qualify

PROCESSED_TABLE = "orders_processed"
FAILURES = "flow_failures"


@dataclass
class FlowResult:
    """A finished run. ``ingest`` is None when there was nothing to read."""
    published: Published
    refresh: Refresh
    tables: dict[str, str]

    @property
    def ingest(self) -> Ingest | None:
        return self.refresh.ingest

    def processed(self) -> DataFrame:
        return self.published.read("clean", SCHEMAS["clean"], self.refresh.entries).drop("source_file")


def register(spark: SparkSession, entries: list[Entry], database: str) -> dict[str, str]:
    """Views of the published folders: the processed rows, the final orders
    and the rollups; name → table."""
    def folders(output: str) -> list[str]:
        return [e.folder for e in entries if e.output == output]

    tables = {PROCESSED_TABLE: catalog.register_view(
        spark, f"{database}.{PROCESSED_TABLE}", folders("clean"), CLEAN)}
    tables["orders"] = catalog.register_view(spark, f"{database}.final_orders", folders("orders"), FINAL_ORDERS)
    for name in ROLLUP_KEYS:
        schema = spark.read.parquet(*folders(name)).schema
        tables[name] = catalog.register_view(spark, f"{database}.final_{name}", folders(name), schema)
    return tables


def run_flow(spark: SparkSession, landing: str, work_dir: str, database: str = "orderlake",
             as_of=None) -> FlowResult:
    try:
        done = refresh(spark, landing, work_dir, as_of)
        return FlowResult(Published(spark, work_dir), done, register(spark, done.entries, database))
    except Exception as exc:
        where = qualify(landing)
        record = (spark.createDataFrame(
            [(where, None, where, str(exc), type(exc).__name__, None, None)], DEAD_LETTER)
            .withColumn("timestamp", F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())))
        record.write.mode("append").parquet(f"{work_dir.rstrip('/')}/{FAILURES}")
        raise


def flow_failures(spark: SparkSession, work_dir: str) -> DataFrame:
    """Letters of the runs that failed; kept by every later run."""
    try:
        return spark.read.schema(DEAD_LETTER).parquet(f"{work_dir.rstrip('/')}/{FAILURES}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DEAD_LETTER)


def read_dead_letters(spark: SparkSession, work_dir: str) -> DataFrame:
    """Letters of failed files (those of the current state) and of failed runs."""
    return Published(spark, work_dir).read("dead_letters", DEAD_LETTER).unionByName(flow_failures(spark, work_dir))


def flow_alerts(spark: SparkSession, work_dir: str) -> DataFrame:
    """One alert payload (REJ-8) per dead letter, failed runs included."""
    return monitor.failure_alerts(read_dead_letters(spark, work_dir))
