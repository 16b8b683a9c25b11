"""Sinks: clean CSV (SNK-1), rollup CSV (SNK-2), partitioned Parquet rollups
(SNK-3) and the date-partitioned orders dataset (SNK-4).

Output sizing is left to the data: rollups keep their global sort through a
range-partitioned write (part files follow the rank order), and a single file
is produced only where the caller asks for it. The orders
dataset is rebalanced by day with AQE, which splits a heavy day into several
files instead of one task, and merges light days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rollups import PARTITION_LABEL
from ..schemas import CLEAN, CLEAN_COLUMNS
from ..session import conf_for, ensure_conf

CSV_WRITE_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "dateFormat": "yyyy-MM-dd",
}

DATE_PARTITIONS = ("year", "month", "day")


def write_clean_csv(clean: DataFrame, path: str, mode: str = "append") -> str:
    """Clean rows as CSV with a header; Spark part names never collide."""
    clean.write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)
    return path


def object_key(source_file: Column, stamp) -> Column:
    """The name of the processed object of an input file: the UTC stamp of the
    run and the file's hash, so two files of one second do not meet."""
    stamp = F.date_format(F.lit(stamp).cast("timestamp_ntz"), "yyyyMMddHHmmss")
    return F.concat(F.lit("orders_processed_"), stamp, F.lit("_"), F.lower(F.hex(F.xxhash64(source_file))))


def write_file_objects(rows: DataFrame, path: str, stamp) -> str:
    """Clean rows with their ``source_file`` as one CSV object per input file:
    the folder ``object=<object_key>``, of several part files where the rows
    of one input are more than a task should write."""
    out = rows.select(object_key(F.col("source_file"), stamp).alias("object"), *CLEAN_COLUMNS).hint("rebalance", "object")
    with conf_for(rows.sparkSession, spark__sql__adaptive__coalescePartitions__minPartitionSize="32k",
                  spark__sql__sources__partitionOverwriteMode="static"):
        out.write.mode("append").options(**CSV_WRITE_OPTIONS).partitionBy("object").csv(path)
    return path


def read_file_objects(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all processed objects, with ``object``."""
    schema = T.StructType([*CLEAN.fields, T.StructField("object", T.StringType())])
    return (spark.read.schema(schema).option("header", "true").option("escape", '"').csv(path))


def _ranked_output(rollup: DataFrame, single_file: bool) -> DataFrame:
    """Range-partitioned part files in rank order, or one file where the
    caller asks for it (the caller's choice, never that of a counted size)."""
    return rollup.coalesce(1) if single_file else rollup


def write_rollup_csv(rollup: DataFrame, path: str,
                     single_file: bool = False) -> str:
    _ranked_output(rollup, single_file).write.mode("overwrite") \
        .options(**CSV_WRITE_OPTIONS).csv(path)
    return path


def write_rollup_parquet(rollup: DataFrame, path: str,
                         single_file: bool = False) -> str:
    """Rollup under the folders year=all/month=all/day=all.

    The labels are constant, so the folder is named directly: a partitioned
    write would add a sort by the (constant) partition columns and could lose
    the rank order inside the file.
    """
    folder = "/".join([path.rstrip("/")] + [f"{p}={PARTITION_LABEL}" for p in DATE_PARTITIONS])
    _ranked_output(rollup, single_file).write.mode("overwrite").parquet(folder)
    return path


def write_orders_parquet(clean: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Orders partitioned by their real date.

    With dynamic partition overwrite only the touched days are replaced, which
    is right only when ``clean`` holds every row of each day it touches.
    """
    ensure_conf(clean.sparkSession)
    out = clean.withColumn("year", F.col("year").cast("string"))
    out = out.hint("rebalance", *DATE_PARTITIONS)
    # A task's work here is files, one a day, as much as bytes: few bytes over
    # many days must not be merged into one task that opens all the files.
    with conf_for(clean.sparkSession, spark__sql__adaptive__coalescePartitions__minPartitionSize="32k"):
        out.write.mode(mode).partitionBy(*DATE_PARTITIONS).parquet(path)
    return path
