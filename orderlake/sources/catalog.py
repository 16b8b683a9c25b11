"""Catalog layer: schema discovery, table registration and reads (SRC-4..6).

Registration is plain Spark SQL over the session catalog; partitions of the
date-partitioned datasets are recovered from their folders. Reads of the
final orders dataset pass an explicit schema so ``month=01`` stays "01", and
date filters become partition filters (only the matching folders are listed).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import FINAL_ORDERS
from ..session import ensure_conf


def _ident(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def discover_csv_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0):
    """Infer the schema of processed CSV files (types from every row by default)."""
    return (spark.read.option("header", "true").option("inferSchema", "true")
            .option("samplingRatio", str(sampling_ratio)).option("escape", '"')
            .csv(path).schema)


def discover_parquet_schema(spark: SparkSession, path: str):
    """Union of the footers' schemas of a Parquet dataset (schema evolution)."""
    return spark.read.option("mergeSchema", "true").parquet(path).schema


def schema_rows(spark: SparkSession, table: str, schema) -> DataFrame:
    """(table_name, col_name, data_type) per column, in column order."""
    rows = [(table, f.name, f.dataType.simpleString(), i) for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(rows, "table_name string, col_name string, data_type string, "
                                       "ordinal int")


def _plain(path: str) -> str:
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def register_table(spark: SparkSession, table: str, path: str, fmt: str = "parquet",
                   schema=None, partitioned_by=(), options: dict | None = None) -> str:
    """Register the files under ``path``; a table that is already there stays
    and gets the columns and partitions it lacks. It is never removed: a name
    that belongs to another folder is an error."""
    ensure_conf(spark)
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(table.split('.')[0])}")
    if spark.catalog.tableExists(table):
        at = (spark.sql(f"DESCRIBE TABLE EXTENDED {_ident(table)}")
              .where("col_name = 'Location'").select("data_type").first())
        if at is None or _plain(at[0]) != _plain(path):
            raise ValueError(f"table {table} belongs to {at and at[0]}, not to {path}")
        if schema is not None:
            add_columns(spark, table, schema)
    else:
        cols = ""
        if schema is not None:
            cols = "(" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + ")"
        opts = ""
        if options:
            opts = " OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in options.items()) + ")"
        part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
        spark.sql(f"CREATE TABLE {_ident(table)} {cols} USING {fmt}{opts}{part} LOCATION '{path}'")
    if partitioned_by:
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    return table


# Types that hold every value of the types before them.
_WIDER = (("tinyint", "smallint", "int", "bigint"), ("float", "double"), ("date", "timestamp"))
_WHOLE, _REAL = _WIDER[0], _WIDER[1]


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that both can be read as: along the whole numbers,
    the reals or the times; double for a whole number and a real; else text."""
    x, y = a.simpleString(), b.simpleString()
    if x == y:
        return a
    for chain in _WIDER:
        if x in chain and y in chain:
            return a if chain.index(x) > chain.index(y) else b
    if {x, y} <= {*_WHOLE, *_REAL}:
        return T.DoubleType()
    return T.StringType()


ADDED, RETYPED, VANISHED = "added", "retyped", "vanished"


def evolve(table: T.StructType, found: T.StructType) -> tuple[T.StructType, list[tuple]]:
    """(the table's schema after files with the schema ``found`` have come,
    changes as (col_name, change, old_type, found_type, table_type)).

    Columns are matched without regard to case. New ones go to the end, a type
    that does not hold the files' values becomes wider, and a column that the
    files lack stays (a delete is only logged)."""
    new = {f.name.lower(): f for f in found.fields}
    out, changes = [], []
    for f in table.fields:
        g = new.pop(f.name.lower(), None)
        if g is None:
            changes.append((f.name, VANISHED, f.dataType.simpleString(), None, f.dataType.simpleString()))
            out.append(f)
            continue
        both = wider_type(f.dataType, g.dataType)
        if g.dataType != f.dataType:
            changes.append((f.name, RETYPED, f.dataType.simpleString(), g.dataType.simpleString(), both.simpleString()))
        out.append(T.StructField(f.name, both))
    for f in found.fields:
        if f.name.lower() in new:
            changes.append((f.name, ADDED, None, f.dataType.simpleString(), f.dataType.simpleString()))
            out.append(T.StructField(f.name, f.dataType))
    return T.StructType(out), changes


def evolve_folders(spark: SparkSession, folders: list[str]) -> tuple[T.StructType, list[tuple]]:
    """The schema that holds all Parquet folders, in the order they came, and
    the changes as (version, ...) with the first folder as version 1."""
    schema, log = None, []
    for version, folder in enumerate(folders, 1):
        found = discover_parquet_schema(spark, folder)
        schema, changes = (found, []) if schema is None else evolve(schema, found)
        log += [(version, *c) for c in changes]
    return schema, log


def register_evolving(spark: SparkSession, view: str, folders: list[str]) -> list[tuple]:
    """Register the folders as one table whose columns follow their schemas;
    returns the changes. Older rows are read as the wider type."""
    schema, log = evolve_folders(spark, folders)
    register_view(spark, view, folders, schema)
    return log


CHANGE_LOG = "version int, col_name string, change string, old_type string, found_type string, table_type string"


def register_view(spark: SparkSession, view: str, folders: list[str], schema) -> str:
    """A view of exactly these Parquet folders, replaced in one statement (no
    folders: an empty one). Columns are cast to the schema, so the folders may
    differ in columns they lack."""
    ensure_conf(spark)
    if "." in view:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(view.split('.')[0])}")
    parts = []
    for folder in folders:
        have = {f.name.lower() for f in spark.read.parquet(folder).schema.fields}
        cols = ", ".join(f"CAST({f'`{f.name}`' if f.name.lower() in have else 'NULL'} AS {f.dataType.simpleString()}) "
                         f"AS `{f.name}`" for f in schema.fields)
        parts.append(f"SELECT {cols} FROM parquet.`{folder}`")
    if not parts:
        cols = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
        parts = [f"SELECT {cols} WHERE false"]
    spark.sql(f"CREATE OR REPLACE VIEW {_ident(view)} AS {' UNION ALL '.join(parts)}")
    return view


def add_columns(spark: SparkSession, table: str, new_schema) -> list[str]:
    """Schema evolution: add columns the table does not have yet; never drop."""
    have = {f.name.lower() for f in spark.table(table).schema.fields}
    added = [f for f in new_schema.fields if f.name.lower() not in have]
    if added:
        spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {_ident(table)} ADD COLUMNS ({spec})")
    return [f.name for f in added]


def register_final_orders(spark: SparkSession, table: str, path: str) -> str:
    return register_table(spark, table, path, "parquet", schema=FINAL_ORDERS,
                          partitioned_by=("year", "month", "day"))


def read_catalog_orders(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def read_final_orders(spark: SparkSession, path: str, year: str | None = None,
                      month: str | None = None, day: str | None = None) -> DataFrame:
    """Final orders Parquet; given date parts are partition filters."""
    ensure_conf(spark)
    df = spark.read.schema(FINAL_ORDERS).parquet(path)
    for name, v in (("year", year), ("month", month), ("day", day)):
        if v is not None:
            df = df.where(F.col(name) == v)
    return df
