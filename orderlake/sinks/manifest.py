"""Datasets that change all at once: folders, and a manifest that lists them.

A writer puts every output of a batch into a folder of its own, which nobody
reads yet, and writes the next manifest last. Readers take the newest manifest
and see exactly the folders it lists: a batch that dies between two outputs
leaves folders that no manifest names, never half a batch. A manifest is one
Parquet file, so it is there whole or not at all; its version is its folder's
name, and two writers of one version cannot both succeed.

The rows of a manifest are folders (batches x outputs), not files or data.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "output string, batch string, folder string"
#: Outputs with partition folders.
PARTITIONED = ("orders",)


@dataclass(frozen=True)
class Entry:
    """One folder: an output (a dataset's name) of one batch."""
    output: str
    batch: str
    folder: str


class Published:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _manifests(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(f"{MANIFEST}, version long").parquet(f"{self.root}/manifests")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def current(self) -> tuple[int, list[Entry]]:
        """(newest version, its entries); (0, []) before the first one."""
        manifests = self._manifests()
        version = manifests.agg(F.max("version")).first()[0] if manifests is not None else None
        if version is None:
            return 0, []
        rows = manifests.where(F.col("version") == version).collect()
        return version, [Entry(r["output"], r["batch"], r["folder"]) for r in rows]

    def new_folder(self, output: str, batch: str) -> str:
        """A folder that nothing has written to, also by a run that failed."""
        return f"{self.root}/{output}/{batch}/{uuid.uuid4().hex[:12]}"

    def write(self, output: str, batch: str, df: DataFrame) -> Entry:
        entry = Entry(output, batch, self.new_folder(output, batch))
        df.write.parquet(entry.folder)
        return entry

    def commit(self, version: int, entries: list[Entry]) -> int:
        """Write the manifest after ``version``; fails if it is there already."""
        rows = self.spark.createDataFrame([(e.output, e.batch, e.folder) for e in entries], MANIFEST)
        rows.coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/manifests/version={version + 1}")
        return version + 1

    def read(self, output: str, schema: T.StructType | str, entries: list[Entry] | None = None,
             with_batch: bool = False) -> DataFrame:
        """All rows of an output, ``with_batch``: and the name of their batch."""
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        entries = self.current()[1] if entries is None else entries
        folders = [e.folder for e in entries if e.output == output]
        def load(*some: str) -> DataFrame:
            df = self.spark.read.schema(schema).parquet(*some)
            if not with_batch:
                return df
            return df.withColumn("batch_id", F.regexp_extract("_metadata.file_path", f"/{output}/([^/]+)/[0-9a-f]+/", 1))

        if not folders:
            df = self.spark.createDataFrame([], schema)
            return df.withColumn("batch_id", F.lit("")) if with_batch else df
        if output in PARTITIONED:  # each folder is the root of partitions of its own
            return reduce(DataFrame.unionByName, map(load, folders))
        return load(*folders)
