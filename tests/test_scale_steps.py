"""Steps that all file queries share: the raw files are written without a copy
of their rows, and text that is no number costs no thrown exceptions."""

import csv
import glob
import time
from datetime import datetime

from pyspark.sql import functions as F

from orderlake.functions import parse_float, parse_int
from orderlake.schemas import RAW_COLUMNS
from orderlake.session import scratch_path
from orderlake.sources import fixture


def _tables(spark, folder):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")

    put("nation", [(0, "PERU"), (1, "KENYA")], "n_nationkey int, n_name string")
    put("customer", [(1, "Ann", 0), (2, "Bo, \"B\"", 1)], "c_custkey long, c_name string, c_nationkey int")
    put("part", [(7, "nut", 1.5), (8, "bolt", 2.25)], "p_partkey long, p_name string, p_retailprice double")
    put("orders", [(k, 1 + k % 2, datetime(1994, 1, 1 + k % 28)) for k in range(1200)],
        "o_orderkey long, o_custkey long, o_orderdate timestamp")
    lines = [(k, 7 + (k + n) % 2, n, float(n + 1), 10.0 * n) for k in range(1200) for n in (3, 1, 2)]
    # One line thrice, with other values: their texts decide the order.
    lines += [(5, 7, 1, 9.0, 90.0), (5, 8, 1, 4.0, 1.0), (5, 8, 1, 4.0, 1.0)]
    put("lineitem", lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double")


def test_raw_files_hold_every_line_in_order_without_a_copy_of_the_rows(spark, tmp_path):
    _tables(spark, tmp_path)
    copies = lambda: set(glob.glob(scratch_path(spark, "raw-rows-*")))
    before = copies()
    landing = fixture.stage_raw_files(spark, str(tmp_path))
    assert copies() == before
    want = {}
    for r in (fixture.order_lines(spark, str(tmp_path)).withColumn("file_no", F.col("l_orderkey") % fixture.FILES)
              .select("file_no", "l_orderkey", "l_linenumber", *fixture.raw_text_columns(True)).collect()):
        want.setdefault(r["file_no"], []).append(tuple(r)[1:])
    assert len(want) == 400
    for no, rows in want.items():
        [path] = glob.glob(f"{landing}/file_no={no}/*.csv")
        with open(path, newline="") as f:
            got = list(csv.DictReader(f))
        assert list(got[0]) == list(fixture.LAYOUTS[no % 3])
        assert [tuple(g[c] for c in RAW_COLUMNS) for g in got] == [r[2:] for r in sorted(rows)]


def test_text_that_is_no_number_costs_no_exceptions(spark):
    def seconds(text):
        rows = spark.range(0, 1_500_000, 1, 4).select(F.concat(F.lit(text), F.lpad(F.col("id").cast("string"), 0, "0")).alias("t"))
        t = rows.select(parse_int("t").alias("i"), parse_float("t").alias("f"))
        t.write.format("noop").mode("overwrite").save()
        start = time.perf_counter()
        t.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    number = seconds("123")
    for text in ("two", "N/A", "not-a-date", ""):
        assert seconds(text) < 0.8 + 2 * number, text
