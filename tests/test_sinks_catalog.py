"""Sinks round-trip; catalog registration and partition pruning."""

import json

from pyspark.sql import functions as F

from orderlake.operators import rollups
from orderlake.operators.classify import accepted, classify
from orderlake.schemas import CLEAN, CLEAN_COLUMNS
from orderlake.session import unique_path
from orderlake.sinks import (write_clean_csv, write_orders_parquet, write_rollup_csv,
                             write_rollup_parquet)
from orderlake.sources import catalog
from orderlake.sources.fixture import raw_orders


def _clean(spark, sf):
    return accepted(classify(raw_orders(spark, sf)))


def _bag(df):
    return sorted(tuple(r) for r in df.collect())


def test_clean_csv_round_trip(spark, sf):
    clean = _clean(spark, sf)
    path = write_clean_csv(clean, unique_path(spark, "t-clean"), mode="overwrite")
    back = spark.read.schema(CLEAN).option("header", "true").option("escape", '"').csv(path)
    assert _bag(back) == _bag(clean)


def test_rollup_csv_keeps_rank_order(spark, sf):
    vip = rollups.vip_customers(_clean(spark, sf))
    path = write_rollup_csv(vip, unique_path(spark, "t-vip"))
    back = (spark.read.schema("customer_email string, total_spent double, order_count long")
            .option("header", "true").csv(path))
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in vip.collect()]


def test_rollup_parquet_labels(spark, sf):
    prod = rollups.product_performance(_clean(spark, sf))
    path = write_rollup_parquet(prod, unique_path(spark, "t-prod"))
    back = spark.read.parquet(path)
    assert set(back.columns) >= {"year", "month", "day"}
    assert back.select("year", "month", "day").distinct().collect()[0] == ("all", "all", "all")
    assert back.count() == prod.count()


def test_orders_parquet_partitions_stay_strings(spark, sf):
    clean = _clean(spark, sf)
    path = write_orders_parquet(clean, unique_path(spark, "t-orders"))
    back = catalog.read_final_orders(spark, path)
    assert dict(back.dtypes)["month"] == "string"
    assert back.where(F.col("month") == "01").count() == clean.where(F.col("month") == "01").count()
    plan = back.where((F.col("year") == "1997") & (F.col("month") == "01"))._jdf \
        .queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "1997" in plan
    table = catalog.register_final_orders(spark, "orderlake_test.orders", path)
    assert spark.table(table).select(*CLEAN_COLUMNS).count() == clean.count()


def test_dynamic_overwrite_replaces_only_touched_days(spark, sf):
    clean = _clean(spark, sf)
    path = write_orders_parquet(clean, unique_path(spark, "t-dyn"))
    one_day = clean.where((F.col("year") == 1997) & (F.col("month") == "01") & (F.col("day") == "02"))
    n_day = one_day.count()
    write_orders_parquet(one_day.union(one_day), path)  # rewrite one day with doubled rows
    back = catalog.read_final_orders(spark, path)
    assert back.count() == clean.count() + n_day


def test_schema_discovery_and_evolution(spark, sf):
    clean = _clean(spark, sf)
    path = write_clean_csv(clean, unique_path(spark, "t-disc"), mode="overwrite")
    schema = catalog.discover_csv_schema(spark, path)
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    assert types["order_date"] == "date" and types["unit_price"] == "double"
    assert types["customer_email"] == "string"
    table = catalog.register_table(spark, "orderlake_test.processed", path, "csv",
                                   schema=schema, options={"header": "true"})
    from pyspark.sql import types as T
    added = catalog.add_columns(spark, table, T.StructType(
        list(schema.fields) + [T.StructField("channel", T.StringType())]))
    assert added == ["channel"]
    assert "channel" in spark.table(table).columns


def test_run_flow_twice_gives_the_same(spark, tmp_path):
    from pyspark.sql import functions as F

    from orderlake.plans.flow import read_dead_letters, run_flow

    head = "OrderID,CustomerEmail,Country,Product,Quantity,UnitPrice,OrderDate,TotalAmount\n"
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text(head + "1,a@b.com,Peru,Pen,2,1.5,2024-01-02,3.0\n")
    (landing / "bad.csv").write_text(head + "x,a@b.com,Peru,Pen,2,1.5,2024-01-02,3.0\n")

    def run():
        out = run_flow(spark, str(landing), str(tmp_path / "work"), database="flow_twice")
        rows = out.processed()
        return rows.count(), rows.agg(F.sum("quantity")).first()[0], read_dead_letters(spark, str(tmp_path / "work")).count()

    spark.sql("CREATE DATABASE IF NOT EXISTS flow_twice")
    first = run()
    assert first[0] == 1 and first[2] == 1
    assert run() == first
    (landing / "c.csv").write_text(head + "2,c@d.com,Peru,Pen,1,1.5,2024-01-03,1.5\n")
    assert run()[0] == 2


def test_register_again_keeps_table_and_columns(spark, sf):
    import pytest
    from pyspark.sql import types as T
    path = unique_path(spark, "t-again")
    _clean(spark, sf).write.parquet(path)
    schema = T.StructType(list(CLEAN.fields) + [T.StructField("channel", T.StringType())])
    table = f"orderlake_test.again_{path[-12:]}"
    catalog.register_table(spark, table, path, schema=CLEAN)
    catalog.register_table(spark, table, path, schema=schema)
    catalog.register_table(spark, table, path, schema=CLEAN)
    assert spark.table(table).columns[-1] == "channel"
    with pytest.raises(ValueError):
        catalog.register_table(spark, table, path + "-other", schema=CLEAN)


def test_run_flow_retry_after_a_failure(spark, tmp_path, monkeypatch):
    from orderlake.plans import flow, incremental

    head = "OrderID,CustomerEmail,Country,Product,Quantity,UnitPrice,OrderDate,TotalAmount\n"
    landing, work = tmp_path / "landing", str(tmp_path / "work")
    landing.mkdir()
    (landing / "a.csv").write_text(head + "1,a@b.com,Peru,Pen,2,1.5,2024-01-02,3.0\n")
    with monkeypatch.context() as m:
        m.setattr(incremental, "current_rollups", lambda *a, **k: 1 / 0)
        try:
            flow.run_flow(spark, str(landing), work, database="flow_retry")
            raise AssertionError("must fail")
        except ZeroDivisionError:
            pass
    dead = flow.read_dead_letters(spark, work).collect()
    assert [r["error_type"] for r in dead] == ["ZeroDivisionError"]
    out = flow.run_flow(spark, str(landing), work, database="flow_retry")
    assert out.processed().count() == 1
    assert spark.table(out.tables[rollups.VIP]).first()["total_spent"] == 3.0
    # The letter of the failed run stays, and has an alert with error and cause.
    assert flow.read_dead_letters(spark, work).count() == 1
    alert = json.loads(flow.flow_alerts(spark, work).first()["payload"])
    assert (alert["error"], alert["cause"]) == ("ZeroDivisionError", "division by zero")


def test_wider_types_and_changes(spark, tmp_path):
    from pyspark.sql import types as T
    ddl = T.StructType.fromDDL
    wider = lambda a, b: catalog.wider_type(ddl(f"x {a}")[0].dataType, ddl(f"x {b}")[0].dataType).simpleString()
    for a, b, want in (("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("float", "int", "double"),
                       ("date", "timestamp", "timestamp"), ("int", "date", "string"), ("string", "int", "string"),
                       ("boolean", "boolean", "boolean")):
        assert wider(a, b) == want, (a, b)
    schema, log = catalog.evolve(ddl("a int, b string"), ddl("A double, c date"))
    assert schema.simpleString() == "struct<a:double,b:string,c:date>"
    assert log == [("a", "retyped", "int", "double", "double"), ("b", "vanished", "string", None, "string"),
                   ("c", "added", None, "date", "date")]
    folders = [str(tmp_path / n) for n in "xy"]
    spark.sql("SELECT 1 AS a, 'p' AS b").write.parquet(folders[0])
    spark.sql("SELECT 2.5D AS a").write.parquet(folders[1])
    assert catalog.register_evolving(spark, "orderlake_test.evolving", folders) == [
        (2, "a", "retyped", "int", "double", "double"), (2, "b", "vanished", "string", None, "string")]
    assert _bag(spark.table("orderlake_test.evolving").fillna("-")) == [(1.0, "p"), (2.5, "-")]


def test_one_stamped_object_per_file(spark, tmp_path):
    import datetime

    from orderlake.plans.events import run_events
    from orderlake.plans.ingest import ingest
    from orderlake.sinks import read_file_objects
    head = "OrderID,CustomerEmail,Country,Product,Quantity,UnitPrice,OrderDate,TotalAmount\n"
    landing = tmp_path / "landing"
    landing.mkdir()
    text = head + "1,a@b.com,Perú,Pen,2,1.5,2024-01-02,\n2,a@b.com,Peru,Pen,x,1.5,2024-01-02,3\r\n"
    (landing / "a.csv").write_bytes(text.encode())
    (landing / "b.csv").write_text(head + "3,a@b.com,Peru,Pen,1,1.5,2024-01-02,1")
    (landing / "bad.csv").write_text(head + "x,a@b.com,Peru,Pen,1,1.5,2024-01-02,1\n")
    ing = ingest(spark, str(landing))
    ing.stamp = datetime.datetime(2024, 5, 6, 7, 8, 9)
    path = ing.write_objects(str(tmp_path / "processed"))
    keys = {r["source_file"].rsplit("/", 1)[-1]: r["output_key"] for r in ing.run_summary().collect()}
    held = {r["object"]: r["n"] for r in read_file_objects(spark, path).groupBy("object").agg(F.count("*").alias("n")).collect()}
    assert keys.keys() == {"a.csv", "b.csv"} and held == {keys["a.csv"]: 1, keys["b.csv"]: 1}
    assert all(k.startswith("orders_processed_20240506070809_") for k in held)
    log = run_events(ing, "out", "req").orderBy("seq", "row").collect()
    of = lambda n: [(r["event"], json.loads(r["record"])) for r in log if r["source_file"].endswith(n)]
    assert [e for e, _ in of("a.csv")] == [
        "invocation_start", "s3_read_start", "s3_read_done", "total_amount_computed", "row_skipped", "cleaning_done",
        "s3_write_start", "s3_write_done", "processing_success", "response"]
    records = dict(of("a.csv"))
    assert records["s3_read_done"] == {"event": "s3_read_done", "key": "a.csv", "bytes": len(text)}
    assert json.loads(records["response"]["body"]) == {
        "message": "File processed successfully", "output_key": keys["a.csv"], "rows_written": 1}
    assert [e for e, _ in of("bad.csv")][-1] == "processing_failed"
