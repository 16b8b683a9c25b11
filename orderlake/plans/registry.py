"""Registered queries: one per operator of the inventory, each reading the
driver's tables (or data Spark derives from them) at a scale directory.

Row-level operators run on the raw-order fixture derived from the tables.
File-level operators run on the same fixture written as 400 CSV files into
the shared scratch folder (once per session) and report the file's number
(``file_no``, from its folder name) instead of its scratch path.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (date_parts, normalize_country, normalize_date, normalize_email,
                         normalize_product, parse_float, parse_int, total_with_fallback)
from ..operators import monitor, rollups
from ..operators.classify import ACCEPTED, accepted, classify
from ..schemas import CLEAN, CLEAN_COLUMNS, FINAL_ORDERS, RAW_COLUMNS
from ..session import ensure_conf, staged, unique_path
from ..sinks import (read_file_objects, write_clean_csv, write_orders_parquet, write_rollup_csv,
                     write_rollup_parquet)
from ..sources import catalog, raw_csv
from ..sources.fixture import (raw_order_files_frame, raw_orders, read_table, stage_raw_files, upload_raw_files,
                               write_raw_files)
from ..streaming.alarm import live_alarm
from ..streaming.file_ingest import clean_rows, ingest_stream
from . import sql as adhoc
from .events import run_events
from .flow import FlowResult, run_flow
from .incremental import SCHEMAS
from .ingest import Ingest, ingest

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered checks.
CHECK_AS_OF = "2024-02-01 00:00:00"
CHECK_REQUEST_ID = "orderlake-check"
CHECK_YEAR = "1997"

def _file_no():
    """The fixture file's number, from its folder name ``file_no=N``."""
    return F.regexp_extract("source_file", r"file_no=(\d+)", 1).cast("long").alias("file_no")

_INGESTS: dict[tuple, Ingest] = {}


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    return classify(raw_orders(spark, sf))


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return accepted(_classified(spark, sf))


def _files(spark: SparkSession, sf: str) -> Ingest:
    """Ingest of the staged fixture files, planned once per session."""
    key = (sf.rstrip("/"), spark.sparkContext.applicationId)
    if key not in _INGESTS:
        _INGESTS[key] = ingest(spark, stage_raw_files(spark, sf))
    return _INGESTS[key]


_FINAL: dict[tuple, str] = {}


def _final_orders(spark: SparkSession, sf: str) -> str:
    """The date-partitioned orders dataset, written once per session."""
    key = (sf.rstrip("/"), spark.sparkContext.applicationId)
    if key not in _FINAL:
        path = unique_path(spark, "final-orders")
        write_orders_parquet(_clean(spark, sf), path)
        _FINAL[key] = path
    return _FINAL[key]


# ---- scalar functions ------------------------------------------------------

def q_normalize_date(spark, sf):
    return raw_orders(spark, sf).select(F.col("OrderDate").alias("order_date_text"),
                                        normalize_date("OrderDate").alias("order_date"))


def q_normalize_email(spark, sf):
    return raw_orders(spark, sf).select(F.col("CustomerEmail").alias("email_text"),
                                        normalize_email("CustomerEmail").alias("customer_email"))


def q_normalize_country(spark, sf):
    return raw_orders(spark, sf).select(F.col("Country").alias("country_text"),
                                        normalize_country("Country").alias("country"))


def q_normalize_product(spark, sf):
    return raw_orders(spark, sf).select(F.col("Product").alias("product_text"),
                                        normalize_product("Product").alias("product"))


def q_parse_quantity(spark, sf):
    return raw_orders(spark, sf).select(F.col("Quantity").alias("quantity_text"),
                                        parse_int("Quantity").alias("quantity"))


def q_parse_unit_price(spark, sf):
    return raw_orders(spark, sf).select(F.col("UnitPrice").alias("unit_price_text"),
                                        parse_float("UnitPrice").alias("unit_price"))


def q_total_amount_fallback(spark, sf):
    r = raw_orders(spark, sf).select(
        F.col("TotalAmount").alias("total_text"),
        parse_int("Quantity").alias("quantity"), parse_float("UnitPrice").alias("unit_price"))
    return (r.where(F.col("quantity").isNotNull() & F.col("unit_price").isNotNull())
            .select("total_text", "quantity", "unit_price",
                    total_with_fallback("total_text", "quantity", "unit_price").alias("total_amount")))


def q_date_parts(spark, sf):
    # order_date, year, month and day are columns of the classified frame.
    return (_classified(spark, sf).where(F.col("order_date").isNotNull())
            .select("order_date", "year", "month", "day"))


# ---- projection, filters, quality outputs on the row fixture ---------------

def q_clean_orders(spark, sf):
    return _clean(spark, sf)


def _reject(reason: str, *cols: str):
    def q(spark, sf):
        return (_classified(spark, sf).where(F.col("reason") == reason)
                .select("raw_order_id", *cols))
    return q


def q_reject_reason(spark, sf):
    return _classified(spark, sf).select("raw_order_id", "status", "reason")


def q_reject_profile(spark, sf):
    c = _classified(spark, sf)
    return c.groupBy("status", "reason").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("total_was_computed")).alias("computed_totals"),
        F.count_if((F.col("status") == ACCEPTED) & F.isnan("total_amount")).alias("nan_totals"))


# ---- rollups -----------------------------------------------------------------

def q_vip(spark, sf):
    return rollups.vip_customers(_clean(spark, sf))


def q_market(spark, sf):
    return rollups.market_performance(_clean(spark, sf))


def q_product(spark, sf):
    return rollups.product_performance(_clean(spark, sf))


def q_one_pass(spark, sf):
    return rollups.rollups_one_pass(_clean(spark, sf))


def q_partition_labels(spark, sf):
    return rollups.with_partition_labels(rollups.vip_customers(_clean(spark, sf)))


# ---- raw CSV layer and file gates -----------------------------------------------

def q_scan_raw_csv(spark, sf):
    text = raw_csv.raw_text(spark, stage_raw_files(spark, sf))
    parts = staged(raw_csv.segment_checks(text), "segment-checks")
    raw, _ = raw_csv.scan_raw(text, parts, staged(raw_csv.file_checks(parts), "file-checks"))
    return raw_csv.without_headers(raw).select(_file_no(), *RAW_COLUMNS)


def q_header_check(spark, sf):
    return _files(spark, sf).checks.select(_file_no(), "header", "utf8_ok", "error")


def q_published_orders(spark, sf):
    return _files(spark, sf).published()


def q_poison_files(spark, sf):
    o = _files(spark, sf).outcomes
    return o.where(F.col("poison_row").isNotNull()).select(_file_no(), "poison_row", "error")


def q_no_valid_rows(spark, sf):
    o = _files(spark, sf).outcomes
    return (o.where(F.col("poison_row").isNull() & (F.col("rows_accepted") == 0))
            .select(_file_no(), "rows_skipped", "error"))


def q_rejects(spark, sf):
    return _files(spark, sf).rejects().select(_file_no(), "row", "reason", "value", "detail",
                                              "raw_order_id")


def q_repairs(spark, sf):
    return _files(spark, sf).repairs().select(_file_no(), "row", "raw_order_id", "computed")


def q_ingest_metrics(spark, sf):
    return _files(spark, sf).metrics().select(_file_no(), "rows_accepted", "rows_skipped")


def _dead(spark, sf):
    return _files(spark, sf).dead_letters(as_of=CHECK_AS_OF, request_id=CHECK_REQUEST_ID)


def q_dead_letters(spark, sf):
    return _dead(spark, sf).select(_file_no(), "error", "timestamp", "request_id")


def _parsed(payload: str, fields: str):
    """A JSON payload as columns; the landing folder, a scratch path, is cut
    from the bucket, and the key is reduced to its folder."""
    body = F.from_json(payload, f"bucket string, key string, {fields}")
    return [_file_no(), F.col("source_file").startswith(body["bucket"]).alias("in_bucket"),
            F.regexp_extract(body["key"], "^(file_no=[0-9]+)/", 1).alias("key_folder"),
            *[body[f.split()[0]].alias(f.split()[0]) for f in fields.split(", ")]]


def q_dead_letters_json(spark, sf):
    return monitor.dead_letter_json(_dead(spark, sf)).select(
        *_parsed("body", "error string, timestamp string, request_id string"))


def q_failure_alerts(spark, sf):
    return monitor.failure_alerts(_dead(spark, sf)).select(
        *_parsed("payload", "error string, cause string"))


def _stamped(spark, sf) -> Ingest:
    return replace(_files(spark, sf), stamp=datetime.fromisoformat(CHECK_AS_OF))


def q_run_summary(spark, sf):
    """Each published file's summary, and the rows of the object it names."""
    ing = _stamped(spark, sf)
    path = ing.write_objects(unique_path(spark, "processed-objects"))
    held = read_file_objects(spark, path).groupBy(F.col("object").alias("output_key")).agg(
        F.count("*").alias("rows_in_object"), F.round(F.sum("total_amount"), 2).alias("total_in_object"))
    return ing.run_summary().join(held, "output_key", "left").select(
        _file_no(), "message", F.regexp_extract("output_key", "^(.*)_[0-9a-f]+$", 1).alias("key_stamp"),
        "rows_written", "rows_in_object", "total_in_object")


def q_run_events(spark, sf):
    """The log of a run, its records read back."""
    log = run_events(_stamped(spark, sf), "processed", CHECK_REQUEST_ID)
    fields = ("reason string, value string, detail string, computed double, rows_accepted long, rows_skipped long, "
              "rows long, rows_written long, error string, request_id string, statusCode int, body string")
    r = F.from_json("record", f"event string, {fields}")
    names = [f.split()[0] for f in fields.split(", ")]
    parsed = log.select(_file_no(), "seq", "row", "event", *[r[n].alias(n) for n in names if n != "body"],
                        F.get_json_object(r["body"], "$.message").alias("message"),
                        F.get_json_object(r["body"], "$.rows_written").cast("long").alias("body_rows"))
    return parsed.withColumnRenamed("statusCode", "status_code")


# ---- dead-letter queue monitoring on `events` -------------------------------------

def _error_events(spark, sf):
    return read_table(spark, sf, "events").where(F.col("event_type") == "error").select("event_id", "ts")


def q_retention(spark, sf):
    return monitor.retained(_error_events(spark, sf))


def q_alarm(spark, sf):
    return monitor.backlog_alarm(_error_events(spark, sf))


def q_live_alarm(spark, sf):
    """The live alarm over the error events, which arrive in three files by
    time, until the last one has expired (a tick moves time on)."""
    events = staged(_error_events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp")), "queue")
    folder, out = unique_path(spark, "queue-in"), unique_path(spark, "queue-out")
    cuts = events.agg(F.percentile_approx(F.unix_micros("ts"), [1 / 3, 2 / 3]).alias("cuts"), F.max("ts").alias("last"))
    (low, high), last = cuts.select("cuts", F.unix_micros("last").alias("last")).first()
    at = F.unix_micros("ts")
    tick = spark.range(1).select(F.lit(None).cast("long").alias("event_id"), F.timestamp_micros(
        F.lit(last + (14 * 1440 + 20) * 60_000_000)).alias("ts"))
    for part in (events.where(at <= low), events.where((at > low) & (at <= high)), events.where(at > high), tick):
        part.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(folder)
    query = (live_alarm(stream).writeStream.format("parquet").outputMode("append").option("path", out)
             .option("checkpointLocation", unique_path(spark, "queue-ckpt")).trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(out).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                                          "arrivals", "backlog", "state")


# ---- sinks (write, read back) ----------------------------------------------------

def q_sink_clean_csv(spark, sf):
    path = write_clean_csv(_clean(spark, sf), unique_path(spark, "clean-csv"), mode="overwrite")
    return (spark.read.schema(CLEAN).option("header", "true").option("escape", '"')
            .csv(path))


def q_sink_rollup_csv(spark, sf):
    path = write_rollup_csv(rollups.vip_customers(_clean(spark, sf)),
                            unique_path(spark, "vip-csv"))
    return (spark.read.schema("customer_email string, total_spent double, order_count long")
            .option("header", "true").option("escape", '"').csv(path))


def q_sink_rollup_parquet(spark, sf):
    ensure_conf(spark)
    path = write_rollup_parquet(rollups.product_performance(_clean(spark, sf)),
                                unique_path(spark, "product-parquet"))
    return spark.read.parquet(path)


def q_sink_orders_parquet(spark, sf):
    path = write_orders_parquet(_clean(spark, sf), unique_path(spark, "orders-parquet"))
    return catalog.read_final_orders(spark, path)


# ---- catalog and SQL -------------------------------------------------------------------

def q_scan_catalog_orders(spark, sf):
    path = _final_orders(spark, sf)
    table = catalog.register_final_orders(spark, f"orderlake_check.orders_{path[-12:]}", path)
    return catalog.read_catalog_orders(spark, table).select(*CLEAN_COLUMNS)


def q_scan_final_orders_by_day(spark, sf):
    return catalog.read_final_orders(spark, _final_orders(spark, sf), year=CHECK_YEAR)


def q_discover_schema(spark, sf):
    path = write_clean_csv(_clean(spark, sf), unique_path(spark, "processed-csv"), mode="overwrite")
    return catalog.schema_rows(spark, "orders", catalog.discover_csv_schema(spark, path))


def q_discover_schema_parquet(spark, sf):
    return catalog.schema_rows(spark, "final_orders",
                               catalog.discover_parquet_schema(spark, _final_orders(spark, sf)))


def q_schema_evolution(spark, sf):
    """Registered before ``country`` is known, then again with it: the table
    stays, and all its rows show the new column."""
    path = _final_orders(spark, sf)
    table = f"orderlake_check.evolving_{path[-12:]}"
    parts = ("year", "month", "day")
    early = T.StructType([f for f in FINAL_ORDERS.fields if f.name != "country"])
    catalog.register_table(spark, table, path, schema=early, partitioned_by=parts)
    catalog.register_table(spark, table, path, schema=FINAL_ORDERS, partitioned_by=parts)
    return spark.table(table).groupBy("year").agg(
        F.count(F.lit(1)).alias("rows"), F.count("country").alias("with_country"),
        F.count_distinct("country").alias("countries"))


_EVOLVED: dict[tuple, tuple[str, list]] = {}


def _evolved(spark, sf) -> tuple[str, list]:
    """The clean orders as three deliveries of other schemas, by year: to 1994
    without country, with a channel and small quantities; to 1996 with country,
    without channel; then with whole prices and order ids as text."""
    key = (sf.rstrip("/"), spark.sparkContext.applicationId)
    if key not in _EVOLVED:
        clean, year = staged(_clean(spark, sf), "evolving"), F.col("year")
        first = clean.where(year <= 1994).drop("country").withColumn("channel", F.lit("web")).withColumn(
            "quantity", F.col("quantity").cast("int"))
        second = clean.where((year > 1994) & (year <= 1996))
        third = clean.where(year > 1996).withColumn("unit_price", F.floor("unit_price").cast("bigint")).withColumn(
            "order_id", F.col("order_id").cast("string"))
        folders = [unique_path(spark, f"delivery-{i}") for i in (1, 2, 3)]
        for part, folder in zip((first, second, third), folders):
            part.write.parquet(folder)
        table = f"orderlake_check.deliveries_{folders[0][-12:]}"
        _EVOLVED[key] = table, catalog.register_evolving(spark, table, folders)
    return _EVOLVED[key]


def q_schema_changes(spark, sf):
    """The log of changed columns, with the rows of each delivery."""
    table, log = _evolved(spark, sf)
    version = F.when(F.col("year") <= 1994, 1).when(F.col("year") <= 1996, 2).otherwise(3)
    rows = spark.table(table).groupBy(version.alias("version")).agg(F.count("*").alias("rows"))
    return spark.createDataFrame(log, catalog.CHANGE_LOG).join(rows, "version")


def q_evolved_table(spark, sf):
    """All deliveries read through the evolved table."""
    return spark.table(_evolved(spark, sf)[0]).groupBy("year").agg(
        F.count("*").alias("rows"), F.count("country").alias("with_country"), F.count("channel").alias("with_channel"),
        F.sum("quantity").alias("units"), F.round(F.sum("unit_price"), 2).alias("prices"),
        F.max("order_id").alias("last_order_text"))


def _orders_view(spark, sf) -> str:
    name = "orderlake_final_orders"
    catalog.read_final_orders(spark, _final_orders(spark, sf)).createOrReplaceTempView(name)
    return name


def q_adhoc_daily_revenue(spark, sf):
    return adhoc.run_sql(spark, adhoc.DAILY_REVENUE, orders=_orders_view(spark, sf))


def q_adhoc_top_market(spark, sf):
    return adhoc.run_sql(spark, adhoc.TOP_MARKET_PER_YEAR, orders=_orders_view(spark, sf))


# ---- streaming and jobs -----------------------------------------------------------------

def q_stream_ingest(spark, sf):
    landing = stage_raw_files(spark, sf)
    out = unique_path(spark, "stream-out")
    ingest_stream(spark, landing, out, unique_path(spark, "stream-ckpt"))
    return clean_rows(spark, out)


def q_incremental_rerun(spark, sf):
    base = unique_path(spark, "landing")
    ckpt, out = unique_path(spark, "rerun-ckpt"), unique_path(spark, "rerun-out")
    stage_raw_files(spark, sf, where=F.col("file_no") < 200, path=f"{base}/first")
    ingest_stream(spark, base, out, ckpt)
    stage_raw_files(spark, sf, where=F.col("file_no") >= 200, path=f"{base}/second")
    ingest_stream(spark, base, out, ckpt)
    return clean_rows(spark, out)


def q_end_to_end(spark, sf):
    landing = stage_raw_files(spark, sf)
    work = unique_path(spark, "flow")
    res = run_flow(spark, landing, work, database=f"orderlake_flow_{work[-12:]}", as_of=CHECK_AS_OF)
    return spark.table(res.tables[rollups.VIP])


_TWICE: dict[tuple, FlowResult] = {}


def _two_runs(spark, sf) -> FlowResult:
    """The flow run twice, once per session. First there are the files 0 to
    299, of which 0 to 99 hold what belongs into 300 to 399; then 0 to 99 come
    again with their own rows, and 300 to 399 arrive."""
    key = (sf.rstrip("/"), spark.sparkContext.applicationId)
    if key not in _TWICE:
        base, work = unique_path(spark, "flow-landing"), unique_path(spark, "flow-twice")
        frame = raw_order_files_frame(spark, sf)
        no = F.col("file_no")
        early = frame.where(no >= 100).withColumn("file_no", F.when(no >= 300, no - 300).otherwise(no))
        for rows in (early, frame.where((no < 100) | (no >= 300))):
            upload_raw_files(write_raw_files(rows, unique_path(spark, "upload")), base, spark)
            _TWICE[key] = run_flow(spark, base, work, database=f"orderlake_flow_{work[-12:]}", as_of=CHECK_AS_OF)
    return _TWICE[key]


def q_pipeline_end_to_end(spark, sf):
    return spark.table(_two_runs(spark, sf).tables[rollups.MARKET])


def q_orders_follow_source(spark, sf):
    """The orders dataset after files were corrected and added."""
    return spark.table(_two_runs(spark, sf).tables["orders"])


def q_incremental_rollups(spark, sf):
    """The rollups merged from the partial sums of the batches."""
    run = _two_runs(spark, sf)
    return rollups.merge_partials(run.published.read("partials", SCHEMAS["partials"], run.refresh.entries))


def q_processed_ledger(spark, sf):
    """The files in the state, each once, with the rows it published."""
    run = _two_runs(spark, sf)
    of = lambda name: run.published.read(name, SCHEMAS[name], run.refresh.entries)
    rows = of("clean").groupBy("source_file").agg(F.count("*").alias("rows_published"))
    return (of("ledger").join(rows, "source_file", "left")
            .select(_file_no(), F.coalesce("rows_published", F.lit(0)).alias("rows_published")))


QUERIES: dict[str, Query] = {
    # sources
    "scan_raw_csv": q_scan_raw_csv,
    "header_check": q_header_check,
    "stream_ingest": q_stream_ingest,
    "scan_catalog_orders": q_scan_catalog_orders,
    "discover_schema": q_discover_schema,
    "discover_schema_parquet": q_discover_schema_parquet,
    "schema_evolution": q_schema_evolution,
    "schema_changes": q_schema_changes,
    "evolved_table": q_evolved_table,
    "scan_final_orders_by_day": q_scan_final_orders_by_day,
    # projection and scalar functions
    "clean_orders": q_clean_orders,
    "normalize_date": q_normalize_date,
    "normalize_email": q_normalize_email,
    "normalize_country": q_normalize_country,
    "normalize_product": q_normalize_product,
    "parse_quantity": q_parse_quantity,
    "parse_unit_price": q_parse_unit_price,
    "total_amount_fallback": q_total_amount_fallback,
    "date_parts": q_date_parts,
    "rollup_partition_labels": q_partition_labels,
    "dead_letters_json": q_dead_letters_json,
    # filters and gates
    "reject_invalid_date": _reject("invalid_date", "value"),
    "reject_invalid_quantity": _reject("invalid_quantity", "value", "detail"),
    "reject_invalid_unit_price": _reject("invalid_unit_price", "value"),
    "reject_reason": q_reject_reason,
    "poison_files": q_poison_files,
    "no_valid_rows_files": q_no_valid_rows,
    "published_orders": q_published_orders,
    # quality outputs
    "rejects": q_rejects,
    "repairs": q_repairs,
    "ingest_metrics": q_ingest_metrics,
    "reject_profile": q_reject_profile,
    "dead_letters": q_dead_letters,
    "dead_letter_retention": q_retention,
    "dead_letter_alarm": q_alarm,
    "dead_letter_alarm_live": q_live_alarm,
    "run_summary": q_run_summary,
    "run_events": q_run_events,
    "failure_alerts": q_failure_alerts,
    # aggregations
    "vip_customers": q_vip,
    "market_performance": q_market,
    "product_performance": q_product,
    "rollups_one_pass": q_one_pass,
    # sinks
    "sink_clean_csv": q_sink_clean_csv,
    "sink_rollup_csv": q_sink_rollup_csv,
    "sink_rollup_parquet": q_sink_rollup_parquet,
    "sink_orders_parquet": q_sink_orders_parquet,
    # SQL surface
    "adhoc_sql_daily_revenue": q_adhoc_daily_revenue,
    "adhoc_sql_top_market": q_adhoc_top_market,
    # jobs
    "incremental_rerun": q_incremental_rerun,
    "end_to_end_run": q_end_to_end,
    "pipeline_end_to_end": q_pipeline_end_to_end,
    "incremental_rollups": q_incremental_rollups,
    "orders_follow_source": q_orders_follow_source,
    "processed_ledger": q_processed_ledger,
}
