"""Incremental arrival: two availableNow runs with a file added in between
equal one batch run, with nothing ingested twice."""

from pyspark.sql import functions as F

from orderlake.operators.rollups import vip_customers
from orderlake.plans.ingest import ingest
from orderlake.session import unique_path
from orderlake.sources.fixture import stage_raw_files
from orderlake.streaming.file_ingest import clean_rows, ingest_stream, read_rollup, read_stream_output


def _bag(df):
    return sorted(tuple(r) for r in df.collect())


def test_incremental_equals_batch(spark, sf):
    base = unique_path(spark, "t-landing")
    ckpt, out = unique_path(spark, "t-ckpt"), unique_path(spark, "t-out")
    stage_raw_files(spark, sf, where=F.col("file_no") < 150, path=f"{base}/a")
    ingest_stream(spark, base, out, ckpt)
    first = clean_rows(spark, out).count()
    stage_raw_files(spark, sf, where=F.col("file_no") >= 150, path=f"{base}/b")
    ingest_stream(spark, base, out, ckpt)
    ingest_stream(spark, base, out, ckpt)  # nothing new: no new batch, no duplicates
    streamed = clean_rows(spark, out)
    batch = ingest(spark, base).published()
    assert 0 < first < streamed.count()
    assert _bag(streamed) == _bag(batch)
    batches = read_stream_output(spark, out).select("batch_id").distinct().count()
    assert batches == 2
    dead = read_stream_output(spark, out, "dead_letters")
    assert dead.count() == ingest(spark, base).outcomes.where(F.col("error").isNotNull()).count()


def test_empty_file_in_the_stream(spark, tmp_path):
    head = "OrderID,CustomerEmail,Country,Product,Quantity,UnitPrice,OrderDate,TotalAmount\n"
    landing, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    landing.mkdir()
    (landing / "a.csv").write_text(head + "1,a@b.com,Peru,Pen,2,1.5,2024-01-02,3.0\n")
    (landing / "none.csv").write_bytes(b"")
    for _ in range(2):
        ingest_stream(spark, str(landing), out, ckpt)
        dead = read_stream_output(spark, out, "dead_letters").collect()
        assert [(r["key"], r["error_type"]) for r in dead] == [("none.csv", "ValueError")]
    assert clean_rows(spark, out).count() == 1


def test_empty_landing_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    out = str(tmp_path / "out")
    ingest_stream(spark, str(tmp_path / "in"), out, str(tmp_path / "ckpt"))
    assert clean_rows(spark, out).count() == read_stream_output(spark, out, "dead_letters").count() == 0


def test_stream_keeps_all_outputs_current(spark, sf, tmp_path):
    base, out = str(tmp_path / "in"), str(tmp_path / "out")
    for k, some in enumerate((F.col("file_no") < 30, F.col("file_no").between(30, 60))):
        stage_raw_files(spark, sf, where=some, path=f"{base}/{k}")
        ingest_stream(spark, base, out, str(tmp_path / "ckpt"))
    batch = ingest(spark, base)
    pub = read_stream_output
    for name, want in (("repairs", batch.repairs()), ("rejects", batch.rejects()), ("metrics", batch.metrics())):
        assert _bag(pub(spark, out, name).drop("batch_id").select(*want.columns)) == _bag(want), name
    want = vip_customers(batch.published())
    assert _bag(read_rollup(spark, out, "vip_customers").select(*want.columns)) == _bag(want)
    assert _bag(pub(spark, out, "orders").select("order_id")) == _bag(batch.published().select("order_id"))
