"""Incremental runs: only new files are read, corrected files replace their
rows, nothing half-done is ever visible."""

import os

import pytest
from pyspark.sql import functions as F

from orderlake.operators import rollups
from orderlake.plans import incremental
from orderlake.plans.flow import run_flow
from orderlake.plans.ingest import ingest
from orderlake.sinks.manifest import Entry, Published
from orderlake.sources.fixture import stage_raw_files

HEAD = "OrderID,CustomerEmail,Country,Product,Quantity,UnitPrice,OrderDate,TotalAmount\n"


def row(i, day, total, who="a@b.com"):
    return f"{i},{who},Peru,Pen,2,1.5,{day},{total}\n"


def write(path, text, at):
    path.write_text(HEAD + text)
    os.utime(path, (at, at))


def bag(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


def test_corrected_file_moves_its_rows(spark, landing, tmp_path):
    work = str(tmp_path / "work")
    write(landing / "a.csv", row(1, "2024-02-01", 3), 1000)
    write(landing / "b.csv", row(2, "2024-02-02", 5), 1000)
    first = run_flow(spark, str(landing), work, database="inc_corrected")
    assert first.refresh.files_read == 2
    write(landing / "b.csv", row(2, "2024-03-03", 7), 2000)
    second = run_flow(spark, str(landing), work, database="inc_corrected")
    assert second.refresh.files_read == 1
    orders = spark.table(second.tables["orders"])
    assert bag(orders.select("order_id", "year", "month", "day")) == [(1, "2024", "02", "01"), (2, "2024", "03", "03")]
    vip = spark.table(second.tables[rollups.VIP]).first()
    assert (vip["total_spent"], vip["order_count"]) == (10.0, 2)
    third = run_flow(spark, str(landing), work, database="inc_corrected")
    assert third.ingest is None and third.refresh.version == second.refresh.version


def test_same_as_one_full_run(spark, sf, tmp_path):
    base, work, once = str(tmp_path / "landing"), str(tmp_path / "work"), str(tmp_path / "once")
    for k, some in enumerate((F.col("file_no") < 12, F.col("file_no").between(12, 24), F.col("file_no").between(25, 33))):
        stage_raw_files(spark, sf, where=some, path=f"{base}/part{k}")
        done = incremental.refresh(spark, base, work, fold_after=2)
    assert len({e.batch for e in done.entries if e.batch != incremental.CURRENT}) == 2  # two were folded
    full = incremental.refresh(spark, base, once)
    assert full.files_read > done.files_read > 0
    a, b = Published(spark, work), Published(spark, once)
    for name in ("clean", "orders", "rejects", "repairs", "metrics", "ledger"):
        assert bag(a.read(name, incremental.SCHEMAS[name])) == bag(b.read(name, incremental.SCHEMAS[name])), name
    for name in rollups.ROLLUP_KEYS:
        frames = [spark.read.parquet(next(e.folder for e in r.entries if e.output == name)) for r in (done, full)]
        assert bag(frames[0]) == bag(frames[1]), name
    assert bag(a.read("clean", incremental.CLEAN_ROWS).drop("source_file")) == bag(ingest(spark, base).published())


def test_failure_between_outputs_shows_nothing(spark, landing, tmp_path, monkeypatch):
    work = str(tmp_path / "work")
    write(landing / "a.csv", row(1, "2024-02-01", 3), 1000)
    incremental.refresh(spark, str(landing), work)
    pub = Published(spark, work)
    before = pub.current(), bag(pub.read("clean", incremental.CLEAN_ROWS))
    write(landing / "a.csv", row(1, "2024-02-09", 4), 2000)
    write(landing / "c.csv", row(3, "2024-02-03", 1), 2000)
    real = Published.write
    for broken in ("rejects", "partials"):
        def failing(self, output, batch, df, broken=broken):
            if output == broken and batch == "b00000002":
                raise OSError("lost")
            return real(self, output, batch, df)
        with monkeypatch.context() as m:
            m.setattr(Published, "write", failing)
            with pytest.raises(OSError):
                incremental.refresh(spark, str(landing), work)
        assert (pub.current(), bag(pub.read("clean", incremental.CLEAN_ROWS))) == before, broken
    done = incremental.refresh(spark, str(landing), work)
    assert done.version == 2 and done.files_read == 2
    rows = pub.read("orders", incremental.SCHEMAS["orders"])
    assert bag(rows.select("order_id", "day")) == [(1, "09"), (3, "03")]


def test_empty_landing_and_empty_files(spark, landing, tmp_path):
    work = str(tmp_path / "work")
    first = run_flow(spark, str(landing), work, database="inc_empty")
    assert spark.table(first.tables["orders"]).count() == spark.table(first.tables[rollups.VIP]).count() == 0
    (landing / "none.csv").write_bytes(b"")
    run_flow(spark, str(landing), work, database="inc_empty")
    letters = Published(spark, work).read("dead_letters", incremental.SCHEMAS["dead_letters"])
    assert [r["key"] for r in letters.collect()] == ["none.csv"]
    assert run_flow(spark, str(landing), work, database="inc_empty").ingest is None
    write(landing / "none.csv", row(1, "2024-02-01", 3), 1000)  # its content has come
    last = run_flow(spark, str(landing), work, database="inc_empty")
    assert spark.table(last.tables["orders"]).count() == 1
    assert Published(spark, work).read("dead_letters", incremental.SCHEMAS["dead_letters"]).count() == 0


def test_manifest_versions(spark, tmp_path):
    pub = Published(spark, str(tmp_path / "pub"))
    assert pub.current() == (0, []) and pub.read("x", "a int").count() == 0
    one = pub.write("x", "b1", spark.range(3).selectExpr("cast(id as int) a"))
    assert pub.read("x", "a int").count() == 0  # written, not listed
    pub.commit(0, [one])
    assert pub.current() == (1, [one]) and pub.read("x", "a int").count() == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        pub.commit(0, [])
    pub.commit(1, [Entry("y", "b1", one.folder)])
    assert pub.read("x", "a int").count() == 0
    assert {r["batch_id"] for r in Published(spark, pub.root).read("x", "a int", [one], with_batch=True).collect()} == {"b1"}
