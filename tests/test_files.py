"""File-level behaviour of the CSV layer (FIXTURES.md §4): each case is its
own file; the outcome is published, skipped rows or a dead letter."""

import pytest

from orderlake.operators.gates import NO_VALID_ROWS_ERROR
from orderlake.plans.ingest import ingest
from orderlake.sources.raw_csv import BAD_ENCODING_ERROR, MISSING_HEADERS_ERROR

H = "OrderID,OrderDate,CustomerEmail,Country,Product,Quantity,UnitPrice,TotalAmount"
GOOD = "1,2024-01-05,a@b.com,italy,Widget,2,1.5,3.0"

FILES = {
    # name: (bytes, expected error or None, expected published rows)
    "reordered.csv": (("TotalAmount,Extra,Product,UnitPrice,Quantity,Country,CustomerEmail,"
                       "OrderDate,OrderID\n9.5,zzz,Gadget,2,3,spain,x@y.com,05/01/2024,7\n")
                      .encode(), None, 1),
    "quoted.csv": ((H + '\n2,2024-01-05,q@q.com,"united, states","Big ""Red""\nWidget",1,2,2\n')
                   .encode(), None, 1),
    "empty.csv": (b"", MISSING_HEADERS_ERROR, 0),
    "blank_first.csv": (("\n" + H + "\n" + GOOD + "\n").encode(), MISSING_HEADERS_ERROR, 0),
    "header_only.csv": ((H + "\n").encode(), NO_VALID_ROWS_ERROR, 0),
    "no_product_col.csv": (("OrderID,OrderDate,CustomerEmail,Country,Quantity,UnitPrice,TotalAmount\n"
                            "1,2024-01-05,a@b.com,italy,2,1.5,3.0\n").encode(), "'Product'", 0),
    "all_rejected.csv": ((H + "\n1,bad,a,b,p,1,1,1\n2,2024-01-01,a,b,p,0,1,1\n").encode(),
                         NO_VALID_ROWS_ERROR, 0),
    "cut_after_email.csv": ((H + "\n" + GOOD + "\n3,2024-01-05,a@b.com\n").encode(),
                            "'NoneType' object has no attribute 'strip'", 0),
    "cut_after_price.csv": ((H + "\n4,2024-01-05,a@b.com,italy,Widget,2,1.5\n").encode(), None, 1),
    "surplus.csv": ((H + "\n" + GOOD + ",extra,more\n").encode(), None, 1),
    "bad_id.csv": ((H + "\nx,2024-01-05,a@b.com,italy,Widget,2,1.5,3.0\n").encode(),
                   "invalid literal for int() with base 10: 'x'", 0),
    "bad_id_bad_date.csv": ((H + "\nx,never,a@b.com,italy,Widget,2,1.5,3.0\n" + GOOD + "\n")
                            .encode(), None, 1),
    "bad_utf8.csv": ((H + "\n" + GOOD + "\n").encode() + b"5,2024-01-05,\xff\xfe,it,W,1,1,1\n",
                     BAD_ENCODING_ERROR, 0),
    "bom.csv": (b"\xef\xbb\xbf" + (H + "\n" + GOOD + "\n").encode(), None, 1),
    "spaces_line.csv": ((H + "\n" + GOOD + "\n   \n").encode(),
                        "'NoneType' object has no attribute 'strip'", 0),
    "spaces_line_date_first.csv": (("OrderDate,OrderID,CustomerEmail,Country,Product,Quantity,"
                                    "UnitPrice,TotalAmount\n2024-01-05,1,a,b,p,1,1,1\n   \n")
                                   .encode(), None, 1),
    "late_break.csv": ((H + "\n" + GOOD + "\n" + 'x"y,2024-01-05,"a\nb",it,W,1,1,1\n').encode(),
                       "invalid literal for int() with base 10: 'x\"y'", 0),
    "blanks_then_reject.csv": (("OrderDate,OrderID,CustomerEmail,Country,Product,Quantity,"
                                "UnitPrice,TotalAmount\n2024-01-05,1,a,b,p,1,1,1\n \t\nbad,2,a,b,p,1,1,1\n")
                               .encode(), None, 1),
    "quotes_in_line.csv": ((H + '\n6,2024-01-05,"q@q.com","a, b","x ""y""",1,2,""\n').encode(), None, 1),
    "notes.txt": (b"not,a,csv\n", None, None),
}


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    landing = tmp_path_factory.mktemp("landing")
    for name, (data, _, _) in FILES.items():
        (landing / name).write_bytes(data)
    ing = ingest(spark, str(landing))
    outcomes = {r["source_file"].rsplit("/", 1)[-1]: r for r in ing.outcomes.collect()}
    published = {}
    for r in ing.published(with_source=True).collect():
        k = r["source_file"].rsplit("/", 1)[-1]
        published[k] = published.get(k, 0) + 1
    return ing, outcomes, published


@pytest.mark.parametrize("name", sorted(FILES))
def test_file_outcome(result, name):
    _, outcomes, published = result
    _, error, rows = FILES[name]
    if rows is None:
        assert name not in outcomes  # not a *.csv object: never picked up
        return
    assert name in outcomes, name
    assert outcomes[name]["error"] == error, name
    assert published.get(name, 0) == rows, name


def test_text_kept_intact(result):
    ing, _, _ = result
    rows = {r["order_id"]: r for r in ing.published().collect()}
    assert rows[2]["country"] == "UNITED, STATES"
    assert rows[2]["product"] == 'Big "Red"\nWidget'
    assert rows[7]["total_amount"] == 9.5 and rows[7]["order_date"].isoformat() == "2024-01-05"
    assert rows[4]["total_amount"] == 3.0  # computed from 2 * 1.5


def test_rejects_and_dead_letters(result):
    ing, _, _ = result
    rejects = {(r["source_file"].rsplit("/", 1)[-1], r["row"]): r["reason"]
               for r in ing.rejects().collect()}
    assert rejects[("all_rejected.csv", 1)] == "invalid_date"
    assert rejects[("all_rejected.csv", 2)] == "invalid_quantity"
    assert rejects[("bad_id_bad_date.csv", 1)] == "invalid_date"
    assert rejects[("spaces_line_date_first.csv", 2)] == "invalid_date"
    assert rejects[("blanks_then_reject.csv", 2)] == "invalid_date"
    assert rejects[("blanks_then_reject.csv", 3)] == "invalid_date"
    types = {r["key"].rsplit("/", 1)[-1]: r["error_type"] for r in ing.dead_letters().collect()}
    assert types["no_product_col.csv"] == "KeyError" and types["bad_id.csv"] == "ValueError"
    assert types["cut_after_email.csv"] == "AttributeError"
    assert types["bad_utf8.csv"] == "UnicodeDecodeError"
    dead = {r["key"].rsplit("/", 1)[-1]: r["error"] for r in ing.dead_letters().collect()}
    assert set(dead) == {n for n, (_, e, rows) in FILES.items() if e is not None}
    repairs = {r["source_file"].rsplit("/", 1)[-1] for r in ing.repairs().collect()}
    assert "cut_after_price.csv" in repairs
    metrics = {r["source_file"].rsplit("/", 1)[-1]: r for r in ing.metrics().collect()}
    assert metrics["all_rejected.csv"]["rows_skipped"] == 2
    assert "bad_id.csv" not in metrics  # the loop never finished


def test_row_numbers_span_splits(spark, tmp_path):
    """Row numbers stay exact when one file is read as many splits."""
    lines = [H] + [f"{i},{'bad' if i % 7 == 0 else '2024-01-05'},a,b,p,1,1,1" for i in range(1, 5001)]
    (tmp_path / "big.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        ing = ingest(spark, str(tmp_path))
        assert ing.segments.count() > 4
        rows = sorted(r["row"] for r in ing.rejects().collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows == [i for i in range(1, 5001) if i % 7 == 0]


def test_row_numbers_survive_another_split_size(spark, tmp_path):
    """Outputs read later, under other settings, number rows as before."""
    lines = [H] + [f"{i},{'bad' if i % 7 == 0 else '2024-01-05'},a,b,p,1,1," for i in range(1, 3001)]
    (tmp_path / "big.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        ing = ingest(spark, str(tmp_path))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
        rejects = sorted(r["row"] for r in ing.rejects().collect())
        repairs = sorted(r["row"] for r in ing.repairs().collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rejects == [i for i in range(1, 3001) if i % 7 == 0]
    assert repairs == [i for i in range(1, 3001) if i % 7]


@pytest.mark.parametrize("split", ["128m", "8k"])
def test_outcomes_at_any_split_size(spark, tmp_path, split):
    """Special lines behind many good ones, in files of several splits."""
    good = (GOOD + "\n") * 600
    cases = {
        "plain.csv": (good + "bad,bad,a,b,p,1,1,1\n", None, 600),
        "blanks.csv": (good + "   \n", "'NoneType' object has no attribute 'strip'", 0),
        "break.csv": (good + '2,2024-01-05,q@q.com,it,"Big\nWidget",1,2,2\n' + good, None, 1201),
        "bad_id.csv": (good + "x,2024-01-05,a,b,p,1,1,1\n",
                       "invalid literal for int() with base 10: 'x'", 0),
    }
    for name, (body, _, _) in cases.items():
        (tmp_path / name).write_text(H + "\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        ing = ingest(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    short = lambda r: r["source_file"].rsplit("/", 1)[-1]
    outcomes = {short(r): r for r in ing.outcomes.collect()}
    assert {n: o["error"] for n, o in outcomes.items()} == {n: e for n, (_, e, _) in cases.items()}
    assert outcomes["blanks.csv"]["poison_row"] == outcomes["bad_id.csv"]["poison_row"] == 601
    assert {short(r): r["count"] for r in ing.published(with_source=True).groupBy("source_file").count().collect()} == {
        n: k for n, (_, e, k) in cases.items() if e is None}
    assert [(short(r), r["row"]) for r in ing.rejects().collect()] == [("plain.csv", 601)]
    assert (ing.segments.count() > 6) == (split == "8k")


def test_no_readable_file(spark, tmp_path):
    (tmp_path / "empty.csv").write_bytes(b"")
    ing = ingest(spark, str(tmp_path))
    assert ing.published().count() == ing.rejects().count() == ing.repairs().count() == 0
    assert [r["error"] for r in ing.dead_letters().collect()] == [MISSING_HEADERS_ERROR]


def test_segment_stats_sorts_nothing(spark, tmp_path):
    from orderlake.operators.gates import segment_stats
    (tmp_path / "a.csv").write_text(H + "\n" + GOOD + "\n")
    plan = segment_stats(ingest(spark, str(tmp_path)).classified)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
