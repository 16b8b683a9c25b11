"""Records of raw CSV files against Python's csv module, at any split size."""

import csv
import io
import random

import pytest

from orderlake.schemas import RAW_COLUMNS
from orderlake.session import staged
from orderlake.sources import raw_csv

H = ",".join(RAW_COLUMNS)


def scan(spark, landing):
    text = raw_csv.raw_text(spark, str(landing))
    parts = staged(raw_csv.segment_checks(text), "t-segments")
    return raw_csv.scan_raw(text, parts, staged(raw_csv.file_checks(parts), "t-checks"))


def rows_by_file(raw):
    out = {}
    for r in sorted(raw.collect(), key=lambda r: (r["source_file"], r["block_start"], r["mid"])):
        out.setdefault(r["source_file"].rsplit("/", 1)[-1], []).append(
            ("error", r["_csv_error"]) if r["_csv_error"] else tuple(r[c] for c in RAW_COLUMNS))
    return {f: rows[1:] for f, rows in out.items()}  # record 0 is the header


def expected(text):
    reader, rows = csv.DictReader(io.StringIO(text)), []
    try:
        for row in reader:
            rows.append(tuple(row.get(c) for c in RAW_COLUMNS))
    except csv.Error as e:
        rows.append(("error", str(e)))
    return rows


@pytest.fixture
def split_bytes(spark):
    def set_to(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)
    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("split", ["48b", "1m"])
def test_random_files_like_the_csv_module(spark, tmp_path, split_bytes, split):
    r = random.Random(5)
    bits = ["a", "bc", '"', '"', '""', ",", ",", "\n", "\n", "\r\n", " ", "é", ',"x\ny",', '"p""q",']
    texts = {}
    for i in range(50):
        body = "".join(r.choices(bits if i % 3 else bits + ["\r"], k=r.randint(0, 60)))
        texts[f"f{i}.csv"] = f"{H}\n{body}"
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    split_bytes(split)
    raw, _ = scan(spark, tmp_path)
    got = rows_by_file(raw)
    for name, text in texts.items():
        want = expected(text)
        have = got[name][:len(want)] if want and want[-1][0] == "error" else got[name]
        assert have == want, (name, text)
    assert any(w and w[-1][0] == "error" for w in map(expected, texts.values()))


def test_one_long_file_of_quoted_breaks(spark, tmp_path, split_bytes):
    rows = [[str(i), "2024-01-05", "a@b.com", "it", f'line one {i}\nline "two"\n\nfour', "1", "2.5", "2.5"]
            for i in range(3000)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([RAW_COLUMNS, *rows])
    (tmp_path / "long.csv").write_text(out.getvalue())
    results = []
    for split in ("8k", "64k", "128m"):
        split_bytes(split)
        raw, checks = scan(spark, tmp_path)
        kept = staged(raw, "t-raw")
        results.append([tuple(r) for r in kept.orderBy("block_start", "mid").select(*RAW_COLUMNS).collect()])
        blocks = kept.select("block_start").distinct().count()
        assert blocks > 10 if split == "8k" else blocks >= 1
    assert results[0][1:] == [tuple(r) for r in rows] and results[0] == results[1] == results[2]


def test_headers_of_any_order_and_form(spark, tmp_path):
    def write(name, header, row):
        (tmp_path / name).write_text(f"{header}\n{row}\n")
    plain = "1,2024-01-05,a@b.com,it,pen,1,2.5,2.5"
    for i in range(3):
        write(f"plain{i}.csv", H, plain)
    write("turned.csv", ",".join(reversed(RAW_COLUMNS)), ",".join(reversed(plain.split(","))))
    write("wide.csv", "x,y," + H, "0,0," + plain)
    write("twice.csv", H + ",OrderID", plain + ",9")
    write("short.csv", "OrderID,Product", "1,pen")
    write("quoted name, with comma.csv", '"a\nb",' + H, "0," + plain)
    write("tail.csv", H, '"1"0,2024-01-05,a@b.com,it,"p""e"n"x",1,2.5,2.5')
    raw, checks = scan(spark, tmp_path)
    got = rows_by_file(raw)
    want = tuple(plain.split(","))
    for name in ("plain0.csv", "plain2.csv", "turned.csv", "wide.csv", "quoted%20name,%20with%20comma.csv"):
        assert got[name] == [want], name
    assert got["twice.csv"] == [("9", *want[1:])]
    assert got["short.csv"] == [("1", None, None, None, "pen", None, None, None)]
    assert got["tail.csv"] == [("10", *want[1:4], 'p"en"x"', *want[5:])]
    absent = {r["source_file"].rsplit("/", 1)[-1]: r["_absent_Country"] for r in raw.collect()}
    assert absent["short.csv"] and not absent["wide.csv"]
    rows = raw_csv.without_headers(raw)
    assert rows.count() == 9 and rows.columns == ["source_file", *RAW_COLUMNS]


def test_field_limit_and_unclosed_quote(spark, tmp_path):
    big = "x" * (csv.field_size_limit() + 1)
    (tmp_path / "big.csv").write_text(f"{H}\n1,{big},a,b,c,1,1,1\n")
    (tmp_path / "open.csv").write_text(H + '\n1,"never closed,\n' + "2,2024-01-05\n" * 20000)
    got = rows_by_file(scan(spark, tmp_path)[0])
    assert got["big.csv"] == [("error", raw_csv.FIELD_LIMIT_ERROR)] == expected((tmp_path / "big.csv").read_text())
    assert got["open.csv"] == [("error", raw_csv.FIELD_LIMIT_ERROR)] == expected((tmp_path / "open.csv").read_text())


def test_listing_shows_empty_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "none.csv").write_bytes(b"")
    (tmp_path / "a b.csv").write_text(H + "\n")
    (tmp_path / "c.txt").write_text("x")
    found = {r["source_file"].rsplit("/", 1)[-1]: r["file_size"] for r in raw_csv.listing(spark, str(tmp_path)).collect()}
    assert found == {"none.csv": 0, "a%20b.csv": len(H) + 1}


def test_checks_aggregate_by_hash(spark, tmp_path):
    (tmp_path / "a.csv").write_text(H + "\n")
    text = raw_csv.raw_text(spark, str(tmp_path))
    plan = raw_csv.segment_checks(text)._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "Sort" not in plan
