"""Driver contract: entry runs, every query has a name-matched oracle or is
rows-only by design, and a sample of queries match DuckDB at sf 0.001."""

import duckdb
import pytest

import __spark_entry__ as entry

ROWS_ONLY = {"dead_letters_json", "failure_alerts"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["customer_email", "total_spent", "order_count"]


def test_every_query_has_an_oracle():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(entry.QUERIES) - set(o) <= ROWS_ONLY
    assert set(o) <= set(q)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def norm(v):
        return round(v, 6) if isinstance(v, float) else v
    return [cols[i] for i in order], sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("name", ["clean_orders", "vip_customers", "rollups_one_pass",
                                  "reject_reason", "rejects", "poison_files", "dead_letter_alarm",
                                  "published_orders", "repairs"])
def test_query_matches_oracle(spark, sf, name):
    con = duckdb.connect()
    for t in ["lineitem", "orders", "customer", "nation", "part", "events"]:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = entry.queries()[name](spark, sf)
    res = con.sql(entry.oracle_sql()[name])
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(res.columns, res.fetchall())
