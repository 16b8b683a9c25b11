"""Scalar parsers against Python's own behaviour (FIXTURES.md §4)."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from orderlake.functions import (normalize_country, normalize_date, normalize_email,
                                 normalize_product, parse_float, parse_int, py_repr, pytrim)


def _py_date(s):
    for fmt in ("%Y-%m-%d", "%d/%m/%Y", "%Y/%m/%d"):
        try:
            return datetime.datetime.strptime(s.strip(), fmt).date()
        except ValueError:
            continue
    return None


def _py_int(s):
    try:
        v = int(s)
    except ValueError:
        return None
    return v if -(2**63) <= v < 2**63 else None


def _py_float(s):
    try:
        return float(s)
    except ValueError:
        return None


def _apply(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return dict(df.select("s", fn("s").alias("v")).collect())


DATES = ["2024-01-05", "2024-1-5", "05/01/2024", "5/1/2024", "2024/01/05", "2024/1/5",
         " 2024-01-05 ", "\t2024-01-05", "2024-1- 5", "0001-01-01", "31/12/1969",
         "2024-13-01", "2024-02-30", "29/02/2023", "24-01-05", "0000-01-01", "12024-01-05",
         "+12024-01-05", "2024-001-05", "2024-01-05x", "2024-01-05 10:00", "01-05-2024",
         "2024/01-05", "29/02/2024", "2000-02-29", "1900-02-29", "", "   ", "2024-00-10",
         "2024-1-00", "2024-01- 12", " 5/ 1/2024", "5/1/24", "2024-12-31"]


def test_normalize_date_matches_python(spark):
    got = _apply(spark, normalize_date, DATES)
    for s in DATES:
        assert got[s] == _py_date(s), s


def test_normalize_date_known_values(spark):
    got = _apply(spark, normalize_date, ["2024-1- 5", "31/12/1969", "0001-01-01", "0000-01-01"])
    assert got["2024-1- 5"] == datetime.date(2024, 1, 5)
    assert got["31/12/1969"] == datetime.date(1969, 12, 31)
    assert got["0001-01-01"] == datetime.date(1, 1, 1)
    assert got["0000-01-01"] is None


INTS = ["5", " 5 ", "+5", "\t5\n", " 5", "1_000", "-3", "", "abc", "5.0", "1e3", "1d",
        "0x10", "12L", "+", "-", "+-5", "5-", "_1", "1_", "1__0", "007", "-0",
        "99999999999999999999999"]


def test_parse_int_matches_python(spark):
    got = _apply(spark, parse_int, INTS)
    for s in INTS:
        assert got[s] == _py_int(s), s


FLOATS = ["5", "1.5", ".5", "5.", "1e3", "1_000", "nan", "NaN", "inf", "Infinity", "-inf",
          "+nan", "-NAN", "INFINITY", "1_0.5_0", "1e1_0", "1e400", "99999999999999999999",
          "", "abc", "1d", "1f", "0x10", "0x1p3", "12L", "+", ".", "e5", "1e", "1.2.3", "1_",
          "_1", "infin", " 7 ", " 7", "-0", "1E5", "+.5"]


def test_parse_float_matches_python(spark):
    got = _apply(spark, parse_float, FLOATS)
    for s in FLOATS:
        exp, v = _py_float(s), got[s]
        if exp is None:
            assert v is None, s
        elif math.isnan(exp):
            assert v is not None and math.isnan(v), s
        else:
            assert v == exp, s


def test_strip_and_case(spark):
    vals = ["  A@B.COM ", "", "   ", "　x ", "\x1cy\x85", "Mixed Case  "]
    got = _apply(spark, pytrim, vals)
    for s in vals:
        assert got[s] == s.strip(), repr(s)
    email = _apply(spark, normalize_email, vals)
    for s in vals:
        assert email[s] == (s.strip().lower() or "unknown@unknown.com"), repr(s)
    country = _apply(spark, normalize_country, [" italy ", "", "united states"])
    assert country == {" italy ": "ITALY", "": "", "united states": "UNITED STATES"}
    product = _apply(spark, normalize_product, ["  Red Plate  "])
    assert product["  Red Plate  "] == "Red Plate"


def test_py_repr(spark):
    vals = ["two", "it's", 'a"b', "back\\slash", ""]
    got = _apply(spark, py_repr, vals)
    for s in vals:
        assert got[s] == repr(s), s


@pytest.mark.parametrize("fn", [parse_int, parse_float, normalize_date])
def test_null_stays_null(spark, fn):
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(fn("s")).collect()[0][0] is None
