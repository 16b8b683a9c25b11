"""Date parsing with the reference's three accepted layouts.

The reference tries, in order, ``%Y-%m-%d``, ``%d/%m/%Y`` and ``%Y/%m/%d`` on
the stripped text. Spark's pattern parser is more lenient than that (it takes
``0000``, ``+12024``, 3-digit months) and slow, so the shape is checked with
one anchored regex, the three numbers are cut out with ``substring_index``,
the calendar is checked with integer arithmetic and ``make_date`` builds the
value only for valid days.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import _col, pytrim

# Day field as strptime's %d reads it: one or two digits, or a blank and one
# digit. Year: exactly four digits. Month: one or two digits.
# Groups: 1 year, 2 separator, 3 month, 4|5 day  (year-first layouts, same separator)
#         6|7 day, 8 month, 9 year               (day-first layout, slashes)
_SHAPE = (r"^(?:(\d{4})([-/])(\d{1,2})\2(?: ([1-9])|(\d{1,2}))"
          r"|(?: ([1-9])|(\d{1,2}))/(\d{1,2})/(\d{4}))$")


def days_in_month(y: Column, m: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return (F.when(m == 2, F.when(leap, 29).otherwise(28))
            .when(m.isin(4, 6, 9, 11), 30).otherwise(31))


def normalize_date(c) -> Column:
    """Text → DATE, or null when no layout matches or the day does not exist."""
    return date_from_stripped(pytrim(c))


def date_fields(t: Column) -> dict[str, Column]:
    """Shape check and the year, month, day numbers of stripped date text.

    Computed as separate columns so the validation step refers to plain
    columns (small generated code, no repeated sub-trees). Text of another
    shape has no numbers: a cast that fails costs a thrown exception.
    """
    u = F.replace(F.regexp_substr(t, F.lit(_SHAPE)), F.lit("/"), F.lit("-"))
    first = F.substring_index(u, "-", 1)
    middle = F.substring_index(F.substring_index(u, "-", 2), "-", -1)
    last = F.substring_index(u, "-", -1)
    year_first = F.length(first) == 4
    return {
        "shape_ok": t.rlike(_SHAPE),
        "y": F.when(year_first, first).otherwise(last).try_cast("int"),
        "m": middle.try_cast("int"),
        "d": F.when(year_first, last).otherwise(first).try_cast("int"),  # " 5" reads as 5
    }


def date_from_fields(shape_ok: Column, y: Column, m: Column, d: Column) -> Column:
    """DATE from checked fields; null unless the day exists (pass column references)."""
    valid = (shape_ok & (y >= 1) & (m >= 1) & (m <= 12) & (d >= 1)
             & (d <= days_in_month(y, m)))
    return F.when(valid, F.make_date(y, m, d))


def date_from_stripped(t: Column) -> Column:
    """``normalize_date`` of text that is already stripped."""
    f = date_fields(t)
    return date_from_fields(f["shape_ok"], f["y"], f["m"], f["d"])


def date_parts(c) -> dict[str, Column]:
    """year as int, month and day as two-character strings."""
    d = _col(c)
    return {
        "year": F.year(d).cast("int"),
        "month": F.lpad(F.month(d).cast("string"), 2, "0"),
        "day": F.lpad(F.dayofmonth(d).cast("string"), 2, "0"),
    }
