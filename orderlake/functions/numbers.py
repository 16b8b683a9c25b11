"""Number parsing with Python ``int()`` / ``float()`` acceptance rules.

``try_cast`` agrees with Python on plain numbers and does the work. Where the
two differ, cheap checks decide: Python also takes digit-group underscores and
signed ``nan`` (handled by an anchored regex of Python's grammar, evaluated
only when ``try_cast`` gives null), while Spark doubles also take hex floats
and a ``d``/``f`` suffix (rejected). Integers beyond 64 bits become null
(documented deviation; Python accepts them).

``try_cast`` makes, throws and catches an exception for a text it cannot read,
at many times the price of a number. So it only sees texts that may be
numbers; the checks before it refuse nothing that it would read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import _col, pytrim

_D = r"\d+(?:_\d+)*"
INT_RE = rf"^[+-]?{_D}$"
# All texts that Spark reads as a whole number (it drops control characters at
# the ends), and a wider set than those that it reads as a double.
_EDGE = r"[\x00-\x20\x7f]*+"
_MAYBE_INT = rf"\A{_EDGE}[+-]?[0-9]++{_EDGE}\z"
_MAYBE_DOUBLE = (rf"\A{_EDGE}[+-]?(?:[0-9.][0-9.eE+-]*+[dDfF]?|0[xX][0-9a-fA-F.]++[pP][0-9+-]++[dDfF]?|(?i:nan|inf(?:inity)?)[dDfF]?)"
                 rf"{_EDGE}\z")
FLOAT_RE = rf"(?i)^[+-]?(?:(?:{_D}\.?(?:{_D})?|\.{_D})(?:e[+-]?{_D})?|nan|inf(?:inity)?)$"


def parse_int(c) -> Column:
    """``int(text)`` or null."""
    return int_from_stripped(pytrim(c))


def int_from_stripped(t: Column) -> Column:
    """``parse_int`` of text that is already stripped (pass a column reference)."""
    return (F.when(t.contains("_"), F.when(t.rlike(INT_RE),
                                           F.replace(t, F.lit("_"), F.lit("")).try_cast("bigint")))
            .otherwise(F.when(t.rlike(_MAYBE_INT), t.try_cast("bigint"))))


def _spark_only_double(t: Column) -> Column:
    """Text Spark reads as a double but Python does not: hex or a d/f suffix."""
    last = F.lower(F.substring(t, -1, 1))
    suffix = last.isin("d", "f") & ~F.lower(t).endswith("inf")
    return t.contains("x") | t.contains("X") | suffix


def parse_float(c) -> Column:
    """``float(text)`` or null; nan and inf are values."""
    return float_from_stripped(pytrim(c))


def float_from_stripped(t: Column) -> Column:
    """``parse_float`` of text that is already stripped (pass a column reference)."""
    fast = F.when(t.rlike(_MAYBE_DOUBLE), t.try_cast("double"))
    low = F.lower(t)
    slow = F.when(low.rlike(FLOAT_RE), F.regexp_replace(
        F.replace(low, F.lit("_"), F.lit("")), r"^[+-](nan)$", "$1").try_cast("double"))
    return (F.when(fast.isNotNull(), F.when(~_spark_only_double(t), fast))
            .otherwise(slow))


def total_with_fallback(total_text, quantity, unit_price) -> Column:
    """Supplied total if it parses, else quantity * unit_price."""
    return F.coalesce(parse_float(total_text), _col(quantity) * _col(unit_price))
