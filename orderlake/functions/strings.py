"""String normalisation as Column expressions (no Python UDFs).

Python's ``str.strip()`` removes every Unicode white-space character; Spark's
``trim`` removes only the ASCII blank. ``pytrim`` strips the same set as
Python with ``btrim`` and an explicit character set (no regex per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's output.
UNKNOWN_EMAIL = "unknown@unknown.com"

# The characters Python's str.isspace() accepts, in code point order.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pytrim(c) -> Column:
    """``str.strip()`` semantics; null stays null.

    Blanks go with the cheap ``trim``. The general ``btrim`` over the whole
    white-space set runs only when an edge character is not printable ASCII
    (code 33..132 holds no white space).
    """
    t = F.trim(_col(c))
    a, z = F.ascii(t), F.ascii(F.substring(t, -1, 1))
    printable_edges = (a > 32) & (a < 133) & (z > 32) & (z < 133)
    return F.when(printable_edges | (F.length(t) == 0), t).otherwise(
        F.btrim(t, F.lit(PY_WHITESPACE)))


def normalize_email(c) -> Column:
    """strip, lower-case; blank becomes the fixed unknown address."""
    return email_from_stripped(pytrim(c))


def email_from_stripped(t: Column) -> Column:
    return F.coalesce(F.nullif(F.lower(t), F.lit("")), F.lit(UNKNOWN_EMAIL))


def normalize_country(c) -> Column:
    """strip, upper-case; blank stays blank."""
    return F.upper(pytrim(c))


def normalize_product(c) -> Column:
    """strip only; case is kept."""
    return pytrim(c)


def py_repr(c) -> Column:
    """Python ``repr`` of a plain string, as used in ``ValueError`` texts.

    Single quotes unless the text holds a single quote and no double quote.
    Escapes of control characters are not reproduced (documented deviation).
    """
    s = _col(c)
    esc = F.regexp_replace(s, r"\\", r"\\\\")
    use_double = s.contains("'") & ~s.contains('"')
    single = F.concat(F.lit("'"), F.regexp_replace(esc, "'", r"\\'"), F.lit("'"))
    double = F.concat(F.lit('"'), esc, F.lit('"'))
    return F.when(use_double, double).otherwise(single)
