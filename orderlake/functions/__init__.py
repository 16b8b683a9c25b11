"""Column → Column building blocks of the cleaner; all JVM-side built-ins."""

from .dates import (date_fields, date_from_fields, date_from_stripped, date_parts,
                    normalize_date)
from .encode import json_record
from .numbers import (float_from_stripped, int_from_stripped, parse_float, parse_int,
                      total_with_fallback)
from .strings import (UNKNOWN_EMAIL, email_from_stripped, normalize_country, normalize_email,
                      normalize_product, py_repr, pytrim)

__all__ = [
    "UNKNOWN_EMAIL", "date_fields", "date_from_fields", "date_from_stripped", "email_from_stripped", "float_from_stripped",
    "int_from_stripped", "date_parts", "json_record", "normalize_country",
    "normalize_date", "normalize_email", "normalize_product", "parse_float",
    "parse_int", "py_repr", "pytrim", "total_with_fallback",
]
