"""JSON encoding of log, dead-letter and alert records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_record(*cols, **named) -> Column:
    """``to_json(struct(...))``: one JSON object per row, keys in given order."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    parts += [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in named.items()]
    return F.to_json(F.struct(*parts))
