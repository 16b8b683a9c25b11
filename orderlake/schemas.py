"""Schemas of every dataset the engine reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw header names the reference reads, in its access order.
RAW_COLUMNS = (
    "OrderID", "OrderDate", "CustomerEmail", "Country", "Product",
    "Quantity", "UnitPrice", "TotalAmount",
)

# Clean column names, in the reference's output order.
CLEAN_COLUMNS = (
    "order_id", "order_date", "customer_email", "country", "product",
    "quantity", "unit_price", "total_amount", "year", "month", "day",
)

CLEAN = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("customer_email", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.StringType()),
    T.StructField("day", T.StringType()),
])

# Written orders dataset: partition folders are strings (month=01 stays "01").
FINAL_ORDERS = T.StructType(
    [f for f in CLEAN.fields if f.name not in ("year", "month", "day")]
    + [T.StructField(n, T.StringType()) for n in ("year", "month", "day")]
)

DEAD_LETTER = T.StructType([
    T.StructField("bucket", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("request_id", T.StringType()),
])


def raw_string_schema(names, corrupt: str | None = "_corrupt_record") -> T.StructType:
    fields = [T.StructField(n, T.StringType()) for n in names]
    if corrupt:
        fields.append(T.StructField(corrupt, T.StringType()))
    return T.StructType(fields)
