"""Row classification: one projection computes every parsed column, the
outcome of the reference's row checks, and the file-poisoning error.

Input: a frame with the eight raw text columns (null means the field is
missing from a short row), optionally boolean ``_absent_<column>`` flags,
true when the file's header lacks that required column, and ``_csv_error``,
the csv reader's error on the record. Other columns pass through; the
raw text itself is replaced by the clean columns (plus ``raw_order_id``).

The checks run in the reference's order; the first failing one decides:

    not a CSV record       → poison   (csv.Error)
    OrderDate missing      → poison   (None.strip())
    date does not parse    → rejected invalid_date
    CustomerEmail missing  → poison
    Country missing        → poison
    Quantity missing       → poison   (int(None))
    not an int, or <= 0    → rejected invalid_quantity
    UnitPrice missing      → poison   (float(None))
    not a float            → rejected invalid_unit_price
    TotalAmount column absent from the header → poison (KeyError)
    OrderID missing / not an int → poison
    Product missing        → poison
    otherwise              → accepted (total computed when blank or junk)

A poisoned row makes its whole file fail (see ``gates``). Everything is a
chain of ``select``s of built-in expressions. As one method their code would be
larger than what the JVM compiles, so ``ensure_conf`` has Spark generate it as
split projections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (date_fields, date_from_fields, date_parts, email_from_stripped,
                         float_from_stripped, int_from_stripped, py_repr, pytrim)
from ..schemas import CLEAN_COLUMNS, RAW_COLUMNS
from ..session import ensure_conf

# Clean values are computed for every row; they are meaningful only where
# ``status`` is accepted, which is what ``accepted`` selects.

# Reject reasons and the exception texts the reference reports.
INVALID_DATE = "invalid_date"
INVALID_QUANTITY = "invalid_quantity"
INVALID_UNIT_PRICE = "invalid_unit_price"
NON_POSITIVE_QUANTITY = "non-positive quantity"
INT_LITERAL_ERROR = "invalid literal for int() with base 10: "
NONE_STRIP_ERROR = "'NoneType' object has no attribute 'strip'"
NONE_INT_ERROR = "int() argument must be a string, a bytes-like object or a real number, not 'NoneType'"
NONE_FLOAT_ERROR = "float() argument must be a string or a real number, not 'NoneType'"

ACCEPTED, REJECTED, POISON = "accepted", "rejected", "poison"


def error_type(error: Column) -> Column:
    """The type of the exception that carries a file's error text."""
    return (F.when(error.startswith("'utf-8' codec"), F.lit("UnicodeDecodeError"))
            .when(error == NONE_STRIP_ERROR, F.lit("AttributeError"))
            .when(error.startswith("new-line character seen") | error.startswith("field larger than"), F.lit("Error"))
            .when(error.isin(NONE_INT_ERROR, NONE_FLOAT_ERROR), F.lit("TypeError"))
            .when(error.isin(*[f"'{n}'" for n in RAW_COLUMNS]), F.lit("KeyError"))
            .when(error.isNotNull(), F.lit("ValueError")))

OUTCOME_COLUMNS = ("status", "reason", "value", "detail", "poison_error", "total_was_computed",
                   "computed_total")


def _absent(df: DataFrame, name: str) -> Column:
    """True when the file's header lacks ``name`` (flag columns ``_absent_<name>``)."""
    if f"_absent_{name}" in df.columns:
        return F.col(f"_absent_{name}")
    return F.lit(False)


def _none_error(df: DataFrame, name: str, usage_error: str) -> Column:
    """KeyError text when the header lacks the column, else the None error."""
    if f"_absent_{name}" not in df.columns:
        return F.lit(usage_error)
    return F.when(_absent(df, name), F.lit(f"'{name}'")).otherwise(F.lit(usage_error))


# Outcome codes, in check order. Poison codes at or after TOTAL_DONE are
# raised after the total step (their computed total is logged).
(OK_CODE, P_CSV, P_DATE_NONE, R_DATE, P_EMAIL_NONE, P_COUNTRY_NONE, P_QTY_NONE, R_QTY,
 P_PRICE_NONE, R_PRICE, P_TOTAL_ABSENT, P_ID_NONE, P_ID_BAD, P_PRODUCT_NONE) = range(14)
TOTAL_DONE = P_ID_NONE
_REJECT_CODES = {R_DATE: INVALID_DATE, R_QTY: INVALID_QUANTITY, R_PRICE: INVALID_UNIT_PRICE}


def classify(raw: DataFrame) -> DataFrame:
    """Wide frame: passthrough + clean columns + outcome columns.

    Separate projections strip, parse, compute an integer outcome code and
    derive the texts from it, each referring to the previous one's columns,
    so no parser runs twice.
    """
    ensure_conf(raw.sparkSession)
    c = {n: F.col(n) for n in RAW_COLUMNS}
    none = {n: c[n].isNull() for n in RAW_COLUMNS}
    # Spark names are case-insensitive: raw "Country" would clash with the
    # clean "country", so raw text leaves the frame (the OrderID text is kept
    # as raw_order_id for reject reports).
    keep = [x for x in raw.columns if not x.startswith("_absent_") and x not in (*RAW_COLUMNS, "_csv_error")]
    csv_error = F.col("_csv_error") if "_csv_error" in raw.columns else F.lit(None).cast("string")
    absent = [F.col(x) for x in raw.columns if x.startswith("_absent_")]
    absent_names = [x for x in raw.columns if x.startswith("_absent_")]

    # Projection 1: strip every text once. Later projections refer to the
    # stripped columns, so no parser inlines the strip expression again.
    stripped = raw.select(
        *keep, *absent,
        csv_error.alias("_csv_error"), c["OrderID"].alias("raw_order_id"),
        c["OrderDate"].alias("_date_text"), c["Quantity"].alias("_qty_text"),
        c["UnitPrice"].alias("_price_text"),
        none["CustomerEmail"].alias("_email_none"), none["Country"].alias("_country_none"),
        none["Product"].alias("_product_none"), none["OrderID"].alias("_id_none"),
        *[pytrim(c[n]).alias(f"_s_{n}") for n in RAW_COLUMNS if n != "OrderID"],
        pytrim(c["OrderID"]).alias("_s_OrderID"),
    )
    s_ = {n: F.col(f"_s_{n}") for n in RAW_COLUMNS}
    passthrough = [x for x in stripped.columns]
    # Projection 1b: cut the date into fields.
    stripped = stripped.select(
        *passthrough, *[v.alias(f"_date_{k}") for k, v in date_fields(s_["OrderDate"]).items()])
    # Projection 2: parse. Filters on the outcome (status, reason, ...) and on
    # order_date stop above the guarded columns (see ``_opaque``).
    fields = {
        "order_date": date_from_fields(*[F.col(f"_date_{k}") for k in ("shape_ok", "y", "m", "d")]),
        "customer_email": email_from_stripped(s_["CustomerEmail"]),
        "country": F.upper(s_["Country"]),
        "product": s_["Product"],
        "quantity": int_from_stripped(s_["Quantity"]),
        "unit_price": float_from_stripped(s_["UnitPrice"]),
        "_supplied_total": float_from_stripped(s_["TotalAmount"]),
        "order_id": int_from_stripped(s_["OrderID"]),
    }
    parsed = stripped.select(
        *keep, *absent_names, "_csv_error", "raw_order_id", "_date_text", "_qty_text", "_price_text",
        "_email_none", "_country_none", "_product_none", "_id_none",
        # order_date is guarded too: date-range filters are the common ones.
        *[(_opaque(v) if k == "order_date" else v).alias(k) for k, v in fields.items()],
    )
    q, u, d = F.col("quantity"), F.col("unit_price"), F.col("order_date")
    code = (
        F.when(F.col("_csv_error").isNotNull(), P_CSV)
        .when(F.col("_date_text").isNull(), P_DATE_NONE)
        .when(d.isNull(), R_DATE)
        .when(F.col("_email_none"), P_EMAIL_NONE)
        .when(F.col("_country_none"), P_COUNTRY_NONE)
        .when(F.col("_qty_text").isNull(), P_QTY_NONE)
        .when(q.isNull() | (q <= 0), R_QTY)
        .when(F.col("_price_text").isNull(), P_PRICE_NONE)
        .when(u.isNull(), R_PRICE)
        .when(_absent(raw, "TotalAmount"), P_TOTAL_ABSENT)
        .when(F.col("_id_none"), P_ID_NONE)
        .when(F.col("order_id").isNull(), P_ID_BAD)
        .when(F.col("_product_none"), P_PRODUCT_NONE)
        .otherwise(OK_CODE)
    )
    coded = parsed.withColumn("_code", _opaque(code))

    k = F.col("_code")
    status = (F.when(k == OK_CODE, F.lit(ACCEPTED))
              .when(k.isin(*_REJECT_CODES), F.lit(REJECTED)).otherwise(F.lit(POISON)))
    reason = F.lit(None).cast("string")
    for rc, text in _REJECT_CODES.items():
        reason = F.when(k == rc, F.lit(text)).otherwise(reason)
    value = (F.when(k == R_DATE, F.col("_date_text")).when(k == R_QTY, F.col("_qty_text"))
             .when(k == R_PRICE, F.col("_price_text")))
    detail = F.when(k == R_QTY, F.when(q.isNotNull(), F.lit(NON_POSITIVE_QUANTITY)).otherwise(
        F.concat(F.lit(INT_LITERAL_ERROR), py_repr(F.col("_qty_text")))))
    error = (
        F.when(k == P_CSV, F.col("_csv_error"))
        .when(k.isin(P_DATE_NONE, P_EMAIL_NONE, P_COUNTRY_NONE, P_PRODUCT_NONE),
               F.when(k == P_DATE_NONE, _none_error(raw, "OrderDate", NONE_STRIP_ERROR))
               .when(k == P_EMAIL_NONE, _none_error(raw, "CustomerEmail", NONE_STRIP_ERROR))
               .when(k == P_COUNTRY_NONE, _none_error(raw, "Country", NONE_STRIP_ERROR))
               .otherwise(_none_error(raw, "Product", NONE_STRIP_ERROR)))
        .when(k == P_QTY_NONE, _none_error(raw, "Quantity", NONE_INT_ERROR))
        .when(k == P_PRICE_NONE, _none_error(raw, "UnitPrice", NONE_FLOAT_ERROR))
        .when(k == P_TOTAL_ABSENT, F.lit("'TotalAmount'"))
        .when(k == P_ID_NONE, _none_error(raw, "OrderID", NONE_INT_ERROR))
        .when(k == P_ID_BAD, F.concat(F.lit(INT_LITERAL_ERROR), py_repr(F.col("raw_order_id"))))
    )
    # The reference logs a computed total before it parses OrderID, so a row
    # that poisons its file at OrderID/Product still logs its repair.
    computed = (k == OK_CODE) | (k >= TOTAL_DONE)
    computed = computed & F.col("_supplied_total").isNull()
    parts = date_parts(d)
    out = {
        **{x: F.col(x) for x in keep}, "raw_order_id": F.col("raw_order_id"),
        **{x: F.col(x) for x in ("order_id", "order_date", "customer_email", "country",
                                 "product", "quantity", "unit_price")},
        "total_amount": F.coalesce(F.col("_supplied_total"), q * u),
        **parts,
        "status": status, "reason": reason, "value": value, "detail": detail,
        "poison_error": error, "total_was_computed": computed,
        "computed_total": F.when(computed, q * u),
    }
    return coded.select(*[c.alias(n) for n, c in out.items()])


def _opaque(c: Column) -> Column:
    """Optimizer barrier on a computed column.

    Catalyst pushes a filter on a derived column (status, order_date, ...)
    below the projections that compute it by inlining the whole parse tree
    into the filter — even into a join below — so every parser would run
    twice and the generated code would outgrow codegen limits. A filter is
    never pushed through a projection with a nondeterministic field; this
    guard is always true and costs one comparison per row. Where a guarded
    column is selected, no filter passes it, not even one on pass-through
    columns: filter those before ``classify``.
    """
    return F.when(F.spark_partition_id() >= 0, c)


def accepted(classified: DataFrame, *extra: str) -> DataFrame:
    """Rows that pass every check, as the 11 clean columns (+ ``extra``)."""
    return classified.where(F.col("status") == ACCEPTED).select(*extra, *CLEAN_COLUMNS)
