"""Raw order text derived from the driver's TPC-H-like tables.

The reference ships no raw input, so raw orders are derived from
``lineitem ⋈ orders ⋈ customer ⋈ nation`` and ``lineitem ⋈ part``. Every field
is text, shaped like the uploads the cleaner sees: three date layouts, padded
and mixed-case emails, lower-case countries, junk quantities and prices and
missing totals. The rule is keyed by ``k = l_orderkey * 7 + l_linenumber``.

All work is a Spark join plan; Catalyst prunes every table to the few columns
used and the planner picks broadcast or sort-merge joins from table sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_COLUMNS
from ..session import conf_for, unique_path

# Fixed values of the fixture rule (FIXTURES.md §3, §3b).
BAD_DATE_MOD, BAD_DATE_TEXT = 41, "not-a-date"
NO_SUCH_DAY_MOD, NO_SUCH_DAY_TEXT = 43, "2024-02-30"
BLANK_EMAIL_MOD = 10
ZERO_QTY_MOD, NEG_QTY_MOD, WORD_QTY_MOD = 29, 31, 37
BAD_PRICE_MOD, BAD_PRICE_TEXT = 47, "N/A"
BLANK_TOTAL_MOD = 5
FILES = 400
BAD_ORDER_ID_MOD, BAD_ORDER_ID_TEXT = 997, "BAD"
ALL_ZERO_FILE_MOD, ALL_ZERO_FILE_REM = 100, 99

# Order in which rows are written inside each raw file.
WRITE_ORDER = ("l_orderkey", "l_linenumber") + RAW_COLUMNS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with the order, customer, nation and part fields."""
    t = lambda n: read_table(spark, sf_dir, n)
    cust = (t("customer").select("c_custkey", "c_name", "c_nationkey")
            .join(t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"),
                  "c_nationkey"))
    orders = (t("orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                 F.col("o_custkey").alias("c_custkey"), "o_orderdate")
              .join(cust, "c_custkey"))
    parts = t("part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_retailprice")
    # lineitem ⋈ orders is a big-to-big join: a sort-merge join on the order
    # key. Without the hint the size estimate of orders ⋈ customer (a product
    # of sizes) makes the planner broadcast lineitem, which leaves the whole
    # per-row parse to the few tasks that scan orders.
    return (t("lineitem")
            .select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
            .join(orders.hint("merge"), "l_orderkey")
            .join(parts, "l_partkey"))


def _k() -> Column:
    return F.col("l_orderkey") * 7 + F.col("l_linenumber")


def _is(mod: int) -> Column:
    return (_k() % mod) == 0


def raw_text_columns(file_variant: bool = False) -> list[Column]:
    d = F.col("o_orderdate")
    layout = _k() % 3
    order_date = (F.when(_is(BAD_DATE_MOD), F.lit(BAD_DATE_TEXT))
                  .when(_is(NO_SUCH_DAY_MOD), F.lit(NO_SUCH_DAY_TEXT))
                  .when(layout == 0, F.date_format(d, "yyyy-MM-dd"))
                  .when(layout == 1, F.date_format(d, "dd/MM/yyyy"))
                  .otherwise(F.date_format(d, "yyyy/MM/dd")))
    email = (F.when(_is(BLANK_EMAIL_MOD), F.lit(""))
             .otherwise(F.concat(F.lit("  "), F.col("c_name"), F.lit("@Example.COM "))))
    quantity = (F.when(_is(ZERO_QTY_MOD), F.lit("0"))
                .when(_is(NEG_QTY_MOD), F.lit("-1"))
                .when(_is(WORD_QTY_MOD), F.lit("two"))
                .otherwise(F.col("l_quantity").cast("int").cast("string")))
    order_id = F.col("l_orderkey").cast("string")
    if file_variant:
        order_id = F.when(_is(BAD_ORDER_ID_MOD), F.lit(BAD_ORDER_ID_TEXT)).otherwise(order_id)
        quantity = (F.when(F.col("file_no") % ALL_ZERO_FILE_MOD == ALL_ZERO_FILE_REM, F.lit("0"))
                    .otherwise(quantity))
    cols = {
        "OrderID": order_id,
        "OrderDate": order_date,
        "CustomerEmail": email,
        "Country": F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")),
        "Product": F.concat(F.col("p_name"), F.lit("  ")),
        "Quantity": quantity,
        "UnitPrice": F.when(_is(BAD_PRICE_MOD), F.lit(BAD_PRICE_TEXT))
                      .otherwise(F.col("p_retailprice").cast("string")),
        "TotalAmount": F.when(_is(BLANK_TOTAL_MOD), F.lit(""))
                        .otherwise(F.col("l_extendedprice").cast("string")),
    }
    return [cols[n].alias(n) for n in RAW_COLUMNS]


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw-order fixture as a frame of eight text columns (no files)."""
    return order_lines(spark, sf_dir).select(*raw_text_columns())


def raw_order_files_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the file variant with their ``file_no``; ``write_raw_files``
    makes their text, so that numbers and not texts are shuffled and sorted."""
    return order_lines(spark, sf_dir).withColumn("file_no", F.col("l_orderkey") % FILES)


# Fixed values of the files' layouts: the file number modulo 3 gives the order
# of the columns, and some files of the third kind have line breaks in quotes.
NOTE, NOTE_TEXT, NOTE_MOD, NOTE_REM = "Note", 'first line\nsecond, "quoted" line', 30, 2
LAYOUTS = (RAW_COLUMNS, tuple(reversed(RAW_COLUMNS)), (NOTE, *RAW_COLUMNS[4:], *RAW_COLUMNS[:4]))


# Raw CSV writer options: keep every byte of the text (Spark's writer would
# otherwise trim blanks) and quote RFC-style.
RAW_WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


# Bytes of the shuffled lines that one task sorts: they are compressed, and
# several times as large in memory.
SORTED_BYTES = "16m"


def write_raw_files(lines: DataFrame, path: str) -> str:
    """One CSV per ``file_no`` (folder ``file_no=N``) of the text of ``lines``
    (``raw_order_files_frame``), rows in WRITE_ORDER, columns as its layout has them.

    Each layout joins and reads its own third of the lines: ``file_no`` comes
    from the order key, so its filter reaches the scans."""
    note = F.when(F.col("file_no") % NOTE_MOD == NOTE_REM, F.lit(NOTE_TEXT)).otherwise(F.lit("-")).alias(NOTE)
    text = dict(zip(RAW_COLUMNS, raw_text_columns(True)), **{NOTE: note})
    order = [text.get(c, F.col(c)) for c in WRITE_ORDER]
    with conf_for(lines.sparkSession, spark__sql__adaptive__advisoryPartitionSizeInBytes=SORTED_BYTES):
        for kind, layout in enumerate(LAYOUTS):
            (lines.where(F.col("file_no") % len(LAYOUTS) == kind)
             .repartition("file_no").sortWithinPartitions("file_no", *order)
             .select("file_no", *[text[c] for c in layout])
             .write.mode("append").options(**RAW_WRITE_OPTIONS).partitionBy("file_no").csv(path))
    return path


def upload_raw_files(written: str, landing: str, spark: SparkSession) -> str:
    """Move the files of ``write_raw_files`` to ``landing/file_no=N/orders.csv``,
    in place of a file that is there: a sender uploads them (again)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(written).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for part in fs.globStatus(path(f"{written}/file_no=*/part-*.csv")):
        target = path(f"{landing}/{part.getPath().getParent().getName()}/orders.csv")
        fs.mkdirs(target.getParent())
        fs.delete(target, False)
        fs.rename(part.getPath(), target)
    return landing


_STAGED: dict[tuple, str] = {}


def stage_raw_files(spark: SparkSession, sf_dir: str, where: Column | None = None,
                    path: str | None = None) -> str:
    """Write the file variant as CSV files into the shared scratch folder.

    Without ``where``/``path`` the full set is written once per session and
    reused; ``where`` selects some files (to simulate late arrivals).
    """
    frame = raw_order_files_frame(spark, sf_dir)
    if where is not None or path is not None:
        if where is not None:
            frame = frame.where(where)
        return write_raw_files(frame, path or unique_path(spark, "raw-part"))
    key = (sf_dir.rstrip("/"), spark.sparkContext.applicationId)
    if key not in _STAGED:
        _STAGED[key] = write_raw_files(frame, unique_path(spark, "raw-all"))
    return _STAGED[key]
