"""Raw CSV layer: header check (SRC-2) and header-aware scan (SRC-1).

Files are read as text, split by split; the rules of the csv module (RFC-4180
quoting, lenient about text after a closing quote) are built-in expressions.

1. ``segment_checks``: one scan, aggregated by hash to one row for each segment
   (file x split): the first line, whether all is valid UTF-8, and whether a
   line leaves a quoted field open; ``file_checks`` sums them up.  Zero-byte
   files give no line; they come from the ``listing``.
2. ``scan_raw``: in a file without such a line every line is a record.  In the
   others each line maps "outside quotes" and "inside quotes" to the state
   after it; these maps are composed within each split, then over the splits
   of a file (one row a split), which tells where every split's first record
   starts.  So a huge file with quoted line breaks is many tasks, and its
   records are the same at any split size.

Columns are picked by NAME: the commonest header is a literal of the plan, and
only files with another header (or unreadable ones) are looked up in a table,
by segment, so neither a union over headers nor a list of paths exists.

The header is record 0 of its file and flows through like the others: it can
never be accepted, as its order date reads "OrderDate" (see ``gates``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import RAW_COLUMNS
from ..session import ensure_conf, staged

# File-level error texts of the reference and of its csv reader.
MISSING_HEADERS_ERROR = "Empty or missing CSV headers"
BAD_ENCODING_ERROR = "'utf-8' codec can't decode the file"
BARE_RETURN_ERROR = "new-line character seen in unquoted field - do you need to open the file with newline=''?"
FIELD_LIMIT = 131072
FIELD_LIMIT_ERROR = f"field larger than field limit ({FIELD_LIMIT})"

#: A record of more characters is not put together; it counts as one with a
#: field over the limit (a quote that is never closed, in all likelihood).
RECORD_LIMIT = 128 * FIELD_LIMIT

# The part of a field in quotes, up to its closing quote or the end.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:{_QUOTED}"[^,]*+|[^",][^,]*+|)'
# A line, read from a record's start, that ends inside quotes.
_LEAVES_OPEN = rf'^(?:{_FIELD},)*+{_QUOTED}$'

SEGMENT = ["source_file", "block_start"]


def raw_text(spark: SparkSession, paths, glob: str | None = "*.csv", recursive: bool = True) -> DataFrame:
    reader = spark.read.format("text").option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load([paths] if isinstance(paths, str) else list(paths))


def no_text(spark: SparkSession) -> DataFrame:
    """A text frame without files."""
    return spark.createDataFrame([], "value string, _metadata struct<file_path:string,file_name:string,"
                                     "file_size:bigint,file_block_start:bigint>")


def listing(spark: SparkSession, paths, glob: str | None = "*.csv") -> DataFrame:
    """source_file, path, file_size, modified of all files; contents are not
    read. The scan shows the files that are not empty. No scan of Spark's has
    a row for a zero-byte file, whatever the source, so those (path and
    modified null) are the files of its index that the scan does not show."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(paths if isinstance(paths, str) else list(paths))
    index = spark.createDataFrame([(p,) for p in files.inputFiles()], "value string")
    shown = files.select(
        F.col("_metadata.file_path").alias("source_file"), "path", F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified"))
    every = index.select(F.regexp_replace("value", "^file:///", "file:/").alias("source_file"))
    return shown.unionByName(every.join(shown, "source_file", "left_anti").withColumn("file_size", F.lit(0).cast("long")),
                             allowMissingColumns=True)


# ---- records and fields -----------------------------------------------------

def _unreturned(line: Column) -> Column:
    """A line without the carriage returns before its line feed."""
    return F.when(line.endswith("\r"), F.regexp_replace(line, "\r+$", "")).otherwise(line)


def _leaves_open(line: Column) -> Column:
    return line.contains('"') & line.rlike(_LEAVES_OPEN)


def split_fields(record: Column) -> Column:
    """The fields of a record as an array of texts."""
    def value(field: Column) -> Column:
        body = F.regexp_extract(field, f"^{_QUOTED}", 0)
        rest = F.substring(field, F.length(body) + 1, F.lit(1 << 30))
        text = F.replace(F.substring(body, F.lit(2), F.lit(1 << 30)), F.lit('""'), F.lit('"'))
        return F.when(field.startswith('"'), F.concat(text, F.regexp_replace(rest, '^"', ""))).otherwise(field)

    quoted = F.transform(F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(f',({_QUOTED}"?[^,]*+|[^",][^,]*+|)')),
                         value)
    return F.when(record.contains('"'), quoted).otherwise(F.split(record, ",", -1))


def csv_error(record: Column) -> Column:
    """The csv reader's error on a record, or null."""
    unquoted = F.when(record.contains('"'), F.regexp_replace(
        record, rf'(^|,){_QUOTED}(?:"|$)', "$1")).otherwise(record)
    return (F.when(record.contains("\r") & unquoted.contains("\r"), F.lit(BARE_RETURN_ERROR))
            .when((F.length(record) > FIELD_LIMIT)
                  & F.exists(split_fields(record), lambda f: F.length(f) > FIELD_LIMIT), F.lit(FIELD_LIMIT_ERROR)))


def header_names(header: Column) -> Column:
    """The names in a header record (a byte-order mark is dropped)."""
    return split_fields(F.regexp_replace(header, "^﻿", ""))


# ---- file checks --------------------------------------------------------------

def segment_checks(text: DataFrame) -> DataFrame:
    """Per segment: file_size, characters and bytes without line feeds, first
    line, utf8_ok, broken (a line leaves a quoted field open), and the numbers
    of lines beyond the record limit.

    ``text``: a text-source frame (batch or one micro-batch). That list is
    hardly ever filled; with it the planner aggregates objects by hash, where
    text buffers alone would make it sort every raw line.
    """
    mid = F.monotonically_increasing_id()
    lines = text.select(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_size").alias("file_size"), mid.alias("mid"), "value")
    return lines.groupBy(*SEGMENT).agg(
        F.max("file_size").alias("file_size"),
        F.sum(F.length("value")).alias("chars"), F.sum(F.octet_length("value")).alias("octets"),
        F.min_by(F.when(F.col("block_start") == 0, F.col("value")), "mid").alias("first_line"),
        F.bool_and(F.is_valid_utf8("value")).alias("utf8_ok"),
        F.bool_or(_leaves_open(F.col("value"))).alias("broken"),
        F.array_agg(F.when(F.length("value") > RECORD_LIMIT, F.col("mid"))).alias("long_lines"))


def file_checks(segments: DataFrame) -> DataFrame:
    """Per file: source_file, file_size, chars, header, names, utf8_ok, broken, error.

    The header of a file that is ``broken`` may take several lines; it is then
    the first record that ``scan_raw`` puts together, and null here.
    """
    per_file = segments.groupBy("source_file").agg(
        F.max("file_size").alias("file_size"), F.array_agg("first_line").alias("first"),
        # Line feeds are what the lines lack of the file; each is one character.
        (F.sum("chars") + F.max("file_size") - F.sum("octets")).alias("chars"),
        F.bool_and("utf8_ok").alias("utf8_ok"), F.bool_or("broken").alias("broken"))
    header = _unreturned(F.col("first")[0])
    rows = per_file.select("source_file", "file_size", "chars", "utf8_ok", "broken",
                           F.when(~(F.col("broken") & _leaves_open(header)), header).alias("header"))
    return with_names(rows)


def with_names(files: DataFrame) -> DataFrame:
    """Add names and error to files with their header text."""
    return files.select(
        "source_file", "file_size", "chars", "header", header_names(F.col("header")).alias("names"), "utf8_ok", "broken",
        F.when(~F.col("utf8_ok"), F.lit(BAD_ENCODING_ERROR))
         .when(F.col("header") == "", F.lit(MISSING_HEADERS_ERROR))
         .otherwise(csv_error(F.col("header"))).alias("error"))


def empty_files(files: DataFrame, seen: DataFrame) -> DataFrame:
    """The zero-byte files of a listing, in the form of ``file_checks``
    (without those of ``seen``: source_file). Spark's sources skip them."""
    return (files.where("file_size = 0").join(seen.select("source_file"), "source_file", "left_anti")
            .select("source_file", F.lit(0).cast("long").alias("file_size"), F.lit(0).cast("long").alias("chars"),
                    F.lit(None).cast("string").alias("header"),
                    F.lit(None).cast("array<string>").alias("names"), F.lit(True).alias("utf8_ok"),
                    F.lit(False).alias("broken"), F.lit(MISSING_HEADERS_ERROR).alias("error")))


# ---- records ----------------------------------------------------------------------

def line_records(text: DataFrame) -> DataFrame:
    """source_file, block_start, mid, record: every line that is not blank is a
    record, numbered without gaps inside its segment."""
    lines = text.select(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block_start"),
        _unreturned(F.col("value")).alias("record"))
    return lines.where(F.col("record") != "").select(
        *SEGMENT, F.monotonically_increasing_id().alias("mid"), "record")


def _xor(a: Column, b: Column) -> Column:
    return a != b


def broken_records(text: DataFrame, files: DataFrame) -> DataFrame:
    """The records of files with quoted line breaks (``files``: source_file),
    in the form of ``line_records``, and ``too_long``.

    A line is a map of the state before it to the state after it: the same
    state for both (it sets the state), each its own (it keeps it) or each the
    other (it flips it). A run of lines is composed from the last line that
    sets the state and the parity of the flips; first within a split, then
    over the splits of a file.
    """
    mid = F.monotonically_increasing_id()
    lines = staged(
        text.select(F.col("_metadata.file_path").alias("source_file"),
                    F.col("_metadata.file_block_start").alias("block_start"), mid.alias("mid"), "value")
        .join(files.select("source_file"), "source_file", "left_semi"), "broken-lines")
    value = F.col("value")
    out_open = _leaves_open(value)
    in_open = F.when(value.contains('"'), F.concat(F.lit('"'), value).rlike(_LEAVES_OPEN)).otherwise(F.lit(True))
    maps = lines.select("*", out_open.alias("from_out"), in_open.alias("from_in"))
    sets, flips = F.col("from_out") == F.col("from_in"), F.col("from_out") & ~F.col("from_in")
    inside = Window.partitionBy(*SEGMENT).orderBy("mid")

    def composed(frame: DataFrame, sets: Column, set_to: Column, flips: Column, over) -> DataFrame:
        """The state after each row, as: the state it was set to (null: not
        yet), and whether it has been flipped an odd number of times."""
        odd = (F.sum(flips.cast("int")).over(over.rowsBetween(Window.unboundedPreceding, 0)) % 2) == 1
        frame = frame.withColumn("odd", odd)
        return frame.withColumn("set_to", F.last(F.when(sets, _xor(set_to, F.col("odd"))), True).over(
            over.rowsBetween(Window.unboundedPreceding, 0)))

    def after(start: Column) -> Column:
        return _xor(F.coalesce(F.col("set_to"), start), F.col("odd"))

    lines = composed(maps, sets, F.col("from_out"), flips, inside)
    # Whether each line starts inside quotes, for either state at the split's start.
    for name, start in (("if_out", False), ("if_in", True)):
        lines = lines.withColumn(name, F.coalesce(F.lag(after(F.lit(start))).over(inside), F.lit(start)))
    blank = _unreturned(value) == ""
    lines = staged(lines.select(*SEGMENT, "mid", "value", "if_out", "if_in", "set_to", "odd", (~blank).alias("counts")),
                   "broken-states")
    # One row a split: its map, and its number of records for either start.
    count = lambda state: F.count_if(~F.col(state) & F.col("counts"))
    parts = lines.groupBy(*SEGMENT).agg(
        F.max_by("set_to", "mid").alias("end_set"), F.max_by("odd", "mid").alias("end_odd"),
        count("if_out").alias("n_out"), count("if_in").alias("n_in"))
    along = Window.partitionBy("source_file").orderBy("block_start")
    # The set state of a split was taken before its flips, as that of a line.
    parts = composed(parts, F.col("end_set").isNotNull(), _xor(F.col("end_set"), F.col("end_odd")),
                     F.col("end_odd"), along)
    parts = parts.withColumn("inside", F.coalesce(F.lag(after(F.lit(False))).over(along), F.lit(False)))
    parts = parts.select(*SEGMENT, "inside", F.coalesce(F.sum(F.when(
        F.col("inside"), F.col("n_in")).otherwise(F.col("n_out"))).over(
            along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    placed = lines.join(staged(parts, "broken-splits"), SEGMENT)
    continues = F.when(F.col("inside"), F.col("if_in")).otherwise(F.col("if_out"))
    placed = placed.select(*SEGMENT, "mid", "value", "before", continues.alias("continues"), "counts")
    number = F.sum((~F.col("continues") & F.col("counts")).cast("long")).over(
        inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = placed.withColumn("local", number).where("continues or counts")
    # Lines of one record: those of a later split follow its last record.
    record = Window.partitionBy("source_file", "record_no")
    grouped = (placed.withColumn("record_no", F.col("before") + F.col("local"))
               .withColumn("chars", F.sum(F.length("value") + 1).over(record))
               .withColumn("too_long", F.col("chars") > RECORD_LIMIT)
               .where("not too_long or not continues")
               .groupBy("source_file", "record_no").agg(
                   F.array_sort(F.array_agg(F.struct("block_start", "mid", "value"))).alias("lines"),
                   F.max(F.when(~F.col("continues"), F.col("block_start"))).alias("block_start"),
                   F.max(F.when(~F.col("continues"), F.col("local"))).alias("mid"),
                   F.bool_or("too_long").alias("too_long")))
    joined = F.array_join(F.transform("lines", lambda x: x["value"]), "\n")
    return grouped.select(*SEGMENT, "mid", _unreturned(joined).alias("record"), "too_long")


# ---- columns by name ------------------------------------------------------------------

def _places(names: Column) -> Column:
    """The place of each raw column in a header, from 0; null where it lacks
    it. The last of duplicate names wins, as in a dict built per row."""
    back = F.reverse(names)
    return F.array(*[F.size(names) - F.nullif(F.array_position(back, n), F.lit(0)).cast("int") for n in RAW_COLUMNS])


def _fields_to_columns(records: DataFrame, places: list[Column], absent: list[Column]) -> DataFrame:
    cut = records.withColumn("fields", split_fields(F.col("record"))).withColumn("_csv_error", F.when(
        F.col("too_long"), F.lit(FIELD_LIMIT_ERROR)).otherwise(csv_error(F.col("record"))))
    return cut.select(
        *SEGMENT, "mid", "_csv_error",
        *[F.get("fields", p).alias(n) for n, p in zip(RAW_COLUMNS, places)],
        *[a.alias(f"_absent_{n}") for n, a in zip(RAW_COLUMNS, absent)])


def scan_raw(text: DataFrame, segments: DataFrame, checks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records as the eight raw columns by name, the checks completed).

    ``segments``, ``checks``: the staged checks of the same text frame. Every
    record carries its segment, its place ``mid`` there, ``_csv_error`` and
    ``_absent_<column>`` (the header lacks the column).
    """
    spark = text.sparkSession
    ensure_conf(spark)
    broken = checks.where(F.col("broken") & F.col("utf8_ok") & F.col("error").isNull())
    records = line_records(text).withColumn("too_long", F.lit(False))
    if not broken.isEmpty():
        whole = staged(broken_records(text, broken), "broken-records")
        first = whole.where((F.col("block_start") == 0) & (F.col("mid") == 1)).select(
            "source_file", F.col("record").alias("whole_header"))
        checks = staged(with_names(checks.join(first, "source_file", "left").withColumn(
            "header", F.coalesce("header", "whole_header")).drop("names", "error", "whole_header")), "checks")
        records = records.join(broken.select("source_file"), "source_file", "left_anti").unionByName(whole)
    readable = checks.where(F.col("error").isNull() & F.col("names").isNotNull())
    common = readable.groupBy("names").count().orderBy(F.desc("count"), "names").first()
    names = common["names"] if common else []
    place = {n: i for i, n in enumerate(names)}  # the last of duplicate names wins
    known = [place.get(n) for n in RAW_COLUMNS]
    special = staged(checks.where(F.col("error").isNotNull() | ~F.col("names").eqNullSafe(
        F.array(*[F.lit(n) for n in names]).cast("array<string>"))).select(
            "source_file", F.col("error").isNull().alias("readable"), _places(F.col("names")).alias("places")),
        "other-headers")
    if special.isEmpty():
        return _fields_to_columns(records, [F.lit(p).cast("int") for p in known],
                                  [F.lit(p is None) for p in known]), checks
    # Rows meet the table by segment: no key is larger than one split.
    by_segment = staged(segments.select(*SEGMENT).join(special, "source_file"), "other-segments")
    joined = records.join(by_segment, SEGMENT, "left").where(F.coalesce("readable", F.lit(True)))
    standard = F.array(*[F.lit(p).cast("int") for p in known])
    joined = joined.withColumn("places", F.when(F.col("readable").isNull(), standard).otherwise(F.col("places")))
    places = [F.col("places")[i] for i in range(len(RAW_COLUMNS))]
    return _fields_to_columns(joined, places, [p.isNull() for p in places]), checks


def without_headers(raw: DataFrame) -> DataFrame:
    """Rows of ``scan_raw`` but the header of each file: the raw columns."""
    first = raw.where(F.col("block_start") == 0).groupBy("source_file").agg(F.min("mid").alias("mid"))
    rows = raw.join(first.withColumn("block_start", F.lit(0).cast("long")), [*SEGMENT, "mid"], "left_anti")
    return rows.select("source_file", *RAW_COLUMNS)
