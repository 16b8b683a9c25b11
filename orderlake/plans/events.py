"""The log of a run (FN-15): one JSON record per event, in the order in which
the reference logs them, as a table.

Per file: ``invocation_start``, ``s3_read_start``, ``s3_read_done`` (with the
number of characters, if the file could be decoded), one record for each row
that was skipped or whose total was computed, ``cleaning_done``; then
``s3_write_start``, ``s3_write_done``, ``processing_success`` and the response,
or ``processing_failed``. Rows are logged up to the one that fails the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import json_record
from ..sinks import object_key
from .ingest import SUCCESS_MESSAGE, Ingest, file_key

#: Order of the events of a file; those of rows are numbered by ``row`` within.
(START, READ, READ_DONE, ROW, CLEANED, WRITE, WRITE_DONE, OUTCOME, RESPONSE) = range(1, 10)


def _named(event: str, **fields) -> Column:
    return json_record(event=F.lit(event), **fields)


def run_events(ing: Ingest, output_bucket: str, request_id: str | None = None) -> DataFrame:
    """source_file, seq, row (for row events), event (name), record (JSON)."""
    request = F.lit(request_id or ing.run_id)
    bucket, key = F.lit(ing.landing), file_key(ing.landing)
    out_key = object_key(F.col("source_file"), ing.stamp)
    rows, accepted = F.col("rows_accepted"), F.col("error").isNull()
    finished = F.col("readable") & F.col("poison_row").isNull()
    events = [
        (START, "invocation_start", F.lit(True), dict(source_bucket=bucket, source_key=key, request_id=request)),
        (READ, "s3_read_start", F.lit(True), dict(bucket=bucket, key=key)),
        (READ_DONE, "s3_read_done", F.col("utf8_ok"), dict(key=key, bytes="chars")),
        (CLEANED, "cleaning_done", finished, dict(rows_accepted="rows_accepted", rows_skipped="rows_skipped")),
        (WRITE, "s3_write_start", accepted, dict(bucket=F.lit(output_bucket), key=out_key)),
        (WRITE_DONE, "s3_write_done", accepted, dict(key=out_key, rows=rows)),
        (OUTCOME, "processing_success", accepted,
         dict(source_key=key, output_key=out_key, rows_written=rows, request_id=request)),
        (OUTCOME, "processing_failed", ~accepted,
         dict(source_bucket=bucket, source_key=key, error="error", request_id=request)),
    ]
    body = json_record(message=F.lit(SUCCESS_MESSAGE), output_key=out_key, rows_written=rows)
    records = [F.struct(F.lit(seq).alias("seq"), F.lit(name).alias("event"), when.alias("happens"),
                        _named(name, **fields).alias("record")) for seq, name, when, fields in events]
    records.append(F.struct(F.lit(RESPONSE).alias("seq"), F.lit("response").alias("event"), accepted.alias("happens"),
                            json_record(statusCode=F.lit(200), body=body).alias("record")))
    files = ing.outcomes.select("source_file", F.inline(F.array(*records))).where("happens").select(
        "source_file", "seq", F.lit(None).cast("long").alias("row"), "event", "record")

    def of_rows(frame: DataFrame, event: str, record: Column) -> DataFrame:
        return frame.select("source_file", F.lit(ROW).alias("seq"), "row", F.lit(event).alias("event"),
                            record.alias("record"))

    # A skipped row has its text, or for a quantity the detail.
    with_value = _named("row_skipped", reason="reason", row="row", value="value")
    with_detail = _named("row_skipped", reason="reason", row="row", detail="detail")
    skipped = of_rows(ing.rejects(), "row_skipped", F.when(F.col("detail").isNull(), with_value).otherwise(with_detail))
    computed = of_rows(ing.repairs(), "total_amount_computed",
                       _named("total_amount_computed", row="row", computed="computed"))
    return files.unionByName(skipped).unionByName(computed)
