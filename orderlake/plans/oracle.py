"""DuckDB SQL for the correctness gate: the same questions asked of the same
parquet tables, written independently of the Spark code.

The raw-order fixture is rebuilt as a CTE; parsing uses DuckDB's own
``try_strptime`` / ``TRY_CAST``, which agree with the Python-parity Spark
expressions on this fixture (the edge strings are covered by unit tests).
"""

from __future__ import annotations

BASE = """
lines AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice,
         o.o_orderdate, c.c_name, n.n_name, p.p_name, p.p_retailprice,
         l.l_orderkey * 7 + l.l_linenumber AS k,
         l.l_orderkey % 400 AS file_no
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

RAW_FIELDS = """
    CASE WHEN k % 41 = 0 THEN 'not-a-date'
         WHEN k % 43 = 0 THEN '2024-02-30'
         WHEN k % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
         WHEN k % 3 = 1 THEN strftime(o_orderdate, '%d/%m/%Y')
         ELSE strftime(o_orderdate, '%Y/%m/%d') END AS "OrderDate",
    CASE WHEN k % 10 = 0 THEN '' ELSE '  ' || c_name || '@Example.COM ' END AS "CustomerEmail",
    ' ' || lower(n_name) || ' ' AS "Country",
    p_name || '  ' AS "Product",
    CASE WHEN k % 47 = 0 THEN 'N/A' ELSE CAST(p_retailprice AS VARCHAR) END AS "UnitPrice",
    CASE WHEN k % 5 = 0 THEN '' ELSE CAST(l_extendedprice AS VARCHAR) END AS "TotalAmount\""""

QTY_PLAIN = """CASE WHEN k % 29 = 0 THEN '0' WHEN k % 31 = 0 THEN '-1' WHEN k % 37 = 0 THEN 'two'
         ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END"""

RAW = f"""
raw AS (
  SELECT k, file_no, l_orderkey, l_linenumber,
    CAST(l_orderkey AS VARCHAR) AS "OrderID",
    {QTY_PLAIN} AS "Quantity",{RAW_FIELDS}
  FROM lines
)"""

RAW_FILES = f"""
raw AS (
  SELECT k, file_no, l_orderkey, l_linenumber,
    CASE WHEN k % 997 = 0 THEN 'BAD' ELSE CAST(l_orderkey AS VARCHAR) END AS "OrderID",
    CASE WHEN file_no % 100 = 99 THEN '0' ELSE {QTY_PLAIN} END AS "Quantity",{RAW_FIELDS}
  FROM lines
)"""

PARSED = """
parsed AS (
  SELECT *,
    CAST(coalesce(try_strptime(trim("OrderDate"), '%Y-%m-%d'),
                  try_strptime(trim("OrderDate"), '%d/%m/%Y'),
                  try_strptime(trim("OrderDate"), '%Y/%m/%d')) AS DATE) AS d,
    TRY_CAST(trim("Quantity") AS BIGINT) AS q,
    TRY_CAST(trim("UnitPrice") AS DOUBLE) AS u,
    TRY_CAST(trim("TotalAmount") AS DOUBLE) AS t,
    TRY_CAST(trim("OrderID") AS BIGINT) AS oid
  FROM raw
),
cls AS (
  SELECT *,
    CASE WHEN d IS NULL THEN 'invalid_date'
         WHEN q IS NULL OR q <= 0 THEN 'invalid_quantity'
         WHEN u IS NULL THEN 'invalid_unit_price' END AS reason,
    CASE WHEN d IS NULL THEN "OrderDate"
         WHEN q IS NULL OR q <= 0 THEN "Quantity"
         WHEN u IS NULL THEN "UnitPrice" END AS value,
    CASE WHEN d IS NOT NULL AND (q IS NULL OR q <= 0)
         THEN CASE WHEN q IS NULL THEN 'invalid literal for int() with base 10: ''' || "Quantity" || ''''
                   ELSE 'non-positive quantity' END END AS detail
  FROM parsed
),
clean_all AS (
  SELECT k, file_no, l_orderkey, l_linenumber, "OrderID" AS raw_order_id,
    oid AS order_id, d AS order_date,
    coalesce(nullif(lower(trim("CustomerEmail")), ''), 'unknown@unknown.com') AS customer_email,
    upper(trim("Country")) AS country,
    trim("Product") AS product,
    q AS quantity, u AS unit_price,
    coalesce(t, q * u) AS total_amount,
    CAST(year(d) AS INTEGER) AS year,
    strftime(d, '%m') AS month,
    strftime(d, '%d') AS day,
    t IS NULL AS total_was_computed
  FROM cls WHERE reason IS NULL
)"""

CLEAN_COLS = ("order_id, order_date, customer_email, country, product, quantity, "
              "unit_price, total_amount, year, month, day")


def with_fixture(body: str, files: bool = False) -> str:
    return f"WITH {BASE},{RAW_FILES if files else RAW},{PARSED}\n{body}"



# Per-file gating of the file variant. Rows are numbered in the order they are
# written into each file. A row that passes every row check but has a
# non-integer OrderID poisons its file; a file with no accepted row fails.
FILE_STATUS = r""",
file_rows AS (
  SELECT *,
    row_number() OVER (PARTITION BY file_no ORDER BY l_orderkey, l_linenumber, "OrderID",
        "OrderDate", "CustomerEmail", "Country", "Product", "Quantity", "UnitPrice",
        "TotalAmount") AS row,
    (reason IS NULL AND oid IS NULL) AS poison
  FROM cls
),
file_status AS (
  SELECT file_no,
    count(*) FILTER (WHERE reason IS NULL AND oid IS NOT NULL) AS rows_accepted,
    count(*) FILTER (WHERE reason IS NOT NULL) AS rows_skipped,
    min(row) FILTER (WHERE poison) AS poison_row
  FROM file_rows GROUP BY file_no
),
file_outcome AS (
  SELECT s.*,
    CASE WHEN s.poison_row IS NOT NULL
           THEN 'invalid literal for int() with base 10: ''' || p."OrderID" || ''''
         WHEN s.rows_accepted = 0 THEN 'No valid rows found after cleaning' END AS error
  FROM file_status s LEFT JOIN file_rows p ON p.file_no = s.file_no AND p.row = s.poison_row
)"""


def with_files(body: str) -> str:
    return f"WITH {BASE},{RAW_FILES},{PARSED}{FILE_STATUS}\n{body}"


# The three layouts of the fixture's files, by file number modulo 3.
HEADERS = """CASE file_no % 3
    WHEN 0 THEN 'OrderID,OrderDate,CustomerEmail,Country,Product,Quantity,UnitPrice,TotalAmount'
    WHEN 1 THEN 'TotalAmount,UnitPrice,Quantity,Product,Country,CustomerEmail,OrderDate,OrderID'
    ELSE 'Note,Product,Quantity,UnitPrice,TotalAmount,OrderID,OrderDate,CustomerEmail,Country' END"""

VIP = ("SELECT customer_email, round(sum(total_amount), 2) AS total_spent, "
       "count(order_id) AS order_count FROM {src} GROUP BY customer_email")
MARKET = ("SELECT country, round(sum(total_amount), 2) AS total_revenue, "
          "count(order_id) AS order_count FROM {src} GROUP BY country")
PRODUCT = ("SELECT product, round(sum(total_amount), 2) AS total_revenue, "
           "CAST(sum(quantity) AS BIGINT) AS total_units_sold, count(order_id) AS order_count "
           "FROM {src} GROUP BY product")
LABELS = "'all' AS year, 'all' AS month, 'all' AS day"
FINAL_COLS = ("order_id, order_date, customer_email, country, product, quantity, unit_price, "
              "total_amount, CAST(year AS VARCHAR) AS year, month, day")
PUBLISHED = ("(SELECT c.* FROM clean_all c JOIN file_outcome f USING (file_no) "
             "WHERE f.error IS NULL)")
ERRORS = "(SELECT event_id, ts FROM events WHERE event_type = 'error')"

ALARM = f"""
WITH b AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, count(*) AS arrivals
  FROM {ERRORS} e GROUP BY 1
), g AS (
  SELECT unnest(generate_series((SELECT min(window_start) FROM b),
                                (SELECT max(window_start) FROM b), INTERVAL 5 MINUTE)) AS window_start
), d AS (
  SELECT g.window_start, coalesce(b.arrivals, 0) AS arrivals FROM g LEFT JOIN b USING (window_start)
), s AS (
  SELECT window_start, arrivals,
    CAST(sum(arrivals) OVER (ORDER BY window_start ROWS BETWEEN 4031 PRECEDING AND CURRENT ROW)
         AS BIGINT) AS backlog
  FROM d
)
SELECT window_start, arrivals, backlog,
  CASE WHEN backlog >= 1 THEN 'ALARM' ELSE 'OK' END AS state FROM s"""

ONE_PASS = (
    "SELECT 'vip_customers' AS rollup, customer_email AS group_key, "
    "round(sum(total_amount), 2) AS amount, CAST(sum(quantity) AS BIGINT) AS units, "
    "count(order_id) AS order_count FROM clean_all GROUP BY customer_email "
    "UNION ALL SELECT 'market_performance', country, round(sum(total_amount), 2), "
    "CAST(sum(quantity) AS BIGINT), count(order_id) FROM clean_all GROUP BY country "
    "UNION ALL SELECT 'product_performance', product, round(sum(total_amount), 2), "
    "CAST(sum(quantity) AS BIGINT), count(order_id) FROM clean_all GROUP BY product")

TOP_MARKET = (
    "SELECT CAST(year AS VARCHAR) AS year, country, revenue FROM ("
    "SELECT year, country, round(sum(total_amount), 2) AS revenue, "
    "rank() OVER (PARTITION BY year ORDER BY round(sum(total_amount), 2) DESC) AS rnk "
    "FROM clean_all GROUP BY year, country) WHERE rnk = 1")

# CSV type inference of the processed orders: integers are "int" when every
# value fits 32 bits; zero-padded month/day text reads as numbers.
DISCOVER = with_fixture("""
SELECT 'orders' AS table_name, col_name, data_type, ordinal FROM (
  SELECT 'order_id' AS col_name, CASE WHEN (SELECT max(abs(order_id)) FROM clean_all) < 2147483648
         THEN 'int' ELSE 'bigint' END AS data_type, 0 AS ordinal
  UNION ALL SELECT 'order_date', 'date', 1
  UNION ALL SELECT 'customer_email', 'string', 2
  UNION ALL SELECT 'country', 'string', 3
  UNION ALL SELECT 'product', 'string', 4
  UNION ALL SELECT 'quantity', CASE WHEN (SELECT max(abs(quantity)) FROM clean_all) < 2147483648
         THEN 'int' ELSE 'bigint' END, 5
  UNION ALL SELECT 'unit_price', 'double', 6
  UNION ALL SELECT 'total_amount', 'double', 7
  UNION ALL SELECT 'year', 'int', 8
  UNION ALL SELECT 'month', 'int', 9
  UNION ALL SELECT 'day', 'int', 10
) t""")

DEAD = ("SELECT file_no, true AS in_bucket, 'file_no=' || CAST(file_no AS VARCHAR) AS key_folder, "
        "{fields} FROM file_outcome WHERE error IS NOT NULL")

DISCOVER_PARQUET = with_fixture("""
SELECT 'final_orders' AS table_name, col_name, data_type, CAST(ordinal AS INTEGER) AS ordinal
FROM (SELECT count(*) AS n FROM clean_all) rows, (VALUES
  ('order_id', 'bigint', 0), ('order_date', 'date', 1), ('customer_email', 'string', 2),
  ('country', 'string', 3), ('product', 'string', 4), ('quantity', 'bigint', 5),
  ('unit_price', 'double', 6), ('total_amount', 'double', 7), ('year', 'string', 8),
  ('month', 'string', 9), ('day', 'string', 10)) t(col_name, data_type, ordinal)
WHERE n > 0""")

EVENTS = """
, per_file AS (
  SELECT file_no, rows_accepted, rows_skipped, error, error IS NULL AS ok, poison_row IS NULL AS finished
  FROM file_outcome
), file_events AS (
  SELECT *, unnest([1, 2, 3, 5, 6, 7, 8, 9]) AS seq FROM per_file
)
SELECT file_no, seq, CAST(NULL AS BIGINT) AS row,
  CASE seq WHEN 1 THEN 'invocation_start' WHEN 2 THEN 's3_read_start' WHEN 3 THEN 's3_read_done'
           WHEN 5 THEN 'cleaning_done' WHEN 6 THEN 's3_write_start' WHEN 7 THEN 's3_write_done'
           WHEN 8 THEN CASE WHEN ok THEN 'processing_success' ELSE 'processing_failed' END
           ELSE 'response' END AS event,
  CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS value, CAST(NULL AS VARCHAR) AS detail,
  CAST(NULL AS DOUBLE) AS computed,
  CASE WHEN seq = 5 THEN rows_accepted END AS rows_accepted, CASE WHEN seq = 5 THEN rows_skipped END AS rows_skipped,
  CASE WHEN seq = 7 THEN rows_accepted END AS rows,
  CASE WHEN seq = 8 AND ok THEN rows_accepted END AS rows_written,
  CASE WHEN seq = 8 THEN error END AS error,
  CASE WHEN seq IN (1, 8) THEN 'orderlake-check' END AS request_id,
  CAST(CASE WHEN seq = 9 THEN 200 END AS INTEGER) AS status_code,
  CASE WHEN seq = 9 THEN 'File processed successfully' END AS message,
  CASE WHEN seq = 9 THEN rows_accepted END AS body_rows
FROM file_events WHERE seq <= 3 OR (seq = 5 AND finished) OR seq = 8 OR ok
UNION ALL
SELECT r.file_no, 4, r.row, CASE WHEN r.reason IS NULL THEN 'total_amount_computed' ELSE 'row_skipped' END,
  r.reason, CASE WHEN r.detail IS NULL THEN r.value END, r.detail,
  CASE WHEN r.reason IS NULL THEN r.q * r.u END, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM file_rows r JOIN file_status s USING (file_no)
WHERE (r.reason IS NOT NULL AND (s.poison_row IS NULL OR r.row < s.poison_row))
   OR (r.reason IS NULL AND r.t IS NULL AND (s.poison_row IS NULL OR r.row <= s.poison_row))"""

ORACLES: dict[str, str] = {
    "discover_schema_parquet": DISCOVER_PARQUET,
    "schema_evolution": with_fixture(
        "SELECT CAST(year AS VARCHAR) AS year, count(*) AS rows, count(country) AS with_country, "
        "count(DISTINCT country) AS countries FROM clean_all GROUP BY 1"),
    "dead_letters_json": with_files(DEAD.format(
        fields="error, '2024-02-01T00:00:00.000000+00:00' AS timestamp, "
               "'orderlake-check' AS request_id")),
    # Both errors of the fixture (a bad OrderID, no accepted row) are value errors.
    "failure_alerts": with_files(DEAD.format(fields="'ValueError' AS error, error AS cause")),
    "incremental_rollups": with_files(ONE_PASS.replace("FROM clean_all", f"FROM {PUBLISHED} p")),
    "orders_follow_source": with_files(f"SELECT {FINAL_COLS} FROM {PUBLISHED} p"),
    "processed_ledger": with_files(
        "SELECT file_no, CASE WHEN error IS NULL THEN rows_accepted ELSE 0 END AS rows_published FROM file_outcome"),
    "schema_changes": with_fixture("""
SELECT CAST(c.version AS INTEGER) AS version, col_name, change, old_type, found_type, table_type, rows
FROM (VALUES (2, 'country', 'added', NULL, 'string', 'string'), (2, 'channel', 'vanished', 'string', NULL, 'string'),
      (2, 'quantity', 'retyped', 'int', 'bigint', 'bigint'), (3, 'channel', 'vanished', 'string', NULL, 'string'),
      (3, 'unit_price', 'retyped', 'double', 'bigint', 'double'), (3, 'order_id', 'retyped', 'bigint', 'string', 'string')
     ) c(version, col_name, change, old_type, found_type, table_type)
JOIN (SELECT CASE WHEN year <= 1994 THEN 1 WHEN year <= 1996 THEN 2 ELSE 3 END AS version, count(*) AS rows
      FROM clean_all GROUP BY 1) r USING (version)"""),
    "evolved_table": with_fixture("""
SELECT year, count(*) AS rows, count(*) FILTER (WHERE year > 1994) AS with_country,
  count(*) FILTER (WHERE year <= 1994) AS with_channel, CAST(sum(quantity) AS BIGINT) AS units,
  round(sum(CASE WHEN year > 1996 THEN floor(unit_price) ELSE unit_price END), 2) AS prices,
  max(CAST(order_id AS VARCHAR)) AS last_order_text
FROM clean_all GROUP BY year"""),
    "pipeline_end_to_end": with_files(
        f"SELECT *, {LABELS} FROM ({MARKET.format(src=PUBLISHED + ' p')})"),
    "discover_schema": DISCOVER,
    "scan_raw_csv": with_files(
        'SELECT file_no, "OrderID", "OrderDate", "CustomerEmail", "Country", "Product", '
        '"Quantity", "UnitPrice", "TotalAmount" FROM raw'),
    "header_check": with_files(
        f"SELECT DISTINCT file_no, {HEADERS} AS header, true AS utf8_ok, "
        "CAST(NULL AS VARCHAR) AS error FROM raw"),
    "stream_ingest": with_files(f"SELECT {CLEAN_COLS} FROM {PUBLISHED} p"),
    "scan_catalog_orders": with_fixture(f"SELECT {FINAL_COLS} FROM clean_all"),
    "scan_final_orders_by_day": with_fixture(
        f"SELECT {FINAL_COLS} FROM clean_all WHERE year = 1997"),
    "clean_orders": with_fixture(f"SELECT {CLEAN_COLS} FROM clean_all"),
    "normalize_date": with_fixture(
        'SELECT "OrderDate" AS order_date_text, d AS order_date FROM parsed'),
    "normalize_email": with_fixture(
        'SELECT "CustomerEmail" AS email_text, '
        "coalesce(nullif(lower(trim(\"CustomerEmail\")), ''), 'unknown@unknown.com') "
        "AS customer_email FROM raw"),
    "normalize_country": with_fixture(
        'SELECT "Country" AS country_text, upper(trim("Country")) AS country FROM raw'),
    "normalize_product": with_fixture(
        'SELECT "Product" AS product_text, trim("Product") AS product FROM raw'),
    "parse_quantity": with_fixture('SELECT "Quantity" AS quantity_text, q AS quantity FROM parsed'),
    "parse_unit_price": with_fixture(
        'SELECT "UnitPrice" AS unit_price_text, u AS unit_price FROM parsed'),
    "total_amount_fallback": with_fixture(
        'SELECT "TotalAmount" AS total_text, q AS quantity, u AS unit_price, '
        "coalesce(t, q * u) AS total_amount FROM parsed WHERE q IS NOT NULL AND u IS NOT NULL"),
    "date_parts": with_fixture(
        "SELECT d AS order_date, CAST(year(d) AS INTEGER) AS year, strftime(d, '%m') AS month, "
        "strftime(d, '%d') AS day FROM parsed WHERE d IS NOT NULL"),
    "rollup_partition_labels": with_fixture(
        f"SELECT *, {LABELS} FROM ({VIP.format(src='clean_all')})"),
    "reject_invalid_date": with_fixture(
        'SELECT "OrderID" AS raw_order_id, value FROM cls WHERE reason = \'invalid_date\''),
    "reject_invalid_quantity": with_fixture(
        'SELECT "OrderID" AS raw_order_id, value, detail FROM cls '
        "WHERE reason = 'invalid_quantity'"),
    "reject_invalid_unit_price": with_fixture(
        'SELECT "OrderID" AS raw_order_id, value FROM cls WHERE reason = \'invalid_unit_price\''),
    "reject_reason": with_fixture(
        'SELECT "OrderID" AS raw_order_id, '
        "CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status, reason FROM cls"),
    "poison_files": with_files(
        "SELECT file_no, poison_row, error FROM file_outcome WHERE poison_row IS NOT NULL"),
    "no_valid_rows_files": with_files(
        "SELECT file_no, rows_skipped, error FROM file_outcome "
        "WHERE poison_row IS NULL AND rows_accepted = 0"),
    "published_orders": with_files(f"SELECT {CLEAN_COLS} FROM {PUBLISHED} p"),
    "rejects": with_files(
        'SELECT r.file_no, r.row, r.reason, r.value, r.detail, r."OrderID" AS raw_order_id '
        "FROM file_rows r JOIN file_status s USING (file_no) "
        "WHERE r.reason IS NOT NULL AND (s.poison_row IS NULL OR r.row < s.poison_row)"),
    "repairs": with_files(
        'SELECT r.file_no, r.row, r."OrderID" AS raw_order_id, r.q * r.u AS computed '
        "FROM file_rows r JOIN file_status s USING (file_no) "
        "WHERE r.reason IS NULL AND r.t IS NULL "
        "AND (s.poison_row IS NULL OR r.row <= s.poison_row)"),
    "ingest_metrics": with_files(
        "SELECT file_no, rows_accepted, rows_skipped FROM file_status WHERE poison_row IS NULL"),
    "reject_profile": with_fixture(
        "SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status, reason, "
        "count(*) AS rows, count(*) FILTER (WHERE reason IS NULL AND t IS NULL) AS computed_totals, "
        "count(*) FILTER (WHERE reason IS NULL AND isnan(coalesce(t, q * u))) AS nan_totals "
        "FROM cls GROUP BY 1, 2"),
    "dead_letters": with_files(
        "SELECT file_no, error, TIMESTAMP '2024-02-01 00:00:00' AS timestamp, "
        "'orderlake-check' AS request_id FROM file_outcome WHERE error IS NOT NULL"),
    "dead_letter_retention": (
        f"SELECT event_id, ts FROM {ERRORS} e "
        f"WHERE ts > (SELECT max(ts) FROM {ERRORS} m) - INTERVAL 14 DAY "
        f"AND ts <= (SELECT max(ts) FROM {ERRORS} m2)"),
    "dead_letter_alarm": ALARM,
    # The live form goes on until the last message has expired.
    "dead_letter_alarm_live": ALARM.replace(
        "(SELECT max(window_start) FROM b)", "(SELECT max(window_start) FROM b) + INTERVAL 14 DAY"),
    "run_summary": with_files(
        "SELECT file_no, 'File processed successfully' AS message, 'orders_processed_20240201000000' AS key_stamp, "
        "f.rows_accepted AS rows_written, count(*) AS rows_in_object, round(sum(c.total_amount), 2) AS total_in_object "
        "FROM file_outcome f JOIN clean_all c USING (file_no) WHERE error IS NULL AND c.order_id IS NOT NULL "
        "GROUP BY file_no, f.rows_accepted"),
    "run_events": with_files(EVENTS),
    "vip_customers": with_fixture(VIP.format(src="clean_all")),
    "market_performance": with_fixture(MARKET.format(src="clean_all")),
    "product_performance": with_fixture(PRODUCT.format(src="clean_all")),
    "rollups_one_pass": with_fixture(ONE_PASS),
    "sink_clean_csv": with_fixture(f"SELECT {CLEAN_COLS} FROM clean_all"),
    "sink_rollup_csv": with_fixture(VIP.format(src="clean_all")),
    "sink_rollup_parquet": with_fixture(
        f"SELECT *, {LABELS} FROM ({PRODUCT.format(src='clean_all')})"),
    "sink_orders_parquet": with_fixture(f"SELECT {FINAL_COLS} FROM clean_all"),
    "adhoc_sql_daily_revenue": with_fixture(
        "SELECT order_date, round(sum(total_amount), 2) AS revenue, count(order_id) AS orders "
        "FROM clean_all GROUP BY order_date"),
    "adhoc_sql_top_market": with_fixture(TOP_MARKET),
    "incremental_rerun": with_files(f"SELECT {CLEAN_COLS} FROM {PUBLISHED} p"),
    "end_to_end_run": with_files(
        f"SELECT *, {LABELS} FROM ({VIP.format(src=PUBLISHED + ' p')})"),
}
