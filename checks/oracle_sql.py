"""DuckDB SQL oracle for every query in ``tillflow.plans.queries``.

Written directly in SQL against the pre-registered test tables, not derived
from the Spark code. Decimal results are cast to DOUBLE, integer widths are
cast to the Spark result types, and rounding of averages is done in exact
integer arithmetic (DuckDB turns decimal division into DOUBLE).
"""

from __future__ import annotations

BATCH_ID = "fixture_batch"
INGESTED_AT = "TIMESTAMP '2001-09-01 00:00:00'"
QUARANTINED_AT = "TIMESTAMP '2001-09-01 00:00:00'"
AS_OF = "DATE '2001-08-31'"
WM_TS = "TIMESTAMP '1998-06-27 16:35:00'"
WM_INV = "'6000'"

IDS = "l_orderkey, l_partkey, l_linenumber, l_suppkey, l_extendedprice"
ORDER_DESC = ("l_orderkey DESC, l_partkey DESC, l_linenumber DESC, l_suppkey DESC, "
              "l_extendedprice DESC")
NA_TOKENS = ("'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', "
             "'1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'")


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def tok(x: str) -> str:
    return f"CASE WHEN {x} IN ('NULL', 'null', '') THEN NULL ELSE {x} END"


SALE = "(LEFT(invoice_no, 1) != 'C' AND quantity > 0)"

SRC = """src AS (
SELECT
  CASE WHEN l_orderkey % 97 = 0 THEN NULL
       WHEN l_returnflag = 'R' THEN 'C' || CAST(o_orderkey AS VARCHAR)
       ELSE CAST(o_orderkey AS VARCHAR) END AS invoice_no,
  CASE WHEN l_partkey % 50 = 0 THEN 'POST'
       WHEN l_partkey % 50 = 1 THEN ' post '
       WHEN l_partkey % 50 BETWEEN 2 AND 9 THEN 'sku' || CAST(l_partkey % 400 AS VARCHAR)
       WHEN l_partkey % 50 = 10 THEN 'SLW' || CAST(l_orderkey AS VARCHAR)
       WHEN l_partkey % 50 = 11 THEN 'nan'
       WHEN l_partkey % 50 = 12 THEN NULL
       ELSE 'SKU' || CAST(l_partkey AS VARCHAR) END AS stock_code,
  CASE WHEN l_linenumber = 7 AND l_partkey % 3 = 0 THEN 'nan'
       WHEN l_linenumber = 6 AND l_partkey % 5 = 0 THEN NULL
       WHEN l_orderkey % 127 = 0 THEN UPPER(p_name) || repeat('-', 500)
       ELSE ' ' || UPPER(p_name) || ' ' END AS description,
  CASE WHEN l_orderkey % 113 = 0 THEN NULL
       WHEN l_returnflag = 'R' THEN -l_quantity
       ELSE l_quantity END AS quantity,
  CASE WHEN l_orderkey % 109 = 0 THEN NULL
       WHEN l_orderkey % 3 = 0 THEN o_orderdate + (o_orderkey % 1440) * INTERVAL '1' MINUTE
                                    + l_linenumber * INTERVAL '1' MILLISECOND
       ELSE o_orderdate + (o_orderkey % 1440) * INTERVAL '1' MINUTE END AS invoice_date,
  CASE WHEN l_orderkey % 101 = 0 THEN -p_retailprice
       WHEN l_orderkey % 103 = 0 THEN 0.0
       WHEN l_orderkey % 107 = 0 THEN NULL
       WHEN l_orderkey % 131 = 0 THEN 1e8 + p_retailprice
       ELSE p_retailprice END AS unit_price,
  CASE WHEN o_custkey % 13 = 0 THEN NULL
       WHEN o_custkey % 17 = 0 THEN '  '
       WHEN o_custkey % 19 = 0 THEN 'NaN'
       WHEN o_custkey % 4 = 0 THEN CAST(o_custkey % 100 AS VARCHAR)
       WHEN o_custkey % 4 = 1 THEN ' ' || CAST(o_custkey % 500 AS VARCHAR)
       ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
  CASE WHEN l_orderkey % 137 = 0 THEN NULL
       WHEN n_nationkey % 2 = 0 THEN LOWER(n_name) ELSE n_name || ' ' END AS country,
  l_orderkey, l_partkey, l_linenumber, l_suppkey, l_extendedprice
FROM lineitem
JOIN orders   ON l_orderkey = o_orderkey
JOIN customer ON o_custkey  = c_custkey
JOIN nation   ON c_nationkey = n_nationkey
JOIN part     ON l_partkey  = p_partkey
)"""

CLEANED = f"""cleaned AS (
SELECT
  {strip('invoice_no')} AS invoice_no,
  {strip('stock_code')} AS stock_code,
  {strip('description')} AS description,
  CASE WHEN isnan(quantity) THEN NULL ELSE CAST(quantity AS DOUBLE) END AS quantity,
  CAST(invoice_date AS TIMESTAMP) AS invoice_date,
  CASE WHEN isnan(unit_price) THEN NULL ELSE CAST(unit_price AS DOUBLE) END AS unit_price,
  NULLIF({strip("COALESCE(customer_id, 'nan')")}, 'nan') AS customer_id,
  {strip('country')} AS country,
  {IDS}
FROM src
)"""

DEDUP = f"""ranked AS (
SELECT *,
  row_number() OVER (PARTITION BY invoice_no, stock_code, invoice_date ORDER BY {ORDER_DESC}) AS rn
FROM cleaned
),
dedup AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1)"""

FLAGGED = """flagged AS (
SELECT *,
  (CASE WHEN invoice_no IS NULL THEN 'invoice_no is null; ' ELSE '' END ||
   CASE WHEN stock_code IS NULL THEN 'stock_code is null; ' ELSE '' END ||
   CASE WHEN invoice_date IS NULL THEN 'invoice_date is null; ' ELSE '' END ||
   CASE WHEN quantity IS NULL THEN 'quantity is null; ' ELSE '' END ||
   CASE WHEN unit_price IS NULL THEN 'unit_price is null; ' ELSE '' END ||
   CASE WHEN unit_price < 0 THEN 'unit_price is negative; ' ELSE '' END) AS error_reason
FROM dedup
)"""

CONFORMED = f"""conformed AS (
SELECT
  {tok('invoice_no')} AS invoice_no,
  {tok('stock_code')} AS stock_code,
  {tok('description')} AS description,
  TRY_CAST(quantity AS DECIMAL(10,2)) AS quantity,
  CAST(date_trunc('second', invoice_date) AS TIMESTAMP) AS invoice_date,
  TRY_CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
  {tok('customer_id')} AS customer_id,
  {tok('country')} AS country,
  '{BATCH_ID}' AS batch_id,
  {INGESTED_AT} AS ingested_at,
  error_reason,
  (COALESCE(length({tok('invoice_no')}) <= 20, TRUE)
   AND COALESCE(length({tok('stock_code')}) <= 20, TRUE)
   AND COALESCE(length({tok('description')}) <= 500, TRUE)
   AND COALESCE(length({tok('customer_id')}) <= 20, TRUE)
   AND COALESCE(length({tok('country')}) <= 100, TRUE)
   AND (quantity IS NULL OR TRY_CAST(quantity AS DECIMAL(10,2)) IS NOT NULL)
   AND (unit_price IS NULL OR TRY_CAST(unit_price AS DECIMAL(10,2)) IS NOT NULL)) AS loadable,
  {IDS}
FROM flagged
)"""

RAW = """raw AS (
SELECT invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id,
       country, batch_id, ingested_at
FROM conformed WHERE error_reason = '' AND loadable
)"""

STG_ORDERS = """stg_orders AS (
SELECT
  invoice_no, stock_code,
  CASE WHEN LEFT(invoice_no, 1) = 'C' THEN TRUE ELSE FALSE END AS is_cancelled,
  TRIM(description) AS description,
  TRY_CAST(quantity AS DECIMAL(10,2)) AS quantity,
  TRY_CAST(unit_price AS DECIMAL(10,4)) AS unit_price,
  TRY_CAST(quantity * unit_price AS DECIMAL(12,4)) AS line_total,
  CAST(invoice_date AS TIMESTAMP) AS invoice_date,
  CAST(invoice_date AS DATE) AS invoice_date_key,
  NULLIF(TRIM(customer_id), '') AS customer_id,
  UPPER(TRIM(country)) AS country,
  batch_id, ingested_at
FROM raw
)"""

STG_CUSTOMERS = f"""stg_customers AS (
SELECT
  TRIM(customer_id) AS customer_id,
  MAX(TRIM(country)) AS country,
  MIN(invoice_date) AS first_order_date,
  MAX(invoice_date) AS last_order_date,
  COUNT(DISTINCT CASE WHEN {SALE} THEN invoice_no END) AS total_orders,
  COUNT(CASE WHEN {SALE} THEN 1 END) AS total_line_items,
  SUM(CASE WHEN {SALE} THEN quantity ELSE 0 END) AS total_units_purchased,
  SUM(CASE WHEN {SALE} THEN quantity * unit_price ELSE 0 END) AS lifetime_revenue
FROM raw
WHERE customer_id IS NOT NULL AND TRIM(customer_id) != '' AND LOWER(TRIM(customer_id)) != 'nan'
GROUP BY TRIM(customer_id)
)"""

PRODUCT_FILTER = ("stock_code IS NOT NULL AND TRIM(stock_code) != '' AND TRIM(stock_code) != 'nan' "
                  "AND stock_code NOT IN ('POST', 'D', 'M', 'BANK CHARGES', 'PADS')")

# Average of the positive prices at scale 6, half-up, as an integer of
# millionths: avg * 1e6 = cents * 1e4 / n.
STG_PRODUCTS = f"""stg_products_int AS (
SELECT
  UPPER(TRIM(stock_code)) AS stock_code,
  NULLIF(MAX(TRIM(description)), 'nan') AS description,
  SUM(CASE WHEN unit_price > 0 THEN CAST(unit_price * 100 AS HUGEINT) END) AS pos_cents,
  COUNT(CASE WHEN unit_price > 0 THEN 1 END) AS pos_n,
  MIN(CASE WHEN unit_price > 0 THEN unit_price END) AS min_unit_price,
  MAX(unit_price) AS max_unit_price,
  SUM(CASE WHEN {SALE} THEN quantity ELSE 0 END) AS total_units_sold,
  COUNT(DISTINCT invoice_no) AS times_ordered,
  COUNT(DISTINCT customer_id) AS unique_customers,
  MIN(invoice_date) AS first_sold_date,
  MAX(invoice_date) AS last_sold_date
FROM raw
WHERE {PRODUCT_FILTER}
GROUP BY UPPER(TRIM(stock_code))
),
stg_products AS (
SELECT stock_code, description,
  CASE WHEN pos_n > 0 THEN (pos_cents * 20000 + pos_n) // (2 * pos_n) END AS avg_micros,
  min_unit_price, max_unit_price, total_units_sold, times_ordered, unique_customers,
  first_sold_date, last_sold_date
FROM stg_products_int
)"""

FCT = """fct AS (
SELECT
  md5(invoice_no || '-' || stock_code || '-' || strftime(invoice_date, '%Y-%m-%d %H:%M:%S')) AS order_key,
  invoice_no, stock_code, customer_id,
  CAST(strftime(CAST(invoice_date AS DATE), '%Y%m%d') AS INTEGER) AS date_id,
  is_cancelled, invoice_date, quantity, unit_price,
  ROUND(line_total, 2) AS line_total,
  CASE WHEN is_cancelled THEN ABS(line_total) * -1 ELSE line_total END AS net_line_total,
  country, batch_id, ingested_at
FROM stg_orders
)"""

DAYS_SINCE = f"datediff('day', CAST(last_order_date AS DATE), {AS_OF})"

# avg_order_value: revenue (scale 4) / orders, half-up to 2 decimals, exact.
DIM_CUSTOMERS = f"""dim_customers AS (
SELECT
  customer_id, country, first_order_date, last_order_date, total_orders, total_line_items,
  total_units_purchased,
  ROUND(lifetime_revenue, 2) AS lifetime_revenue,
  CASE WHEN total_orders = 0 THEN NULL
       ELSE ((CAST(lifetime_revenue * 10000 AS HUGEINT) * 2 + 100 * total_orders)
             // (200 * total_orders)) / 100.0 END AS avg_order_value,
  CAST({DAYS_SINCE} AS INTEGER) AS days_since_last_order,
  CAST(datediff('day', CAST(first_order_date AS DATE), CAST(last_order_date AS DATE)) AS INTEGER)
    AS customer_lifetime_days,
  CASE WHEN lifetime_revenue >= 10000 AND total_orders >= 50 THEN 'VIP'
       WHEN total_orders >= 20 THEN 'LOYAL'
       WHEN total_orders >= 5 THEN 'REGULAR'
       ELSE 'NEW' END AS customer_segment,
  CASE WHEN {DAYS_SINCE} <= 30 THEN 'ACTIVE'
       WHEN {DAYS_SINCE} <= 90 THEN 'WARM'
       ELSE 'CHURN_RISK' END AS customer_status
FROM stg_customers
)"""

DIM_PRODUCTS = """dim_products AS (
SELECT
  stock_code, description,
  CAST((avg_micros + 5000) // 10000 AS DOUBLE) / 100.0 AS avg_unit_price,
  ROUND(min_unit_price, 2) AS min_unit_price,
  ROUND(max_unit_price, 2) AS max_unit_price,
  total_units_sold, times_ordered, unique_customers, first_sold_date, last_sold_date,
  CASE WHEN total_units_sold >= 10000 THEN 'BESTSELLER'
       WHEN total_units_sold >= 1000 THEN 'POPULAR'
       WHEN total_units_sold >= 100 THEN 'REGULAR'
       ELSE 'SLOW_MOVER' END AS product_tier
FROM stg_products
)"""

DIM_DATE = """bounds AS (
SELECT date_trunc('year', MIN(invoice_date)) AS lo,
       date_trunc('year', MAX(invoice_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS hi
FROM raw
),
spine AS (
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS full_date
FROM bounds WHERE lo IS NOT NULL
),
dim_date AS (
SELECT
  CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_id,
  full_date,
  CAST(day(full_date) AS INTEGER) AS day_of_month,
  CAST(dayofweek(full_date) AS INTEGER) AS day_of_week_number,
  strftime(full_date, '%a') AS day_of_week_name,
  CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
  CAST(month(full_date) AS INTEGER) AS month_number,
  strftime(full_date, '%b') AS month_name,
  CAST(quarter(full_date) AS INTEGER) AS quarter_number,
  'Q' || CAST(quarter(full_date) AS VARCHAR) AS quarter_name,
  CAST(year(full_date) AS INTEGER) AS year,
  dayofweek(full_date) IN (0, 6) AS is_weekend,
  strftime(full_date, '%Y-%m') AS year_month
FROM spine
)"""

BASE = ",\n".join([SRC, CLEANED, DEDUP, FLAGGED, CONFORMED, RAW, STG_ORDERS, STG_CUSTOMERS,
                   STG_PRODUCTS, FCT, DIM_CUSTOMERS, DIM_PRODUCTS, DIM_DATE])

# The same ingest chain with missing text rendered as 'nan' (string_nulls="nan").
CLEANED_NAN = f"""cleaned_nan AS (
SELECT
  {strip("COALESCE(invoice_no, 'nan')")} AS invoice_no,
  {strip("COALESCE(stock_code, 'nan')")} AS stock_code,
  {strip("COALESCE(description, 'nan')")} AS description,
  CASE WHEN isnan(quantity) THEN NULL ELSE CAST(quantity AS DOUBLE) END AS quantity,
  CAST(invoice_date AS TIMESTAMP) AS invoice_date,
  CASE WHEN isnan(unit_price) THEN NULL ELSE CAST(unit_price AS DOUBLE) END AS unit_price,
  NULLIF({strip("COALESCE(customer_id, 'nan')")}, 'nan') AS customer_id,
  {strip("COALESCE(country, 'nan')")} AS country,
  {IDS}
FROM src
)"""


def _nan_chain() -> str:
    parts = [CLEANED_NAN]
    for text, names in ((DEDUP, ("ranked", "dedup")), (FLAGGED, ("flagged",)), (CONFORMED, ("conformed",)),
                        (RAW, ("raw",))):
        t = text
        for n in ("raw", "conformed", "flagged", "dedup", "ranked", "cleaned"):
            t = t.replace(f"FROM {n}\n", f"FROM {n}_nan\n").replace(f"FROM {n} ", f"FROM {n}_nan ")
            t = t.replace(f"{n} AS (", f"{n}_nan AS (")
        parts.append(t)
    return ",\n".join(parts)


NAN_CHAIN = _nan_chain()


def q(select: str) -> str:
    return f"WITH {BASE}\n{select}"


def dbl(*cols: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


def share(expr: str) -> str:
    return (f"CAST({expr} AS DOUBLE) * CAST(100.0 AS DOUBLE) "
            f"/ NULLIF(CAST(SUM({expr}) OVER () AS DOUBLE), 0.0)")


STG_ORDERS_COLS = ("invoice_no, stock_code, is_cancelled, description, "
                   + dbl("quantity", "unit_price", "line_total")
                   + ", invoice_date, invoice_date_key, customer_id, country, batch_id, ingested_at")

NOT_NULL_STG_ORDERS = ("invoice_no", "stock_code", "is_cancelled", "quantity", "unit_price",
                       "line_total", "invoice_date", "country")

SUITE = (
    ("stg_orders", "stg_orders", NOT_NULL_STG_ORDERS, ()),
    ("stg_customers", "stg_customers", ("customer_id", "country", "first_order_date", "last_order_date",
                                        "total_orders", "lifetime_revenue"), ("customer_id",)),
    ("stg_products", "stg_products", ("stock_code", "total_units_sold", "times_ordered"), ("stock_code",)),
    ("dim_date", "dim_date", ("date_id", "full_date"), ("date_id",)),
    ("dim_customers", "dim_customers", ("customer_id", "country", "customer_segment"), ("customer_id",)),
    ("dim_products", "dim_products", ("stock_code",), ("stock_code",)),
    ("fct_orders", "fct", ("order_key", "invoice_no", "date_id", "quantity", "line_total"), ("order_key",)),
)


def _suite_sql() -> str:
    parts = []
    for model, cte, nn, uq in SUITE:
        for c in nn:
            parts.append(f"SELECT '{model}' AS model, '{c}' AS column_name, 'not_null' AS test, "
                         f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {cte}")
        for c in uq:
            parts.append(f"SELECT '{model}' AS model, '{c}' AS column_name, 'unique' AS test, "
                         f"CAST(COUNT(*) AS BIGINT) AS failures FROM (SELECT {c} FROM {cte} "
                         f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)")
    body = "\nUNION ALL\n".join(parts)
    return f"SELECT model, column_name, test, failures, failures = 0 AS passed FROM (\n{body}\n)"


def _not_null_sql() -> str:
    parts = [f"SELECT 'stg_orders' AS model, '{c}' AS column_name, 'not_null' AS test, "
             f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM stg_orders"
             for c in NOT_NULL_STG_ORDERS]
    return "\nUNION ALL\n".join(parts)


CUT = "TIMESTAMP '1998-01-01 00:00:00'"
IO_IDS = "l_orderkey, l_partkey, l_linenumber, l_suppkey"


def _ranked_marks(where: str) -> str:
    return (f"SELECT country, invoice_date, invoice_no, row_number() OVER (PARTITION BY country "
            f"ORDER BY invoice_date DESC, invoice_no DESC) AS rn FROM flagged WHERE error_reason = '' {where}")


WATERMARK_UPSERT = f"""SELECT
  COALESCE(t.pipeline_name, s.pipeline_name) AS pipeline_name,
  COALESCE(t.source_table, s.source_table) AS source_table,
  CASE WHEN s.source_table IS NOT NULL THEN s.last_processed_at ELSE t.last_processed_at END AS last_processed_at,
  CASE WHEN s.source_table IS NOT NULL THEN s.last_invoice_no ELSE t.last_invoice_no END AS last_invoice_no,
  CASE WHEN s.source_table IS NOT NULL THEN s.updated_at ELSE t.updated_at END AS updated_at
FROM (SELECT country AS pipeline_name, 'raw_orders' AS source_table, invoice_date AS last_processed_at,
             invoice_no AS last_invoice_no, TIMESTAMP '2001-01-01 00:00:00' AS updated_at
      FROM ({_ranked_marks(f"AND invoice_date < {CUT}")}) WHERE rn = 1) t
FULL OUTER JOIN
     (SELECT country AS pipeline_name,
             CASE WHEN lower(country) = country THEN 'raw_orders' ELSE 'raw_orders_v2' END AS source_table,
             invoice_date AS last_processed_at, invoice_no AS last_invoice_no,
             TIMESTAMP '2001-09-01 00:00:00' AS updated_at
      FROM ({_ranked_marks("")}) WHERE rn = 1) s
ON t.pipeline_name IS NOT DISTINCT FROM s.pipeline_name AND t.source_table = s.source_table"""

AUDIT_DAYS = """SELECT CAST(invoice_date AS DATE) AS d, MIN(invoice_date) AS first_ts, MAX(invoice_date) AS last_ts,
  COUNT(*) AS lines, COUNT(*) FILTER (WHERE error_reason = '') AS clean,
  COUNT(*) FILTER (WHERE error_reason != '') AS rejected
FROM flagged WHERE invoice_date IS NOT NULL GROUP BY 1"""

AUDIT_UPSERT = f"""SELECT
  COALESCE(t.batch_id, s.batch_id) AS batch_id,
  CASE WHEN t.batch_id IS NOT NULL THEN t.pipeline_name ELSE s.pipeline_name END AS pipeline_name,
  CASE WHEN s.batch_id IS NOT NULL THEN s.status ELSE t.status END AS status,
  CASE WHEN s.batch_id IS NOT NULL THEN s.records_read ELSE t.records_read END AS records_read,
  CASE WHEN s.batch_id IS NOT NULL THEN s.records_loaded ELSE t.records_loaded END AS records_loaded,
  CASE WHEN t.batch_id IS NOT NULL THEN t.started_at ELSE s.started_at END AS started_at,
  CASE WHEN s.batch_id IS NOT NULL THEN s.completed_at ELSE t.completed_at END AS completed_at,
  CASE WHEN s.batch_id IS NOT NULL THEN s.duration_seconds ELSE t.duration_seconds END AS duration_seconds,
  CASE WHEN s.batch_id IS NOT NULL THEN s.error_message ELSE t.error_message END AS error_message,
  CASE WHEN s.batch_id IS NOT NULL THEN s.updated_at ELSE t.updated_at END AS updated_at
FROM (SELECT 'orders_' || strftime(d, '%Y%m%d') AS batch_id, 'retail_orders_pipeline' AS pipeline_name,
             'in_progress' AS status, CAST(0 AS BIGINT) AS records_read, CAST(0 AS BIGINT) AS records_loaded,
             first_ts AS started_at, CAST(NULL AS TIMESTAMP) AS completed_at,
             CAST(NULL AS DOUBLE) AS duration_seconds, CAST(NULL AS VARCHAR) AS error_message,
             first_ts AS updated_at
      FROM ({AUDIT_DAYS}) WHERE year(d) <= 1996) t
FULL OUTER JOIN
     (SELECT 'orders_' || strftime(d, '%Y%m%d') AS batch_id, 'late_writer' AS pipeline_name,
             'success' AS status, CAST(lines AS BIGINT) AS records_read, CAST(clean AS BIGINT) AS records_loaded,
             last_ts AS started_at, last_ts AS completed_at,
             CAST(date_diff('microsecond', first_ts, last_ts) // 1000000 AS DOUBLE) AS duration_seconds,
             CASE WHEN rejected > 0 THEN 'rejected ' || CAST(rejected AS VARCHAR) END AS error_message,
             last_ts AS updated_at
      FROM ({AUDIT_DAYS}) WHERE year(d) >= 1996) s
ON t.batch_id = s.batch_id"""

TOKENED_SRC = ("SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, quantity, invoice_date, unit_price, "
               + ", ".join(f"CASE WHEN {c} IN ({NA_TOKENS}) THEN NULL ELSE {c} END AS {c}"
                           for c in ("invoice_no", "stock_code", "description", "customer_id", "country"))
               + " FROM src")


NUMBER_TEXT = """SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_extendedprice,
  CASE WHEN l_linenumber = 2 THEN NULL WHEN l_linenumber = 3 THEN NULL WHEN l_linenumber = 6 THEN quantity * 10
       ELSE quantity END AS quantity,
  CASE WHEN l_linenumber = 4 THEN NULL WHEN l_linenumber = 5 THEN NULL ELSE unit_price END AS unit_price FROM src"""

DATE_TEXT = """SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_extendedprice,
  CASE l_linenumber WHEN 2 THEN date_trunc('minute', invoice_date) WHEN 3 THEN NULL
       WHEN 4 THEN date_trunc('day', invoice_date) WHEN 5 THEN NULL ELSE invoice_date END AS invoice_date FROM src"""

YEARS = """SELECT CAST(year(invoice_date) AS VARCHAR) AS y, MIN(invoice_date) AS first_ts, MAX(invoice_date) AS last_ts,
  COUNT(*) AS lines, COUNT(*) FILTER (WHERE error_reason = '') AS clean
FROM flagged WHERE invoice_date IS NOT NULL GROUP BY 1"""

# Years that end in an even digit complete, the others fail; each then reports once more.
AUDIT_LIFECYCLE = f"""SELECT 'orders_' || y AS batch_id, 'retail_orders_pipeline' AS pipeline_name,
  CASE WHEN CAST(y AS INTEGER) % 2 = 0 THEN 'success' ELSE 'failed' END AS status,
  CAST(CASE WHEN CAST(y AS INTEGER) % 2 = 0 THEN lines ELSE 0 END AS BIGINT) AS records_read,
  CAST(CASE WHEN CAST(y AS INTEGER) % 2 = 0 THEN clean ELSE 0 END AS BIGINT) AS records_loaded,
  first_ts AS started_at, last_ts AS completed_at,
  CAST(date_diff('microsecond', first_ts, last_ts) AS DOUBLE) / 1000000.0 AS duration_seconds,
  CASE WHEN CAST(y AS INTEGER) % 2 = 1 THEN 'year ' || y END AS error_message
FROM ({YEARS})"""

MARK = ("(SELECT invoice_date AS t, invoice_no AS i FROM flagged WHERE error_reason = '' "
        "ORDER BY invoice_date DESC, invoice_no DESC LIMIT 1)")

MARTS_WRITTEN = f"""SELECT 'dim_customers' AS mart, customer_id AS name, CAST(total_orders AS BIGINT) AS counted,
  CAST(lifetime_revenue AS DOUBLE) AS amount, customer_segment AS label, first_order_date AS first_at, last_order_date AS last_at
FROM dim_customers
UNION ALL
SELECT 'dim_products', stock_code, CAST(times_ordered * 1000000 + unique_customers AS BIGINT), CAST(total_units_sold AS DOUBLE),
  product_tier, first_sold_date, last_sold_date FROM dim_products
UNION ALL
SELECT 'fct_orders', CASE WHEN invoice_date < {CUT} THEN 'm1' ELSE 'm2' END, COUNT(*), CAST(SUM(net_line_total) AS DOUBLE),
  NULL, MIN(invoice_date), MAX(invoice_date) FROM fct GROUP BY 2"""

# Lines 7 have one field too many; unfit clean lines are set aside as well.
CSV_QUARANTINE = f"""WITH {SRC},
tokened AS ({TOKENED_SRC}),
typed AS (
SELECT {strip('invoice_no')} AS invoice_no, {strip('stock_code')} AS stock_code, {strip('description')} AS description,
  quantity, invoice_date, unit_price, {strip('country')} AS country, l_linenumber = 7 AS overlong,
  l_orderkey, l_partkey, l_linenumber, l_suppkey FROM tokened),
lasts AS (
SELECT *, row_number() OVER (PARTITION BY overlong, invoice_no, stock_code, invoice_date,
    CASE WHEN overlong THEN (l_orderkey, l_partkey, l_linenumber, l_suppkey) END
  ORDER BY l_orderkey DESC, l_partkey DESC, l_linenumber DESC, l_suppkey DESC) AS rn FROM typed),
reasons AS (
SELECT *, CASE WHEN overlong THEN 'record has more fields than the header; ' ELSE
   CASE WHEN invoice_no IS NULL THEN 'invoice_no is null; ' ELSE '' END ||
   CASE WHEN stock_code IS NULL THEN 'stock_code is null; ' ELSE '' END ||
   CASE WHEN invoice_date IS NULL THEN 'invoice_date is null; ' ELSE '' END ||
   CASE WHEN quantity IS NULL THEN 'quantity is null; ' ELSE '' END ||
   CASE WHEN unit_price IS NULL THEN 'unit_price is null; ' ELSE '' END ||
   CASE WHEN unit_price < 0 THEN 'unit_price is negative; ' ELSE '' END END AS failed,
  CASE WHEN length(description) > 500 THEN 'description does not fit the raw table; ' ELSE '' END ||
  CASE WHEN unit_price >= 1e8 THEN 'unit_price does not fit the raw table; ' ELSE '' END AS unfit
FROM lasts WHERE rn = 1)
SELECT load_status, error_reason, COUNT(*) AS line_rows, COUNT(DISTINCT invoice_no) AS invoices,
  CAST(SUM(CASE WHEN has_record THEN 1 ELSE 0 END) AS BIGINT) AS with_record
FROM (SELECT invoice_no, CASE WHEN failed != '' THEN failed WHEN unfit != '' THEN unfit END AS error_reason,
             CASE WHEN failed || unfit = '' THEN 'loaded' ELSE 'quarantined' END AS load_status,
             overlong OR (failed = '' AND unfit != '') AS has_record FROM reasons)
GROUP BY 1, 2"""


def _monthly() -> str:
    return ("SELECT d.year_month, SUM(f.net_line_total) AS revenue, COUNT(*) AS lines "
            "FROM fct f JOIN dim_date d ON f.date_id = d.date_id GROUP BY d.year_month")


ORACLE: dict[str, str] = {
    "rename_and_strip": q(f"SELECT {IDS}, invoice_no, stock_code, description, country FROM cleaned"),
    "numeric_coerce": q(NUMBER_TEXT),
    "customer_id_nullify": q(f"SELECT {IDS}, customer_id FROM cleaned"),
    "date_coerce": q(DATE_TEXT),
    "string_nulls_nan": q(
        f"SELECT {IDS}, {strip("COALESCE(invoice_no, 'nan')")} AS invoice_no, "
        f"{strip("COALESCE(stock_code, 'nan')")} AS stock_code, "
        f"{strip("COALESCE(description, 'nan')")} AS description, "
        f"{strip("COALESCE(country, 'nan')")} AS country, "
        f"NULLIF({strip("COALESCE(customer_id, 'nan')")}, 'nan') AS customer_id FROM src"),
    "na_tokens": q(
        f"SELECT {IDS}, "
        + ", ".join(f"CASE WHEN {c} IN ({NA_TOKENS}) THEN NULL ELSE {c} END AS {c}"
                    for c in ("invoice_no", "stock_code", "description", "customer_id", "country"))
        + " FROM src"),
    "conform_to_raw": q(
        f"SELECT invoice_no, stock_code, invoice_date, description, {dbl('quantity', 'unit_price')}, "
        f"customer_id, country, {IDS}, batch_id, ingested_at, loadable FROM conformed "
        f"WHERE error_reason = ''"),
    "dedup_keep_last": q(
        f"SELECT invoice_no, stock_code, invoice_date, description, quantity, unit_price, customer_id, "
        f"country, {IDS} FROM dedup"),
    "duplicate_count": q(
        "SELECT CAST((SELECT COUNT(*) FROM cleaned) AS BIGINT) AS rows_before, "
        "CAST((SELECT COUNT(*) FROM dedup) AS BIGINT) AS rows_after, "
        "CAST((SELECT COUNT(*) FROM cleaned) - (SELECT COUNT(*) FROM dedup) AS BIGINT) AS duplicates_removed"),
    "quality_clean": q(
        f"SELECT invoice_no, stock_code, invoice_date, description, quantity, unit_price, customer_id, "
        f"country, '{BATCH_ID}' AS batch_id, {INGESTED_AT} AS ingested_at, {IDS} "
        f"FROM flagged WHERE error_reason = ''"),
    "quality_rejected": q(
        f"SELECT invoice_no, stock_code, description, {dbl('quantity')}, invoice_date, {dbl('unit_price')}, "
        f"customer_id, country, batch_id, ingested_at, error_reason, {QUARANTINED_AT} AS quarantined_at "
        f"FROM conformed WHERE error_reason != ''"),
    "error_reasons": q(
        "SELECT error_reason, COUNT(*) AS rejected_rows FROM flagged WHERE error_reason != '' "
        "GROUP BY error_reason"),
    "quarantine_breakdown": q(
        "SELECT reason, COUNT(*) AS rejected_rows FROM ("
        "SELECT unnest(string_split(error_reason, '; ')) AS reason FROM flagged WHERE error_reason != '') "
        "WHERE reason != '' GROUP BY reason"),
    "incremental_filter": q(
        f"SELECT {IDS}, invoice_no, invoice_date FROM cleaned WHERE invoice_date > {WM_TS} "
        f"OR (invoice_date = {WM_TS} AND invoice_no > {WM_INV})"),
    "incremental_keep_null_dates": q(
        f"SELECT {IDS}, invoice_no, invoice_date FROM cleaned WHERE invoice_date > {WM_TS} "
        f"OR (invoice_date = {WM_TS} AND invoice_no > {WM_INV}) OR invoice_date IS NULL"),
    "incremental_first_run": q(
        "SELECT COUNT(*) AS records_read, COUNT(invoice_date) AS records_with_date FROM cleaned"),
    "next_watermark": q(
        "SELECT invoice_date AS last_processed_at, invoice_no AS last_invoice_no FROM flagged "
        "WHERE error_reason = '' ORDER BY invoice_date DESC, invoice_no DESC LIMIT 1"),
    "raw_orders": q(
        f"SELECT invoice_no, stock_code, description, {dbl('quantity')}, invoice_date, {dbl('unit_price')}, "
        "customer_id, country, batch_id, ingested_at FROM raw"),
    "raw_orders_nan_mode": f"WITH {BASE},\n{NAN_CHAIN}\n" + (
        f"SELECT invoice_no, stock_code, description, {dbl('quantity')}, invoice_date, {dbl('unit_price')}, "
        "customer_id, country, batch_id, ingested_at FROM raw_nan"),
    "stg_orders": q(f"SELECT {STG_ORDERS_COLS} FROM stg_orders"),
    "stg_customers": q(
        "SELECT customer_id, country, first_order_date, last_order_date, total_orders, total_line_items, "
        f"{dbl('total_units_purchased', 'lifetime_revenue')} FROM stg_customers"),
    "stg_customers_latest_country": q(
        "SELECT c.customer_id, l.country, c.first_order_date, c.last_order_date, c.total_orders, "
        f"c.total_line_items, {dbl('c.total_units_purchased', 'c.lifetime_revenue').replace('AS c.', 'AS ')} "
        "FROM stg_customers c JOIN ("
        "SELECT TRIM(customer_id) AS customer_id, TRIM(country) AS country, row_number() OVER ("
        "PARTITION BY TRIM(customer_id) ORDER BY invoice_date DESC, invoice_no DESC) AS rn FROM raw "
        "WHERE customer_id IS NOT NULL AND TRIM(customer_id) != '' AND LOWER(TRIM(customer_id)) != 'nan'"
        ") l ON c.customer_id = l.customer_id AND l.rn = 1"),
    "stg_products": q(
        "SELECT stock_code, description, CAST(avg_micros AS DOUBLE) / 1000000.0 AS avg_unit_price, "
        f"{dbl('min_unit_price', 'max_unit_price', 'total_units_sold')}, times_ordered, unique_customers, "
        "first_sold_date, last_sold_date FROM stg_products"),
    "fct_orders": q(
        "SELECT order_key, invoice_no, stock_code, customer_id, date_id, is_cancelled, invoice_date, "
        f"{dbl('quantity', 'unit_price', 'line_total', 'net_line_total')}, country, batch_id, ingested_at "
        "FROM fct"),
    "dim_customers": q(
        "SELECT customer_id, country, first_order_date, last_order_date, total_orders, total_line_items, "
        f"{dbl('total_units_purchased', 'lifetime_revenue', 'avg_order_value')}, days_since_last_order, "
        "customer_lifetime_days, customer_segment, customer_status FROM dim_customers"),
    "dim_products": q(
        f"SELECT stock_code, description, {dbl('avg_unit_price', 'min_unit_price', 'max_unit_price')}, "
        f"{dbl('total_units_sold')}, times_ordered, unique_customers, first_sold_date, last_sold_date, "
        "product_tier FROM dim_products"),
    "dim_date": q("SELECT * FROM dim_date"),
    "star_orders_customers": q(
        "SELECT f.customer_id, f.order_key, CAST(f.net_line_total AS DOUBLE) AS net_line_total, "
        "c.customer_segment, c.customer_status, c.country AS customer_country "
        "FROM fct f LEFT JOIN dim_customers c ON f.customer_id = c.customer_id"),
    "star_orders_products": q(
        "SELECT UPPER(TRIM(f.stock_code)) AS product_code, f.order_key, f.stock_code, "
        "CAST(f.quantity AS DOUBLE) AS quantity, p.product_tier, p.description AS product_description "
        "FROM fct f LEFT JOIN dim_products p ON UPPER(TRIM(f.stock_code)) = p.stock_code"),
    "star_orders_dates": q(
        "SELECT f.date_id, f.order_key, CAST(f.net_line_total AS DOUBLE) AS net_line_total, d.year_month, "
        "d.quarter_name, d.day_of_week_name, d.is_weekend "
        "FROM fct f LEFT JOIN dim_date d ON f.date_id = d.date_id"),
    "kpi_headline": q(
        "SELECT CAST(SUM(net_line_total) AS DOUBLE) AS total_revenue, "
        "COUNT(DISTINCT CASE WHEN customer_id IS NOT NULL AND LOWER(customer_id) != 'nan' "
        "THEN customer_id END) AS total_customers, "
        "COUNT(DISTINCT invoice_no) AS total_invoices, "
        f"COUNT(DISTINCT CASE WHEN {PRODUCT_FILTER} THEN UPPER(TRIM(stock_code)) END) AS total_products, "
        "COUNT(DISTINCT country) AS total_countries, COUNT(*) AS total_lines FROM fct"),
    "revenue_by_month": q(
        f"SELECT year_month, CAST(revenue AS DOUBLE) AS revenue, CAST(lines AS BIGINT) AS lines "
        f"FROM ({_monthly()})"),
    "peak_month": q(
        f"SELECT year_month, CAST(revenue AS DOUBLE) AS revenue, CAST(lines AS BIGINT) AS lines "
        f"FROM ({_monthly()}) ORDER BY revenue DESC, year_month LIMIT 1"),
    "segment_distribution": q(
        f"SELECT customer_segment, COUNT(*) AS customers, {share('COUNT(*)')} AS share_pct "
        "FROM dim_customers GROUP BY customer_segment"),
    "revenue_by_country": q(
        f"SELECT country, CAST(SUM(net_line_total) AS DOUBLE) AS revenue, "
        f"{share('SUM(net_line_total)')} AS share_pct FROM fct GROUP BY country"),
    "top_products": q(
        f"SELECT stock_code, description, {dbl('avg_unit_price', 'min_unit_price', 'max_unit_price')}, "
        f"{dbl('total_units_sold')}, times_ordered, unique_customers, first_sold_date, last_sold_date, "
        "product_tier FROM dim_products ORDER BY dim_products.total_units_sold DESC, stock_code LIMIT 10"),
    "revenue_by_segment": q(
        "SELECT c.customer_segment, CAST(SUM(f.net_line_total) AS DOUBLE) AS revenue, "
        f"{share('SUM(f.net_line_total)')} AS share_pct "
        "FROM fct f LEFT JOIN dim_customers c ON f.customer_id = c.customer_id GROUP BY c.customer_segment"),
    "test_not_null": q(_not_null_sql()),
    "test_unique": q(
        "SELECT order_key, COUNT(*) AS n_records FROM fct WHERE order_key IS NOT NULL "
        "GROUP BY order_key HAVING COUNT(*) > 1"),
    "test_suite": q(_suite_sql()),
    "watermark_upsert": q(WATERMARK_UPSERT),
    "audit_upsert": q(AUDIT_UPSERT),
    "audit_history": q(
        "SELECT status, COUNT(*) AS runs, CAST(SUM(records_read) AS BIGINT) AS records_read, "
        "CAST(SUM(records_loaded) AS BIGINT) AS records_loaded, AVG(duration_seconds) AS avg_duration_seconds "
        f"FROM ({AUDIT_UPSERT}) GROUP BY status"),
    "batch_overwrite": q(
        f"SELECT CASE WHEN invoice_date < {CUT} THEN 'b_early' ELSE 'b_late' END AS batch_id, "
        "CASE WHEN error_reason = '' THEN 'loaded' ELSE 'quarantined' END AS load_status, "
        "COUNT(*) AS line_rows, CAST(SUM(quantity) AS DOUBLE) AS quantity "
        "FROM conformed WHERE error_reason != '' OR loadable GROUP BY 1, 2"),
    "batch_count": q(
        "SELECT COUNT(*) AS records_loaded FROM conformed WHERE error_reason = '' AND loadable "
        f"AND NOT COALESCE(invoice_date < {CUT}, FALSE)"),
    "csv_roundtrip": q(
        f"SELECT {IO_IDS}, {strip('invoice_no')} AS invoice_no, {strip('stock_code')} AS stock_code, "
        f"{strip('description')} AS description, quantity, invoice_date, unit_price, "
        f"NULLIF({strip("COALESCE(customer_id, 'nan')")}, 'nan') AS customer_id, {strip('country')} AS country "
        f"FROM ({TOKENED_SRC})"),
    "csv_ragged": q(f"SELECT {IO_IDS}, l_linenumber = 7 AS overlong, (l_linenumber = 6 OR country IS NULL) AS padded FROM src"),
    "csv_latin1_fallback": q(
        f"SELECT {IO_IDS}, CASE WHEN translate(description, 'E', 'É') IN ({NA_TOKENS}) THEN NULL "
        "ELSE translate(description, 'E', 'É') END AS Description, 'ISO-8859-1' AS encoding FROM src"),
    "pipeline_end_to_end": q(
        f"SELECT invoice_no, stock_code, description, {dbl('quantity')}, invoice_date, {dbl('unit_price')}, "
        f"customer_id, country, CASE WHEN invoice_date < {CUT} THEN 'e2e_1' ELSE 'e2e_2' END AS batch_id FROM raw"),
    "csv_quarantine": CSV_QUARANTINE,
    "audit_lifecycle": q(AUDIT_LIFECYCLE),
    "no_new_rows": q(
        f"SELECT CAST(COUNT(*) AS BIGINT) AS records_read, CAST(0 AS BIGINT) AS records_loaded, "
        f"(SELECT COUNT(*) FROM raw) AS raw_rows, (SELECT t FROM {MARK}) AS marked_at, "
        f"(SELECT i FROM {MARK}) AS marked_invoice "
        f"FROM cleaned, {MARK} AS x WHERE invoice_date > x.t OR (invoice_date = x.t AND invoice_no > x.i)"),
    "marts_written": q(MARTS_WRITTEN),
    "compacted_lines": q(
        "SELECT strftime(invoice_date, '%Y-%m') AS month, load_status, COUNT(*) AS line_rows, "
        "CAST(SUM(quantity) AS DOUBLE) AS quantity FROM ("
        "SELECT *, CASE WHEN error_reason = '' THEN 'loaded' ELSE 'quarantined' END AS load_status FROM conformed "
        f"WHERE (error_reason != '' OR loadable) AND invoice_date >= TIMESTAMP '1995-03-01 00:00:00' "
        "AND invoice_date <= TIMESTAMP '1998-02-15 00:00:00') GROUP BY 1, 2"),
}
