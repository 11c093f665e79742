"""The same queries in DuckDB SQL, straight from the order tables.

Written to be easy to check, not to be fast: plain windows and distinct counts
over the whole tables, independent of how the Spark plans get there.
"""

from __future__ import annotations

_RAW = """
joined AS (
  SELECT l.*, o.o_custkey, o.o_orderdate, n.n_name, n.n_regionkey, p.p_name
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
retail AS (
  SELECT
    CASE WHEN l_orderkey % 65 = 0 AND l_linenumber = 3 THEN NULL
         ELSE CASE WHEN l_orderkey % 13 = 0 THEN 'C' ELSE '' END || CAST(500000 + l_orderkey AS VARCHAR) END AS "Invoice",
    CASE WHEN l_orderkey % 347 = 0 AND l_linenumber = 2 THEN NULL
         WHEN l_orderkey % 349 = 0 AND l_linenumber = 2 THEN ''
         ELSE ' ' || CAST(10000 + l_partkey AS VARCHAR) END AS "StockCode",
    CASE WHEN l_linenumber = 7 AND l_partkey % 5 = 0 THEN NULL
         WHEN l_orderkey % 367 = 0 AND l_linenumber = 1 THEN ''
         WHEN l_orderkey % 359 = 0 AND l_linenumber = 4 THEN chr(9) || p_name || chr(160) || chr(160) || 'x' || chr(9)
         WHEN l_partkey % 250 = 0 THEN 'Postage'
         WHEN l_partkey % 250 = 1 THEN ' Manual '
         WHEN l_linenumber = 6 THEN upper(p_name)
         ELSE ' ' || replace(p_name, ' ', '  ') || ' ' END AS "Description",
    CAST(CASE WHEN l_orderkey % 311 = 0 AND l_linenumber = 2 THEN NULL
         WHEN l_orderkey % 13 = 0 THEN -l_quantity
         WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber = 1 THEN -l_quantity
         WHEN l_orderkey % 211 = 0 AND l_linenumber = 2 THEN 0
         ELSE l_quantity END AS INTEGER) AS "Quantity",
    CASE WHEN l_orderkey % 307 = 0 AND l_linenumber = 1 THEN NULL
         ELSE o_orderdate + to_hours(CAST(8 + l_orderkey % 12 AS INTEGER)) END AS "InvoiceDate",
    CAST(CASE WHEN l_orderkey % 313 = 0 AND l_linenumber = 3 THEN NULL
         WHEN l_orderkey % 997 = 0 AND l_linenumber = 3 THEN -l_extendedprice
         WHEN l_discount = 0 AND l_tax = 0 THEN 0
         ELSE l_extendedprice END AS DECIMAL(18, 2)) AS "Price",
    CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS "Customer ID",
    CASE WHEN l_orderkey % 317 = 0 AND l_linenumber = 1 THEN NULL
         WHEN l_orderkey % 331 = 0 AND l_linenumber = 1 THEN ''
         WHEN l_orderkey % 337 = 0 AND l_linenumber = 2 THEN chr(160) || n_name || chr(9)
         WHEN l_orderkey % 101 = 0 THEN 'NATION_24'
         WHEN n_regionkey = 0 THEN 'United Kingdom'
         ELSE n_name END AS "Country",
    'Year ' || CAST(year(o_orderdate) AS VARCHAR) AS source_sheet,
    l_orderkey
  FROM joined
),
raw AS (
  SELECT * EXCLUDE (l_orderkey) FROM retail
  UNION ALL
  SELECT * EXCLUDE (l_orderkey) FROM retail WHERE l_orderkey % 83 = 0
)"""

# Python's white space, as far as it occurs here.
_SPACE = "' ' || chr(9) || chr(10) || chr(160)"


def _strip(name: str) -> str:
    return f"trim({name}, {_SPACE})"


def _tidy(name: str) -> str:
    return f"regexp_replace({_strip(name)}, '[\\s\\x{{A0}}]+', ' ', 'g')"


_CLEAN = f"""
base AS (
  SELECT
    {_strip('"Invoice"')} AS invoice_id,
    {_strip('"StockCode"')} AS stock_code,
    {_tidy('"Description"')} AS description,
    "Quantity" AS quantity,
    "InvoiceDate" AS invoice_date,
    "Price" AS unit_price,
    CAST(CAST("Customer ID" AS BIGINT) AS VARCHAR) AS customer_id,
    {_tidy('"Country"')} AS country,
    {_strip("source_sheet")} AS source_sheet,
    row_number() OVER (ORDER BY
      "InvoiceDate" NULLS FIRST, "Invoice" NULLS FIRST, "Country" NULLS FIRST,
      "StockCode" NULLS FIRST, "Description" NULLS FIRST, "Quantity" NULLS FIRST,
      "Price" NULLS FIRST, "Customer ID" NULLS FIRST, source_sheet NULLS FIRST
    ) AS row_order
  FROM (SELECT DISTINCT * FROM raw)
),
flagged AS (
  SELECT *,
    coalesce(upper(invoice_id) LIKE 'C%', false) AS is_cancelled,
    coalesce(quantity < 0, false) AS is_return,
    coalesce(unit_price = 0, false) AS is_zero_price,
    coalesce(unit_price < 0, false) AS is_invalid_price,
    customer_id IS NOT NULL AS has_customer_id,
    coalesce(quantity > 0 AND unit_price > 0 AND NOT coalesce(upper(invoice_id) LIKE 'C%', false)
             AND invoice_date IS NOT NULL, false) AS is_valid_sale,
    CAST(quantity * unit_price AS DECIMAL(18, 2)) AS net_line_value
  FROM base
),
clean AS (
  SELECT *,
    CASE WHEN is_valid_sale THEN net_line_value ELSE 0 END AS sales_revenue,
    CASE WHEN is_return OR is_cancelled
         THEN CAST(abs(quantity) * CASE WHEN unit_price < 0 THEN 0 ELSE unit_price END AS DECIMAL(18, 2))
         ELSE 0 END AS return_value,
    CAST(year(invoice_date) AS INTEGER) AS invoice_year,
    'Q' || CAST(quarter(invoice_date) AS VARCHAR) AS invoice_quarter,
    CAST(month(invoice_date) AS INTEGER) AS invoice_month_number,
    monthname(invoice_date) AS invoice_month_name,
    strftime(invoice_date, '%Y-%m') AS year_month,
    dayname(invoice_date) AS day_of_week,
    CAST(hour(invoice_date) AS INTEGER) AS invoice_hour,
    CAST(invoice_date AS DATE) AS invoice_date_only,
    CASE WHEN unit_price < 0 THEN 'invalid_price'
         WHEN unit_price = 0 THEN 'zero_price'
         WHEN quantity = 0 THEN 'zero_quantity'
         WHEN invoice_date IS NULL THEN 'missing_invoice_date'
         WHEN is_cancelled THEN 'cancelled'
         WHEN is_return THEN 'return_or_adjustment'
         WHEN description IS NULL THEN 'missing_description'
         WHEN customer_id IS NULL THEN 'missing_customer_id'
         WHEN is_valid_sale THEN 'valid_sale'
         ELSE 'requires_review' END AS transaction_status
  FROM flagged
)"""

_DIMS = """
lines AS (
  SELECT * REPLACE (nullif(invoice_id, '') AS invoice_id, nullif(stock_code, '') AS stock_code,
                    nullif(description, '') AS description, nullif(country, '') AS country)
  FROM clean
),
first_lines AS (
  SELECT customer_id, country,
    row_number() OVER (PARTITION BY customer_id ORDER BY
      invoice_date NULLS FIRST, invoice_id NULLS FIRST, country NULLS FIRST) AS nth
  FROM lines WHERE customer_id IS NOT NULL
),
dim_customer AS (
  SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, customer_id, country
  FROM first_lines WHERE nth = 1
),
uses AS (
  SELECT stock_code, description,
    row_number() OVER (PARTITION BY stock_code ORDER BY count(*) DESC, description) AS nth
  FROM lines WHERE stock_code IS NOT NULL AND description IS NOT NULL
  GROUP BY stock_code, description
),
dim_product AS (
  SELECT row_number() OVER (ORDER BY c.stock_code NULLS LAST) AS product_key,
    c.stock_code, coalesce(u.description, 'UNKNOWN PRODUCT') AS description
  FROM (SELECT DISTINCT stock_code FROM lines) c
  LEFT JOIN uses u ON u.stock_code = c.stock_code AND u.nth = 1
),
dim_country AS (
  SELECT row_number() OVER (ORDER BY country NULLS LAST) AS country_key, country
  FROM (SELECT DISTINCT country FROM lines)
),
days AS (
  SELECT CAST(unnest(generate_series(min(invoice_date_only), max(invoice_date_only), INTERVAL 1 DAY)) AS DATE) AS full_date
  FROM lines
),
dim_date AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key,
    full_date,
    CAST(year(full_date) AS INTEGER) AS year,
    'Q' || CAST(quarter(full_date) AS VARCHAR) AS quarter,
    CAST(month(full_date) AS INTEGER) AS month_number,
    monthname(full_date) AS month_name,
    strftime(full_date, '%Y-%m') AS year_month,
    CAST(day(full_date) AS INTEGER) AS day_of_month,
    dayname(full_date) AS day_name,
    CAST(week(full_date) AS INTEGER) AS week_number,
    CAST(isodow(full_date) >= 6 AS INTEGER) AS is_weekend
  FROM days
)"""

_FACT = """
fact AS (
  SELECT
    f.row_order AS transaction_key,
    f.invoice_id,
    coalesce(c.customer_key, 0) AS customer_key,
    coalesce(p.product_key, 0) AS product_key,
    coalesce(co.country_key, 0) AS country_key,
    coalesce(CAST(strftime(f.invoice_date, '%Y%m%d') AS INTEGER), 0) AS date_key,
    f.invoice_date AS invoice_datetime,
    f.invoice_hour, f.quantity, f.unit_price, f.net_line_value, f.sales_revenue, f.return_value,
    CAST(f.is_cancelled AS INTEGER) AS is_cancelled,
    CAST(f.is_return AS INTEGER) AS is_return,
    CAST(f.is_valid_sale AS INTEGER) AS is_valid_sale,
    CAST(f.has_customer_id AS INTEGER) AS has_customer_id,
    f.transaction_status
  FROM lines f
  LEFT JOIN dim_customer c ON f.customer_id = c.customer_id
  LEFT JOIN dim_product p ON f.stock_code IS NOT DISTINCT FROM p.stock_code
  LEFT JOIN dim_country co ON f.country IS NOT DISTINCT FROM co.country
),
sales AS (
  SELECT f.*, c.customer_id, p.stock_code, p.description, co.country
  FROM fact f
  LEFT JOIN dim_customer c USING (customer_key)
  LEFT JOIN dim_product p USING (product_key)
  LEFT JOIN dim_country co USING (country_key)
  WHERE f.is_valid_sale = 1
)"""


def _money(name: str) -> str:
    return f"CAST({name} AS DOUBLE) AS {name}"


_MEASURES = """CAST(sum(sales_revenue) AS DOUBLE) AS revenue,
    count(DISTINCT invoice_id) AS orders,
    count(DISTINCT nullif(customer_key, 0)) AS customers,
    CAST(sum(quantity) AS BIGINT) AS units_sold"""

_VIEWS = f"""
monthly AS (
  SELECT d.year, d.month_number, d.month_name, d.year_month, {_MEASURES}
  FROM sales JOIN dim_date d USING (date_key) GROUP BY ALL
),
countries AS (SELECT country, {_MEASURES} FROM sales GROUP BY country),
products AS (
  SELECT stock_code, description,
    CAST(sum(sales_revenue) AS DOUBLE) AS revenue,
    CAST(sum(quantity) AS BIGINT) AS units_sold,
    count(DISTINCT invoice_id) AS orders
  FROM sales GROUP BY stock_code, description
),
customers AS (
  SELECT customer_id,
    CAST(sum(sales_revenue) AS DOUBLE) AS revenue,
    count(DISTINCT invoice_id) AS orders,
    CAST(sum(quantity) AS BIGINT) AS units_purchased,
    min(invoice_datetime) AS first_purchase,
    max(invoice_datetime) AS latest_purchase
  FROM sales WHERE customer_key > 0 GROUP BY customer_id
),
goods AS (
  SELECT * FROM products
  WHERE description IS NOT NULL AND upper(trim(description)) NOT IN
    ('MANUAL', 'POSTAGE', 'DOTCOM POSTAGE', 'BANK CHARGES', 'AMAZON FEE', 'DISCOUNT')
)"""

# round_even(x * 100, 0) / 100 is the scale-round-unscale rule spelled out.
_RFM = """
snapshot AS (SELECT max(invoice_datetime) + INTERVAL 1 DAY AS at, count(*) AS n FROM sales),
measured AS (
  SELECT customer_id,
    first_purchase AS first_purchase_date,
    latest_purchase AS latest_purchase_date,
    orders AS frequency,
    revenue AS monetary,
    units_purchased,
    CAST(epoch_us(s.at - latest_purchase) // 86400000000 AS INTEGER) AS recency_days,
    CAST(epoch_us(latest_purchase - first_purchase) // 86400000000 AS INTEGER) AS customer_lifetime_days,
    round_even(revenue / orders * 100, 0) / 100 AS average_order_value
  FROM customers, snapshot s
),
ranked AS (
  SELECT *,
    count(*) OVER () AS n,
    row_number() OVER (ORDER BY recency_days, customer_id) AS r,
    row_number() OVER (ORDER BY frequency, customer_id) AS f,
    row_number() OVER (ORDER BY monetary, customer_id) AS m
  FROM measured
),
binned AS (
  SELECT *,
    CAST(6 - greatest(1, (5 * (r - 1) + n - 2) // greatest(n - 1, 1)) AS INTEGER) AS recency_score,
    CAST(greatest(1, (5 * (f - 1) + n - 2) // greatest(n - 1, 1)) AS INTEGER) AS frequency_score,
    CAST(greatest(1, (5 * (m - 1) + n - 2) // greatest(n - 1, 1)) AS INTEGER) AS monetary_score
  FROM ranked
),
rfm AS (
  SELECT * EXCLUDE (n, r, f, m),
    CAST(recency_score AS VARCHAR) || CAST(frequency_score AS VARCHAR)
      || CAST(monetary_score AS VARCHAR) AS rfm_score,
    CASE WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'Champions'
         WHEN recency_score >= 3 AND frequency_score >= 4 THEN 'Loyal Customers'
         WHEN recency_score = 5 AND frequency_score = 1 THEN 'New Customers'
         WHEN recency_score >= 4 AND frequency_score IN (2, 3) THEN 'Potential Loyalists'
         WHEN recency_score <= 2 AND frequency_score >= 4 THEN 'At Risk'
         WHEN recency_score = 1 AND frequency_score <= 2 THEN 'Lost Customers'
         WHEN recency_score <= 2 AND frequency_score <= 3 THEN 'Hibernating'
         WHEN monetary_score >= 4 AND frequency_score >= 2 THEN 'Big Spenders'
         ELSE 'Need Attention' END AS customer_segment
  FROM binned
),
segments AS (
  SELECT customer_segment,
    count(*) AS customer_count,
    CAST(sum(CAST(monetary AS DECIMAL(18, 2))) AS DOUBLE) AS total_revenue,
    CAST(sum(recency_days) AS DOUBLE) AS days,
    CAST(sum(frequency) AS DOUBLE) AS orders
  FROM rfm GROUP BY customer_segment
),
summary AS (
  SELECT customer_segment, customer_count, total_revenue,
    round_even(total_revenue / customer_count * 100, 0) / 100 AS average_revenue,
    round_even(days / customer_count * 10, 0) / 10 AS average_recency_days,
    round_even(orders / customer_count * 10, 0) / 10 AS average_frequency,
    round_even(total_revenue
      / CAST(sum(CAST(total_revenue AS DECIMAL(28, 2))) OVER () AS DOUBLE) * 100 * 100, 0) / 100
      AS revenue_share_percentage
  FROM segments
)"""

_TO_CLEAN = (_RAW, _CLEAN)
_TO_DIMS = (*_TO_CLEAN, _DIMS)
_TO_FACT = (*_TO_DIMS, _FACT)
_TO_VIEWS = (*_TO_FACT, _VIEWS)
_TO_RFM = (*_TO_VIEWS, _RFM)


def _with(parts: tuple[str, ...], select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def _metrics(source: str, metrics: list[tuple[str, str]], value_type: str) -> str:
    rows = [
        f"SELECT '{label}' AS metric, CAST({value} AS {value_type}) AS value FROM {source}"
        for label, value in metrics
    ]
    return "\nUNION ALL ".join(rows)


_RAW_TYPES = {
    "Invoice": "string",
    "StockCode": "string",
    "Description": "string",
    "Quantity": "int",
    "InvoiceDate": "timestamp_ntz",
    "Price": "decimal(18,4)",
    "Customer ID": "double",
    "Country": "string",
    "source_sheet": "string",
}

_PROFILE = "\nUNION ALL ".join(
    f"""SELECT '{name}' AS "column", '{kind}' AS data_type, count(*) AS total_rows,
    count(*) - count("{name}") AS missing_values, count(DISTINCT "{name}") AS unique_values,
    round_even((count(*) - count("{name}")) / count(*) * 100 * 100, 0) / 100 AS missing_percentage
  FROM raw"""
    for name, kind in _RAW_TYPES.items()
)

_QUALITY = [
    ("Total rows", "count(*)"),
    ("Total columns", "9 + 0 * count(*)"),
    ("Duplicate rows", "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw))"),
    ("Missing customer IDs", """count(*) - count("Customer ID")"""),
    ("Missing descriptions", """count(*) - count("Description")"""),
    ("Missing invoice dates", """count(*) - count("InvoiceDate")"""),
    ("Blank descriptions", """count(*) FILTER (trim("Description") = '')"""),
    ("Blank countries", """count(*) FILTER (trim("Country") = '')"""),
    ("Cancelled transaction rows", """count(*) FILTER (upper("Invoice") LIKE 'C%')"""),
    ("Unique cancelled invoices", """count(DISTINCT "Invoice") FILTER (upper("Invoice") LIKE 'C%')"""),
    ("Negative quantities", """count(*) FILTER ("Quantity" < 0)"""),
    ("Zero quantities", """count(*) FILTER ("Quantity" = 0)"""),
    ("Negative prices", """count(*) FILTER ("Price" < 0)"""),
    ("Zero prices", """count(*) FILTER ("Price" = 0)"""),
    ("Unique invoices", """count(DISTINCT "Invoice")"""),
    ("Unique customers", """count(DISTINCT "Customer ID")"""),
    ("Unique products", """count(DISTINCT "StockCode")"""),
    ("Unique countries", """count(DISTINCT "Country")"""),
    ("Earliest invoice date", """min("InvoiceDate")"""),
    ("Latest invoice date", """max("InvoiceDate")"""),
]

_EXCEPTION = "(unit_price <= 0 OR quantity = 0 OR invoice_date IS NULL OR description IS NULL)"

_SUMMARY = [
    ("Raw rows", "any_value((SELECT count(*) FROM raw))"),
    ("Exact duplicates removed", "(SELECT count(*) FROM raw) - count(*)"),
    ("Rows after deduplication", "count(*)"),
    ("Valid sales rows", "count(*) FILTER (is_valid_sale)"),
    ("Valid sales with customer ID", "count(*) FILTER (is_valid_sale AND customer_id IS NOT NULL)"),
    ("Cancelled rows", "count(*) FILTER (is_cancelled)"),
    ("Return or negative-quantity rows", "count(*) FILTER (is_return)"),
    ("Rows missing customer ID", "count(*) FILTER (customer_id IS NULL)"),
    ("Zero-price rows", "count(*) FILTER (is_zero_price)"),
    ("Negative-price rows", "count(*) FILTER (is_invalid_price)"),
    ("Exception rows", f"count(*) FILTER {_EXCEPTION}"),
    ("Total valid sales revenue", "coalesce(sum(sales_revenue) FILTER (is_valid_sale), 0)"),
    ("Total recorded return value", "coalesce(sum(return_value), 0)"),
]

_KPI_INPUTS = """
kpi AS (
  SELECT
    coalesce(sum(sales_revenue) FILTER (is_valid_sale = 1), 0) AS gross,
    coalesce(sum(return_value), 0) AS returned,
    count(DISTINCT invoice_id) FILTER (is_valid_sale = 1) AS orders,
    count(DISTINCT customer_key) FILTER (is_valid_sale = 1 AND customer_key > 0) AS customers,
    coalesce(sum(quantity) FILTER (is_valid_sale = 1), 0) AS units,
    coalesce(sum(sales_revenue) FILTER (is_valid_sale = 1 AND customer_key = 0), 0) AS unidentified,
    count(DISTINCT invoice_id) FILTER (is_cancelled = 1) AS cancelled,
    count(DISTINCT invoice_id) AS invoices,
    (SELECT count(*) FROM (
      SELECT customer_key FROM fact WHERE is_valid_sale = 1 AND customer_key > 0
      GROUP BY customer_key HAVING count(DISTINCT invoice_id) > 1)) AS repeaters
  FROM fact
)"""


def _rate(part: str, whole: str) -> str:
    share = f"CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0)"
    return f"coalesce(round_even({share} * 100 * 100, 0) / 100, 0)"


_KPIS = [
    ("Gross Sales Revenue", "gross"),
    ("Recorded Return Value", "returned"),
    ("Estimated Net Revenue", "gross - returned"),
    ("Total Valid Orders", "orders"),
    ("Identified Customers", "customers"),
    ("Units Sold", "units"),
    ("Average Order Value",
     "coalesce(round_even(CAST(gross AS DOUBLE) / nullif(CAST(orders AS DOUBLE), 0) * 100, 0) / 100, 0)"),
    ("Return Value Rate (%)", _rate("returned", "gross")),
    ("Cancellation Rate (%)", _rate("cancelled", "invoices")),
    ("Repeat Customer Rate (%)", _rate("repeaters", "customers")),
    ("Unidentified Customer Revenue", "unidentified"),
    ("Unidentified Revenue Share (%)", _rate("unidentified", "gross")),
]

_CLEAN_COLUMNS = f"""invoice_id, stock_code, description, quantity, invoice_date, {_money("unit_price")},
  customer_id, country, source_sheet, is_cancelled, is_return, is_zero_price, is_invalid_price,
  has_customer_id, is_valid_sale, {_money("net_line_value")}, {_money("sales_revenue")},
  {_money("return_value")}, invoice_year, invoice_quarter, invoice_month_number,
  invoice_month_name, year_month, day_of_week, invoice_hour, invoice_date_only, transaction_status"""

_FACT_COLUMNS = f"""transaction_key, invoice_id, customer_key, product_key, country_key, date_key,
  invoice_datetime, invoice_hour, quantity, {_money("unit_price")}, {_money("net_line_value")},
  {_money("sales_revenue")}, {_money("return_value")}, is_cancelled, is_return, is_valid_sale,
  has_customer_id, transaction_status"""

_SALES_COLUMNS = f"""transaction_key, invoice_id, invoice_datetime, date_key, invoice_hour, quantity,
  {_money("unit_price")}, {_money("sales_revenue")}, customer_key, customer_id, product_key,
  stock_code, description, country_key, country"""

_RAW_COLUMNS = """"Invoice", "StockCode", "Description", "Quantity", "InvoiceDate",
  CAST("Price" AS DOUBLE) AS "Price", "Customer ID", "Country", source_sheet"""

# The workbook's text, and what is left of it: a quantity with a fraction or in words, and a date in words, are missing.
_WORKBOOK = f"""
pages AS (
  SELECT *, 'lines.v1.' || coalesce(CAST(year("InvoiceDate") AS VARCHAR), 'none') AS sheet,
    "Description" || CASE WHEN "Quantity" % 3 = 0 THEN chr(10) || '"new"' ELSE '' END AS told,
    "Quantity" % 7 <> 0 AND ("Quantity" % 11 = 0 OR "Quantity" % 13 = 0) AS odd,
    CASE WHEN "Quantity" % 7 <> 0 AND "Quantity" % 11 <> 0 AND "Quantity" % 13 = 0 THEN 'many' ELSE CAST("Quantity" AS VARCHAR) END AS written,
    coalesce(year("InvoiceDate") % 2 = 0, false) AS lacking
  FROM raw
),
entries AS (
  SELECT DISTINCT nullif("Invoice", '') AS invoice, nullif("StockCode", '') AS code, nullif(told, '') AS told, written, odd,
    "Price", "Customer ID", CASE WHEN NOT lacking THEN nullif("Country", '') END AS country, sheet,
    CASE WHEN NOT odd THEN "Quantity" END AS quantity, CASE WHEN coalesce("Quantity" <> 17, true) THEN "InvoiceDate" END AS invoice_date
  FROM pages
)"""

_SHARE = "round(revenue * 100 / (SELECT CAST(sum(sales_revenue) AS DOUBLE) FROM sales), 2)"

ORACLES: dict[str, str] = {
    "workbook_scan": _with(
        (_RAW, _WORKBOOK),
        f"""SELECT {_strip("invoice")} AS invoice_id, {_strip("code")} AS stock_code, {_tidy("told")} AS description,
          CAST(quantity AS INTEGER) AS quantity, invoice_date,
          CAST("Price" AS DOUBLE) AS unit_price, CAST(CAST("Customer ID" AS BIGINT) AS VARCHAR) AS customer_id,
          {_tidy("country")} AS country, sheet AS source_sheet FROM entries""",
    ),
    "rejected_values": _with(
        (_RAW, _WORKBOOK),
        """SELECT sheet AS source_sheet, nullif("Invoice", '') AS invoice, column_name, raw_text, reason FROM (
          SELECT sheet, "Invoice", 'Quantity' AS column_name,
            CASE WHEN written = 'many' THEN 'many' ELSE written || '.5' END AS raw_text,
            CASE WHEN written = 'many' THEN 'no number' ELSE 'not a whole number in range' END AS reason
          FROM pages WHERE odd AND "Quantity" IS NOT NULL
          UNION ALL
          SELECT sheet, "Invoice", 'InvoiceDate', 'soon', 'no timestamp' FROM pages WHERE "Quantity" = 17
        )""",
    ),
    "raw_transactions": _with((_RAW,), f"SELECT {_RAW_COLUMNS} FROM raw"),
    "column_profile": _with((_RAW,), _PROFILE),
    "data_quality_summary": _with((_RAW,), _metrics("raw", _QUALITY, "VARCHAR")),
    "duplicate_count": _with((_RAW,), """SELECT CAST(count(*) -
        (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS BIGINT) AS duplicate_rows FROM raw"""),
    "exact_dedup": _with((_RAW,), f"SELECT {_RAW_COLUMNS} FROM (SELECT DISTINCT * FROM raw)"),
    "clean_transactions": _with(_TO_CLEAN, f"SELECT {_CLEAN_COLUMNS} FROM clean"),
    "exceptions": _with(_TO_CLEAN, f"SELECT {_CLEAN_COLUMNS} FROM clean WHERE {_EXCEPTION}"),
    "valid_sales_subset": _with(_TO_CLEAN, f"SELECT {_CLEAN_COLUMNS} FROM clean WHERE is_valid_sale"),
    "customer_sales_subset": _with(
        _TO_CLEAN,
        f"SELECT {_CLEAN_COLUMNS} FROM clean WHERE is_valid_sale AND customer_id IS NOT NULL",
    ),
    "status_counts": _with(
        _TO_CLEAN, "SELECT transaction_status, count(*) AS line_count FROM clean GROUP BY ALL"
    ),
    "cleaning_summary": _with(_TO_CLEAN, _metrics("clean", _SUMMARY, "DOUBLE")),
    "dim_customer": _with(_TO_DIMS, "SELECT * FROM dim_customer"),
    "dim_product": _with(_TO_DIMS, "SELECT * FROM dim_product"),
    "dim_country": _with(_TO_DIMS, "SELECT * FROM dim_country"),
    "dim_date": _with(_TO_DIMS, "SELECT * FROM dim_date"),
    "fact_transactions": _with(_TO_FACT, f"SELECT {_FACT_COLUMNS} FROM fact"),
    "vw_valid_sales": _with(_TO_FACT, f"SELECT {_SALES_COLUMNS} FROM sales"),
    "vw_monthly_sales": _with(_TO_VIEWS, "SELECT * FROM monthly"),
    "vw_country_performance": _with(_TO_VIEWS, "SELECT * FROM countries"),
    "vw_product_performance": _with(_TO_VIEWS, "SELECT * FROM products"),
    "vw_customer_performance": _with(_TO_VIEWS, "SELECT * FROM customers"),
    "executive_kpis": _with((*_TO_FACT, _KPI_INPUTS), _metrics("kpi", _KPIS, "DOUBLE")),
    "rfm_customers": _with(_TO_RFM, "SELECT * FROM rfm"),
    "rfm_segment_summary": _with(_TO_RFM, "SELECT * FROM summary ORDER BY total_revenue DESC"),
    "monthly_trend": _with(_TO_VIEWS, "SELECT * FROM monthly ORDER BY year, month_number"),
    "top_international_markets": _with(
        _TO_VIEWS,
        """SELECT country, revenue, orders FROM countries WHERE country <> 'United Kingdom'
        ORDER BY revenue DESC, country LIMIT 10""",
    ),
    "revenue_concentration": _with(
        _TO_VIEWS,
        f"""SELECT country, revenue, {_SHARE} AS revenue_share_percentage
        FROM countries ORDER BY revenue DESC, country""",
    ),
    "top_products_by_revenue": _with(
        _TO_VIEWS,
        """SELECT stock_code, description, units_sold, revenue, orders FROM goods
        ORDER BY revenue DESC, stock_code LIMIT 10""",
    ),
    "top_products_by_units": _with(
        _TO_VIEWS,
        """SELECT stock_code, description, units_sold, revenue FROM goods
        ORDER BY units_sold DESC, stock_code LIMIT 10""",
    ),
    "top_customers": _with(
        _TO_VIEWS, "SELECT * FROM customers ORDER BY revenue DESC, customer_id LIMIT 20"
    ),
    "top_markets": _with(
        _TO_VIEWS,
        """SELECT country, revenue, orders FROM countries
        ORDER BY revenue DESC, orders DESC, country LIMIT 15""",
    ),
    "product_revenue_vs_volume": _with(
        _TO_VIEWS,
        """SELECT stock_code, description, units_sold, revenue, orders FROM products
        WHERE description IS NOT NULL AND revenue > 0 AND units_sold > 0
        ORDER BY revenue DESC, stock_code LIMIT 100""",
    ),
    "valid_sales_sample": _with(
        _TO_FACT, f"SELECT {_SALES_COLUMNS} FROM sales ORDER BY transaction_key LIMIT 100"
    ),
    "home_vs_international": _with(
        _TO_VIEWS,
        f"""SELECT market, revenue, {_SHARE} AS revenue_share_percentage FROM (
          SELECT CASE WHEN country = 'United Kingdom' THEN 'home' ELSE 'international' END AS market,
            CAST(sum(sales_revenue) AS DOUBLE) AS revenue
          FROM sales GROUP BY market)""",
    ),
    "active_products": _with(_TO_VIEWS, "SELECT count(*) AS active_products FROM products"),
    "top_product": _with(
        _TO_VIEWS,
        """SELECT stock_code, description, revenue FROM products
        ORDER BY revenue DESC, stock_code LIMIT 1""",
    ),
    "segment_spotlight": _with(
        _TO_RFM,
        """SELECT customer_segment, customer_count, total_revenue, revenue_share_percentage
        FROM summary WHERE customer_segment = 'Champions'""",
    ),
    "volume_vs_revenue_rank": _with(
        _TO_VIEWS,
        """SELECT stock_code, description, units_sold, revenue,
          CAST(rank() OVER (ORDER BY units_sold DESC) AS INTEGER) AS volume_rank,
          CAST(rank() OVER (ORDER BY revenue DESC) AS INTEGER) AS revenue_rank
        FROM products WHERE description IS NOT NULL AND revenue > 0 AND units_sold > 0
        ORDER BY volume_rank, stock_code LIMIT 100""",
    ),
}
