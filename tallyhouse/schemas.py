"""Explicit schemas of every table; nothing in the engine infers types."""

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 4)
MONEY = T.DecimalType(18, 2)

# Written next to the clean columns: where a line stands in the table's row
# order, as line_block and line_place (see operators/ordering.py).
LINE = "line"
LINE_POSITION = T.StructType([
    T.StructField("line_block", T.IntegerType()),
    T.StructField("line_place", T.LongType()),
])

RAW = T.StructType([
    T.StructField("Invoice", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.IntegerType()),
    T.StructField("InvoiceDate", T.TimestampNTZType()),
    T.StructField("Price", PRICE),
    T.StructField("Customer ID", T.DoubleType()),
    T.StructField("Country", T.StringType()),
    T.StructField("source_sheet", T.StringType()),
])

CLEAN = T.StructType([
    T.StructField("invoice_id", T.StringType()),
    T.StructField("stock_code", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("invoice_date", T.TimestampNTZType()),
    T.StructField("unit_price", PRICE),
    T.StructField("customer_id", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("source_sheet", T.StringType()),
    T.StructField("is_cancelled", T.BooleanType()),
    T.StructField("is_return", T.BooleanType()),
    T.StructField("is_zero_price", T.BooleanType()),
    T.StructField("is_invalid_price", T.BooleanType()),
    T.StructField("has_customer_id", T.BooleanType()),
    T.StructField("is_valid_sale", T.BooleanType()),
    T.StructField("net_line_value", MONEY),
    T.StructField("sales_revenue", MONEY),
    T.StructField("return_value", MONEY),
    T.StructField("invoice_year", T.IntegerType()),
    T.StructField("invoice_quarter", T.StringType()),
    T.StructField("invoice_month_number", T.IntegerType()),
    T.StructField("invoice_month_name", T.StringType()),
    T.StructField("year_month", T.StringType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("invoice_hour", T.IntegerType()),
    T.StructField("invoice_date_only", T.DateType()),
    T.StructField("transaction_status", T.StringType()),
])

DIM_CUSTOMER = T.StructType([
    T.StructField("customer_key", T.LongType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("country", T.StringType()),
])

DIM_PRODUCT = T.StructType([
    T.StructField("product_key", T.LongType()),
    T.StructField("stock_code", T.StringType()),
    T.StructField("description", T.StringType()),
])

DIM_COUNTRY = T.StructType([
    T.StructField("country_key", T.LongType()),
    T.StructField("country", T.StringType()),
])

DIM_DATE = T.StructType([
    T.StructField("date_key", T.IntegerType()),
    T.StructField("full_date", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("quarter", T.StringType()),
    T.StructField("month_number", T.IntegerType()),
    T.StructField("month_name", T.StringType()),
    T.StructField("year_month", T.StringType()),
    T.StructField("day_of_month", T.IntegerType()),
    T.StructField("day_name", T.StringType()),
    T.StructField("week_number", T.IntegerType()),
    T.StructField("is_weekend", T.IntegerType()),
])

FACT = T.StructType([
    T.StructField("transaction_key", T.LongType()),
    T.StructField("invoice_id", T.StringType()),
    T.StructField("customer_key", T.LongType()),
    T.StructField("product_key", T.LongType()),
    T.StructField("country_key", T.LongType()),
    T.StructField("date_key", T.IntegerType()),
    T.StructField("invoice_datetime", T.TimestampNTZType()),
    T.StructField("invoice_hour", T.IntegerType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", PRICE),
    T.StructField("net_line_value", MONEY),
    T.StructField("sales_revenue", MONEY),
    T.StructField("return_value", MONEY),
    T.StructField("is_cancelled", T.IntegerType()),
    T.StructField("is_return", T.IntegerType()),
    T.StructField("is_valid_sale", T.IntegerType()),
    T.StructField("has_customer_id", T.IntegerType()),
    T.StructField("transaction_status", T.StringType()),
])

WAREHOUSE = {
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "dim_country": DIM_COUNTRY,
    "dim_date": DIM_DATE,
    "fact_transactions": FACT,
}
