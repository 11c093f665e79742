"""From raw invoice lines to clean, classified ones.

Exact duplicates go first, while the text is still as it was read; all other
steps work row by row and run in one stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import constants as K
from tallyhouse.functions import calendar as cal
from tallyhouse.functions.numbers import (
    to_customer_id,
    to_money,
    to_price,
    to_quantity,
    to_timestamp,
)
from tallyhouse.functions.reports import gather, long_report
from tallyhouse.functions.text import is_cancellation, strip, tidy
from tallyhouse.schemas import CLEAN, MONEY
from tallyhouse.session import scratch_path


def _truth(condition: Column) -> Column:
    """A comparison with a missing value is false, not null."""
    return F.coalesce(condition, F.lit(False))


_HASH = "row_hash"


def _hashed(raw: DataFrame) -> DataFrame:
    """``raw`` with 64 bits of its columns. A hash passes over nulls, so which columns are null is hashed as well."""
    columns = [F.col(f"`{name}`") for name in raw.columns]
    nulls = sum(F.when(column.isNull(), 1 << i).otherwise(0) for i, column in enumerate(columns))
    return raw.withColumn(_HASH, F.xxhash64(nulls, *columns))


def repeated_rows(raw: DataFrame, path: str) -> DataFrame | None:
    """Hashes that occur more than once, written to ``path``; None if they are too many to hand to every task."""
    spark = raw.sparkSession
    counted = _hashed(raw).groupBy(_HASH).agg(F.count(F.lit(1)).alias("n"))
    counted.where("n > 1").select(_HASH).write.mode("overwrite").parquet(path)
    repeated = spark.read.schema(f"{_HASH} long").parquet(path)
    size = int(repeated._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return repeated if size <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold() else None


def _split(raw: DataFrame, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that certainly have no copy, and those that may have one."""
    marked, found = _hashed(raw), F.broadcast(repeated)  # its size was checked
    alone, copies = (marked.join(found, _HASH, how).drop(_HASH) for how in ("left_anti", "left_semi"))
    return alone, copies


def deduplicate(raw: DataFrame, path: str | None = None) -> DataFrame:
    """Drop exact copies over all columns, the sheet tag included.

    Two phases. Hashes of rows are counted first, so only they are shuffled, and
    those that occur twice are written to ``path``. Then rows whose hash occurs once
    stay where they are; only the others travel whole, after their copies have
    collapsed inside each task. Those are compared in full, so two rows that share
    a hash stay two. If there are more repeated hashes than fit a broadcast, all rows
    are grouped at once instead.
    """
    repeated = repeated_rows(raw, path or scratch_path(raw.sparkSession, "repeated-rows"))
    if repeated is None:
        return raw.dropDuplicates()
    alone, copies = _split(raw, repeated)
    return alone.union(copies.dropDuplicates())


def duplicate_count(raw: DataFrame, path: str | None = None) -> DataFrame:
    """One row: how many rows :func:`deduplicate` removes."""
    repeated = repeated_rows(raw, path or scratch_path(raw.sparkSession, "repeated-rows"))
    rows = raw if repeated is None else _split(raw, repeated)[1]
    copies = rows.groupBy(*[f"`{name}`" for name in raw.columns]).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def standardise(lines: DataFrame, timestamp_format: str | None = None) -> DataFrame:
    """Rename to snake_case, tidy the text and settle the types.

    Values are as they were read until here; ``timestamp_format`` is the pattern
    of dates that are text.
    """
    text_dates = timestamp_format if dict(lines.dtypes)["InvoiceDate"] == "string" else None
    renamed = lines.withColumnsRenamed(K.RENAMES)
    return renamed.withColumns({
        "invoice_id": strip(F.col("invoice_id")),
        "stock_code": strip(F.col("stock_code")),
        "description": tidy(F.col("description")),
        "country": tidy(F.col("country")),
        K.SHEET: strip(F.col(K.SHEET)),
        "quantity": to_quantity(F.col("quantity")),
        "unit_price": to_price(F.col("unit_price")),
        "invoice_date": to_timestamp(F.col("invoice_date"), text_dates),
        "customer_id": to_customer_id(F.col("customer_id")),
    })


def add_flags(lines: DataFrame) -> DataFrame:
    quantity, price = F.col("quantity"), F.col("unit_price")
    cancelled = is_cancellation(F.col("invoice_id"))
    return lines.withColumns({
        "is_cancelled": cancelled,
        "is_return": _truth(quantity < 0),
        "is_zero_price": _truth(price == 0),
        "is_invalid_price": _truth(price < 0),
        "has_customer_id": F.col("customer_id").isNotNull(),
        "is_valid_sale": _truth(
            (quantity > 0) & (price > 0) & ~cancelled & F.col("invoice_date").isNotNull()
        ),
    })


def add_money(lines: DataFrame) -> DataFrame:
    quantity, price = F.col("quantity"), F.col("unit_price")
    net = to_money(quantity * price)
    # A missing price has to stay missing, which greatest(price, 0) would hide.
    charged = F.when(price < 0, F.lit(0)).otherwise(price)
    given_back = F.col("is_return") | F.col("is_cancelled")
    nothing = F.lit(0).cast(MONEY)
    return lines.withColumns({
        "net_line_value": net,
        "sales_revenue": F.when(F.col("is_valid_sale"), net).otherwise(nothing),
        "return_value": F.when(given_back, to_money(F.abs(quantity) * charged)).otherwise(nothing),
    })


def add_calendar(lines: DataFrame) -> DataFrame:
    moment = F.col("invoice_date")
    return lines.withColumns({
        "invoice_year": F.year(moment),
        "invoice_quarter": cal.quarter_name(moment),
        "invoice_month_number": F.month(moment),
        "invoice_month_name": cal.month_name(moment),
        "year_month": cal.year_month(moment),
        "day_of_week": cal.day_name(moment),
        "invoice_hour": F.hour(moment),
        "invoice_date_only": F.to_date(moment),
    })


def transaction_status() -> Column:
    """The first rule that holds names the row. The rules and their order."""
    return (
        F.when(F.col("unit_price") < 0, K.INVALID_PRICE)
        .when(F.col("unit_price") == 0, K.ZERO_PRICE)
        .when(F.col("quantity") == 0, K.ZERO_QUANTITY)
        .when(F.col("invoice_date").isNull(), K.MISSING_DATE)
        .when(F.col("is_cancelled"), K.CANCELLED)
        .when(F.col("is_return"), K.RETURN)
        .when(F.col("description").isNull(), K.MISSING_DESCRIPTION)
        .when(F.col("customer_id").isNull(), K.MISSING_CUSTOMER)
        .when(F.col("is_valid_sale"), K.VALID_SALE)
        .otherwise(K.REQUIRES_REVIEW)
    )


def derive(standardised: DataFrame) -> DataFrame:
    """All flags, amounts, calendar columns and the status, row by row."""
    lines = add_calendar(add_money(add_flags(standardised)))
    return lines.withColumn("transaction_status", transaction_status())


def clean_transactions(raw: DataFrame) -> DataFrame:
    return derive(standardise(deduplicate(raw))).select(*CLEAN.names)


def is_exception() -> Column:
    return _truth(
        (F.col("unit_price") <= 0)
        | (F.col("quantity") == 0)
        | F.col("invoice_date").isNull()
        | F.col("description").isNull()
    )


def exceptions(clean: DataFrame) -> DataFrame:
    """Rows worth a look; they also stay in the clean table."""
    return clean.filter(is_exception())


def valid_sales(clean: DataFrame) -> DataFrame:
    return clean.filter("is_valid_sale")


def customer_sales(clean: DataFrame) -> DataFrame:
    return clean.filter("is_valid_sale AND customer_id IS NOT NULL")


def status_counts(clean: DataFrame) -> DataFrame:
    return clean.groupBy("transaction_status").agg(F.count(F.lit(1)).alias("line_count"))


def cleaning_summary(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Thirteen metrics from a row count of ``raw`` and one pass over ``clean``."""
    valid, identified = F.col("is_valid_sale"), F.col("customer_id").isNotNull()
    nothing = F.lit(0).cast(MONEY)
    row = gather([
        raw.agg(F.count(F.lit(1)).alias("raw_rows")),
        clean.agg(
            F.count(F.lit(1)).alias("clean_rows"),
            F.count_if(valid).alias("valid"),
            F.count_if(valid & identified).alias("valid_identified"),
            F.count_if("is_cancelled").alias("cancelled"),
            F.count_if("is_return").alias("returned"),
            F.count_if(~identified).alias("unidentified"),
            F.count_if("is_zero_price").alias("zero_price"),
            F.count_if("is_invalid_price").alias("negative_price"),
            F.count_if(is_exception()).alias("exceptions"),
            F.coalesce(F.sum(F.when(valid, F.col("sales_revenue"))), nothing).alias("revenue"),
            F.coalesce(F.sum("return_value"), nothing).alias("returns"),
        ),
    ])
    # Metric labels and their order.
    return long_report(
        row,
        [
            ("Raw rows", F.col("raw_rows")),
            ("Exact duplicates removed", F.col("raw_rows") - F.col("clean_rows")),
            ("Rows after deduplication", F.col("clean_rows")),
            ("Valid sales rows", F.col("valid")),
            ("Valid sales with customer ID", F.col("valid_identified")),
            ("Cancelled rows", F.col("cancelled")),
            ("Return or negative-quantity rows", F.col("returned")),
            ("Rows missing customer ID", F.col("unidentified")),
            ("Zero-price rows", F.col("zero_price")),
            ("Negative-price rows", F.col("negative_price")),
            ("Exception rows", F.col("exceptions")),
            ("Total valid sales revenue", F.col("revenue")),
            ("Total recorded return value", F.col("returns")),
        ],
        "double",
    )
