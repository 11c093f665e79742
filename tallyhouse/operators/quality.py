"""Column profile and quality summary of the raw lines.

Distinct values are counted exactly. Each column is counted on its own, so a
columnar source is read once in total, and no row is multiplied the way
several distinct counts inside one aggregate would do.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.numbers import half_even, not_nan, number, to_timestamp
from tallyhouse.functions.reports import gather, long_report
from tallyhouse.functions.text import is_blank, is_cancellation
from tallyhouse.operators.cleaning import duplicate_count


def _value_counts(raw: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column with their number of rows."""
    kind = dict(raw.dtypes)[column]
    return (
        raw.select(not_nan(F.col(f"`{column}`"), kind).alias("value"))
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def column_profile(raw: DataFrame) -> DataFrame:
    """One row per column, in column order."""
    profiles = []
    for position, (column, kind) in enumerate(raw.dtypes):
        profiles.append(
            _value_counts(raw, column)
            .agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
                F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing_values"),
                F.count("value").alias("unique_values"),
            )
            .select(
                F.lit(position).alias("position"),
                F.lit(column).alias("column"),
                F.lit(kind).alias("data_type"),
                "total_rows",
                "missing_values",
                "unique_values",
            )
        )
    share = F.try_divide(F.col("missing_values").cast("double"), F.col("total_rows").cast("double"))
    return (
        reduce(DataFrame.union, profiles)
        .withColumn("missing_percentage", half_even(share * 100.0, 2))
        .orderBy("position")
        .drop("position")
    )


def _distinct(raw: DataFrame, column: str, name: str) -> DataFrame:
    return _value_counts(raw, column).agg(F.count("value").alias(name))


def _invoice_metrics(raw: DataFrame) -> DataFrame:
    """Whether a row is cancelled depends on its invoice number alone, so the
    rows per invoice number answer all three invoice metrics."""
    cancelled = is_cancellation(F.col("value"))
    return _value_counts(raw, "Invoice").agg(
        F.count("value").alias("invoices"),
        F.count_if(cancelled).alias("cancelled_invoices"),
        F.coalesce(F.sum(F.when(cancelled, F.col("n"))), F.lit(0)).alias("cancelled_rows"),
    )


def _duplicates(raw: DataFrame, deduplicated: DataFrame | None) -> DataFrame:
    if deduplicated is None:
        return duplicate_count(raw)
    return gather([
        raw.agg(F.count(F.lit(1)).alias("all_rows")),
        deduplicated.agg(F.count(F.lit(1)).alias("kept_rows")),
    ]).select((F.col("all_rows") - F.col("kept_rows")).alias("duplicate_rows"))


def data_quality_summary(
    raw: DataFrame, deduplicated: DataFrame | None = None, timestamp_format: str | None = None
) -> DataFrame:
    """Twenty metrics; ``deduplicated`` (the written clean table, say) spares
    the shuffle that counting duplicates otherwise takes.

    Missing means not there; text that is no number or date is there, but is
    neither negative nor zero, nor early or late.
    """
    kinds = dict(raw.dtypes)
    text_dates = timestamp_format if kinds["InvoiceDate"] == "string" else None
    moment = to_timestamp(F.col("InvoiceDate"), text_dates)

    def value(column: str) -> Column:
        return not_nan(F.col(f"`{column}`"), kinds[column])

    scan = raw.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(value("Customer ID").isNull()).alias("no_customer"),
        F.count_if(value("Description").isNull()).alias("no_description"),
        F.count_if(value("InvoiceDate").isNull()).alias("no_date"),
        F.count_if(is_blank(value("Description"))).alias("blank_descriptions"),
        F.count_if(is_blank(value("Country"))).alias("blank_countries"),
        F.count_if(number(value("Quantity")) < 0).alias("negative_quantities"),
        F.count_if(number(value("Quantity")) == 0).alias("zero_quantities"),
        F.count_if(number(value("Price")) < 0).alias("negative_prices"),
        F.count_if(number(value("Price")) == 0).alias("zero_prices"),
        F.min(moment).alias("earliest"),
        F.max(moment).alias("latest"),
    )
    row = gather([
        scan,
        _duplicates(raw, deduplicated),
        _invoice_metrics(raw),
        _distinct(raw, "Customer ID", "customers"),
        _distinct(raw, "StockCode", "products"),
        _distinct(raw, "Country", "countries"),
    ])
    # Metric labels and their order.
    return long_report(
        row,
        [
            ("Total rows", F.col("rows")),
            ("Total columns", F.lit(len(raw.columns))),
            ("Duplicate rows", F.col("duplicate_rows")),
            ("Missing customer IDs", F.col("no_customer")),
            ("Missing descriptions", F.col("no_description")),
            ("Missing invoice dates", F.col("no_date")),
            ("Blank descriptions", F.col("blank_descriptions")),
            ("Blank countries", F.col("blank_countries")),
            ("Cancelled transaction rows", F.col("cancelled_rows")),
            ("Unique cancelled invoices", F.col("cancelled_invoices")),
            ("Negative quantities", F.col("negative_quantities")),
            ("Zero quantities", F.col("zero_quantities")),
            ("Negative prices", F.col("negative_prices")),
            ("Zero prices", F.col("zero_prices")),
            ("Unique invoices", F.col("invoices")),
            ("Unique customers", F.col("customers")),
            ("Unique products", F.col("products")),
            ("Unique countries", F.col("countries")),
            ("Earliest invoice date", F.col("earliest")),
            ("Latest invoice date", F.col("latest")),
        ],
        "string",
    )
