"""The four dimensions, before their surrogate keys are given out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import constants as K
from tallyhouse.functions import calendar as cal
from tallyhouse.schemas import DIM_DATE


def customer_members(lines: DataFrame) -> DataFrame:
    """Known customers with the country of their first line.

    First means the lowest (date, invoice, country), which is the row order of
    the clean table. Lines shrink to one row per customer, invoice and country
    before customers are compared, so a customer with a third of all lines
    costs no more than their invoices.
    """
    invoices = (
        lines.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "invoice_id", "country")
        .agg(
            F.min("invoice_date").alias("invoice_date"),
            F.count_if(F.col("invoice_date").isNull()).alias("undated"),
        )
    )
    # Lines without a date come first, as they do in the clean table.
    moment = F.when(F.col("undated") == 0, F.col("invoice_date"))
    return invoices.groupBy("customer_id").agg(
        F.min_by("country", F.struct(moment, F.col("invoice_id"), F.col("country"))).alias("country")
    )


def product_members(lines: DataFrame) -> DataFrame:
    """Every stock code, a missing one included, with its modal description.

    Ties go to the lowest text. Counting per description first keeps the state
    of one product to a single candidate however many descriptions it has.
    """
    uses = lines.groupBy("stock_code", "description").agg(F.count(F.lit(1)).alias("uses"))
    preference = F.when(
        F.col("description").isNotNull() & F.col("stock_code").isNotNull(),
        F.struct(-F.col("uses"), F.col("description")),
    )
    return uses.groupBy("stock_code").agg(
        F.coalesce(F.min_by("description", preference), F.lit(K.UNKNOWN_PRODUCT)).alias("description")
    )


def country_members(lines: DataFrame) -> DataFrame:
    return lines.select("country").distinct()


def date_dimension(lines: DataFrame) -> DataFrame:
    """Every day from the first to the last invoice, gaps filled."""
    span = lines.agg(
        F.to_date(F.min("invoice_date")).alias("first"),
        F.to_date(F.max("invoice_date")).alias("last"),
    )
    days = span.select(F.explode(F.sequence("first", "last")).alias("full_date"))
    day = F.col("full_date")
    return days.withColumns({
        "date_key": cal.date_key(day),
        "year": F.year(day),
        "quarter": cal.quarter_name(day),
        "month_number": F.month(day),
        "month_name": cal.month_name(day),
        "year_month": cal.year_month(day),
        "day_of_month": F.dayofmonth(day),
        "day_name": cal.day_name(day),
        "week_number": F.weekofyear(day),
        "is_weekend": cal.is_weekend(day),
    }).select(*DIM_DATE.names)
