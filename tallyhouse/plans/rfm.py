"""Recency, frequency and monetary scores, and the segments they make."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import constants as K
from tallyhouse.functions import calendar as cal
from tallyhouse.functions.numbers import half_even
from tallyhouse.operators.selection import rows_in_order
from tallyhouse.plans.views import Star, customer_performance
from tallyhouse.session import scratch_path

BINS = 5
_MEASURES = ("recency_days", "frequency", "monetary")


def customer_measures(star: Star) -> DataFrame:
    """One row per buying customer. The snapshot is a day after the last valid
    sale of all, those of unknown customers included."""
    latest = star.sales.agg(F.max("invoice_datetime").alias("latest")).scalar()
    customers = customer_performance(star).select(
        "customer_id",
        F.col("first_purchase").alias("first_purchase_date"),
        F.col("latest_purchase").alias("latest_purchase_date"),
        F.col("orders").alias("frequency"),
        F.col("revenue").alias("monetary"),
        "units_purchased",
    )
    first, last = F.col("first_purchase_date"), F.col("latest_purchase_date")
    snapshot = latest + F.expr("INTERVAL 1 DAY")
    return customers.withColumns({
        "recency_days": cal.whole_days(last, snapshot).cast("int"),
        "customer_lifetime_days": cal.whole_days(first, last).cast("int"),
        "average_order_value": half_even(
            F.col("monetary").cast("double") / F.col("frequency").cast("double"), 2
        ),
    })


def last_of_bin(count: int) -> list[int]:
    """Row numbers that close the first four of five equal-frequency bins.

    Bin edges are the interpolated quantiles of 1..count and belong to the bin
    they close, so the sizes can differ from those of ``ntile``.
    """
    return [1 + j * (count - 1) // BINS for j in range(1, BINS)]


def _cut_rows(measures: DataFrame) -> dict[str, list[tuple[Decimal, str]]]:
    """Measure and id of the customer that closes each bin, per measure.

    All measures are searched together; scoring a customer is then a comparison
    with four constants.
    """
    cents = measures.select("customer_id", *[(F.col(name).cast("decimal(28,2)") * 100).cast("bigint").alias(name) for name in _MEASURES])
    customers = measures.count()
    if customers == 0:
        return {name: [] for name in _MEASURES}
    found = rows_in_order(cents, "customer_id", {name: last_of_bin(customers) for name in _MEASURES})
    return {name: [(Decimal(value).scaleb(-2), customer) for value, customer in cuts] for name, cuts in found.items()}


def bin_number(measure: str, cuts: Sequence[tuple[Decimal, str]]) -> Column:
    """1..5; ties in the measure are told apart by customer id."""
    amount, customer = F.col(measure).cast("decimal(28,2)"), F.col("customer_id")
    number = F.lit(1)
    for value, closing in cuts:
        edge = F.lit(value).cast("decimal(28,2)")
        beyond = (amount > edge) | ((amount == edge) & (customer > closing))
        number = number + beyond.cast("int")
    return number


def customer_segment() -> Column:
    """The first rule that holds names the segment. The rules and their order."""
    r, f, m = F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), K.CHAMPIONS)
        .when((r >= 3) & (f >= 4), K.LOYAL)
        .when((r == 5) & (f == 1), K.NEW)
        .when((r >= 4) & f.isin(2, 3), K.POTENTIAL_LOYALISTS)
        .when((r <= 2) & (f >= 4), K.AT_RISK)
        .when((r == 1) & (f <= 2), K.LOST)
        .when((r <= 2) & (f <= 3), K.HIBERNATING)
        .when((m >= 4) & (f >= 2), K.BIG_SPENDERS)
        .otherwise(K.NEED_ATTENTION)
    )


def score(measures: DataFrame, cuts: Mapping[str, Sequence[tuple[Decimal, str]]]) -> DataFrame:
    """Scores, score text and segment of every customer."""
    scores = ("recency_score", "frequency_score", "monetary_score")
    return (
        measures.withColumns({
            # A recent purchase is a small number of days and a high score.
            "recency_score": F.lit(BINS + 1) - bin_number("recency_days", cuts["recency_days"]),
            "frequency_score": bin_number("frequency", cuts["frequency"]),
            "monetary_score": bin_number("monetary", cuts["monetary"]),
        })
        .withColumn("rfm_score", F.concat(*[F.col(name).cast("string") for name in scores]))
        .withColumn("customer_segment", customer_segment())
    )


def rfm_customers(spark: SparkSession, star: Star) -> DataFrame:
    """Measures are written once, then searched for the cuts and scored from that table."""
    path = scratch_path(spark, "rfm-measures")
    customer_measures(star).write.mode("overwrite").parquet(path)
    measures = spark.read.parquet(path)
    return score(measures, _cut_rows(measures)).select(
        "customer_id", "first_purchase_date", "latest_purchase_date", "frequency", "monetary",
        "units_purchased", "recency_days", "customer_lifetime_days", "average_order_value",
        "recency_score", "frequency_score", "monetary_score", "rfm_score", "customer_segment",
    )


def rfm_segment_summary(customers: DataFrame) -> DataFrame:
    """Segments present, largest revenue first."""
    segments = customers.groupBy("customer_segment").agg(
        F.count("customer_id").alias("customer_count"),
        F.sum("monetary").alias("revenue"),
        F.sum("recency_days").alias("days"),
        F.sum("frequency").alias("orders"),
    )
    total = segments.agg(F.sum("revenue").cast("double")).scalar()
    count, revenue = F.col("customer_count").cast("double"), F.col("revenue").cast("double")
    return segments.select(
        "customer_segment",
        "customer_count",
        F.col("revenue").alias("total_revenue"),
        half_even(revenue / count, 2).alias("average_revenue"),
        half_even(F.col("days").cast("double") / count, 1).alias("average_recency_days"),
        half_even(F.col("orders").cast("double") / count, 1).alias("average_frequency"),
        half_even(F.try_divide(revenue, total) * 100.0, 2).alias("revenue_share_percentage"),
    ).orderBy(F.desc("total_revenue"), "customer_segment")
