"""Business questions on the views.

Every limited result has a unique last sort column, so it is the same on each
run; the limit turns into a top-k in every task and never sorts all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import constants as K
from tallyhouse.plans import views
from tallyhouse.plans.views import Star


def _name(column: str) -> Column:
    return F.col(column).asc_nulls_last()


def monthly_trend(star: Star) -> DataFrame:
    return views.monthly_sales(star).orderBy("year", "month_number")


def top_international_markets(star: Star, home: str = K.HOME_MARKET, limit: int = 10) -> DataFrame:
    return (
        views.country_performance(star)
        .filter(F.col("country") != home)
        .select("country", "revenue", "orders")
        .orderBy(F.desc("revenue"), _name("country"))
        .limit(limit)
    )


def _share(part: Column, total: Column) -> Column:
    return F.round(F.try_divide(part.cast("double") * 100.0, total.cast("double")), 2)


def _country_revenue(star: Star) -> tuple[DataFrame, Column]:
    """Revenue per country, and the total as a scalar subquery over the same
    grouped sums, which Spark computes once for both.

    A fact always has its keys. Saying so here gives both sides the filter the
    join would otherwise add to one of them, and so the same scan.
    """
    keyed = star.sales.filter("country_key IS NOT NULL")
    sums = keyed.groupBy("country_key").agg(F.sum("sales_revenue").alias("revenue"))
    countries = sums.join(star.dim_country, "country_key").select("country", "revenue")
    return countries, sums.agg(F.sum("revenue")).scalar()


def revenue_concentration(star: Star) -> DataFrame:
    countries, total = _country_revenue(star)
    return countries.withColumn(
        "revenue_share_percentage", _share(F.col("revenue"), total)
    ).orderBy(F.desc("revenue"), _name("country"))


def _goods(star: Star, operational: Sequence[str]) -> DataFrame:
    """Products without postage, fees and other operational entries."""
    description = F.col("description")
    return views.product_performance(star).filter(
        description.isNotNull() & ~F.upper(F.trim(description)).isin(*operational)
    )


def top_products_by_revenue(
    star: Star, operational: Sequence[str] = K.OPERATIONAL_DESCRIPTIONS, limit: int = 10
) -> DataFrame:
    return (
        _goods(star, operational)
        .select("stock_code", "description", "units_sold", "revenue", "orders")
        .orderBy(F.desc("revenue"), _name("stock_code"))
        .limit(limit)
    )


def top_products_by_units(
    star: Star, operational: Sequence[str] = K.OPERATIONAL_DESCRIPTIONS, limit: int = 10
) -> DataFrame:
    return (
        _goods(star, operational)
        .select("stock_code", "description", "units_sold", "revenue")
        .orderBy(F.desc("units_sold"), _name("stock_code"))
        .limit(limit)
    )


def top_customers(star: Star, limit: int = 20) -> DataFrame:
    return (
        views.customer_performance(star)
        .orderBy(F.desc("revenue"), _name("customer_id"))
        .limit(limit)
    )


def top_markets(star: Star, limit: int = 15) -> DataFrame:
    return (
        views.country_performance(star)
        .select("country", "revenue", "orders")
        .orderBy(F.desc("revenue"), F.desc("orders"), _name("country"))
        .limit(limit)
    )


def product_revenue_vs_volume(star: Star, limit: int = 100) -> DataFrame:
    return (
        views.product_performance(star)
        .filter("description IS NOT NULL AND revenue > 0 AND units_sold > 0")
        .select("stock_code", "description", "units_sold", "revenue", "orders")
        .orderBy(F.desc("revenue"), _name("stock_code"))
        .limit(limit)
    )


def valid_sales_sample(star: Star, limit: int = 100) -> DataFrame:
    """The first valid lines by key. The names are joined to the sample only:
    the joins keep every line exactly once, so the limit can go first."""
    first = star.sales.orderBy("transaction_key").limit(limit)
    return views.valid_sales(star, first)


def home_vs_international(star: Star, home: str = K.HOME_MARKET) -> DataFrame:
    market = F.when(F.col("country") == home, "home").otherwise("international")
    countries, total = _country_revenue(star)
    return (
        countries.groupBy(market.alias("market"))
        .agg(F.sum("revenue").alias("revenue"))
        .withColumn("revenue_share_percentage", _share(F.col("revenue"), total))
    )


def active_products(star: Star) -> DataFrame:
    return views.product_performance(star).agg(F.count(F.lit(1)).alias("active_products"))


def top_product(star: Star) -> DataFrame:
    return (
        views.product_performance(star)
        .select("stock_code", "description", "revenue")
        .orderBy(F.desc("revenue"), _name("stock_code"))
        .limit(1)
    )


def segment_spotlight(summary: DataFrame, segment: str = K.CHAMPIONS) -> DataFrame:
    return summary.filter(F.col("customer_segment") == segment).select(
        "customer_segment", "customer_count", "total_revenue", "revenue_share_percentage"
    )


def volume_vs_revenue_rank(star: Star, limit: int = 100) -> DataFrame:
    """High volume, lower revenue: the products that sell most units, with their
    ranks by volume and by revenue among all products.

    Whatever sells more units than one of the listed products is listed as well. The
    revenues of the list are thresholds: one pass counts the products between each two
    of them, and a rank is one more than the products beyond. Nothing but the list
    is sorted, and nothing is written; the list and one count per threshold reach the driver.
    """
    products = views.product_performance(star).filter(
        "description IS NOT NULL AND revenue > 0 AND units_sold > 0"
    ).select("stock_code", "description", "units_sold", "revenue")
    listed = products.orderBy(F.desc("units_sold"), _name("stock_code")).limit(limit).collect()
    edges = sorted({row.revenue for row in listed})
    products_beyond = [0] * (len(edges) + 1)
    if edges:
        passed = F.size(F.filter(F.array(*map(F.lit, edges)), lambda edge: edge < F.col("revenue")))
        for row in products.groupBy(passed.alias("passed")).count().collect():
            products_beyond[row.passed] = row["count"]
    rank_of = {edge: 1 + sum(products_beyond[place:]) for place, edge in enumerate(edges, 1)}
    fields = [*products.schema, T.StructField("volume_rank", T.IntegerType()), T.StructField("revenue_rank", T.IntegerType())]

    def entry(row: Row) -> Column:
        ranks = 1 + sum(other.units_sold > row.units_sold for other in listed), rank_of[row.revenue]
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip((*row, *ranks), fields, strict=True)])

    none = F.from_json(F.lit("[]"), T.ArrayType(T.StructType(fields)))
    entries = F.array(*map(entry, listed)) if listed else none
    ranked = products.sparkSession.range(1).select(F.inline(entries))
    return ranked.orderBy("volume_rank", _name("stock_code"))
