"""The star schema and the five views on it.

Measures are grouped by surrogate key first and named afterwards, so the joins
run on the grouped result and not on every line.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.fact import join_members
from tallyhouse.schemas import WAREHOUSE
from tallyhouse.session import spread
from tallyhouse.sources import versions
from tallyhouse.sources.tables import read_table


@dataclass(frozen=True)
class Star:
    """The five tables of the warehouse."""

    dim_customer: DataFrame
    dim_product: DataFrame
    dim_country: DataFrame
    dim_date: DataFrame
    fact_transactions: DataFrame

    @property
    def sales(self) -> DataFrame:
        """Fact lines that are valid sales."""
        return self.fact_transactions.filter("is_valid_sale = 1")


def open_star(spark: SparkSession, location: str) -> Star:
    """The written warehouse, all tables of one version; raises FileNotFoundError when it is missing."""
    version = versions.current(spark, location)
    return Star(**{name: read_table(spark, version, name) for name in WAREHOUSE})


def valid_sales(star: Star, sales: DataFrame | None = None) -> DataFrame:
    """Valid lines with the names their keys stand for."""
    sales = star.sales if sales is None else sales
    named = join_members(sales, star.dim_customer, "customer_key", ["customer_id"])
    named = join_members(named, star.dim_product, "product_key", ["stock_code", "description"])
    named = join_members(named, star.dim_country, "country_key", ["country"])
    return named.select(
        "transaction_key", "invoice_id", "invoice_datetime", "date_key", "invoice_hour",
        "quantity", "unit_price", "sales_revenue", "customer_key", "customer_id",
        "product_key", "stock_code", "description", "country_key", "country",
    )


def _measured(sales: DataFrame, group: Column, name: str) -> DataFrame:
    """Revenue, distinct orders, distinct known customers and units per group.

    Lines shrink to one row per group, invoice and customer before anything is
    counted apart; only these rows are grouped both ways. Revenue is a sum of
    two-digit decimals and needs no rounding.
    """
    pairs = sales.groupBy(group.alias(name), "invoice_id", "customer_key").agg(
        F.sum("sales_revenue").alias("revenue"), F.sum("quantity").alias("units")
    )
    key, invoice, customer = F.col(name), F.col("invoice_id"), F.col("customer_key")
    counted = pairs.groupingSets([[key, invoice], [key, customer]], key, invoice, customer).agg(
        (F.grouping("customer_key") == 1).alias("per_invoice"),
        F.sum("revenue").alias("revenue"),
        F.sum("units").alias("units"),
    )
    per_invoice = F.col("per_invoice")
    return counted.groupBy(name).agg(
        F.sum(F.when(per_invoice, F.col("revenue"))).alias("revenue"),
        F.count_if(per_invoice & invoice.isNotNull()).alias("orders"),
        F.count_if(~per_invoice & (customer > 0)).alias("customers"),
        F.sum(F.when(per_invoice, F.col("units"))).alias("units_sold"),
    )


def monthly_sales(star: Star) -> DataFrame:
    # A date key is yyyyMMdd, so its month needs no look at the calendar.
    months = star.dim_date.select(
        (F.col("year") * 100 + F.col("month_number")).alias("month_key"),
        "year", "month_number", "month_name", "year_month",
    ).distinct()
    grouped = _measured(star.sales, F.expr("date_key DIV 100").cast("int"), "month_key")
    return grouped.join(months, "month_key").select(
        "year", "month_number", "month_name", "year_month",
        "revenue", "orders", "customers", "units_sold",
    )


def country_performance(star: Star) -> DataFrame:
    grouped = _measured(star.sales, F.col("country_key"), "country_key")
    return grouped.join(star.dim_country, "country_key").select(
        "country", "revenue", "orders", "customers", "units_sold"
    )


def product_performance(star: Star) -> DataFrame:
    sales = spread(star.sales.select("product_key", "invoice_id", "sales_revenue", "quantity"), "product_key", "invoice_id")
    grouped = sales.groupBy("product_key").agg(
        F.sum("sales_revenue").alias("revenue"),
        F.sum("quantity").alias("units_sold"),
        F.count_distinct("invoice_id").alias("orders"),
    )
    return grouped.join(star.dim_product, "product_key").select(
        "stock_code", "description", "revenue", "units_sold", "orders"
    )


def customer_performance(star: Star) -> DataFrame:
    grouped = star.sales.filter("customer_key > 0").groupBy("customer_key").agg(
        F.sum("sales_revenue").alias("revenue"),
        F.count_distinct("invoice_id").alias("orders"),
        F.sum("quantity").alias("units_purchased"),
        F.min("invoice_datetime").alias("first_purchase"),
        F.max("invoice_datetime").alias("latest_purchase"),
    )
    names = star.dim_customer.select("customer_key", "customer_id")
    return grouped.join(names, "customer_key").select(
        "customer_id", "revenue", "orders", "units_purchased", "first_purchase", "latest_purchase"
    )


VIEWS: dict[str, Callable[[Star], DataFrame]] = {
    "vw_valid_sales": valid_sales,
    "vw_monthly_sales": monthly_sales,
    "vw_country_performance": country_performance,
    "vw_product_performance": product_performance,
    "vw_customer_performance": customer_performance,
}


def register_views(star: Star) -> None:
    """Name the tables and views for ``spark.sql``; old ones are replaced."""
    for name in WAREHOUSE:
        getattr(star, name).createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        view(star).createOrReplaceTempView(name)
