"""Executive KPIs in one pass over the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.numbers import half_even, ratio
from tallyhouse.functions.reports import long_report
from tallyhouse.schemas import MONEY


def kpi_inputs(fact: DataFrame) -> DataFrame:
    """One row of sums and counts.

    Lines shrink to one row per invoice and customer. Those rows are grouped
    once by invoice and once by customer in the same step, which yields the
    distinct invoices, the distinct customers and the orders per customer
    without a second scan.
    """
    sold = F.col("is_valid_sale") == 1
    pairs = fact.groupBy("invoice_id", "customer_key").agg(
        F.sum(F.when(sold, F.col("sales_revenue"))).alias("revenue"),
        F.sum(F.when(sold, F.col("quantity"))).alias("units"),
        F.sum("return_value").alias("returned"),
        F.max("is_valid_sale").alias("sold"),
        F.max("is_cancelled").alias("cancelled"),
    )
    invoice, customer = F.col("invoice_id"), F.col("customer_key")
    groups = pairs.groupingSets([[invoice], [customer]], invoice, customer).agg(
        (F.grouping("customer_key") == 1).alias("per_invoice"),
        F.sum("revenue").alias("revenue"),
        F.sum("units").alias("units"),
        F.sum("returned").alias("returned"),
        F.max("sold").alias("sold"),
        F.max("cancelled").alias("cancelled"),
        F.count(F.when(F.col("sold") == 1, invoice)).alias("orders"),
    )
    per_invoice, numbered = F.col("per_invoice"), invoice.isNotNull()
    buyer = ~per_invoice & (customer > 0) & (F.col("sold") == 1)
    nothing = F.lit(0).cast(MONEY)
    return groups.agg(
        F.coalesce(F.sum(F.when(per_invoice, F.col("revenue"))), nothing).alias("gross"),
        F.coalesce(F.sum(F.when(per_invoice, F.col("returned"))), nothing).alias("returned"),
        F.coalesce(F.sum(F.when(per_invoice, F.col("units"))), F.lit(0)).alias("units"),
        F.coalesce(
            F.sum(F.when(~per_invoice & (customer == 0), F.col("revenue"))), nothing
        ).alias("unidentified"),
        F.count_if(per_invoice & numbered & (F.col("sold") == 1)).alias("orders"),
        F.count_if(per_invoice & numbered & (F.col("cancelled") == 1)).alias("cancelled"),
        F.count_if(per_invoice & numbered).alias("invoices"),
        F.count_if(buyer).alias("customers"),
        F.count_if(buyer & (F.col("orders") > 1)).alias("repeat_customers"),
    )


def executive_kpis(fact: DataFrame) -> DataFrame:
    gross, returned = F.col("gross"), F.col("returned")

    def percent(part, whole):
        return half_even(ratio(part, whole) * 100.0, 2)

    # Metric labels and their order.
    return long_report(
        kpi_inputs(fact),
        [
            ("Gross Sales Revenue", gross),
            ("Recorded Return Value", returned),
            ("Estimated Net Revenue", gross - returned),
            ("Total Valid Orders", F.col("orders")),
            ("Identified Customers", F.col("customers")),
            ("Units Sold", F.col("units")),
            ("Average Order Value", half_even(ratio(gross, F.col("orders")), 2)),
            ("Return Value Rate (%)", percent(returned, gross)),
            ("Cancellation Rate (%)", percent(F.col("cancelled"), F.col("invoices"))),
            ("Repeat Customer Rate (%)", percent(F.col("repeat_customers"), F.col("customers"))),
            ("Unidentified Customer Revenue", F.col("unidentified")),
            ("Unidentified Revenue Share (%)", percent(F.col("unidentified"), gross)),
        ],
        "double",
    )
