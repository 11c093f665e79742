"""The batch jobs: ingest and clean, build the warehouse, export, answer the business questions.

They hand over through written tables, so each can run on its own and a lost
executor never reaches back past the last table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators import cleaning, quality, rejects
from tallyhouse.plans import business, views
from tallyhouse.plans.kpis import executive_kpis
from tallyhouse.plans.rfm import rfm_customers, rfm_segment_summary
from tallyhouse.plans.views import Star, open_star, register_views
from tallyhouse.session import row_bytes, scratch, sized_for
from tallyhouse.sinks.exports import write_csv
from tallyhouse.sinks.tables import write_clean, write_landing, write_warehouse
from tallyhouse.sources.sheets import scan_landing
from tallyhouse.sources.tables import read_clean
from tallyhouse.sources.versions import current


def ingest_and_clean(
    spark: SparkSession,
    raw: DataFrame,
    output: str,
    num_bytes: int,
    land: bool = False,
    timestamp_format: str | None = None,
    malformed: DataFrame | None = None,
) -> None:
    """Clean table, exceptions, rejects, and the reports on raw and clean lines.

    Rejects are the values that cleaning lost and, if given, the ``malformed`` lines of the source. ``land`` first stores the lines in columns. Worth it for text sources: the
    reports look at single columns, and parsing every line for each would cost
    far more than the copy.
    """
    with sized_for(spark, num_bytes):
        if land:
            write_landing(raw, f"{output}/landing")
            raw = scan_landing(spark, f"{output}/landing", raw.schema)
        write_clean(raw, f"{output}/clean_transactions", timestamp_format)
        clean = read_clean(spark, f"{output}/clean_transactions")
        with scratch(spark, "rejects") as path:
            rejects.rejects(raw, malformed, timestamp_format).write.parquet(path)
            found = spark.read.parquet(path)
            write_csv(found, f"{output}/data_rejects")
            write_csv(rejects.reject_summary(found), f"{output}/reports/reject_summary")
        write_csv(cleaning.exceptions(clean), f"{output}/data_exceptions")
        write_csv(cleaning.cleaning_summary(raw, clean), f"{output}/reports/cleaning_summary")
        write_csv(quality.column_profile(raw), f"{output}/reports/column_profile")
        write_csv(
            quality.data_quality_summary(raw, deduplicated=clean, timestamp_format=timestamp_format),
            f"{output}/reports/data_quality_summary",
        )


def build_warehouse(spark: SparkSession, output: str) -> Star:
    """Star schema and views from the written clean table, replacing old ones."""
    clean_path = f"{output}/clean_transactions"
    read_clean(spark, clean_path)
    with sized_for(spark, row_bytes(spark, clean_path)):
        write_warehouse(spark, clean_path, f"{output}/warehouse")
    return attach_warehouse(spark, output)


def attach_warehouse(spark: SparkSession, output: str) -> Star:
    """The written warehouse, its tables and views named for ``spark.sql``."""
    star = open_star(spark, f"{output}/warehouse")
    register_views(star)
    return star


def export_analytics(spark: SparkSession, output: str) -> None:
    """Seven CSV exports from the written warehouse."""
    star = open_star(spark, f"{output}/warehouse")
    analytics = f"{output}/analytics"

    def export(frame: DataFrame, name: str, *order: str) -> None:
        columns = [F.desc(c[1:]) if c.startswith("-") else F.col(c).asc_nulls_last() for c in order]
        write_csv(frame, f"{analytics}/{name}", *columns)

    with sized_for(spark, row_bytes(spark, f"{current(spark, f'{output}/warehouse')}/fact_transactions")):
        export(views.monthly_sales(star), "monthly_sales", "year", "month_number")
        export(views.country_performance(star), "country_performance", "-revenue", "country")
        export(views.product_performance(star), "product_performance", "-revenue", "stock_code")
        export(views.customer_performance(star), "customer_performance", "-revenue", "customer_id")

        write_csv(executive_kpis(star.fact_transactions), f"{output}/reports/executive_kpis")

        with scratch(spark, "rfm-customers") as scored:
            rfm_customers(spark, star).write.mode("overwrite").parquet(scored)
            customers = spark.read.parquet(scored)
            export(customers, "customer_rfm_segments", "customer_id")
            summary = rfm_segment_summary(customers)
            write_csv(
                summary, f"{output}/reports/rfm_segment_summary",
                F.desc("total_revenue"), F.col("customer_segment"),
            )


def answer_questions(spark: SparkSession, output: str) -> None:
    """The fourteen business questions, one CSV each, from the written warehouse."""
    star = open_star(spark, f"{output}/warehouse")
    questions = (
        business.monthly_trend, business.top_international_markets, business.revenue_concentration,
        business.top_products_by_revenue, business.top_products_by_units, business.top_customers,
        business.top_markets, business.product_revenue_vs_volume, business.valid_sales_sample,
        business.home_vs_international, business.active_products, business.top_product,
        business.volume_vs_revenue_rank,
    )
    with sized_for(spark, row_bytes(spark, f"{current(spark, f'{output}/warehouse')}/fact_transactions")):
        for question in questions:
            write_csv(question(star), f"{output}/questions/{question.__name__}")
        with scratch(spark, "rfm-customers") as scored:
            rfm_customers(spark, star).write.mode("overwrite").parquet(scored)
            summary = rfm_segment_summary(spark.read.parquet(scored))
            write_csv(business.segment_spotlight(summary), f"{output}/questions/segment_spotlight")
