"""Every named query over a folder of order tables.

Lines are landed, cleaned and modelled once per session and folder, into
tables in the shared folder, the way the batch jobs do it; the queries read
those tables. All of them cover the whole input.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.functions.reports import money_as_double
from tallyhouse.operators import cleaning, quality, rejects
from tallyhouse.plans import business, rfm, views
from tallyhouse.plans.kpis import executive_kpis
from tallyhouse.plans.views import Star, open_star
from tallyhouse.session import drop_folder, row_bytes, scratch_path, sized_for
from tallyhouse.sinks.tables import write_clean, write_landing, write_warehouse
from tallyhouse.sources.sample_lines import retail_lines, write_sample_workbook
from tallyhouse.sources.sheets import scan_landing, scan_workbook
from tallyhouse.sources.tables import read_clean


class Workspace:
    """Tables derived from one folder in one session, each written on first use.

    Writing widens shuffles for the size of the folder and restores the
    session's setting; queries on the written tables run with the session's own.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self.root = scratch_path(spark, "workspace")
        self.num_bytes = row_bytes(spark, folder)

    def close(self) -> None:
        """Delete the tables."""
        drop_folder(self.spark, self.root)
        _workspaces.pop((self.spark.sparkContext.applicationId, self.folder), None)

    @cached_property
    def raw(self) -> DataFrame:
        path = f"{self.root}/landing"
        with sized_for(self.spark, self.num_bytes):
            write_landing(retail_lines(self.spark, self.folder), path)
        return scan_landing(self.spark, path)

    @cached_property
    def workbook(self) -> DataFrame:
        path = f"{self.root}/workbook"
        with sized_for(self.spark, self.num_bytes):
            write_sample_workbook(self.raw, path)
        return scan_workbook(self.spark, path, "csv")

    @cached_property
    def clean_path(self) -> str:
        path = f"{self.root}/clean_transactions"
        raw = self.raw
        with sized_for(self.spark, self.num_bytes):
            write_clean(raw, path)
        return path

    @property
    def clean(self) -> DataFrame:
        return read_clean(self.spark, self.clean_path)

    @cached_property
    def star(self) -> Star:
        location = f"{self.root}/warehouse"
        clean = self.clean_path
        with sized_for(self.spark, self.num_bytes):
            write_warehouse(self.spark, clean, location)
        return open_star(self.spark, location)

    @cached_property
    def rfm(self) -> DataFrame:
        path = f"{self.root}/rfm_customers"
        star = self.star
        with sized_for(self.spark, self.num_bytes):
            rfm.rfm_customers(self.spark, star).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    @property
    def segments(self) -> DataFrame:
        return rfm.rfm_segment_summary(self.rfm)


_workspaces: dict[tuple[str, str], Workspace] = {}
_lock = threading.RLock()


def workspace(spark: SparkSession, folder: str) -> Workspace:
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if key not in _workspaces:
        _workspaces[key] = Workspace(spark, folder.rstrip("/"))
    return _workspaces[key]


_PLANS: dict[str, Callable[[Workspace], DataFrame]] = {
    # raw lines
    "workbook_scan": lambda w: cleaning.standardise(cleaning.deduplicate(w.workbook)),
    "rejected_values": lambda w: rejects.lost_values(w.workbook),
    "raw_transactions": lambda w: w.raw,
    "column_profile": lambda w: quality.column_profile(w.raw),
    "data_quality_summary": lambda w: quality.data_quality_summary(w.raw),
    "duplicate_count": lambda w: cleaning.duplicate_count(w.raw),
    "exact_dedup": lambda w: cleaning.deduplicate(w.raw),
    # clean lines
    "clean_transactions": lambda w: cleaning.clean_transactions(w.raw),
    "exceptions": lambda w: cleaning.exceptions(w.clean),
    "valid_sales_subset": lambda w: cleaning.valid_sales(w.clean),
    "customer_sales_subset": lambda w: cleaning.customer_sales(w.clean),
    "status_counts": lambda w: cleaning.status_counts(w.clean),
    "cleaning_summary": lambda w: cleaning.cleaning_summary(w.raw, w.clean),
    # star schema
    "dim_customer": lambda w: w.star.dim_customer,
    "dim_product": lambda w: w.star.dim_product,
    "dim_country": lambda w: w.star.dim_country,
    "dim_date": lambda w: w.star.dim_date,
    "fact_transactions": lambda w: w.star.fact_transactions,
    # views
    "vw_valid_sales": lambda w: views.valid_sales(w.star),
    "vw_monthly_sales": lambda w: views.monthly_sales(w.star),
    "vw_country_performance": lambda w: views.country_performance(w.star),
    "vw_product_performance": lambda w: views.product_performance(w.star),
    "vw_customer_performance": lambda w: views.customer_performance(w.star),
    # KPIs and segments
    "executive_kpis": lambda w: executive_kpis(w.star.fact_transactions),
    "rfm_customers": lambda w: w.rfm,
    "rfm_segment_summary": lambda w: w.segments,
    # business questions
    "monthly_trend": lambda w: business.monthly_trend(w.star),
    "top_international_markets": lambda w: business.top_international_markets(w.star),
    "revenue_concentration": lambda w: business.revenue_concentration(w.star),
    "top_products_by_revenue": lambda w: business.top_products_by_revenue(w.star),
    "top_products_by_units": lambda w: business.top_products_by_units(w.star),
    "top_customers": lambda w: business.top_customers(w.star),
    "top_markets": lambda w: business.top_markets(w.star),
    "product_revenue_vs_volume": lambda w: business.product_revenue_vs_volume(w.star),
    "valid_sales_sample": lambda w: business.valid_sales_sample(w.star),
    # report measures
    "home_vs_international": lambda w: business.home_vs_international(w.star),
    "active_products": lambda w: business.active_products(w.star),
    "top_product": lambda w: business.top_product(w.star),
    "segment_spotlight": lambda w: business.segment_spotlight(w.segments),
    "volume_vs_revenue_rank": lambda w: business.volume_vs_revenue_rank(w.star),
}


def _query(plan: Callable[[Workspace], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        with _lock:
            return money_as_double(plan(workspace(spark, folder)))

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(plan) for name, plan in _PLANS.items()}
