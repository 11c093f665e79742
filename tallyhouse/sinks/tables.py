"""Parquet tables: landing, clean, and the star schema."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.constants import SHEET
from tallyhouse.functions.numbers import number, to_timestamp
from tallyhouse.operators.cleaning import derive, standardise
from tallyhouse.operators.dimensions import (
    country_members,
    customer_members,
    date_dimension,
    product_members,
)
from tallyhouse.operators.fact import fact_transactions
from tallyhouse.operators.ordering import number_rows, sort_with_place, write_numbered
from tallyhouse.schemas import CLEAN, DIM_COUNTRY, DIM_CUSTOMER, DIM_PRODUCT, LINE, LINE_POSITION
from tallyhouse.session import drop_folder, scratch
from tallyhouse.sources import versions
from tallyhouse.sources.tables import read_clean, read_table, warehouse_lines


_ORDER = ("InvoiceDate", "Invoice", "Country", "StockCode", "Description", "Quantity", "Price", "Customer ID", SHEET)
_MEANING = "meaning_of_"


def _meanings(raw: DataFrame, timestamp_format: str | None) -> dict[str, Column]:
    """What the values mean that were read as text."""
    kinds = dict(raw.dtypes)
    meaning = {
        "InvoiceDate": lambda c: to_timestamp(c, timestamp_format),
        "Quantity": number,
        "Price": number,
        "Customer ID": number,
    }
    return {name: of(F.col(f"`{name}`")) for name, of in meaning.items() if kinds[name] == "string"}


def row_order(raw: DataFrame, timestamp_format: str | None = None) -> list[Column]:
    """By date, then invoice. Values that were read as text are ordered by what
    they mean, and by their text where they mean the same."""
    meaning = _meanings(raw, timestamp_format)
    return [meaning.get(name, F.col(f"`{name}`")) for name in _ORDER] + [F.col(f"`{name}`") for name in meaning]


def write_landing(raw: DataFrame, path: str) -> None:
    """Raw lines in columns, the sheet among them: one file per task, however many sheets there are."""
    raw.write.mode("overwrite").parquet(path)


def write_clean(raw: DataFrame, path: str, timestamp_format: str | None = None) -> None:
    """Clean ``raw`` into a table in row order.

    One shuffle of whole rows puts them into order. The order is total, so copies, and
    only they, end in the same place and are dropped there; everything else is computed on
    the way into the file. No date, country or product can fill a partition by itself.

    The stored order does the work of folders and indexes. A file spans a
    short time, so a filter on a date or month skips whole files by their
    statistics; and the lines of an invoice lie together, so counts per invoice
    mostly finish inside the scanning task.
    """
    meaning = _meanings(raw, timestamp_format)
    order = [F.col(f"`{name}`") for name in (*(f"{_MEANING}{n}" if n in meaning else n for n in _ORDER), *meaning)]
    ranked = raw.withColumns({f"{_MEANING}{name}": column for name, column in meaning.items()})
    placed = sort_with_place(ranked, order, LINE, distinct=True).drop(*(f"{_MEANING}{name}" for name in meaning))
    (
        derive(standardise(placed, timestamp_format))
        .select(*CLEAN.names, *LINE_POSITION.names)
        .write.mode("overwrite")
        .parquet(path)
    )


def write_dimensions(spark: SparkSession, lines: DataFrame, location: str) -> None:
    """Replace the four dimensions; keys follow the members' text order.

    They do not depend on each other, so Spark may run them side by side.
    """

    def write(members: DataFrame, member: str, key: str, names: list[str]) -> None:
        order = [F.col(member).asc_nulls_last()]
        with scratch(spark, key) as path:
            numbered = write_numbered(spark, members, order, key, path)
            name = f"dim_{key.removesuffix('_key')}"
            numbered.select(*names).write.mode("overwrite").parquet(f"{location}/{name}")

    with ThreadPoolExecutor(4) as pool:
        done = [
            pool.submit(write, customer_members(lines), "customer_id", "customer_key", DIM_CUSTOMER.names),
            pool.submit(write, product_members(lines), "stock_code", "product_key", DIM_PRODUCT.names),
            pool.submit(write, country_members(lines), "country", "country_key", DIM_COUNTRY.names),
            pool.submit(
                date_dimension(lines).write.mode("overwrite").parquet, f"{location}/dim_date"
            ),
        ]
        for each in done:
            each.result()


def write_fact(spark: SparkSession, lines: DataFrame, location: str) -> None:
    """Replace the fact table; needs the dimensions in place.

    The dimensions are read back, so the planner knows their true size when it
    chooses between broadcast and shuffle.
    """
    numbered = number_rows(lines, LINE, "transaction_key")
    fact_transactions(
        numbered,
        read_table(spark, location, "dim_customer"),
        read_table(spark, location, "dim_product"),
        read_table(spark, location, "dim_country"),
    ).write.mode("overwrite").parquet(f"{location}/fact_transactions")


def write_warehouse(spark: SparkSession, clean_path: str, location: str) -> None:
    """Full rebuild of the star schema from the written clean table.

    All or nothing: the tables become those of ``location`` together, when the last one is written.
    """
    lines = warehouse_lines(read_clean(spark, clean_path, with_position=True))
    version = versions.new_version(location)
    try:
        write_dimensions(spark, lines, version)
        write_fact(spark, lines, version)
        versions.publish(spark, location, version)
    except BaseException:
        drop_folder(spark, version)
        raise
