"""What did not make it into a typed column: values a cast lost, and malformed lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.constants import SHEET
from tallyhouse.functions.numbers import number, to_price, to_quantity, to_timestamp
from tallyhouse.functions.text import strip

NO_NUMBER = "no number"
NOT_WHOLE = "not a whole number in range"
NO_TIMESTAMP = "no timestamp"
MALFORMED = "malformed line"


def _lost(raw: DataFrame, name: str, typed: Column, reason: Column) -> Column:
    """An entry for a value that is there, as text or as a number, and is not in the typed column. Blank text and
    NaN are missing values, not lost ones."""
    column = F.col(f"`{name}`")
    text = column.cast("string")
    lost = (strip(text) != "") & (F.lower(strip(text)) != "nan") & typed.isNull()
    entry = F.struct(F.lit(name).alias("column_name"), text.alias("raw_text"), reason.alias("reason"))
    return F.when(lost, entry)


def lost_values(raw: DataFrame, timestamp_format: str | None = None) -> DataFrame:
    """``source_sheet, invoice, column_name, raw_text, reason``: one row per value of ``raw`` that cleaning turns
    into a missing one. A fractional customer id is an error there and no entry here."""
    text_dates = timestamp_format if dict(raw.dtypes)["InvoiceDate"] == "string" else None
    quantity, price, customer, date = (F.col(f"`{name}`") for name in ("Quantity", "Price", "Customer ID", "InvoiceDate"))
    entries = F.array(
        _lost(raw, "Quantity", to_quantity(quantity), F.when(number(quantity).isNull(), NO_NUMBER).otherwise(NOT_WHOLE)),
        _lost(raw, "Price", to_price(price), F.lit(NO_NUMBER)),
        _lost(raw, "InvoiceDate", to_timestamp(date, text_dates), F.lit(NO_TIMESTAMP)),
        _lost(raw, "Customer ID", number(customer), F.lit(NO_NUMBER)),
    )
    rows = raw.select(F.col(SHEET), F.col("Invoice").alias("invoice"), F.explode(F.array_compact(entries)).alias("lost"))
    return rows.select(SHEET, "invoice", "lost.column_name", "lost.raw_text", "lost.reason")


def rejects(raw: DataFrame, malformed: DataFrame | None = None, timestamp_format: str | None = None) -> DataFrame:
    """Lost values, and malformed lines (``source_sheet, raw_text``) without invoice and column."""
    found = lost_values(raw, timestamp_format)
    if malformed is None:
        return found
    nothing = F.lit(None).cast("string")
    return found.union(malformed.select(SHEET, nothing, nothing, "raw_text", F.lit(MALFORMED)))


def reject_summary(found: DataFrame) -> DataFrame:
    """Rejects per sheet, column and reason."""
    return found.groupBy(SHEET, "column_name", "reason").agg(F.count(F.lit(1)).alias("rejected"))
