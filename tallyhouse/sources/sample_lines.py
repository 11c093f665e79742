"""Retail lines out of order, line, customer, nation and part tables.

The rules put every kind of row into the result: cancelled invoices, returns,
zero and negative prices, missing customers and descriptions, untidy text and
exact copies, missing and empty values, tabs and no-break spaces. Every order line is used; the remainders below only decide what
a line looks like.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.constants import HOME_MARKET, SHEET
from tallyhouse.schemas import MONEY, RAW


def retail_lines(spark: SparkSession, folder: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    lines = table("lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    )
    orders = table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table("customer").select("c_custkey", "c_nationkey")
    nations = table("nation").select("n_nationkey", "n_name", "n_regionkey")
    parts = table("part").select("p_partkey", "p_name")

    # Customers and their nations meet the orders before the lines do, so the
    # widest table is shuffled as few times as possible.
    buyers = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    headers = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    joined = lines.join(headers, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )

    order, part, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    digits = (F.lit(500000) + order).cast("string")
    cancelled = order % 13 == 0

    def at(remainder: int, place: int) -> Column:
        """A few lines: one place of every so many orders."""
        return (order % remainder == 0) & (line == place)

    nothing = F.lit(None).cast("string")
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F") & (line == 1)
    number = F.when((order % 65 == 0) & (line == 3), nothing).otherwise(
        F.when(cancelled, F.concat(F.lit("C"), digits)).otherwise(digits)
    )
    quantity = (
        F.when(at(311, 2), F.lit(None).cast("double"))
        .when(cancelled | returned, -F.col("l_quantity"))
        .when((order % 211 == 0) & (line == 2), F.lit(0.0))
        .otherwise(F.col("l_quantity"))
    )
    price = (
        F.when(at(313, 3), F.lit(None).cast("double"))
        .when((order % 997 == 0) & (line == 3), -F.col("l_extendedprice"))
        .when((F.col("l_discount") == 0) & (F.col("l_tax") == 0), F.lit(0.0))
        .otherwise(F.col("l_extendedprice"))
    )
    description = (
        F.when((line == 7) & (part % 5 == 0), F.lit(None).cast("string"))
        .when(at(367, 1), "")
        .when(at(359, 4), F.concat(F.lit("\t"), F.col("p_name"), F.lit("\u00a0\u00a0x\t")))
        .when(part % 250 == 0, "Postage")
        .when(part % 250 == 1, " Manual ")
        .when(line == 6, F.upper("p_name"))
        .otherwise(F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("  ")), F.lit(" ")))
    )
    country = (
        F.when(at(317, 1), nothing)
        .when(at(331, 1), "")
        .when(at(337, 2), F.concat(F.lit("\u00a0"), F.col("n_name"), F.lit("\t")))
        .when(order % 101 == 0, "NATION_24")
        .when(F.col("n_regionkey") == 0, HOME_MARKET)
        .otherwise(F.col("n_name"))
    )
    hours = F.make_dt_interval(F.lit(0), (F.lit(8) + order % 12).cast("int"))
    # Second copies come from the same joined row rather than a second join.
    copies = F.explode(F.sequence(F.lit(0), (order % 83 == 0).cast("int")))

    columns = {
        "Invoice": number,
        "StockCode": F.when(at(347, 2), nothing)
        .when(at(349, 2), "")
        .otherwise(F.concat(F.lit(" "), (F.lit(10000) + part).cast("string"))),
        "Description": description,
        "Quantity": quantity.cast("int"),
        "InvoiceDate": F.when(at(307, 1), F.lit(None)).otherwise(F.col("o_orderdate") + hours),
        "Price": price.cast(MONEY),
        "Customer ID": F.when(order % 9 != 0, F.col("o_custkey").cast("double")),
        "Country": country,
        "source_sheet": F.concat(F.lit("Year "), F.year("o_orderdate").cast("string")),
    }
    return joined.select(
        *[columns[field.name].cast(field.dataType).alias(field.name) for field in RAW],
        copies.alias("copy"),
    ).drop("copy")


def write_sample_workbook(lines: DataFrame, path: str) -> None:
    """The lines of :func:`retail_lines` as CSV sheets with dotted names.

    A sheet is a folder with files from every task that has rows of it.
    Some values are written in other ways or cannot be read, descriptions have
    line breaks, and the sheets of even years lack the country. In other sheets every fifth
    quantity is in files with the columns the other way round, and lines without a
    description are in files without that column.
    """
    quantity, moment = F.col("Quantity"), F.col("InvoiceDate")
    text = quantity.cast("string")
    sheets = lines.withColumns({
        "Quantity": F.when(quantity % 7 == 0, F.concat(text, F.lit(".0")))
        .when(quantity % 11 == 0, F.concat(text, F.lit(".5")))
        .when(quantity % 13 == 0, "many")
        .otherwise(text),
        "InvoiceDate": F.when(quantity == 17, "soon").otherwise(F.date_format(moment, "yyyy-MM-dd HH:mm:ss")),
        "Description": F.when(quantity % 3 == 0, F.concat("Description", F.lit('\n"new"'))).otherwise(F.col("Description")),
        SHEET: F.concat(F.lit("lines.v1."), F.coalesce(F.year(moment).cast("string"), F.lit("none"))),
        "even": F.coalesce(F.year(moment) % 2 == 0, F.lit(False)),
        "turned": F.coalesce(quantity % 5 == 0, F.lit(False)),
    })
    turned, bare = F.col("turned"), F.col("Description").isNull()
    names = [name for name in RAW.names if name != SHEET]
    parts = [
        (F.col("even"), [name for name in names if name != "Country"]),
        (~F.col("even") & bare, [name for name in names if name != "Description"]),
        (~F.col("even") & ~bare & turned, names[::-1]),
        (~F.col("even") & ~bare & ~turned, names),
    ]
    options = {"header": "true", "quote": '"', "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}
    for i, (rows, columns) in enumerate(parts):
        part = sheets.where(rows).select(*[f"`{name}`" for name in columns], SHEET)
        part.write.mode("append" if i else "overwrite").partitionBy(SHEET).options(**options).csv(path)
