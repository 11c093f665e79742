"""Lenient parsing, rounding and guarded division."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.schemas import MONEY, PRICE


def half_even(column: Column, digits: int) -> Column:
    """Round a double half to even: scale, round to an integer, scale back."""
    scale = float(10**digits)
    return F.rint(column * scale) / scale


def to_money(column: Column) -> Column:
    """Round an exact decimal half to even to two places."""
    return F.bround(column, 2).cast(MONEY)


def to_price(column: Column) -> Column:
    """Decimal price; text that is no number and NaN become null."""
    return column.try_cast(PRICE)


def number(column: Column) -> Column:
    """Lenient double: text that is no number becomes null."""
    return column.try_cast("double")


def to_quantity(column: Column) -> Column:
    """Whole quantity, however it is written (6, 6.0, 6e0). What does not parse,
    and a fraction, counts as missing, whatever format it came from."""
    value = number(column)
    whole = (value == F.floor(value)) & (F.abs(value) < F.lit(2.0**31))
    return F.when(whole, value).cast("int")


def to_customer_id(column: Column) -> Column:
    """Text of a whole-numbered id.

    What does not parse becomes null; a fractional id is an error, because
    cutting it off would merge two customers.
    """
    number = column.try_cast("double")
    return (
        F.when(number.isNull() | F.isnan(number), F.lit(None).cast("string"))
        .when(
            number != F.floor(number),
            F.raise_error(F.concat(F.lit("fractional customer id: "), column.cast("string"))),
        )
        .otherwise(number.cast("bigint").cast("string"))
    )


def to_timestamp(column: Column, text_format: str | None = None) -> Column:
    """Timestamp; text in another shape becomes null. ``text_format`` is the pattern of text."""
    if text_format:
        return F.try_to_timestamp(column.cast("string"), F.lit(text_format)).cast("timestamp_ntz")
    return column.try_cast("timestamp_ntz")


def not_nan(column: Column, data_type: str) -> Column:
    """The column with NaN turned into null where its type can hold one."""
    if data_type in ("double", "float"):
        return F.when(~F.isnan(column), column)
    return column


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division as double; 0 when a side is missing or the divisor is 0."""
    return F.coalesce(
        F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0)
    )
