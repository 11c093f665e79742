"""Text normalisation with the white-space rules of Python strings."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.constants import WHITE_SPACE

# Text that a quick look finds tidy skips the costly expression: most text is.
_NOT_PLAIN = "[^!-~ ]"
_SPACES = r"(?U)[\s\x1c-\x1f]+"


def _visible(code: Column) -> Column:
    """The code point is a printable ASCII character other than the space."""
    return (code > 32) & (code < 127)


def strip(column: Column) -> Column:
    """Remove white space, including tabs and Unicode spaces, at both ends."""
    text = column.cast("string")
    trimmed = F.trim(text)
    first, last = F.ascii(trimmed), F.ascii(F.substring(trimmed, -1, 1))
    return F.when(_visible(first) & _visible(last), trimmed).otherwise(
        F.btrim(text, F.lit(WHITE_SPACE))
    )


def tidy(column: Column) -> Column:
    """:func:`strip`, and every run of white space inside becomes one space."""
    text = column.cast("string")
    trimmed = F.trim(text)
    return (
        F.when(trimmed.rlike(_NOT_PLAIN), F.regexp_replace(F.btrim(text, F.lit(WHITE_SPACE)), _SPACES, " "))
        .when(F.contains(trimmed, F.lit("  ")), F.regexp_replace(trimmed, "  +", " "))
        .otherwise(trimmed)
    )


def is_cancellation(invoice: Column) -> Column:
    """True when the invoice number starts with C or c; false when missing."""
    return F.coalesce(F.upper(invoice.cast("string")).startswith("C"), F.lit(False))


def is_blank(column: Column) -> Column:
    """True for text that is empty after stripping; null stays null."""
    return strip(column) == ""
