"""Value coercions for untrusted text, and display formats."""

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Half a step beyond the INT range, where rounding would leave it.
INT_LOW, INT_HIGH = -2147483648.5, 2147483647.5


def number_or_null(text: Column) -> Column:
    """Plain decimal or exponent notation as DOUBLE; anything else is null.

    Keeps out what a cast alone would let through: NaN, infinities, hexadecimal
    and type suffixes such as ``1.5d``. Text that ends in a digit or a point
    needs no pattern match.
    """
    last = F.right(text, F.lit(1))
    plain = last.between(".", "9") & ~F.contains(F.lower(text), F.lit("x"))
    parsed = F.when(plain | text.rlike(NUMBER_TEXT), text).try_cast("double")
    return F.when(F.abs(parsed) < F.lit(float("inf")), parsed)


def timestamp_or_null(text: Column) -> Column:
    """Text that starts with a full date as TIMESTAMP_NTZ; otherwise null.

    A cast alone would take a year, or a year and month, for a date.
    """
    full_date = F.locate("-", F.ltrim(text), 6) > 0
    return F.when(full_date, text).try_cast("timestamp_ntz")


def fits_int(value: Column) -> Column:
    """The value when it rounds to an INT, otherwise null."""
    return F.when((value > INT_LOW) & (value < INT_HIGH), value)


def rounded_int(value: Column) -> Column:
    """Nearest integer, ties away from zero; null outside the INT range."""
    return F.round(fits_int(value)).cast("int")


def fixed(value: Column, unit: str) -> Column:
    """``12.34 A``; ``--`` for null and NaN."""
    text = F.replace(F.format_number(value, 2), F.lit(","), F.lit(""))
    return F.when(
        value.isNotNull() & ~F.isnan(value), F.concat(text, F.lit(f" {unit}"))
    ).otherwise(F.lit("--"))
