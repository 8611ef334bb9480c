"""Amounts written as text (P5)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from souqframe.schemas import AMOUNT


def numeric_amount(text: Column | str) -> Column:
    """The number in a formatted amount such as "161,000.00"; 0 where there is none.

    A decimal, so that sums come out the same whatever order the rows are added in.
    """
    column = F.col(text) if isinstance(text, str) else text
    digits = F.translate(column, ", ", "")
    return F.coalesce(digits.try_cast(AMOUNT), F.lit(0).cast(AMOUNT))


def rounded_average(total: Column, rows: Column) -> Column:
    """total / rows to two decimals, halves to the even cent, worked out in decimals."""
    return F.bround(total / rows.cast("decimal(20,0)"), 2).cast("double")
