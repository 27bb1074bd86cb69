"""Fixed-point arithmetic with nine decimal places, rounded half away from zero.

Spark derives a decimal result type from its operand types and silently gives up fractional digits
once 38 digits are exceeded (``decimal(38,9) * decimal(38,9)`` keeps six). The casts below choose
operand types for which that rule lands on ``decimal(38,9)`` with a single rounding. A value too large
for its cast raises under ANSI mode; nothing is truncated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def add(a: Column, b: Column) -> Column:
    return a.cast("decimal(37,9)") + b.cast("decimal(37,9)")


def subtract(a: Column, b: Column) -> Column:
    return a.cast("decimal(37,9)") - b.cast("decimal(37,9)")


def multiply(amount: Column, price: Column) -> Column:
    """amount (up to 18 integer digits) times price (up to 10), as decimal(38,9)."""
    return amount.cast("decimal(27,9)") * price.cast("decimal(19,9)")


def divide(numerator: Column, denominator: Column) -> Column:
    """Quotient as a nine-place decimal, NULL when the denominator is zero."""
    quotient = F.try_divide(numerator.cast("decimal(29,9)"), denominator.cast("decimal(30,9)"))
    return quotient.cast("decimal(32,9)")


def plain_text(number: Column) -> Column:
    """Decimal as text without trailing zeros: 5.00 -> 5, 5.250 -> 5.25."""
    text = number.cast("string")
    return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)
