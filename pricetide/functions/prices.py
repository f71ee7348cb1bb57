"""Scalar price rules, all plain Spark expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a price text may carry besides its number.
PRICE_NOISE = "₹,"


def parse_price(price: Column) -> Column:
    """'₹79,900' -> 79900.0; anything that is no number after that is NULL.

    Numeric input passes through its text form. ``try_cast`` keeps bad text from
    failing the job under ANSI mode.
    """
    return F.trim(F.translate(price.cast("string"), PRICE_NOISE, "")).try_cast("double")


def parse_timestamp(text: Column) -> Column:
    return text.try_cast("timestamp")


def final_price(selling_price: Column, list_price: Column) -> Column:
    return F.coalesce(selling_price, list_price)


def discount_percentage(list_price: Column, price: Column) -> Column:
    """Percent below list price, two decimals; NULL without a list price or with a zero one."""
    return F.round(F.try_divide(list_price - price, list_price) * 100, 2)
