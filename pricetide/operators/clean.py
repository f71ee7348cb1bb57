"""From scraped text to typed, usable observations."""

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pricetide.functions.prices import parse_price, parse_timestamp


def combine_sources(*frames: DataFrame | None) -> DataFrame:
    """Union by column name, duplicates kept; a source that delivered nothing is ``None``."""
    present = [frame for frame in frames if frame is not None]
    if not present:
        raise ValueError("no source delivered any observation")
    return reduce(DataFrame.unionByName, present)


def clean_prices(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "mrp": parse_price(F.col("mrp")),
            "selling_price": parse_price(F.col("selling_price")),
            "timestamp": parse_timestamp(F.col("timestamp")),
        }
    )


def observe_rejects(df: DataFrame, observation: Observation) -> DataFrame:
    """Count rows and priceless rows while some later action reads ``df``; no job of its own."""
    return df.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("selling_price").isNull()).alias("rejected"),
    )


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a selling price, rows without)."""
    priced = F.col("selling_price").isNotNull()
    return df.filter(priced), df.filter(~priced)


def filter_valid(df: DataFrame) -> DataFrame:
    """In stock, with at least one of the two prices."""
    return df.filter(
        (F.col("status") == "In Stock")
        & F.coalesce(F.col("mrp"), F.col("selling_price")).isNotNull()
    )
