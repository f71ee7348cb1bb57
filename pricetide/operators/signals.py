"""Price-drop signals over daily rows, and the alerts made of them."""

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.schema import PAYLOAD_FIELDS

# The buy rule.
WINDOW_ROWS = 7
DROP_TO = 0.9
MIN_DISCOUNT = 10


def _product() -> list[str]:
    return ["url", "website"]


def trailing_avg(daily: DataFrame, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Mean closing price of the previous ``window_rows`` observed days, today excluded.

    Observed days, not calendar days. A window partition holds one row per day of one
    product, so its size is bounded by the calendar however often a page is scraped.
    """
    previous = (
        Window.partitionBy(*_product()).orderBy("date").rowsBetween(-window_rows, -1)
    )
    return daily.withColumn("avg_price_7d", F.round(F.avg("closing_price").over(previous), 2))


def signals(
    daily: DataFrame,
    drop_to: float = DROP_TO,
    min_discount: float = MIN_DISCOUNT,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Add ``avg_price_7d`` and ``signal``: BUY on a price drop or on a deep discount."""
    return judged(trailing_avg(daily, window_rows), drop_to, min_discount)


def judged(
    averaged: DataFrame, drop_to: float = DROP_TO, min_discount: float = MIN_DISCOUNT
) -> DataFrame:
    """Add ``signal`` to rows that have their ``avg_price_7d``."""
    dropped = F.col("closing_price") <= F.col("avg_price_7d") * drop_to
    discounted = F.col("avg_discount_day") >= min_discount
    return averaged.withColumn("signal", F.when(dropped | discounted, "BUY").otherwise("NO_BUY"))


def day_column(as_of: datetime.date | str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def buy_alerts(signalled: DataFrame, as_of: datetime.date | str | None = None) -> DataFrame:
    """BUY rows of one day, by default today."""
    return signalled.filter((F.col("date") == day_column(as_of)) & (F.col("signal") == "BUY"))


def recent_days(
    daily: DataFrame,
    as_of: datetime.date | str | None = None,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """The newest days up to ``as_of`` of each product seen on that day: all that its signals look at.

    The date bound prunes later partitions. A product without a row on the day cannot alert, so only
    rows of the day's products take part; earlier partitions are still read, with no
    look-back limit, because a product may pause for any time. NULL products belong to no day.
    """
    day = day_column(as_of)
    seen = daily.filter(F.col("date") == day).select(*_product()).distinct()
    newest_first = Window.partitionBy(*_product()).orderBy(F.col("date").desc())
    return (
        daily.filter(F.col("date") <= day)
        .join(seen, _product(), "left_semi")
        .withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") <= window_rows + 1)
        .drop("_rank")
    )


def signals_on(
    daily: DataFrame,
    as_of: datetime.date | str | None = None,
    drop_to: float = DROP_TO,
    min_discount: float = MIN_DISCOUNT,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """BUY rows of one day, equal to ``buy_alerts(signals(daily), as_of)`` but pruned."""
    recent = recent_days(daily, as_of, window_rows)
    return buy_alerts(signals(recent, drop_to, min_discount, window_rows), as_of)


def alert_payload(alerts: DataFrame) -> DataFrame:
    """One JSON document per BUY row in column ``value``; the date as text, NULLs written."""
    fields = [
        F.col(name).cast("string").alias(name) if name == "date" else F.col(name)
        for name in PAYLOAD_FIELDS
    ]
    return alerts.filter(F.col("signal") == "BUY").select(
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value")
    )
