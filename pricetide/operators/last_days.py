"""Each product's newest days, kept small, so that a day's signals need no history."""

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.operators.signals import (
    DROP_TO,
    MIN_DISCOUNT,
    WINDOW_ROWS,
    day_column,
    judged,
    signals_on,
)

# A day itself and all that its mean looks back at.
KEEP = WINDOW_ROWS + 1
PRODUCT = ["url", "website"]


def last_days(daily: DataFrame, keep: int = KEEP) -> DataFrame:
    """url, website, days: the newest ``keep`` (date, closing_price) of every product, oldest first.

    Older rows leave map-side, by rank. Rows with a NULL key or date belong to no product's days.
    """
    newest_first = Window.partitionBy(*PRODUCT).orderBy(F.col("date").desc())
    return (
        daily.select(*PRODUCT, "date", "closing_price")
        .dropna(subset=[*PRODUCT, "date"])
        .withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") <= keep)
        .groupBy(*PRODUCT)
        .agg(F.sort_array(F.collect_list(F.struct("date", "closing_price"))).alias("days"))
    )


def merged_days(old: Column, new: Column, keep: int = KEEP) -> Column:
    """Both arrays' days, those of ``new`` in place of equal dates in ``old``, the newest ``keep``."""
    empty = F.array().cast("array<struct<date:date,closing_price:double>>")
    fresh = F.coalesce(new, empty)
    stays = F.filter(
        F.coalesce(old, empty), lambda d: ~F.exists(fresh, lambda n: n["date"] == d["date"])
    )
    both = F.array_sort(F.concat(stays, fresh))
    return F.slice(both, F.greatest(F.lit(1), F.size(both) - keep + 1), keep)


def _mean(closings: Column) -> Column:
    seen = F.filter(closings, lambda c: c.isNotNull())
    total = F.aggregate(seen, F.lit(0.0), lambda a, c: a + c)
    return F.round(F.when(F.size(seen) > 0, total / F.size(seen)), 2)


def signals_from_state(
    day_rows: DataFrame,
    state: DataFrame,
    history: DataFrame,
    as_of: datetime.date | str | None = None,
    drop_to: float = DROP_TO,
    min_discount: float = MIN_DISCOUNT,
    window_rows: int = WINDOW_ROWS,
    keep: int = KEEP,
) -> DataFrame:
    """BUY rows of one day, equal to ``signals_on(history, as_of)``, from ``state`` where that is enough.

    ``state`` is `last_days` of ``history`` with the same ``keep``. It says all about a day if it has
    ``window_rows`` days before it, or if it is not full and so holds every day of the product. Only
    back-dated days of long known products need more: for these products alone ``history`` is read. Whether
    there are any is a job over the day and the state; without them the plan does not hold ``history``.
    """
    day = day_column(as_of)
    today = day_rows.filter(F.col("date") == day)
    earlier = F.filter("_days", lambda d: d["date"] < day)
    enough = (F.size(earlier) >= window_rows) | (F.size("_days") < keep)
    known = today.join(state.select(*PRODUCT, F.col("days").alias("_days")), PRODUCT, "left").withColumn(
        "_enough", F.coalesce(enough, F.lit(False))
    )
    first = F.greatest(F.lit(1), F.size(earlier) - window_rows + 1)
    closings = F.transform(F.slice(earlier, first, window_rows), lambda d: d["closing_price"])
    averaged = known.filter("_enough").withColumn("avg_price_7d", _mean(closings))
    buys = judged(averaged, drop_to, min_discount).filter("signal = 'BUY'").drop("_days", "_enough")
    short = known.filter("NOT _enough").select(*PRODUCT).distinct()
    if short.isEmpty():
        return buys
    whole = history.join(short, PRODUCT, "left_semi")
    return buys.unionByName(signals_on(whole, as_of, drop_to, min_discount, window_rows))
