"""List price carried forward, final price, discount."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.functions.prices import discount_percentage, final_price
from pricetide.operators.clean import clean_prices, filter_valid
from pricetide.operators.hot_keys import HOT_ROWS, find_hot_keys


def forward_fill(
    df: DataFrame, hot_rows: int = HOT_ROWS, counted: DataFrame | None = None
) -> DataFrame:
    """Add ``mrp_ffill`` and ``mrp_final``: the newest known list price of the page so far.

    Rows of one page with equal timestamps see each other's list price, the highest one
    winning for rows that have none; so the result does not depend on row order.

    Ordinary pages need one shuffle by ``url``, which the daily aggregation reuses.
    Pages with more than ``hot_rows`` rows are filled piecewise (`_fill_hot`). They are
    counted in ``counted``, a frame that holds at least these rows and is cheaper to read,
    such as the observations before they were cleaned and filtered.
    """
    hot = find_hot_keys(df if counted is None else counted, "url", hot_rows)
    if hot is None:
        return _fill_window(df)
    ordinary, crowded = hot.split(df)
    return _fill_window(ordinary).unionByName(_fill_hot(crowded))


def _fill_window(df: DataFrame) -> DataFrame:
    so_far = (
        Window.partitionBy("url")
        .orderBy("timestamp", F.col("mrp").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    known = F.last("mrp", ignorenulls=True).over(so_far)
    return df.withColumns({"mrp_ffill": known, "mrp_final": known})


def _fill_hot(df: DataFrame) -> DataFrame:
    """Fill pages whose history is too long for one task.

    1. One point per (url, timestamp): copies and ties collapse map-side.
    2. Fill within (url, minute): at most 6*10^7 distinct microseconds per task group.
    3. Carry each minute's last price into the following minutes: one row per minute.
    4. Only rows without a list price look their point up, an equi-join on
       (url, timestamp) whose other side is unique, so AQE may split any skewed part.
    """
    instant = df.groupBy("url", "timestamp").agg(F.max("mrp").alias("_seen"))
    points = instant.withColumn("_minute", F.date_trunc("minute", "timestamp"))
    within = (
        Window.partitionBy("url", "_minute")
        .orderBy("timestamp")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # Rows without a timestamp come first; minutes without a price have no newest one.
    position = F.coalesce(F.unix_micros("timestamp"), F.lit(-(2**63)))
    newest = F.max_by("_seen", F.when(F.col("_seen").isNotNull(), position))
    carried = (
        points.groupBy(F.col("url").alias("_c_url"), F.col("_minute").alias("_c_minute"))
        .agg(newest.alias("_newest"))
        .withColumn(
            "_carried",
            F.last("_newest", ignorenulls=True).over(
                Window.partitionBy("_c_url")
                .orderBy("_c_minute")
                .rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
    )
    filled = (
        points.withColumn("_inside", F.last("_seen", ignorenulls=True).over(within))
        .join(
            carried,
            F.col("url").eqNullSafe(F.col("_c_url"))
            & F.col("_minute").eqNullSafe(F.col("_c_minute")),
        )
        .select(
            F.col("url").alias("_p_url"),
            F.col("timestamp").alias("_p_timestamp"),
            F.coalesce("_inside", "_carried").alias("_filled"),
        )
    )
    known = df.filter(F.col("mrp").isNotNull()).withColumns(
        {"mrp_ffill": F.col("mrp"), "mrp_final": F.col("mrp")}
    )
    unknown = (
        df.filter(F.col("mrp").isNull())
        .join(
            filled,
            F.col("url").eqNullSafe(F.col("_p_url"))
            & F.col("timestamp").eqNullSafe(F.col("_p_timestamp")),
            "left",
        )
        .withColumns({"mrp_ffill": F.col("_filled"), "mrp_final": F.col("_filled")})
        .select(*known.columns)
    )
    return known.unionByName(unknown)


def add_final_price(df: DataFrame) -> DataFrame:
    return df.withColumn("final_price", final_price(F.col("selling_price"), F.col("mrp_final")))


def add_discount(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "Discount_Percentage", discount_percentage(F.col("mrp_final"), F.col("final_price"))
    )


def enrich(
    df: DataFrame, hot_rows: int = HOT_ROWS, counted: DataFrame | None = None
) -> DataFrame:
    """Cleaned observations to enriched ones; out-of-stock rows never supply a list price."""
    return (
        df.transform(filter_valid)
        .transform(forward_fill, hot_rows, df if counted is None else counted)
        .transform(add_final_price)
        .transform(add_discount)
    )


def process(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Scraped text to enriched observations in one go."""
    return df.transform(clean_prices).transform(enrich, hot_rows, df)
