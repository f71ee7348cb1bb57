"""Checked queries: each runs on the whole test tables and has a SQL twin."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetide.functions.prices import discount_percentage, parse_price, parse_timestamp
from pricetide.operators.clean import (
    clean_prices,
    combine_sources,
    filter_valid,
    split_valid,
)
from pricetide.operators.daily import (
    daily_metrics,
    daily_partials,
    daily_prices,
    daily_prices_joined,
    ranked_closing_rows,
)
from pricetide.operators.enrich import add_final_price, enrich, forward_fill, process
from pricetide.operators.quality import Checks, duplicate_keys
from pricetide.operators.signals import (
    alert_payload,
    buy_alerts,
    signals,
    signals_on,
    trailing_avg,
)
from pricetide.plans.run import run_from_pages, run_pipeline
from pricetide.schema import ALERT, CLEAN, DAILY, DAILY_KEYS, ENRICHED, PAYLOAD_FIELDS, RAW
from pricetide.sources.batches import add_partials, append_raw_once, merged_daily, read_raw_once
from pricetide.sources.observations import observations, shop_a_pages, shop_b_pages
from pricetide.sources.pages import (
    FieldRule,
    extract_fields,
    extract_shop_a,
    extract_shop_b,
)
from pricetide.sources.paths import layer_path, scratch_path, stage
from pricetide.sources.tables import (
    append_raw,
    incremental_append,
    read_raw,
    read_raw_lines,
    read_table,
    upsert,
    write_alerts,
)
from pricetide.streaming.loads import load_new_files

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

LAST_DAY = "2024-01-30"
# Hot-key handling is exercised by calling every page above this size crowded.
FEW_ROWS = 20


def checked(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL that must give the same rows, under ``name``."""

    def register(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, averages to nine decimals: the same in every engine."""

    def shown(field: T.StructField) -> F.Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif field.name.startswith("avg_"):
            column = F.round(column, 9)
        return column.alias(field.name)

    return df.select(*[shown(field) for field in df.schema])


# ---------------------------------------------------------------- SQL building blocks


def _rounded(expression: str, places: int) -> str:
    """Spark's ``round`` of a double: half up on its shortest decimal text."""
    text = f"CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38, 18))"
    return f"CAST(round({text}, {places}) AS DOUBLE)"


def _shown(name: str) -> str:
    if name in ("timestamp", "last_scrape_time"):
        return f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"
    if name == "date":
        return f"CAST({name} AS VARCHAR) AS {name}"
    if name.startswith("avg_"):
        return f"{_rounded(name, 9)} AS {name}"
    return name


def _select(names: list[str], source: str) -> str:
    return f"SELECT {', '.join(_shown(name) for name in names)} FROM {source}"


_RUPEES = "'₹' || format('{{:,}}', CAST({} AS BIGINT))"
_PRICE = "floor(value * 100) + 100"

RAW_SQL = f"""
    SELECT 'item-' || (user_id % 50) AS product_name,
           CASE WHEN event_id % 11 <> 0 THEN {_RUPEES.format(_PRICE)} END AS selling_price,
           CASE WHEN event_type = 'error' THEN 'Out of Stock' ELSE 'In Stock' END AS status,
           CASE WHEN event_id % 5 = 0 THEN NULL
                WHEN event_id % 7 = 0 THEN 'MRP ₹500'
                ELSE {_RUPEES.format(_PRICE + " + (user_id % 40) * 100")} END AS mrp,
           'Brand#' || (user_id % 10) AS brand,
           CASE WHEN event_id % 2 = 0 THEN 'shop-a' ELSE 'shop-b' END AS website,
           ts AS "timestamp",
           'https://shop/p/' || user_id AS url
    FROM events"""


def _parsed(column: str) -> str:
    return f"TRY_CAST(trim(regexp_replace({column}, '[₹,]', '', 'g')) AS DOUBLE)"


CLEAN_SQL = f"""
    SELECT product_name, {_parsed("selling_price")} AS selling_price, status,
           {_parsed("mrp")} AS mrp, brand, website, "timestamp", url
    FROM ({RAW_SQL})"""

PRICED_SQL = f"SELECT * FROM ({CLEAN_SQL}) WHERE selling_price IS NOT NULL"


def _enriched(source: str) -> str:
    return f"""
    SELECT *, {_rounded("(mrp_final - final_price) / nullif(mrp_final, 0) * 100", 2)}
                  AS Discount_Percentage
    FROM (SELECT *, mrp_ffill AS mrp_final, coalesce(selling_price, mrp_ffill) AS final_price
          FROM (SELECT *, last_value(mrp IGNORE NULLS) OVER (
                              PARTITION BY url ORDER BY "timestamp"
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mrp_ffill
                FROM ({source})
                WHERE status = 'In Stock' AND (mrp IS NOT NULL OR selling_price IS NOT NULL)))"""


def _daily(source: str) -> str:
    return f"""
    SELECT url, website, CAST("timestamp" AS DATE) AS date,
           min(final_price) AS min_price_day, max(final_price) AS max_price_day,
           avg(final_price) AS avg_price_day, avg(Discount_Percentage) AS avg_discount_day,
           count(*) AS num_scrapes_day,
           arg_min_null(brand, "timestamp") AS brand,
           arg_min_null(product_name, "timestamp") AS product_name,
           arg_min_null(mrp_final, "timestamp") AS mrp_final,
           arg_max_null(final_price, "timestamp") AS closing_price,
           max("timestamp") AS last_scrape_time,
           arg_max_null(status, "timestamp") AS status
    FROM ({_enriched(source)})
    GROUP BY ALL"""


def _signals(daily: str) -> str:
    return f"""
    SELECT *, CASE WHEN closing_price <= avg_price_7d * 0.9::DOUBLE OR avg_discount_day >= 10
                   THEN 'BUY' ELSE 'NO_BUY' END AS signal
    FROM (SELECT *, {_rounded("previous_mean", 2)} AS avg_price_7d
          FROM (SELECT *, avg(closing_price) OVER (
                              PARTITION BY url, website ORDER BY date
                              ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS previous_mean
                FROM ({daily})))"""


def _buys(daily: str, day: str = LAST_DAY) -> str:
    return f"""
    SELECT * FROM ({_signals(daily)}) WHERE date = DATE '{day}' AND signal = 'BUY'"""


def _from(source: str, where: str) -> str:
    return f"SELECT * FROM ({source}) WHERE {where}"


DAILY_SQL = _daily(PRICED_SQL)
RAW_NAMES, ENRICHED_NAMES = RAW.names, ENRICHED.names
DAILY_NAMES, ALERT_NAMES = DAILY.names, ALERT.names


# ---------------------------------------------------------------- frames shared by queries


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_prices(observations(spark, sf_dir))


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_valid(_clean(spark, sf_dir))[0]


def _enriched_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(_priced(spark, sf_dir), counted=observations(spark, sf_dir))


def _daily_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_prices(_enriched_frame(spark, sf_dir))


def _key() -> list[str]:
    return ["url", "website", "timestamp"]


# ---------------------------------------------------------------- scalar rules and filters


@checked(
    "parse_price",
    f"""SELECT url, website, mrp AS mrp_text, selling_price AS selling_text,
               {_parsed("mrp")} AS mrp, {_parsed("selling_price")} AS selling_price
        FROM ({RAW_SQL})""",
)
def parse_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).select(
        "url",
        "website",
        F.col("mrp").alias("mrp_text"),
        F.col("selling_price").alias("selling_text"),
        parse_price(F.col("mrp")).alias("mrp"),
        parse_price(F.col("selling_price")).alias("selling_price"),
    )


@checked(
    "parse_timestamp",
    f"""SELECT url, website, strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f') AS "timestamp",
               CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS date,
               TRUE AS broken_is_null
        FROM ({RAW_SQL})""",
)
def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps, their dates, and NULL for a text whose month and day are swapped to 99."""
    stamp = parse_timestamp(F.col("timestamp"))
    broken = parse_timestamp(F.regexp_replace("timestamp", "-[0-9]{2}-", "-99-"))
    return comparable(
        observations(spark, sf_dir).select(
            "url",
            "website",
            stamp.alias("timestamp"),
            F.to_date(stamp).alias("date"),
            broken.isNull().alias("broken_is_null"),
        )
    )


@checked(
    "clean_prices",
    _select(RAW_NAMES, f"({CLEAN_SQL})"),
)
def clean_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_clean(spark, sf_dir))


@checked(
    "split_valid",
    f"""SELECT *, 'valid' AS part FROM ({_select(RAW_NAMES, f"({PRICED_SQL})")})
        UNION ALL
        SELECT *, 'rejected' AS part
        FROM ({_select(RAW_NAMES, f"({CLEAN_SQL}) WHERE selling_price IS NULL")})""",
)
def split_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, rejected = split_valid(_clean(spark, sf_dir))
    return comparable(
        valid.withColumn("part", F.lit("valid")).unionByName(
            rejected.withColumn("part", F.lit("rejected"))
        )
    )


@checked(
    "reject_count",
    f"""SELECT website, count(*) AS "rows",
               count(*) FILTER (WHERE selling_price IS NULL) AS rejected
        FROM ({CLEAN_SQL}) GROUP BY website""",
)
def reject_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _clean(spark, sf_dir)
        .groupBy("website")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("selling_price").isNull()).alias("rejected"),
        )
    )


@checked(
    "valid_filter",
    _select(
        RAW_NAMES,
        f"({CLEAN_SQL}) WHERE status = 'In Stock'"
        " AND (mrp IS NOT NULL OR selling_price IS NOT NULL)",
    ),
)
def valid_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(filter_valid(_clean(spark, sf_dir)))


@checked(
    "combine_sources",
    _select(RAW_NAMES, f"({CLEAN_SQL})"),
)
def combined_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two shops with columns in different order, and a third that delivered nothing."""
    everything = observations(spark, sf_dir)
    shop_a = everything.filter(F.col("website") == "shop-a")
    shop_b = everything.filter(F.col("website") == "shop-b").select(*sorted(RAW_NAMES))
    return comparable(clean_prices(combine_sources(shop_a, None, shop_b)))


# ---------------------------------------------------------------- enrichment

FILLED_NAMES = [*_key(), "mrp", "mrp_ffill", "mrp_final"]


@checked(
    "ffill_list_price",
    _select(FILLED_NAMES, f"({_enriched(CLEAN_SQL)})"),
)
def ffill_list_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = forward_fill(filter_valid(_clean(spark, sf_dir)))
    return comparable(filled.select(*FILLED_NAMES))


@checked(
    "ffill_hot_pages",
    _select(FILLED_NAMES, f"({_enriched(CLEAN_SQL)})"),
)
def ffill_hot_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with most pages taken for too crowded and filled piecewise."""
    filled = forward_fill(filter_valid(_clean(spark, sf_dir)), hot_rows=FEW_ROWS)
    return comparable(filled.select(*FILLED_NAMES))


FINAL_NAMES = [*_key(), "selling_price", "mrp_final", "final_price"]


@checked(
    "final_price",
    _select(FINAL_NAMES, f"({_enriched(CLEAN_SQL)})"),
)
def final_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = add_final_price(forward_fill(filter_valid(_clean(spark, sf_dir))))
    return comparable(priced.select(*FINAL_NAMES))


@checked(
    "discount",
    f"""SELECT {", ".join(_shown(n) for n in _key())}, list_price, selling_price,
               {_rounded("(list_price - selling_price) / nullif(list_price, 0) * 100", 2)}
                   AS Discount_Percentage
        FROM (SELECT *, CASE WHEN status = 'In Stock' THEN mrp ELSE 0 END AS list_price
              FROM ({CLEAN_SQL}))""",
)
def discounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discount against the scraped list price, taken as zero when out of stock."""
    list_price = F.when(F.col("status") == "In Stock", F.col("mrp")).otherwise(F.lit(0.0))
    return comparable(
        _clean(spark, sf_dir)
        .withColumn("list_price", list_price)
        .select(
            *_key(),
            "list_price",
            "selling_price",
            discount_percentage(F.col("list_price"), F.col("selling_price")).alias(
                "Discount_Percentage"
            ),
        )
    )


@checked(
    "enrich_all",
    _select(ENRICHED_NAMES, f"({_enriched(CLEAN_SQL)})"),
)
def enrich_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(process(observations(spark, sf_dir)))


# ---------------------------------------------------------------- daily rows

CLOSING_NAMES = ["closing_price", "last_scrape_time", "status"]
METRIC_NAMES = [name for name in DAILY_NAMES if name not in CLOSING_NAMES]


@checked(
    "daily_metrics",
    _select(METRIC_NAMES, f"({DAILY_SQL})"),
)
def metrics_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(daily_metrics(_enriched_frame(spark, sf_dir)))


@checked(
    "latest_per_day",
    _select([*DAILY_KEYS, *CLOSING_NAMES], f"({DAILY_SQL})"),
)
def closing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(ranked_closing_rows(_enriched_frame(spark, sf_dir)))


@checked(
    "daily_join_form",
    _select(DAILY_NAMES, f"({DAILY_SQL})"),
)
def daily_join_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(daily_prices_joined(_enriched_frame(spark, sf_dir)))


@checked(
    "daily_one_pass",
    _select(DAILY_NAMES, f"({DAILY_SQL})"),
)
def daily_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_daily_frame(spark, sf_dir))


@checked(
    "daily_hot_pages",
    _select(DAILY_NAMES, f"({DAILY_SQL})"),
)
def daily_hot_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows after the piecewise fill of crowded pages."""
    enriched = enrich(_priced(spark, sf_dir), hot_rows=FEW_ROWS)
    return comparable(daily_prices(enriched))


# ---------------------------------------------------------------- signals and alerts


@checked(
    "trailing_avg",
    _select([*DAILY_KEYS, "closing_price", "avg_price_7d"], f"({_signals(DAILY_SQL)})"),
)
def trailing_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    averaged = trailing_avg(_daily_frame(spark, sf_dir))
    return comparable(averaged.select(*DAILY_KEYS, "closing_price", "avg_price_7d"))


@checked(
    "signals",
    _select(ALERT_NAMES, f"({_signals(DAILY_SQL)})"),
)
def all_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(signals(_daily_frame(spark, sf_dir)))


@checked(
    "buy_alerts",
    _select(ALERT_NAMES, f"({_buys(DAILY_SQL)})"),
)
def day_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(buy_alerts(signals(_daily_frame(spark, sf_dir)), LAST_DAY))


@checked(
    "signals_pruned",
    _select(ALERT_NAMES, f"({_buys(DAILY_SQL)})"),
)
def day_alerts_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(signals_on(_daily_frame(spark, sf_dir), LAST_DAY))


@checked(
    "alert_payload",
    f"""SELECT {", ".join(n if n != "avg_discount_day" else _shown(n) for n in PAYLOAD_FIELDS
                           if n != "date")}, CAST(date AS VARCHAR) AS date
        FROM ({_signals(DAILY_SQL)}) WHERE signal = 'BUY'""",
)
def alert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of every BUY row, read back from their JSON."""
    alerts = signals(_daily_frame(spark, sf_dir))
    schema = T.StructType(
        [
            T.StructField(n, T.StringType() if n == "date" else ALERT[n].dataType)
            for n in PAYLOAD_FIELDS
        ]
    )
    parsed = alert_payload(alerts).select(F.from_json("value", schema).alias("payload"))
    return comparable(parsed.select("payload.*"))


# ---------------------------------------------------------------- tables

OVERLAP_FROM, OVERLAP_TO = "2024-01-15", "2024-01-20"
_FIRST_SQL = _from(PRICED_SQL, f"\"timestamp\" < DATE '{OVERLAP_TO}' + 1")
_SECOND_SQL = _from(
    PRICED_SQL,
    f"""("timestamp" >= DATE '{OVERLAP_FROM}' AND hour("timestamp") >= 12)
        OR "timestamp" >= DATE '{OVERLAP_TO}' + 1""",
)


def _batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Daily rows up to the 20th; then the afternoons from the 15th and all later days."""
    everything = observations(spark, sf_dir)
    priced, stamp = _priced(spark, sf_dir), F.col("timestamp")
    after_overlap = F.to_date(stamp) > F.lit(OVERLAP_TO).cast("date")
    afternoon = (F.to_date(stamp) >= F.lit(OVERLAP_FROM).cast("date")) & (F.hour(stamp) >= 12)
    first = priced.filter(~after_overlap)
    second = priced.filter(afternoon | after_overlap)
    first, second = (enrich(batch, counted=everything) for batch in (first, second))
    return daily_prices(first), daily_prices(second)


_SAME_KEY = "s.url = t.url AND s.website = t.website AND s.date = t.date"
_UPSERT_SQL = f"""
    WITH t AS ({_daily(_FIRST_SQL)}), s AS ({_daily(_SECOND_SQL)}),
         merged AS (SELECT * FROM s UNION ALL
                    SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {_SAME_KEY}))
    {_select(DAILY_NAMES, "merged")}"""


@checked(
    "upsert_all",
    _UPSERT_SQL)
def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = layer_path(scratch_path(spark), "processed")
    for batch in _batches(spark, sf_dir):
        upsert(batch, path, check_unique=True)
    return comparable(read_table(spark, path).select(*DAILY_NAMES))


@checked(
    "upsert_twice",
    _UPSERT_SQL)
def upsert_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = layer_path(scratch_path(spark), "processed")
    first, second = _batches(spark, sf_dir)
    for batch in (first, second, second):
        upsert(batch, path)
    return comparable(read_table(spark, path).select(*DAILY_NAMES))


@checked(
    "upsert_columns",
    f"""WITH t AS ({_signals(_daily(_FIRST_SQL))}), s AS ({_signals(_daily(_SECOND_SQL))}),
             merged AS (
        SELECT coalesce(t.url, s.url) AS url, coalesce(t.website, s.website) AS website,
               coalesce(t.date, s.date) AS date,
               {", ".join(
                   f"CASE WHEN t.url IS NOT NULL THEN t.{n} ELSE s.{n} END AS {n}"
                   for n in ("brand", "product_name", "mrp_final"))},
               {", ".join(
                   f"CASE WHEN s.url IS NOT NULL THEN s.{n} ELSE t.{n} END AS {n}"
                   for n in ALERT_NAMES
                   if n not in (*DAILY_KEYS, "brand", "product_name", "mrp_final"))}
        FROM t FULL JOIN s ON {_SAME_KEY})
        {_select(ALERT_NAMES, "merged")}""",
)
def upsert_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of two runs: a repeated one keeps brand, product name and list price."""
    path = layer_path(scratch_path(spark), "gold_alerts")
    for batch in _batches(spark, sf_dir):
        write_alerts(signals(batch), path)
    return comparable(read_table(spark, path).select(*ALERT_NAMES))


@checked(
    "upsert_new_columns",
    f"""WITH t AS ({_daily(_FIRST_SQL)}), s AS ({_daily(_SECOND_SQL)}),
             merged AS (
        SELECT s.*, CASE WHEN t.url IS NOT NULL THEN 'first' END AS note, 'again' AS extra
        FROM s LEFT JOIN t ON {_SAME_KEY}
        UNION ALL
        SELECT t.*, 'first' AS note, NULL AS extra
        FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {_SAME_KEY}))
        {_select([*DAILY_NAMES, "note", "extra"], "merged")}""",
)
def upsert_new_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A narrower batch after a wide one, then one with a column of its own."""
    path = layer_path(scratch_path(spark), "processed")
    first, second = _batches(spark, sf_dir)
    upsert(first.withColumn("note", F.lit("first")), path)
    upsert(second, path)
    upsert(second.withColumn("extra", F.lit("again")), path)
    stored = read_table(spark, path, merge_schema=True)
    return comparable(stored.select(*DAILY_NAMES, "note", "extra"))


@checked(
    "alerts_first_write",
    _select(ALERT_NAMES, f"({_signals(_daily(_FIRST_SQL))})"),
)
def alerts_first_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first batch with an older copy of every alert and without counts of single scrapes."""
    path = layer_path(scratch_path(spark), "gold_alerts")
    alerts = signals(_batches(spark, sf_dir)[0])
    older = alerts.withColumns(
        {
            "last_scrape_time": F.col("last_scrape_time") - F.expr("INTERVAL 1 HOUR"),
            "closing_price": F.lit(0.0),
        }
    )
    counts = F.when(F.col("num_scrapes_day") > 1, F.col("num_scrapes_day"))
    write_alerts(alerts.withColumn("num_scrapes_day", counts).union(older), path)
    return comparable(read_table(spark, path).select(*ALERT_NAMES))


@checked(
    "upsert_merged",
    _select(DAILY_NAMES, f"({DAILY_SQL})"),
)
def upsert_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mornings, afternoons, and the mornings delivered again: as daily rows of whole days."""
    path = layer_path(scratch_path(spark), "partials")
    enriched = stage(_enriched_frame(spark, sf_dir))
    halves = {half: enriched.filter((F.hour("timestamp") >= 12) == late) for half, late in (("am", False), ("pm", True))}
    for batch in ("am", "pm", "am"):
        add_partials(daily_partials(halves[batch]), path, batch)
    return comparable(merged_daily(spark, path).select(*DAILY_NAMES))


def _two_loads(first: DataFrame, second: DataFrame) -> DataFrame:
    spark, path = first.sparkSession, scratch_path(first.sparkSession)
    for source in (first, second, second):
        incremental_append(source, path)
    return comparable(read_table(spark, path, merge_schema=True))


@checked(
    "incremental_append",
    f"""SELECT *, CASE WHEN "timestamp" >= '2024-01-16' THEN 'second' END AS batch
        FROM ({_select(RAW_NAMES, f"({PRICED_SQL})")})""",
)
def incremental_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the month, then everything, which adds the newer half and one column."""
    priced = _priced(spark, sf_dir)
    first = priced.filter(F.to_date("timestamp") < F.lit("2024-01-16").cast("date"))
    return _two_loads(first, priced.withColumn("batch", F.lit("second")))


@checked(
    "incremental_late_row",
    _select(RAW_NAMES, f"({PRICED_SQL}) WHERE \"timestamp\" >= DATE '2024-01-10'"),
)
def incremental_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later days first: what comes after them but is older stays out."""
    priced = _priced(spark, sf_dir)
    first = priced.filter(F.to_date("timestamp") >= F.lit("2024-01-10").cast("date"))
    return _two_loads(first, priced)


@checked(
    "incremental_by_day",
    f"""SELECT *, strftime(CAST("timestamp" AS TIMESTAMP), '%Y-%m-%d') AS date
        FROM ({_select(RAW_NAMES, f"({PRICED_SQL})")})
        WHERE "timestamp" >= '2024-01-05'""",
)
def incremental_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days, then the month from the 5th with an older day among it, then all again; a target with day folders."""
    path = scratch_path(spark)
    dated = _priced(spark, sf_dir).withColumn("date", F.to_date("timestamp"))
    first = dated.filter(F.col("date").between(*(F.lit(f"2024-01-0{d}").cast("date") for d in (5, 6))))
    for source in (first, dated, dated):
        incremental_append(source, path, day="date")
    return comparable(read_table(spark, path).select(*RAW_NAMES, "date"))


@checked(
    "load_new_files",
    _select(RAW_NAMES, f"({PRICED_SQL})"),
)
def load_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten days of files at a time, each loaded as it lands; the first ten land again, and nothing new does."""
    root, everything = scratch_path(spark), observations(spark, sf_dir)
    landing, path, checkpoint = (f"{root}/{name}" for name in ("landing", "scrapes", "checkpoint"))
    third = F.least(F.floor((F.dayofmonth(F.to_date("timestamp")) - 1) / 10), F.lit(2))
    for number in (1, 0, 2, 0, None):
        if number is not None:
            everything.filter(third == number).write.mode("append").json(landing)
        load_new_files(spark, landing, path, checkpoint)
    return comparable(read_table(spark, path).select(*RAW_NAMES))


@checked(
    "raw_append_twice",
    f"""SELECT *, CAST(1 AS BIGINT) AS n FROM ({_select(RAW_NAMES, f"({PRICED_SQL})")})""",
)
def raw_appends_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines of each shop as a batch of its own, both delivered twice."""
    path, priced = layer_path(scratch_path(spark), "raw"), _priced(spark, sf_dir)
    for shop in ("shop-a", "shop-b", "shop-a", "shop-b"):
        append_raw_once(priced.filter(F.col("website") == shop), path, shop)
    again = clean_prices(read_raw_once(spark, path))
    return comparable(again).groupBy(*RAW_NAMES).agg(F.count(F.lit(1)).alias("n"))


@checked(
    "raw_broken_lines",
    f"""SELECT {", ".join(n for n in RAW_NAMES if n != "timestamp")}, NULL AS line,
               count(*) OVER () + (SELECT count(*) FROM ({RAW_SQL}) WHERE selling_price IS NULL) AS lines,
               (SELECT count(*) FROM ({RAW_SQL}) WHERE selling_price IS NULL) AS broken
        FROM ({RAW_SQL}) WHERE selling_price IS NOT NULL
        UNION ALL
        SELECT {", ".join("NULL" for _ in RAW_NAMES[1:])},
               '{{"url": "' || url || '", "website": "' || website AS line,
               (SELECT count(*) FROM ({RAW_SQL})) AS lines, count(*) OVER () AS broken
        FROM ({RAW_SQL}) WHERE selling_price IS NULL""",
)
def raw_broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of all observations, those without a price cut off in the middle, read back with their counts."""
    path = layer_path(scratch_path(spark), "raw")
    whole = F.to_json(F.struct(*RAW_NAMES))
    cut = F.concat(F.lit('{"url": "'), "url", F.lit('", "website": "'), "website")
    line = F.when(F.col("selling_price").isNull(), cut).otherwise(whole)
    observations(spark, sf_dir).select(line.alias("value")).write.text(path)
    read = read_raw_lines(spark, path)
    both = read.rows.drop("timestamp").unionByName(read.broken, allowMissingColumns=True)
    return both.withColumns({name: F.lit(read.counts[name]).cast("bigint") for name in ("lines", "broken")})


@checked(
    "raw_roundtrip",
    f"""SELECT *, CAST(1 + (hour(CAST("timestamp" AS TIMESTAMP)) >= 12)::INT AS BIGINT) AS n
        FROM ({_select(RAW_NAMES, f"({PRICED_SQL})")})""",
)
def raw_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON lines written in two appends, the afternoons twice, and read back."""
    path, priced = layer_path(scratch_path(spark), "raw"), _priced(spark, sf_dir)
    append_raw(priced, path)
    append_raw(priced.filter(F.hour("timestamp") >= 12), path)
    again = clean_prices(read_raw(spark, path))
    return comparable(again).groupBy(*RAW_NAMES).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- pages


# The named references that the test pages hold in headings and titles.
PAGE_REFERENCES = {"&nbsp;": "\u00a0", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&copy;": "©", "&middot;": "·"}


def _unescaped(expression: str) -> str:
    for reference, char in PAGE_REFERENCES.items():
        expression = f"replace({expression}, '{reference}', '{char}')"
    return f"replace({expression}, '&amp;', '&')"


def _tag_text(tag: str) -> str:
    inner = f"nullif(regexp_extract(html, '(?s)<{tag}(\\s[^>]*)?>(.*?)</{tag}>', 2), '')"
    return f"trim({_unescaped(f"regexp_replace({inner}, '<[^>]*>', '', 'g')")})"


@checked(
    "page_fields",
    f"""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS host,
               {_tag_text("h1")} AS heading, {_tag_text("title")} AS title
        FROM pages""",
)
def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "heading": FieldRule("h1", join_nodes=False),
        "title": FieldRule("title", join_nodes=False),
    }
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract_fields(pages, rules).select(
        "page_id",
        F.regexp_extract("url", "^[a-z]+://([^/?#:]+)", 1).alias("host"),
        "heading",
        "title",
    )


_PART_PRICE = _RUPEES.format("floor(p_retailprice)")
_PART_LIST = _RUPEES.format("floor(p_retailprice) + 500")
_PART_TIME = "strftime(TIMESTAMP '2024-01-01' + to_seconds(p_partkey), '%Y-%m-%d %H:%M:%S')"


SHOP_A_SQL = f"""
    SELECT p_name || ' & co' AS product_name,
           CASE WHEN layout IN (0, 6) THEN NULL WHEN layout = 2 THEN '₹' ELSE {_PART_PRICE} END
               AS selling_price,
           CASE WHEN layout IN (0, 6) THEN 'Out of Stock' ELSE 'In Stock' END AS status,
           CASE WHEN layout IN (1, 2) THEN {_PART_LIST}
                WHEN layout = 7 THEN replace({_PART_LIST}, '₹', '₹ ') END AS mrp,
           p_brand AS brand, 'Flipkart' AS website, {_PART_TIME} AS "timestamp",
           'https://shop-a/p/' || p_partkey AS url
    FROM (SELECT *, p_partkey % 8 AS layout FROM part) WHERE layout NOT IN (4, 5)"""

SHOP_B_SQL = f"""
    SELECT CASE WHEN layout < 6 THEN p_name || ' & co' END AS product_name,
           CASE WHEN layout = 2 THEN {_PART_LIST}
                WHEN layout < 6 THEN {_PART_PRICE} END AS selling_price,
           CASE WHEN layout < 4 THEN 'In Stock'
                WHEN layout < 6 THEN 'Out of Stock' END AS status,
           CASE WHEN layout IN (0, 2, 4, 5) THEN {_PART_LIST}
                WHEN layout = 3 THEN {_PART_PRICE} END AS mrp,
           CASE WHEN layout < 6 THEN p_brand END AS brand,
           CASE WHEN layout < 6 THEN 'ajio' END AS website,
           CASE WHEN layout < 6 THEN {_PART_TIME} END AS "timestamp",
           'https://shop-b/p/' || p_partkey AS url
    FROM (SELECT *, p_partkey % 7 AS layout FROM part)"""


@checked("extract_shop_a", SHOP_A_SQL)
def shop_a_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_shop_a(shop_a_pages(spark, sf_dir))


@checked("extract_shop_b", SHOP_B_SQL)
def shop_b_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_shop_b(shop_b_pages(spark, sf_dir))


# ---------------------------------------------------------------- quality and whole runs


@checked(
    "grain_duplicates",
    f"""SELECT url, CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS date, count(*) AS count
        FROM ({PRICED_SQL}) GROUP BY ALL HAVING count(*) > 1""",
)
def grain_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages scraped more than once a day: duplicates of the grain (url, date)."""
    dated = _priced(spark, sf_dir).withColumn("date", F.to_date("timestamp"))
    return comparable(duplicate_keys(dated, ["url", "date"]))


@checked(
    "schema_report",
    f"""SELECT {", ".join(f"lower(typeof({n})) AS {n}" for n in
                          ("mrp", "selling_price", "timestamp", "mrp_final", "final_price",
                           "Discount_Percentage"))}, count(*) AS n
        FROM ({_enriched(CLEAN_SQL)}) GROUP BY ALL""",
)
def column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of the cleaned and derived columns, with the number of rows that have them."""
    names = ENRICHED_NAMES[1:2] + ["mrp", "timestamp", "mrp_final", "final_price"]
    enriched = process(observations(spark, sf_dir))
    types = [F.typeof(n).alias(n) for n in [*names, "Discount_Percentage"]]
    return enriched.select(*types).groupBy(*[*names, "Discount_Percentage"]).agg(
        F.count(F.lit(1)).alias("n")
    )


_ROW_CHECKS = {
    "price known": "selling_price IS NOT NULL",
    "in stock": "status = 'In Stock'",
    "list price above price": "mrp >= selling_price",
    "known in January": "timestamp >= '2024-01-10'",
}
_CHECK_TYPES = {"mrp": "DOUBLE", "selling_price": "DOUBLE", "timestamp": "TIMESTAMP"}


def _check_sql(table: str, source: str) -> str:
    """The report of `_CHECKS` on a table of eight columns."""
    rows = f"(SELECT count(*) FROM ({source}))"
    lines = [
        f"SELECT '{table}' AS frame, '{name}' AS \"check\", 'row' AS kind, {rows} AS \"rows\", "
        f"(SELECT count(*) FROM ({source}) WHERE NOT coalesce({holds}, FALSE)) AS violations"
        for name, holds in _ROW_CHECKS.items()
    ]
    surplus = f"SELECT count(*) - count(DISTINCT (url, CAST(\"timestamp\" AS DATE))) FROM ({source})"
    lines.append(f"SELECT '{table}', 'one a day', 'unique', {rows}, ({surplus})")
    for name in RAW_NAMES:
        wrong = f"SELECT max((typeof(\"{name}\") <> '{_CHECK_TYPES.get(name, 'VARCHAR')}')::INT) FROM ({source})"
        lines.append(f"SELECT '{table}', '{name}', 'column', {rows}, ({wrong})")
    return " UNION ALL ".join(lines)


@checked(
    "quality_report",
    f"""SELECT frame, "check", kind, "rows", CAST(violations AS BIGINT) AS violations
        FROM ({_check_sql("text", f"SELECT * REPLACE (strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S') AS \"timestamp\", mrp AS mrp) FROM ({RAW_SQL})")}
              UNION ALL {_check_sql("clean", CLEAN_SQL)})""",
)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One set of checks on the scraped text, where types fail, and on the cleaned rows."""
    reports = []
    for name, df in (("text", observations(spark, sf_dir)), ("clean", _clean(spark, sf_dir))):
        checks = Checks(
            {check: F.expr(holds) for check, holds in _ROW_CHECKS.items()}, {"one a day": ["url", "day"]}, CLEAN
        )
        observed, seen = checks.observed(df.withColumn("day", F.to_date("timestamp")))
        reports.append(checks.report(stage(observed), seen).withColumn("frame", F.lit(name)))
    return reports[0].unionByName(reports[1])


@checked(
    "full_run",
    _select(ALERT_NAMES, f"({_buys(DAILY_SQL)})"),
)
def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both shops through every layer in one batch; the alert table of the last day."""
    everything, root = observations(spark, sf_dir), scratch_path(spark)
    shops = [everything.filter(F.col("website") == shop) for shop in ("shop-a", "shop-b")]
    run_pipeline(spark, shops, root, as_of=LAST_DAY)
    path = layer_path(root, "gold_alerts")
    return comparable(read_table(spark, path).select(*ALERT_NAMES))


@checked(
    "stage_counts",
    f"""SELECT (SELECT count(*) FROM events) AS scraped,
               (SELECT count(*) FROM ({CLEAN_SQL}) WHERE selling_price IS NULL) AS rejected,
               (SELECT count(*) FROM ({_enriched(PRICED_SQL)})) AS usable,
               (SELECT count(*) FROM ({_buys(DAILY_SQL)})) AS alerts""",
)
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows at the borders of a run, as observed while it wrote its tables."""
    report = run_pipeline(
        spark, [observations(spark, sf_dir)], scratch_path(spark), as_of=LAST_DAY
    )
    counts = (report.scraped, report.rejected, report.usable, report.alerts)
    return spark.createDataFrame(
        [counts], "scraped bigint, rejected bigint, usable bigint, alerts bigint"
    )


_BEFORE_SQL = _daily(_from(PRICED_SQL, f"\"timestamp\" < DATE '{LAST_DAY}'"))
_TODAY_SQL = _daily(_from(PRICED_SQL, f"\"timestamp\" >= DATE '{LAST_DAY}'"))


@checked(
    "full_run_with_history",
    _select(ALERT_NAMES, f"({_buys(f'{_BEFORE_SQL} UNION ALL {_TODAY_SQL}')})"),
)
def full_run_with_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month up to the last day, then the last day alone judged by the stored history."""
    everything, root = observations(spark, sf_dir), scratch_path(spark)
    last = F.to_date("timestamp") == F.lit(LAST_DAY).cast("date")
    run_pipeline(spark, [everything.filter(~last)], root, as_of="2024-01-29", history=True)
    report = run_pipeline(spark, [everything.filter(last)], root, LAST_DAY, history=True)
    return comparable(report.buys.select(*ALERT_NAMES))


_DAY_15, _NOT_15 = (
    _daily(_from(PRICED_SQL, f"CAST(\"timestamp\" AS DATE) {sign} DATE '2024-01-15'")) for sign in ("=", "<>")
)


@checked(
    "signals_back_dated",
    _select(ALERT_NAMES, f"({_buys(f'{_NOT_15} UNION ALL {_DAY_15}', '2024-01-15')})"),
)
def signals_back_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month without its 15th day, which arrives last and is judged by the days before it alone."""
    everything, root = observations(spark, sf_dir), scratch_path(spark)
    late = F.to_date("timestamp") == F.lit("2024-01-15").cast("date")
    run_pipeline(spark, [everything.filter(~late)], root, LAST_DAY, history=True).release()
    report = run_pipeline(spark, [everything.filter(late)], root, "2024-01-15", history=True)
    return comparable(report.buys.select(*ALERT_NAMES))


_SCRAPED_SQL = f"""
    SELECT product_name, {_parsed("selling_price")} AS selling_price, status,
           {_parsed("mrp")} AS mrp, brand, website,
           CAST("timestamp" AS TIMESTAMP) AS "timestamp", url
    FROM ({SHOP_A_SQL} UNION ALL {SHOP_B_SQL})"""
_SCRAPED_DAILY_SQL = _daily(_from(_SCRAPED_SQL, "selling_price IS NOT NULL"))


@checked(
    "full_run_from_pages",
    _select(ALERT_NAMES, f"({_buys(_SCRAPED_DAILY_SQL, '2024-01-01')})"),
)
def full_run_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of both shops through extraction and every layer to the alert table."""
    pages = shop_a_pages(spark, sf_dir), shop_b_pages(spark, sf_dir)
    root = scratch_path(spark)
    run_from_pages(spark, *pages, root, as_of="2024-01-01")
    path = layer_path(root, "gold_alerts")
    return comparable(read_table(spark, path).select(*ALERT_NAMES))
