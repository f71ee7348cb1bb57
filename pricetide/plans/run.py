"""One run: observations to raw, daily and alert tables."""

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pricetide.operators.clean import (
    clean_prices,
    combine_sources,
    observe_rejects,
    split_valid,
)
from pricetide.operators.daily import daily_prices
from pricetide.operators.enrich import enrich
from pricetide.operators.last_days import signals_from_state
from pricetide.operators.signals import alert_payload, signals_on
from pricetide.sources.pages import extract_shop_a, extract_shop_b
from pricetide.sources.paths import StageScope, layer_path, stage, table_exists
from pricetide.sources.tables import append_raw, read_table, write_alerts, write_daily


@dataclass(frozen=True)
class RunReport:
    scraped: int
    rejected: int
    usable: int
    alerts: int
    daily: DataFrame
    buys: DataFrame
    payloads: DataFrame
    stages: StageScope

    def release(self) -> None:
        """Delete the staged tables behind ``daily``, ``buys`` and ``payloads``, after the last use of these."""
        self.stages.release()


def run_pipeline(
    spark: SparkSession,
    sources: list[DataFrame | None],
    root: str,
    as_of: datetime.date | str | None = None,
    history: bool = False,
    outbox: str | None = None,
) -> RunReport:
    """Clean, keep raw, enrich, upsert daily rows, find the day's BUY rows, upsert them.

    Signals see this run's daily rows only, or with ``history`` all stored ones: then each product's newest days
    are kept in a table of their own, and a day is judged from its rows and that table.
    ``outbox`` receives the alert payloads as JSON lines. Counts are taken while the
    staged tables are written, each step's result is computed once. A run that fails deletes what it staged;
    else the report owns it.
    """
    with StageScope(spark) as scope:
        scraped = Observation("scraped")
        cleaned = clean_prices(combine_sources(*sources))
        valid, _ = split_valid(stage(observe_rejects(cleaned, scraped)))
        append_raw(valid, layer_path(root, "raw"))

        daily_path, state_path = layer_path(root, "processed"), layer_path(root, "last_days")
        usable = Observation("usable")
        daily = daily_prices(enrich(valid)).observe(
            usable, F.sum("num_scrapes_day").alias("rows")
        )
        keeps_state = history or table_exists(spark, state_path)
        batch = write_daily(daily, daily_path, state_path if keeps_state else None)

        found = Observation("alerts")
        if history and table_exists(spark, state_path):
            known = read_table(spark, daily_path).select(*batch.columns)
            signalled = signals_from_state(known, read_table(spark, state_path), known, as_of)
        else:
            signalled = signals_on(batch, as_of)
        columns = [*batch.columns, "avg_price_7d", "signal"]
        buys = stage(signalled.select(*columns).observe(found, F.count(F.lit(1)).alias("rows")))
        alerts = found.get["rows"]
        if alerts:
            buys = write_alerts(buys, layer_path(root, "gold_alerts"), unique=True)
        payloads = alert_payload(buys)
        if outbox and alerts:
            payloads.write.mode("append").text(outbox)

        return RunReport(
            scraped=scraped.get["rows"],
            rejected=scraped.get["rejected"],
            usable=usable.get["rows"] or 0,
            alerts=alerts,
            daily=batch,
            buys=buys,
            payloads=payloads,
            stages=scope.hand_over(),
        )


def run_from_pages(
    spark: SparkSession,
    shop_a: DataFrame | None,
    shop_b: DataFrame | None,
    root: str,
    as_of: datetime.date | str | None = None,
    history: bool = False,
    outbox: str | None = None,
) -> RunReport:
    """`run_pipeline` on fetched pages (``url, html, fetched_at``); a missing shop is ``None``."""
    sources = [
        None if shop_a is None else extract_shop_a(shop_a),
        None if shop_b is None else extract_shop_b(shop_b),
    ]
    return run_pipeline(spark, sources, root, as_of, history, outbox)
