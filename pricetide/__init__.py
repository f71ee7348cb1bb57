"""Product price histories on Spark: extraction, daily prices, buy alerts."""

from pricetide.operators.clean import clean_prices, combine_sources, filter_valid, split_valid
from pricetide.operators.daily import (
    daily_partials,
    daily_prices,
    daily_prices_joined,
    finish_partials,
    merge_partials,
    ranked_closing_rows,
)
from pricetide.operators.enrich import add_discount, add_final_price, enrich, forward_fill, process
from pricetide.operators.last_days import last_days, signals_from_state
from pricetide.operators.quality import Checks
from pricetide.operators.signals import (
    alert_payload,
    buy_alerts,
    recent_days,
    signals,
    signals_on,
    trailing_avg,
)
from pricetide.plans.run import run_from_pages, run_pipeline
from pricetide.sources.batches import add_partials, append_raw_once, merged_daily, read_raw_once
from pricetide.sources.pages import extract_fields, extract_shop_a, extract_shop_b
from pricetide.sources.tables import incremental_append, read_raw_lines, upsert, write_alerts, write_daily
from pricetide.streaming.loads import load_new_files

__all__ = [
    "Checks",
    "add_partials",
    "append_raw_once",
    "daily_partials",
    "finish_partials",
    "last_days",
    "load_new_files",
    "merge_partials",
    "merged_daily",
    "read_raw_lines",
    "read_raw_once",
    "signals_from_state",
    "add_discount",
    "add_final_price",
    "alert_payload",
    "buy_alerts",
    "clean_prices",
    "combine_sources",
    "daily_prices",
    "daily_prices_joined",
    "enrich",
    "extract_fields",
    "extract_shop_a",
    "extract_shop_b",
    "filter_valid",
    "forward_fill",
    "incremental_append",
    "ranked_closing_rows",
    "process",
    "recent_days",
    "run_from_pages",
    "run_pipeline",
    "signals",
    "signals_on",
    "split_valid",
    "trailing_avg",
    "upsert",
    "write_alerts",
    "write_daily",
]
