"""Schemas of every layer: scraped text, cleaned, enriched, daily, alerts."""

from pyspark.sql import types as T


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, kind, True) for name in names]


_TEXT, _NUMBER, _INSTANT = T.StringType(), T.DoubleType(), T.TimestampType()

# One scrape of one product page, everything still text.
RAW = T.StructType(
    _fields(
        _TEXT,
        "product_name",
        "selling_price",
        "status",
        "mrp",
        "brand",
        "website",
        "timestamp",
        "url",
    )
)

_CLEAN_TYPES = {"selling_price": _NUMBER, "mrp": _NUMBER, "timestamp": _INSTANT}
CLEAN = T.StructType(
    [T.StructField(f.name, _CLEAN_TYPES.get(f.name, f.dataType), True) for f in RAW]
)

ENRICHED = T.StructType(
    CLEAN.fields
    + _fields(_NUMBER, "mrp_ffill", "mrp_final", "final_price", "Discount_Percentage")
)

# One row per product page, shop and calendar day.
DAILY_KEYS = ["url", "website", "date"]
DAILY = T.StructType(
    _fields(_TEXT, "url", "website")
    + _fields(T.DateType(), "date")
    + _fields(_NUMBER, "min_price_day", "max_price_day", "avg_price_day", "avg_discount_day")
    + _fields(T.LongType(), "num_scrapes_day")
    + _fields(_TEXT, "brand", "product_name")
    + _fields(_NUMBER, "mrp_final", "closing_price")
    + _fields(_INSTANT, "last_scrape_time")
    + _fields(_TEXT, "status")
)

ALERT = T.StructType(DAILY.fields + _fields(_NUMBER, "avg_price_7d") + _fields(_TEXT, "signal"))

# What a repeated alert refreshes; brand, product_name and mrp_final keep their first value.
ALERT_UPDATES = [
    "closing_price",
    "min_price_day",
    "max_price_day",
    "avg_price_day",
    "avg_discount_day",
    "num_scrapes_day",
    "avg_price_7d",
    "signal",
    "last_scrape_time",
    "status",
]

PAYLOAD_FIELDS = [
    "url",
    "product_name",
    "brand",
    "closing_price",
    "mrp_final",
    "avg_discount_day",
    "num_scrapes_day",
    "signal",
    "date",
]

PAGES = T.StructType(_fields(_TEXT, "url", "html") + _fields(_INSTANT, "fetched_at"))
