import datetime
import json
import random

import pytest

from pricetide.operators.signals import (
    alert_payload,
    buy_alerts,
    recent_days,
    signals,
    signals_on,
    trailing_avg,
)
from pricetide.schema import ALERT, DAILY, PAYLOAD_FIELDS


@pytest.fixture
def days(spark):
    def make(rows):
        """Rows of (url, date text, closing price, mean discount)."""
        full = []
        for url, day, closing, discount in rows:
            values = dict.fromkeys(DAILY.names)
            values |= {"url": url, "website": "s", "date": datetime.date.fromisoformat(day)}
            values |= {"closing_price": closing, "avg_discount_day": discount}
            full.append(tuple(values[n] for n in DAILY.names))
        return spark.createDataFrame(full, DAILY)

    return make


def judged(df):
    return [(str(r.date), r.avg_price_7d, r.signal) for r in df.orderBy("date").collect()]


def test_previous_observed_days_count_not_calendar_days(days):
    daily = days(
        [
            ("u", "2025-01-01", 10.0, None),
            ("u", "2025-01-02", 20.0, None),
            ("u", "2025-01-20", 5.0, None),
        ]
    )
    result = signals(daily)
    assert result.columns == ALERT.names
    assert judged(result) == [
        ("2025-01-01", None, "NO_BUY"),
        ("2025-01-02", 10.0, "NO_BUY"),
        ("2025-01-20", 15.0, "BUY"),
    ]


def test_oldest_day_leaves_the_frame(days):
    daily = days([("u", f"2025-01-0{d}", 100.0 if d == 1 else 10.0, None) for d in range(1, 10)])
    averages = [r.avg_price_7d for r in trailing_avg(daily).orderBy("date").collect()]
    assert averages[-2:] == [pytest.approx(22.86), 10.0]


@pytest.mark.parametrize(
    ("discount", "signal"), [(10.0, "BUY"), (9.99, "NO_BUY"), (None, "NO_BUY"), (55.0, "BUY")]
)
def test_discount_rule(days, discount, signal):
    assert judged(signals(days([("u", "2025-01-01", None, discount)])))[0][2] == signal


@pytest.mark.parametrize(
    ("closing", "signal"), [(90.0, "BUY"), (90.01, "NO_BUY"), (None, "NO_BUY")]
)
def test_drop_rule(days, closing, signal):
    daily = days([("u", "2025-01-01", 100.0, None), ("u", "2025-01-02", closing, 0.0)])
    assert judged(signals(daily))[1][2] == signal


def test_comparison_uses_the_rounded_mean(days):
    """Mean 3.335 is rounded to 3.34; 0.9 of that is above 3.003, 0.9 of 3.335 is not."""
    daily = days(
        [
            ("u", "2025-01-01", 3.33, None),
            ("u", "2025-01-02", 3.34, None),
            ("u", "2025-01-03", 3.003, None),
        ]
    )
    assert judged(signals(daily))[2] == ("2025-01-03", 3.34, "BUY")


def test_rule_parameters(days):
    daily = days([("u", "2025-01-01", 100.0, 5.0), ("u", "2025-01-02", 96.0, 4.0)])
    result = judged(signals(daily, drop_to=0.97, min_discount=5, window_rows=1))
    assert [s for *_, s in result] == ["BUY", "BUY"]


def test_pruned_signals_equal_unpruned(days):
    pick = random.Random(3)
    rows = [
        (f"u{u}", f"2025-01-{d:02}", round(pick.uniform(5, 50), 2), pick.choice([None, 1.0, 12.0]))
        for u in range(30)
        for d in range(1, 29)
        if pick.random() < 0.6
    ]
    daily = days(rows)
    for day in ("2025-01-05", "2025-01-20", "2025-01-28", "2025-02-01"):
        expected = sorted(map(str, buy_alerts(signals(daily), day).collect()))
        assert sorted(map(str, signals_on(daily, day).collect())) == expected
    most = recent_days(daily, "2025-01-28").groupBy("url").count().agg({"count": "max"})
    assert most.first()[0] <= 8


def test_alerts_of_today_by_default(days):
    today = datetime.datetime.now(datetime.timezone.utc).date()
    yesterday = today - datetime.timedelta(days=1)
    daily = days([("u", str(today), 1.0, 50.0), ("u", str(yesterday), 1.0, 50.0)])
    assert [r.date for r in buy_alerts(signals(daily)).collect()] == [today]
    assert [r.date for r in signals_on(daily).collect()] == [today]


def test_payload_has_nine_fields_with_nulls(days):
    alerts = signals(days([("u", "2025-01-01", 1.5, 50.0), ("v", "2025-01-01", 1.5, 1.0)]))
    (row,) = alert_payload(alerts).collect()
    document = json.loads(row.value)
    assert list(document) == PAYLOAD_FIELDS
    assert document["date"] == "2025-01-01"
    assert document["brand"] is None
    assert (document["closing_price"], document["signal"]) == (1.5, "BUY")
