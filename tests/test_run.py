import json

import pytest

from pricetide.plans.run import run_pipeline
from pricetide.sources.paths import layer_path, table_exists
from pricetide.sources.tables import raw_frame, read_raw, read_table


def scrape(spark, website, *rows):
    return raw_frame(
        spark,
        [
            {
                "url": url,
                "website": website,
                "status": status,
                "mrp": mrp,
                "selling_price": price,
                "timestamp": stamp,
                "brand": "B",
                "product_name": "P",
            }
            for url, stamp, mrp, price, status in rows
        ],
    )


def test_run_writes_every_layer(spark, tmp_path):
    root = str(tmp_path)
    a = scrape(
        spark,
        "A",
        ("a1", "2025-01-10 10:00:00", "₹100", "₹80", "In Stock"),
        ("a1", "2025-01-10 12:00:00", None, "₹85", "In Stock"),
        ("a2", "2025-01-10 10:00:00", "₹100", None, "Out of Stock"),
        ("a3", "2025-01-10 10:00:00", "₹100", "₹50", "Out of Stock"),
    )
    b = scrape(spark, "B", ("b1", "2025-01-10 10:00:00", "₹100", "₹99", "In Stock"))
    outbox = str(tmp_path / "outbox")
    report = run_pipeline(spark, [a, b], root, "2025-01-10", outbox=outbox)
    assert (report.scraped, report.rejected, report.usable, report.alerts) == (5, 1, 3, 1)
    assert read_raw(spark, layer_path(root, "raw")).count() == 4
    daily = {r.url: r for r in read_table(spark, layer_path(root, "processed")).collect()}
    assert set(daily) == {"a1", "b1"}
    assert (daily["a1"].closing_price, daily["a1"].mrp_final) == (85.0, 100.0)
    assert daily["a1"].avg_discount_day == 17.5
    alerts = read_table(spark, layer_path(root, "gold_alerts")).collect()
    assert [(r.url, r.signal, r.num_scrapes_day) for r in alerts] == [("a1", "BUY", 2)]
    (line,) = spark.read.text(outbox).collect()
    assert json.loads(line.value)["url"] == "a1"
    assert [r.value for r in report.payloads.collect()] == [line.value]


def test_replayed_run_repeats_only_raw(spark, tmp_path):
    root = str(tmp_path)
    a = scrape(spark, "A", ("a1", "2025-01-10 10:00:00", "₹100", "₹80", "In Stock"))
    for _ in range(2):
        run_pipeline(spark, [a, None], root, "2025-01-10")
    counts = [
        read_raw(spark, layer_path(root, "raw")).count(),
        read_table(spark, layer_path(root, "processed")).count(),
        read_table(spark, layer_path(root, "gold_alerts")).count(),
    ]
    assert counts == [2, 1, 1]


def test_drop_is_seen_with_history_only(spark, tmp_path):
    yesterday = scrape(spark, "A", ("a1", "2025-01-09 10:00:00", None, "₹100", "In Stock"))
    today = scrape(spark, "A", ("a1", "2025-01-10 10:00:00", None, "₹80", "In Stock"))
    for history, alerts in ((False, 0), (True, 1)):
        root = str(tmp_path / str(history))
        run_pipeline(spark, [yesterday], root, "2025-01-09", history=history)
        report = run_pipeline(spark, [today], root, "2025-01-10", history=history)
        assert report.alerts == report.buys.count() == alerts
        assert table_exists(spark, layer_path(root, "gold_alerts")) == bool(alerts)


def test_run_without_usable_rows(spark, tmp_path):
    a = scrape(spark, "A", ("a1", "2025-01-10 10:00:00", None, "n/a", "In Stock"))
    report = run_pipeline(spark, [a], str(tmp_path), "2025-01-10")
    assert (report.scraped, report.rejected, report.usable, report.alerts) == (1, 1, 0, 0)


def test_run_without_sources(spark, tmp_path):
    with pytest.raises(ValueError, match="no source"):
        run_pipeline(spark, [None, None], str(tmp_path))
