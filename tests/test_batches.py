"""Batches that count once: raw lines and partial daily rows; stages and their owner."""

import os
import uuid

import pytest

from pricetide.operators.daily import daily_partials, daily_prices, finish_partials, merge_partials
from pricetide.operators.quality import Checks, assert_report
from pricetide.schema import DAILY, RAW
from pricetide.sources.batches import (
    Ledger,
    add_partials,
    append_raw_once,
    merged_daily,
    read_raw_once,
)
from pricetide.sources.paths import StageScope, stage, table_exists
from pricetide.sources.tables import incremental_append, raw_frame, read_raw_lines, read_table, upsert
from pricetide.streaming.loads import load_new_files


def raw(spark, *prices, day="2025-01-10"):
    rows = [
        {"url": f"u{k}", "website": "A", "status": "In Stock", "selling_price": p, "timestamp": f"{day} 1{k}:00:00"}
        for k, p in enumerate(prices)
    ]
    return raw_frame(spark, rows)


def test_a_batch_without_entry_is_written_again_in_its_place(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert read_raw_once(spark, path).columns == RAW.names
    raw(spark, "₹1", "₹2", "₹3").write.json(f"{path}/batch=b1")  # broke off before the ledger
    assert append_raw_once(raw(spark, "₹1"), path, "007")
    assert read_raw_once(spark, path).count() == 1
    assert append_raw_once(raw(spark, "₹1", "₹2"), path, "b1")
    assert not append_raw_once(raw(spark, "₹9", "₹9"), path, "b1")
    assert sorted(r.selling_price for r in read_raw_once(spark, path).collect()) == ["₹1", "₹1", "₹2"]
    entries = {r.batch: r.rows for r in Ledger(spark, path).batches().collect()}
    assert entries == {"007": 1, "b1": 2}


@pytest.mark.parametrize("name", ["", "a/b", "_x", "..", "-all-", "a b", "a=b"])
def test_names_that_are_no_folders_are_refused(spark, tmp_path, name):
    with pytest.raises(ValueError, match="named"):
        append_raw_once(raw(spark, "₹1"), str(tmp_path / "raw"), name)


def enriched(frame, rows):
    schema = (
        "url string, website string, timestamp string, brand string, product_name string, mrp_final double,"
        " final_price double, Discount_Percentage double, status string"
    )
    return frame(rows, schema)


ROWS = [
    ("u", "A", "2025-01-10 10:00:00", "B", "P", 100.0, 80.0, 20.0, "In Stock"),
    ("u", "A", "2025-01-10 12:00:00", "C", "Q", None, 90.0, None, "In Stock"),
    ("u", "A", "2025-01-10 12:00:00", "C", "Q", None, 95.0, None, "In Stock"),
    ("u", "A", "2025-01-11 09:00:00", None, None, None, None, None, None),
    ("v", "A", "2025-01-10 09:00:00", "B", "P", 10.0, 10.0, 0.0, "In Stock"),
    (None, "A", "2025-01-10 09:00:00", "B", "P", 10.0, 10.0, 0.0, "In Stock"),
    ("w", "A", None, "B", "P", 10.0, 10.0, 0.0, "In Stock"),
]


def test_partials_of_any_split_are_the_days_of_all(spark, frame, tmp_path):
    whole = sorted(map(str, daily_prices(enriched(frame, ROWS)).collect()))
    for step in (1, 2, 3):
        path = str(tmp_path / str(step))
        for begin in range(0, len(ROWS), step):
            part = daily_partials(enriched(frame, ROWS[begin : begin + step]))
            assert add_partials(part, path, f"b{begin}")
            assert not add_partials(part, path, f"b{begin}")
        found = merged_daily(spark, path).select(*DAILY.names)
        assert sorted(map(str, found.collect())) == whole
    once = finish_partials(merge_partials(daily_partials(enriched(frame, ROWS))))
    assert sorted(map(str, once.select(*DAILY.names).collect())) == whole


def test_partials_of_a_batch_without_entry_do_not_count(spark, frame, tmp_path):
    path = str(tmp_path)
    add_partials(daily_partials(enriched(frame, ROWS[:1])), path, "1")
    add_partials(daily_partials(enriched(frame, ROWS[1:2])), path, "2")
    os.rename(f"{path}/_batches/2", f"{path}/_batches/_2")
    (row,) = merged_daily(spark, path).collect()
    assert (row.num_scrapes_day, row.closing_price) == (1, 80.0)
    assert add_partials(daily_partials(enriched(frame, ROWS[1:2])), path, "2")
    assert merged_daily(spark, path).first().num_scrapes_day == 2


def test_stages_go_with_their_scope(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("pricetide.sources.paths.scratch_path", lambda _: f"{tmp_path}/{uuid.uuid4().hex}")
    files = lambda: {d for d, _, names in os.walk(tmp_path) if "_SUCCESS" in names}
    with StageScope(spark) as outer:
        with StageScope(spark) as inner:
            first = stage(spark.range(5))
            kept = inner.result(first.selectExpr("id + 1 AS id"))
            assert len(files()) == 2
        assert len(files()) == 1 and kept.count() == 5
        with pytest.raises(RuntimeError), StageScope(spark) as broken:
            stage(spark.range(3))
            broken.hand_over()
            raise RuntimeError
        assert len(files()) == 1
        outer.hand_over()
    assert kept.count() == 5
    outer.release()
    assert not files()
    stage(spark.range(2))
    assert len(files()) == 1  # without a scope, the caller's


def test_upsert_refuses_an_empty_day(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", "")], "k string, day string")
    with pytest.raises(ValueError, match="empty"):
        upsert(rows, path, ["k"], day="day")
    assert not table_exists(spark, path)


def test_newest_folder_of_whole_numbers(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(d, d) for d in (8, 9, 10)], "day int, timestamp int")
    assert incremental_append(rows, path, day="day") == 3
    assert incremental_append(rows, path, day="day") == 0
    assert read_table(spark, path).count() == 3


def test_broken_lines_are_kept_apart(spark, tmp_path):
    path = str(tmp_path / "raw")
    lines = ['{"url": "u", "selling_price": "₹1"}', '{"url": "v"', "", "no json", "[1, 2]", '{"other": 1}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    read = read_raw_lines(spark, path)
    assert sorted(r.line for r in read.broken.collect()) == sorted(['{"url": "v"', "no json"] + ["[1, 2]"][: read.counts["broken"] - 2])
    assert read.rows.columns == RAW.names
    assert {"u", None} == {r.url for r in read.rows.collect()}
    assert read.counts["lines"] == read.rows.count() + read.broken.count()


def test_loads_take_each_file_once_and_late_rows_too(spark, tmp_path):
    landing, path, checkpoint, rejects = (str(tmp_path / n) for n in ("landing", "t", "c", "rejects"))
    seen = []
    load = lambda: load_new_files(spark, landing, path, checkpoint, rejects, 1, lambda b: seen.append(b.count()))
    raw(spark, "₹1", None, "₹3").coalesce(1).write.mode("append").json(landing)
    assert load() == 3
    assert load() == 0
    late = raw(spark, "₹10", day="2025-01-10").union(raw(spark, "₹7", day="2025-01-02"))
    late.coalesce(2).write.mode("append").json(landing)
    assert load() == 2
    stored = {(r.url, str(r.date)): r.selling_price for r in read_table(spark, path).collect()}
    assert stored == {("u0", "2025-01-10"): 10.0, ("u2", "2025-01-10"): 3.0, ("u0", "2025-01-02"): 7.0}
    assert spark.read.parquet(rejects).count() == 1
    assert seen == [2, 1, 1]


def test_checks_count_while_writing(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    df = spark.createDataFrame([(1, 5.0, "x"), (1, None, "y"), (2, -1.0, "z"), (2, 1.0, "z"), (2, 1.0, "z")], "k int, p double, s string")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType()), T.StructField("q", T.StringType())])
    checks = Checks({"positive": F.col("p") > 0, "known": F.col("k").isNotNull()}, {"one each": ["k"]}, schema)
    observed, seen = checks.observed(df)
    report = checks.report(stage(observed), seen)
    assert {(r["check"], r["kind"]): r["violations"] for r in report.collect()} == {
        ("positive", "row"): 2,
        ("known", "row"): 0,
        ("one each", "unique"): 3,
        ("k", "column"): 1,
        ("s", "column"): 0,
        ("q", "column"): 1,
    }
    with pytest.raises(ValueError, match="positive"):
        assert_report(report)
    observed, seen = checks.observed(df.limit(0))
    assert checks.report(stage(observed), seen).filter("kind <> 'column' AND violations > 0").isEmpty()
    with pytest.raises(ValueError):
        Checks({"a": F.lit(True)}, {"a": ["k"]})
