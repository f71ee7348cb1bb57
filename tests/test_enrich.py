import datetime
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricetide.operators.enrich import add_discount, add_final_price, enrich, forward_fill, process
from pricetide.operators.hot_keys import find_hot_keys
from pricetide.schema import ENRICHED
from pricetide.sources.tables import raw_frame

SCHEMA = "n int, url string, timestamp timestamp, mrp double"


def filled(df, **options):
    return {r.n: (r.mrp_ffill, r.mrp_final) for r in forward_fill(df, **options).collect()}


def brute_force(rows):
    """Newest list price at or before each row; rows of one instant share the highest one."""
    result = {}
    for n, url, stamp, mrp in rows:
        order = (lambda t: (t is not None, t or 0))
        seen = [r for r in rows if r[1] == url and r[3] is not None and order(r[2]) <= order(stamp)]
        newest = max((order(r[2]) for r in seen), default=None)
        carried = max((r[3] for r in seen if order(r[2]) == newest), default=None)
        result[n] = (mrp, mrp) if mrp is not None else (carried, carried)
    return result


def test_list_price_is_carried_forward_only(frame):
    history = [(7, None), (8, 45.0), (9, None), (10, None), (11, 39.5), (12, None)]
    rows = [(f"2024-06-03 {hour:02}:30:00", "kettle", listed) for hour, listed in history]
    df = frame(rows[::-1], "timestamp string, url string, mrp double")
    result = forward_fill(df).orderBy("timestamp").collect()
    assert [r.mrp_ffill for r in result] == [None, 45.0, 45.0, 45.0, 39.5, 39.5]
    assert all(r.mrp_final == r.mrp_ffill for r in result)


def test_fill_ignores_the_shop(frame):
    """The list price travels along the page URL, whatever shop the rows name."""
    rows = [("2025-01-01 10:00:00", "u", "a", 5.0), ("2025-01-01 11:00:00", "u", "b", None)]
    df = frame(rows, "timestamp string, url string, website string, mrp double")
    assert [r.mrp_final for r in forward_fill(df).collect()] == [5.0, 5.0]


instants = st.integers(0, 200).map(
    lambda s: datetime.datetime(2025, 1, 1) + datetime.timedelta(seconds=13 * s)
)
histories = st.lists(
    st.tuples(
        st.sampled_from(["a", "a", "a", "b", "c", None]),
        st.one_of(st.none(), instants),
        st.one_of(st.none(), st.sampled_from([1.0, 2.0, 3.0])),
    ),
    min_size=1,
    max_size=40,
)


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(history=histories)
def test_both_fills_match_brute_force(spark, history):
    rows = [(n, *row) for n, row in enumerate(history)]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = brute_force(rows)
    assert filled(df) == expected
    assert filled(df, hot_rows=3) == expected
    assert filled(df, hot_rows=0) == expected


@pytest.fixture
def crowded(spark):
    """Half of all rows on one page, a third of those at one instant."""
    pick = random.Random(7)
    rows = []
    for n in range(3000):
        url = "hot" if n % 2 else f"u{pick.randrange(200)}"
        second = 40_000 if n % 3 == 0 else pick.randrange(86_400)
        stamp = datetime.datetime(2025, 1, 1) + datetime.timedelta(seconds=second)
        rows.append((n, url, stamp, pick.choice([None, None, None, 10.0, 20.0])))
    return rows


def test_hot_page_is_filled_exactly(spark, crowded):
    df = spark.createDataFrame(crowded, SCHEMA)
    hot = find_hot_keys(df, "url", hot_rows=1000)
    assert [r[0] for r in hot.keys.collect()] == ["hot"]
    assert filled(df, hot_rows=1000) == brute_force(crowded)


def test_every_hot_key_is_set_apart(spark):
    rows = [(n, f"u{n % 12_000}" if n % 12_000 else None, None, None) for n in range(36_000)]
    df = spark.createDataFrame([*rows, (-1, "small", None, None)], SCHEMA)
    ordinary, busy = find_hot_keys(df, "url", hot_rows=2).split(df)
    assert [r.url for r in ordinary.collect()] == ["small"]
    assert busy.select("url").distinct().count() == 12_000


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_hot_keys_split_with_and_without_broadcast(spark, crowded, threshold):
    df, name = spark.createDataFrame(crowded, SCHEMA), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, threshold)
        assert filled(df, hot_rows=5) == brute_force(crowded)
    finally:
        spark.conf.set(name, before)


def test_no_hot_key_means_one_shuffle(spark, crowded):
    df = spark.createDataFrame(crowded, SCHEMA)
    assert find_hot_keys(df, "url") is None
    plan = forward_fill(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_hot_key_counted_in_a_wider_frame(spark, crowded):
    df = spark.createDataFrame(crowded, SCHEMA)
    part = df.filter(F.col("n") < 1500)
    wider = filled(part, hot_rows=1000, counted=df)
    assert wider == filled(part) == brute_force(crowded[:1500])


def test_final_price_falls_back_to_list_price(spark):
    df = spark.createDataFrame(
        [(80.0, 100.0), (None, 100.0), (None, None)], "selling_price double, mrp_final double"
    )
    result = add_discount(add_final_price(df)).collect()
    assert [(r.final_price, r.Discount_Percentage) for r in result] == [
        (80.0, 20.0),
        (100.0, 0.0),
        (None, None),
    ]


def test_process_shares_a_list_price_within_an_instant(spark):
    scraped = [
        {"url": "lamp", "status": "In Stock", "selling_price": price, "mrp": listed,
         "timestamp": "2024-03-09 18:45:00"}
        for price, listed in (("₹1,500", None), ("₹1,200", "₹2,000"))
    ]
    result = process(raw_frame(spark, scraped)).orderBy("selling_price").collect()
    assert [(r.mrp_final, r.final_price, r.Discount_Percentage) for r in result] == [
        (2000.0, 1200.0, 40.0),
        (2000.0, 1500.0, 25.0),
    ]


def test_out_of_stock_rows_supply_no_list_price(spark):
    rows = [
        {"url": "u", "status": "Out of Stock", "mrp": "₹50", "selling_price": "₹5",
         "timestamp": "2025-01-01 10:00:00"},
        {"url": "u", "status": "In Stock", "selling_price": "₹6",
         "timestamp": "2025-01-01 11:00:00"},
    ]
    result = process(raw_frame(spark, rows))
    assert result.schema == ENRICHED
    assert [(r.final_price, r.mrp_final) for r in result.collect()] == [(6.0, None)]


def test_row_order_and_partitioning_do_not_matter(spark, crowded):
    shuffled = random.Random(1).sample(crowded, len(crowded))
    one = spark.createDataFrame(crowded, SCHEMA).repartition(1)
    many = spark.createDataFrame(shuffled, SCHEMA).repartition(13)
    assert filled(one) == filled(many) == filled(many, hot_rows=100)


def test_enrich_equals_process_on_clean_rows(spark):
    rows = [
        {"url": f"u{n % 3}", "status": "In Stock", "selling_price": f"₹{n}",
         "mrp": None if n % 2 else f"₹{2 * n}", "timestamp": f"2025-01-01 10:00:{n:02}"}
        for n in range(1, 20)
    ]
    raw = raw_frame(spark, rows)
    from pricetide.operators.clean import clean_prices

    assert sorted(map(str, process(raw).collect())) == sorted(
        map(str, enrich(clean_prices(raw), hot_rows=2).collect())
    )
