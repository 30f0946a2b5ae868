from datetime import datetime
from decimal import Decimal

import pytest

from pricetide.operators import history, market

SCHEMA = """product_id string, merchant string, currency string, condition string,
    observed_at timestamp, price decimal(12,2), price_min decimal(12,2), price_max decimal(12,2)"""


@pytest.fixture
def facts(spark):
    def row(product, merchant, day, price, currency="USD"):
        p = Decimal(price)
        return (product, merchant, currency, "new", datetime(2020, 1, day), p, p, p)

    return spark.createDataFrame(
        [
            row("a", "m1", 1, "10"),
            row("a", "m1", 2, "12"),
            row("a", "m1", 3, "12"),
            row("a", "m2", 1, "12"),
            row("a", "m2", 1, "11"),
            row("a", "m3", 5, "1", "EUR"),
            row("b", "m1", 1, "0"),
            row("b", "m1", 2, "5"),
            row("c", "m2", 4, "12"),
        ],
        SCHEMA,
    )


def pick(rows, *columns):
    return sorted(tuple(r[c] for c in columns) for r in rows.collect())


def test_current_price_breaks_ties_by_price(facts):
    got = pick(history.current_price(facts), "product_id", "merchant", "price")
    assert got == [("a", "m1", 12), ("a", "m2", 12), ("a", "m3", 1), ("b", "m1", 5), ("c", "m2", 12)]


def test_change_and_percentage(facts):
    rows = history.price_change(facts).where("product_id in ('a', 'b') and merchant = 'm1'").collect()
    got = {(r.product_id, r.observed_at.day): (r.previous_price, r.price_diff, r.price_pct) for r in rows}
    assert got == {
        ("a", 1): (None, None, None),
        ("a", 2): (10, 2, 20.0),
        ("a", 3): (12, 0, 0.0),
        ("b", 1): (None, None, None),
        ("b", 2): (0, 5, None),
    }


def test_change_points_drop_repeats(facts):
    got = pick(history.price_change_points(facts).where("product_id = 'a' and merchant = 'm1'"), "price")
    assert got == [(10,), (12,)]


def test_change_frequency(facts):
    got = pick(history.change_frequency(facts), "merchant", "observations", "pairs", "changes")
    assert got == [("m1", 5, 3, 2), ("m2", 3, 1, 1), ("m3", 1, 0, 0)]
    rates = {r.merchant: r.change_rate for r in history.change_frequency(facts).collect()}
    assert rates["m3"] is None


def test_cheapest_keeps_ties_and_currencies_apart(facts):
    got = pick(market.cheapest_merchant(facts), "product_id", "currency", "merchant", "price")
    assert got == [
        ("a", "EUR", "m3", 1),
        ("a", "USD", "m1", 12),
        ("a", "USD", "m2", 12),
        ("b", "USD", "m1", 5),
        ("c", "USD", "m2", 12),
    ]


def test_competitor_average_excludes_the_offer_itself(facts):
    rows = {(r.product_id, r.currency, r.merchant): r for r in market.avg_competitor_price(facts).collect()}
    assert rows["a", "USD", "m1"].competitor_avg == 12.0
    assert rows["c", "USD", "m2"].competitor_avg is None


def test_movers(facts):
    ups = history.top_price_increases(facts, 5).collect()
    assert [(r.product_id, r.merchant) for r in ups] == [("a", "m2")]
    since_first = history.top_price_increases(facts, 5, basis="first").collect()
    assert [(r.product_id, r.merchant, r.price_pct) for r in since_first][0] == ("a", "m1", 20.0)
    assert history.top_price_decreases(facts, 5).count() == 0
    with pytest.raises(ValueError):
        history.latest_change(facts, basis="best")


def test_extremes_take_the_earliest(facts):
    high = pick(history.highest_recorded_price(facts).where("product_id = 'a' and currency = 'USD'"), "price", "observed_at", "merchant")
    assert high == [(12, datetime(2020, 1, 1), "m2")]
    low = pick(history.lowest_recorded_price(facts).where("product_id = 'a' and currency = 'USD'"), "price", "merchant")
    assert low == [(10, "m1")]


def test_history_of_one_product_is_ordered(facts):
    rows = history.price_history_view(facts, "a").collect()
    keys = [(r.merchant, r.currency, r.observed_at, r.price) for r in rows]
    assert keys == sorted(keys) and len(keys) == 6


def test_plans_keep_one_shuffle_per_window(spark, facts):
    def plan(rows):
        return rows._jdf.queryExecution().executedPlan().toString()

    assert plan(history.price_change(facts)).count("Exchange hashpartitioning") == 1
    assert plan(market.competitor_comparison(facts)).count("Exchange hashpartitioning") == 2
    top = plan(history.top_price_increases(facts))
    assert top.count("WindowGroupLimit") == 2 and "TakeOrderedAndProject" in top
    assert top.count("Exchange hashpartitioning") == 1
    for rows in (history.price_change(facts), market.competitor_comparison(facts)):
        assert "CartesianProduct" not in plan(rows) and "BroadcastNestedLoop" not in plan(rows)
