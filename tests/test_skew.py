"""Groups cut into slices give the same results as plain windows."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricetide.operators import history, market, skew

# Treat any group of more than a few rows as heavy.
CUT = {"rows_per_task": 4}

SCHEMA = """product_id string, merchant string, currency string, condition string,
    observed_at timestamp, price decimal(12,2), price_min decimal(12,2), price_max decimal(12,2)"""


def make(seed, one_instant=False):
    rng = random.Random(seed)
    rows = set()
    for _ in range(600):
        busy = rng.random() < 0.5
        product = "hot" if busy else f"p{rng.randrange(20)}"
        merchant = "m0" if busy and rng.random() < 0.7 else f"m{rng.randrange(40)}"
        minutes = 0 if one_instant and busy else rng.randrange(300)
        price = Decimal(rng.randrange(1, 60))
        rows.add((product, merchant, "USD", "new", datetime(2020, 1, 1) + timedelta(minutes=minutes), price, price, price))
    return sorted(rows)


@pytest.fixture(params=[(1, False), (2, True)])
def facts(request, spark):
    return spark.createDataFrame(make(*request.param), SCHEMA)


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    a = sorted(map(str, left.select(columns).collect()))
    b = sorted(map(str, right.select(columns).collect()))
    assert a == b


def test_heavy_groups_are_found(facts):
    found = {r["_hash"]: r["_rows"] for r in skew.heavy_groups(facts, ["product_id"], **CUT).collect()}
    expected = {
        r.h: r.n
        for r in facts.groupBy(skew.group_hash(["product_id"]).alias("h")).agg(F.count("*").alias("n")).collect()
        if r.n > 4
    }
    assert found == expected


def test_ordinary_groups_are_not_heavy(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert skew.heavy_groups(rows, ["l_partkey"]) is None


def test_slices_are_small_and_ordered(facts):
    keys = history.offer("merchant")
    heavy = skew.heavy_groups(facts, keys, **CUT)
    cuts = skew.choose_cuts(facts, keys, history.ORDER, heavy, rows_per_task=4)
    sliced = skew.assign_slices(facts, keys, history.ORDER, cuts)
    biggest = sliced.groupBy(*keys, "_slice").count().agg(F.max("count")).first()[0]
    assert biggest <= 5
    groups = {}
    for r in sliced.orderBy(*keys, *history.ORDER).collect():
        groups.setdefault(tuple(r[k] for k in keys), []).append(r._slice)
    assert all(s == sorted(s) for s in groups.values())
    assert max(len(set(s)) for s in groups.values()) > 10


def test_previous_price(facts):
    same(history.previous_price(facts), history.previous_price(facts, **CUT))


def test_change_frequency_and_fluctuation(facts):
    same(history.change_frequency(facts), history.change_frequency(facts, **CUT))
    same(history.price_fluctuation(facts), history.price_fluctuation(facts, **CUT))


def test_market_position(facts):
    same(market.market_position(facts), market.market_position(facts, **CUT))


def test_cheapest_merchant(facts):
    now = history.current_price(facts)
    first = F.rank().over(Window.partitionBy("product_id", "currency", "condition").orderBy("price"))
    found = market.cheapest_merchant(facts)
    same(found, now.withColumn("n", first).where("n = 1").select(*found.columns))


def test_total_before(spark):
    rows = spark.createDataFrame([("a", i, i % 7) for i in range(50)] + [("b", 1, 5)], "k string, i int, n int")
    args = (["k"], ["i"], "n", "before")
    same(skew.with_total_before(rows, *args), skew.with_total_before(rows, *args, **CUT))


def test_many_cuts_use_both_search_levels(spark):
    rows = spark.createDataFrame([("a", i) for i in range(2000)], "k string, i int")
    args = (["k"], ["i"], {"before": "i"})
    same(skew.with_previous(rows, *args), skew.with_previous(rows, *args, **CUT))


def test_total_before_with_figures_of_the_group(spark):
    rows = spark.createDataFrame([("a", i, i % 7) for i in range(50)] + [("b", 1, 5)], "k string, i int, n int")
    got = skew.with_total_before(rows, ["k"], ["i"], "n", "before", {"n": F.sum("n")}, **CUT)
    same(got, skew.with_total_before(rows, ["k"], ["i"], "n", "before", {"n": F.sum("n")}))
    whole = sum(i % 7 for i in range(50))
    assert {(r.k, r.n) for r in got.collect()} == {("a", whole), ("b", 5)}


@pytest.mark.parametrize("crowd", [30, 4])
def test_market_position_moves_offers_once(spark, crowd):
    """Mostly crowded markets and mostly small ones; a market without a key or price is kept."""
    at, one = datetime(2020, 1, 1), Decimal(1)
    rows = [(f"p{p}", f"m{i}", "USD", "new", at, Decimal(i % 9), one, one) for p in range(3) for i in range(crowd)]
    rows += [(f"q{i}", "m", "USD", "new", at, one, one, one) for i in range(5)]
    rows += [("hot", f"m{i}", "USD", "new", at, Decimal(i % 9), one, one) for i in range(9)]
    rows += [("hot", "free", "USD", "new", at, None, one, one), *[("n", f"m{i}", None, "new", at, one, one, one) for i in range(6)]]
    facts = spark.createDataFrame(rows, SCHEMA)
    cut = market.market_position(facts, **CUT)
    same(market.market_position(facts), cut)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line and "_hash" not in line]
    assert len(joins) == 1
