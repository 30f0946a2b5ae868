"""Invariants on generated inputs."""

from datetime import datetime
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricetide.functions import number, strip
from pricetide.functions.text import WHITESPACE
from pricetide.operators import cleaning, facts, history

CALM = settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
    derandomize=True,
)

texts = st.text(st.one_of(st.sampled_from(WHITESPACE + "ab​"), st.characters(exclude_categories=["Cs"])), max_size=8)


@CALM
@given(st.lists(texts, min_size=30, max_size=60))
def test_strip_equals_python(spark, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    got = [r[0] for r in rows.orderBy("i").select(strip(F.col("v"))).collect()]
    assert got == [v.strip() for v in values]


@CALM
@given(st.lists(st.floats(-1e9, 1e9, allow_nan=False), min_size=30, max_size=60))
def test_numbers_round_trip(spark, values):
    rows = spark.createDataFrame([(i, repr(v)) for i, v in enumerate(values)], "i int, v string")
    assert [r[0] for r in rows.orderBy("i").select(number(F.col("v"))).collect()] == values


cells = st.fixed_dictionaries(
    {
        "id": st.sampled_from(["a", " a", "b", None]),
        "prices.amountMin": st.sampled_from(["1", "1.00", "2", "x", "-1", None]),
        "prices.amountMax": st.sampled_from(["2", "3.005"]),
        "prices.dateSeen": st.sampled_from(["2020-01-01", "2020-01-01,bad", "20200101, 2020-01-02", "", None]),
        "prices.merchant": st.sampled_from(["M", "m ", None]),
    }
)


@CALM
@given(st.lists(cells, min_size=10, max_size=40), st.randoms(use_true_random=False))
def test_row_order_does_not_matter_and_every_row_is_accounted_for(feed, rows, random):
    shuffled = list(rows)
    random.shuffle(shuffled)
    left, right = (cleaning.observe(feed(*order)) for order in (rows, shuffled))
    assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))
    account = cleaning.transform_accounting(feed(*rows)).first()
    reasons = [r.reject_reason for r in left.select("reject_reason").collect()]
    assert account.rows_in == len(rows)
    assert account.rows_out == reasons.count(None)
    assert account.rows_bad_date == reasons.count("date_invalid")
    assert account.rows_bad_price + account.rows_exploded == len(reasons)
    loaded = facts.named_facts(cleaning.accepted(left))
    assert loaded.count() == loaded.select("product_id", "merchant", *history.ORDER, "currency", "condition").distinct().count()


OFFER_ROWS = st.lists(
    st.tuples(st.sampled_from(["a", "b"]), st.integers(1, 20), st.integers(0, 5)), min_size=5, max_size=40, unique=True
)


@CALM
@given(OFFER_ROWS)
def test_previous_price_equals_a_python_walk(spark, rows):
    data = [
        (p, "m", "USD", "new", datetime(2020, 1, day), *[Decimal(price)] * 3) for p, day, price in rows
    ]
    table = spark.createDataFrame(
        data,
        """product_id string, merchant string, currency string, condition string, observed_at timestamp,
        price decimal(12,2), price_min decimal(12,2), price_max decimal(12,2)""",
    )
    expected, last = [], {}
    for p, day, price in sorted(rows):
        expected.append((p, day, price, last.get(p)))
        last[p] = price
    for limits in ({}, {"rows_per_task": 2}):
        got = [
            (r.product_id, r.observed_at.day, int(r.price), None if r.previous_price is None else int(r.previous_price))
            for r in history.previous_price(table, **limits).collect()
        ]
        assert sorted(got, key=str) == sorted(expected, key=str)
