from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pricetide.errors import FeedRejected
from pricetide.operators import cleaning
from pricetide.sources.raw import missing_cells


def outcome(raw):
    return [
        (r.product_id, r.reject_reason)
        for r in cleaning.observe(raw).orderBy("product_id", "date_seen").collect()
    ]


def test_reject_reasons(feed):
    raw = feed(
        {"id": "a"},
        {"id": "b", "prices.amountMin": "abc"},
        {"id": "c", "prices.amountMax": None},
        {"id": "d", "prices.amountMin": "-1"},
        {"id": "e", "prices.amountMin": "3"},
        {"id": "f", "prices.dateSeen": "soon"},
        {"id": "g", "prices.dateSeen": None},
        {"id": "h", "prices.amountMin": "x", "prices.dateSeen": "2020-01-01,2020-01-02"},
    )
    assert outcome(raw) == [
        ("a", None),
        ("b", "price_missing"),
        ("c", "price_missing"),
        ("d", "price_negative"),
        ("e", "price_range"),
        ("f", "date_invalid"),
        ("g", "date_invalid"),
        ("h", "price_missing"),
    ]


def test_date_list_keeps_empty_pieces_as_rejects(feed):
    raw = feed({"prices.dateSeen": "2020-01-01,,2020-01-02 , x,"})
    rows = cleaning.observe(raw).collect()
    good = sorted(r.date_seen for r in rows if r.reject_reason is None)
    assert good == [datetime(2020, 1, 1), datetime(2020, 1, 2)]
    assert sorted(r.date_text for r in rows if r.reject_reason) == ["", "", "x"]


def test_case_strip_and_parts(feed):
    raw = feed(
        {
            "name": " Lamp ",
            "prices.currency": " usd",
            "prices.merchant": " Best SHOP\t",
            "prices.condition": "New ",
            "prices.dateSeen": "2020-03-31T23:30:00-01:00",
        }
    )
    row = cleaning.clean(raw).first()
    assert (row.product_name, row.currency, row.merchant, row.condition) == (
        "Lamp",
        "USD",
        "best shop",
        "new",
    )
    assert row.price == 1.5
    assert str(row.observed_date) == "2020-04-01"
    assert (row.observed_year, row.observed_month) == (2020, 4)


def test_duplicates_count_all_columns(feed):
    raw = feed({"id": "a"}, {"id": "a"}, {"id": "b"}).withColumn("extra", F.lit("x"))
    differing = raw.withColumn("extra", F.monotonically_increasing_id())
    assert cleaning.dedup_exact(raw).count() == 2
    assert cleaning.dedup_exact(differing).count() == 3
    landing = raw.withColumn("_batch_id", F.monotonically_increasing_id())
    assert cleaning.dedup_exact(landing).count() == 2


def test_missing_column_is_an_error(feed):
    with pytest.raises(FeedRejected, match="prices.merchant"):
        cleaning.clean(feed({}).drop("prices.merchant"))


def test_accounting_adds_up(feed):
    raw = feed(
        {"id": "a", "prices.dateSeen": "2020-01-01,2020-01-02,bad"},
        {"id": "a", "prices.dateSeen": "2020-01-01,2020-01-02,bad"},
        {"id": "b", "prices.amountMin": "x"},
        {"id": "c", "prices.dateSeen": None},
    )
    row = cleaning.transform_accounting(raw).first()
    assert row.asDict() == {
        "rows_in": 4,
        "rows_duplicate": 1,
        "rows_bad_price": 1,
        "rows_exploded": 4,
        "rows_bad_date": 2,
        "rows_out": 2,
        "rows_removed": 2,
    }
    assert row.rows_bad_price + row.rows_exploded == cleaning.observe(raw).count()


def test_accounting_of_an_empty_feed(feed):
    row = cleaning.transform_accounting(feed({}).where("1 = 0")).first()
    assert set(row.asDict().values()) == {0}


def test_sorted_with_missing_last_and_copies(feed, monkeypatch):
    monkeypatch.setattr(cleaning, "COPIES_PER_BLOCK", 2)
    raw = feed(
        *[{"id": "a", "name": " " * i + "x", "prices.merchant": "m"} for i in range(5)],
        {"id": "a", "prices.merchant": None},
        {"id": "B", "prices.merchant": "z"},
        {"id": "a", "prices.merchant": "k"},
    )
    rows = cleaning.sorted_observations(cleaning.clean(raw)).collect()
    assert [(r.product_id, r.merchant) for r in rows] == [
        ("B", "z"),
        ("a", "k"),
        *[("a", "m")] * 5,
        ("a", None),
    ]


def test_cleaning_twice_changes_nothing(spark, feed):
    raw = feed(
        {"id": " a ", "prices.currency": "usd", "prices.dateSeen": "20200101, 2020-01-02"},
        {"id": "b", "prices.merchant": " X "},
    )
    once = cleaning.clean(raw)
    again = once.select(
        F.col("product_id").alias("id"),
        F.col("product_name").alias("name"),
        "brand",
        F.col("category").alias("categories"),
        F.col("price_min").cast("string").alias("prices.amountMin"),
        F.col("price_max").cast("string").alias("prices.amountMax"),
        F.col("currency").alias("prices.currency"),
        F.date_format("date_seen", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("prices.dateSeen"),
        F.col("merchant").alias("prices.merchant"),
        F.col("condition").alias("prices.condition"),
    )
    twice = cleaning.clean(missing_cells(again))
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
