from datetime import datetime

from pyspark.sql import functions as F

from pricetide.operators import cleaning, dimensions, facts
from pricetide.schema import MERCHANTS, PRODUCTS

T0, T1 = datetime(2020, 1, 1), datetime(2021, 1, 1)


def test_first_row_of_a_product_wins(feed):
    clean = cleaning.clean(
        feed(
            {"id": "a", "name": "late", "prices.merchant": "m", "prices.dateSeen": "2020-01-02"},
            {"id": "a", "name": "early", "prices.merchant": "m", "prices.dateSeen": "2020-01-01"},
            {"id": "a", "name": "no merchant", "prices.merchant": None, "prices.dateSeen": "2019-01-01"},
            {"id": "a", "name": "other", "prices.merchant": "z", "prices.dateSeen": "2018-01-01"},
            {"id": "b", "name": None, "brand": None},
            {"id": "  ", "name": "blank"},
            {"id": None, "name": "null"},
        )
    )
    rows = {r.product_id: (r.product_name, r.brand) for r in dimensions.dim_products(clean).collect()}
    assert rows == {"a": ("early", "brand"), "b": ("", "")}


def test_merchants_without_blanks(feed):
    clean = cleaning.clean(
        feed({"prices.merchant": " A "}, {"prices.merchant": "a"}, {"prices.merchant": "  "}, {"prices.merchant": None})
    )
    assert [r.merchant_name for r in dimensions.dim_merchants(clean).collect()] == ["a"]


def test_upsert_products(spark):
    stored = spark.createDataFrame(
        [("same", "n", "b", "c", T0, T0), ("changed", "n", "b", "c", T0, T0), ("absent", "n", None, "c", T0, T0)],
        PRODUCTS,
    )
    batch = spark.createDataFrame(
        [("same", "n", "b", "c"), ("changed", "new", "", "c2"), ("fresh", "f", "b", "c")],
        "product_id string, product_name string, brand string, category string",
    )
    rows = {r.product_id: r for r in dimensions.upsert_products(stored, batch, F.lit(T1)).collect()}
    assert {k: v.change for k, v in rows.items()} == {
        "same": "updated",
        "changed": "updated",
        "absent": "untouched",
        "fresh": "inserted",
    }
    assert (rows["changed"].product_name, rows["changed"].brand, rows["changed"].created_at) == ("new", "", T0)
    assert rows["changed"].updated_at == rows["same"].updated_at == T1
    assert (rows["absent"].updated_at, rows["fresh"].created_at) == (T0, T1)


def test_new_merchants_get_the_next_ids(spark):
    stored = spark.createDataFrame([(7, "kept", T0)], MERCHANTS)
    names = spark.createDataFrame([(f"m{i}",) for i in range(500)] + [("kept",)], "merchant_name string")
    merged = dimensions.merge_merchants(stored, names, F.lit(T1)).collect()
    assert sorted(r.merchant_id for r in merged) == list(range(7, 508))
    assert {r.merchant_name: r.merchant_id for r in merged}["kept"] == 7
    again = dimensions.new_merchants(spark.createDataFrame(merged, MERCHANTS), names)
    assert again.count() == 0
    shuffled = dimensions.merge_merchants(stored, names.orderBy(F.desc("merchant_name")).repartition(5))
    assert {r.merchant_name: r.merchant_id for r in shuffled.collect()} == {r.merchant_name: r.merchant_id for r in merged}


def test_mapping_keeps_unknown_and_blank_merchants(spark, feed):
    merchants = spark.createDataFrame([(1, "a", T0)], MERCHANTS)
    clean = cleaning.clean(feed({"prices.merchant": "A"}, {"prices.merchant": "b"}, {"prices.merchant": None}))
    rows = dimensions.map_merchant_ids(clean, merchants).collect()
    assert {r.merchant: r.merchant_id for r in rows} == {"a": 1, "b": None, None: None}


def test_load_reasons(spark, feed):
    merchants = spark.createDataFrame([(1, "shop", T0)], MERCHANTS)
    clean = cleaning.clean(
        feed(
            {"id": "ok", "prices.currency": "c" * 10, "prices.condition": "d" * 100},
            {"id": "ok2", "prices.currency": None, "prices.condition": None},
            {"id": " "},
            {"id": "m", "prices.merchant": "who"},
            {"id": "c", "prices.currency": "c" * 11},
            {"id": "d", "prices.condition": "d" * 101},
            {"id": "p", "prices.amountMin": "1e10", "prices.amountMax": "1e10"},
            {"id": "emoji", "prices.currency": "\U0001f600" * 10},
        )
    )
    prepared = facts.prepare_facts(clean, merchants)
    assert {r.product_id: r.reject_reason for r in prepared.collect()} == {
        "ok": None,
        "ok2": None,
        "": "product_missing",
        "m": "merchant_unmapped",
        "c": "currency_too_long",
        "d": "condition_too_long",
        "p": "price_invalid",
        "emoji": None,
    }
    filled = prepared.where("product_id = 'ok2'").first()
    assert (filled.currency, filled.condition) == ("", "")


def test_facts_equal_after_rounding_load_once(spark, feed):
    merchants = spark.createDataFrame([(1, "shop", T0)], MERCHANTS)
    clean = cleaning.clean(
        feed(
            {"prices.amountMin": "1.001", "prices.amountMax": "2.00"},
            {"prices.amountMin": "1.002", "prices.amountMax": "2.001"},
        )
    )
    rows = facts.distinct_facts(facts.loadable(facts.prepare_facts(clean, merchants)))
    assert rows.count() == 1


def test_dim_date(spark):
    rows = spark.createDataFrame([(datetime(2020, 2, 28),), (datetime(2020, 3, 1, 23),)], "observed_at timestamp")
    days = dimensions.dim_date(rows).orderBy("date_key").collect()
    assert [(d.date_key, d.day_of_week, d.is_weekend) for d in days] == [
        (20200228, 5, False),
        (20200229, 6, True),
        (20200301, 7, True),
    ]
    assert dimensions.dim_date(rows.where("1 = 0")).count() == 0


def test_product_search_ignores_case(spark):
    rows = spark.createDataFrame(
        [("1", "Red Lamp", "Acme", "x"), ("2", "cup", "LAMPCO", "y"), ("3", "pen", "z", "50% off")],
        "product_id string, product_name string, brand string, category string",
    )
    assert {r.product_id for r in dimensions.product_search(rows, "lamp").collect()} == {"1", "2"}
    assert {r.product_id for r in dimensions.product_search(rows, "0% O").collect()} == {"3"}
