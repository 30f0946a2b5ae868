from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricetide.errors import FeedRejected, LoadRejected
from pricetide.operators import quality


def test_missing_columns_are_sorted_and_extras_allowed(feed):
    rows = feed({}).drop("name", "brand").withColumn("extra", F.lit(1))
    assert quality.missing_columns(rows) == ["brand", "name"]
    report = {r.column_name: (r.present, r.filled_rows) for r in quality.column_presence(rows).collect()}
    assert report["name"] == (False, 0)
    assert report["id"] == (True, 1)


@pytest.mark.parametrize(
    "rows, options, failure",
    [
        ([{}], {}, ""),
        ([{}, {}], {}, ""),
        ([{}, {}], {"allow_duplicates": False}, "duplicates"),
        ([{"prices.amountMin": "x"}], {}, "null_prices"),
        ([{"prices.amountMin": "x"}], {"allow_null_prices": True}, ""),
        ([{"prices.amountMin": "-1"}], {}, "invalid_prices"),
        ([{"prices.amountMin": "3", "prices.amountMax": "9"}], {"minimum_price": 5}, "invalid_prices"),
        ([{"id": None}], {}, "null_product_ids"),
        ([{"id": "  "}], {}, "null_product_ids"),
        ([{"id": None, "prices.amountMin": "x"}], {}, "null_prices"),
    ],
)
def test_validation_order_and_policy(feed, rows, options, failure):
    report = quality.validation_report(feed(*rows), **options)
    row = report.first()
    assert row.first_failure == failure
    assert row.status == ("FAILED" if failure else "PASSED")
    if failure:
        with pytest.raises(FeedRejected, match=failure):
            quality.require_valid(report)
    else:
        quality.require_valid(report)


def test_report_counts_copies(feed):
    bad = {"prices.amountMin": "x", "prices.amountMax": "-2"}
    row = quality.validation_report(feed(bad, bad, bad, {})).first()
    assert (row.row_count, row.duplicates) == (4, 2)
    assert (row.null_price_rows, row.invalid_price_rows) == (3, 3)


def test_type_conformance(feed):
    rows = feed({}, {"prices.dateSeen": "2020-01-01,bad"}, {"prices.amountMin": "1,000"}, {"prices.currency": None})
    report = {r.column_name: (r.value_rows, r.conforming_rows) for r in quality.type_conformance(rows).collect()}
    assert report["prices.dateSeen"] == (4, 3)
    assert report["prices.amountMin"] == (4, 3)
    assert report["prices.currency"] == (3, 3)


def fact(**changes):
    row = {
        "product_id": "p",
        "merchant_id": 1,
        "price_min": Decimal("1.00"),
        "price_max": Decimal("2.00"),
        "price": Decimal("1.50"),
        "currency": "USD",
        "condition": "new",
        "observed_at": "2020-01-01",
    }
    return tuple({**row, **changes}.values())


FACT = """product_id string, merchant_id int, price_min decimal(12,2), price_max decimal(12,2),
    price decimal(12,2), currency string, condition string, observed_at string"""


def test_load_gate(spark):
    good = spark.createDataFrame([fact(currency="A" * 10, condition="c" * 100)], FACT)
    quality.require_loadable(good)
    bad = spark.createDataFrame(
        [fact(product_id=""), fact(product_id=None), fact(currency="A" * 11), fact(condition="c" * 101),
         fact(merchant_id=None)],
        FACT,
    )
    with pytest.raises(LoadRejected) as error:
        quality.require_loadable(bad)
    assert "product_id_blank=2" in str(error.value)
    assert "currency_too_long=1" in str(error.value)
    assert "condition_too_long=1" in str(error.value)
    assert "merchant_id_null=1" in str(error.value)


def test_constraints_and_orphans(spark):
    facts = spark.createDataFrame(
        [fact(), fact(price_min=Decimal("-1.00")), fact(price_min=Decimal("3.00")), fact(product_id="q", merchant_id=9)],
        FACT,
    ).withColumn("price_id", F.when(F.col("product_id") == "p", F.lit(1).cast("bigint")))
    runs = spark.createDataFrame(
        [
            (1, "2020-01-01", "2020-01-02", "SUCCESS", 1, 1, 1, 1),
            (1, "2020-01-01", None, "RUNNING", 0, 0, 0, 0),
            (2, None, None, "FAILED", 0, 0, 0, -1),
            (3, "2020-01-02", "2020-01-01", "x" * 51, 0, 0, 0, 0),
            (None, "2020-01-01", None, None, None, None, None, None),
        ],
        """run_id bigint, started_at string, completed_at string, status string, records_received bigint,
        records_validated bigint, records_transformed bigint, records_loaded bigint""",
    )
    products = spark.createDataFrame(
        [("p", "a", "b" * 256), ("p", "a", ""), ("r", None, "")], "product_id string, product_name string, brand string"
    )
    merchants = spark.createDataFrame([(1, "m"), (2, "m"), (3, "x" * 501)], "merchant_id int, merchant_name string")
    counts = {r.check_name: r.violations for r in quality.constraint_violations(facts, products, merchants, runs).collect()}
    broken = {name: n for name, n in counts.items() if n}
    assert broken == {
        "products.product_name not null": 1,
        "products.brand length": 1,
        "products.product_id unique": 1,
        "merchants.merchant_name unique": 1,
        "merchants.merchant_name length": 1,
        "price_history.price_id not null": 1,
        "price_history.price_id unique": 2,
        "price_history.price_min >= 0": 1,
        "price_history.price_min <= price_max": 1,
        "pipeline_runs.run_id unique": 1,
        "pipeline_runs.run_id not null": 1,
        "pipeline_runs.started_at not null": 1,
        "pipeline_runs.status not null": 1,
        "pipeline_runs.status length": 1,
        "pipeline_runs.status known": 1,
        "pipeline_runs.records_loaded >= 0": 1,
        "pipeline_runs.completed_at >= started_at": 1,
        "pipeline_runs.completed_at of ended runs": 1,
    }
    orphans = quality.fk_orphans(facts, products, merchants).collect()
    assert {(r.foreign_key, r.key_value, r.fact_rows) for r in orphans} == {
        ("product_id", "q", 1),
        ("merchant_id", "9", 1),
    }


def test_constraints_read_a_table_once(spark, tmp_path):
    spark.createDataFrame([fact()], FACT).withColumn("price_id", F.lit(1)).write.parquet(str(tmp_path / "facts"))
    found = quality.violations(spark.read.parquet(str(tmp_path / "facts")), quality.price_rules())
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert found.count() == 15 and found.where("violations > 0").isEmpty()
