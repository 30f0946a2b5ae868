"""The report of a run that sets bad rows aside is watched while its rows are written."""

import os

import pytest

from pricetide.operators import quality
from pricetide.operators.cleaning import parse_prices, select_business_columns
from pricetide.plans.pipeline import run_pipeline
from pricetide.sources.raw import MALFORMED, landed, write_raw_files

CHECKS = [{}, {"allow_duplicates": False, "allow_null_prices": True, "minimum_price": 2.0}]


@pytest.mark.parametrize("checks", CHECKS)
def test_report_equals_that_of_the_rows_and_nothing_is_stored_for_it(spark, tmp_path, feed, checks):
    good = {"prices.dateSeen": "2020-01-01, bad, 2020-01-02"}
    rows = [good, good, {"id": "  "}, {"id": None}, {"prices.amountMin": "n/a"}, {"prices.amountMin": "-1"}]
    rows += [{"prices.amountMin": "9"}, {"prices.amountMax": None}, {"prices.amountMax": None}]
    write_raw_files(feed(*rows), f"{tmp_path}/feed")
    root = f"{tmp_path}/store"
    run_pipeline(spark, f"{tmp_path}/feed", root, policy="quarantine", **checks)
    raw = landed(spark, f"{root}/raw", "1").where(f"{MALFORMED} is null").drop(MALFORMED)
    expected = quality.validation_report(raw, **checks).first().asDict()
    stored = spark.read.json(f"{root}/reports").first().asDict()
    assert {name: stored[name] for name in expected} == expected
    assert stored["run_id"] == 1 and expected["duplicates"] == 2
    assert not os.path.exists(f"{root}/staged/rows")


def test_report_of_no_rows(spark, feed):
    raw = feed({}).limit(0)
    counted = quality.count_copies(raw)
    parsed = parse_prices(select_business_columns(counted, ["_copies"]))
    watched, report = quality.watch_report(parsed, len(counted.columns) - 1)
    assert watched.columns == parsed.columns and watched.count() == 0
    assert report().first() == quality.validation_report(raw).first()
