from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricetide.functions import (
    fill_blank,
    iso_instant,
    midpoint,
    missing_as_null,
    number,
    strip,
    to_money,
)
from pricetide.functions.text import MISSING_TOKENS, WHITESPACE


def apply(spark, values, function, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r.out for r in rows.withColumn("out", function(F.col("v"))).orderBy("i").collect()]


def test_missing_tokens(spark):
    exact = list(MISSING_TOKENS)
    near = [" " + t for t in exact] + ["text", "0", "NaNa", "nUll"]
    got = apply(spark, exact + near, lambda c: missing_as_null("v"))
    assert len(exact) == 19
    assert got == [None] * 19 + near


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_strip(spark):
    edges = ["\t", " ", "　", "\u0085", "\u001c", " ", "​", ""]
    values = [f"{e}wo rd{e}" for e in edges] + [" \t　", "", None, "\U0001f600 x "]
    expected = [v.strip() if v is not None else None for v in values]
    assert apply(spark, values, strip) == expected
    assert apply(spark, [None, "  ", " a "], fill_blank) == ["", "", "a"]


def test_number(spark):
    good = {"12": 12.0, " 12 ": 12.0, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "+5": 5.0, "-0": 0.0}
    bad = ["inf", "nan", "1_000", "1,000", "$5", "0x10", "1.0d", "2f", "", "e3", "1e", "1e400",
           "-1e400", "--1", "1 2", None]
    assert apply(spark, list(good), number) == list(good.values())
    assert apply(spark, bad, number) == [None] * len(bad)


GOOD_DATES = {
    "2017": datetime(2017, 1, 1),
    "2017-02": datetime(2017, 2, 1),
    "2017-2-3": datetime(2017, 2, 3),
    "2017-02-03": datetime(2017, 2, 3),
    "2017-02-03T10": datetime(2017, 2, 3, 10),
    "2017-02-03T10:00": datetime(2017, 2, 3, 10),
    "2017-02-03 10:00:05": datetime(2017, 2, 3, 10, 0, 5),
    "2017-02-03T10:00:00Z": datetime(2017, 2, 3, 10),
    "2017-02-03T10:00:00+05:30": datetime(2017, 2, 3, 4, 30),
    "2017-02-03T10:00:00+0530": datetime(2017, 2, 3, 4, 30),
    "2017-02-03T10:00:00-05": datetime(2017, 2, 3, 15),
    "2017-02-03T10:00:00.123456789Z": datetime(2017, 2, 3, 10, 0, 0, 123456),
    "20170203": datetime(2017, 2, 3),
    "2017/02/03": datetime(2017, 2, 3),
    "20170203T100000Z": datetime(2017, 2, 3, 10),
    "2017-02-03T100000Z": datetime(2017, 2, 3, 10),
    "1677-10-01": datetime(1677, 10, 1),
    "2262-04-11": datetime(2262, 4, 11),
}
BAD_DATES = [
    "10:00:00", "T10:00", "201702", "+2017-02-03", "2017-02-03 10:00:00 UTC", "now", "today",
    "1500-01-01", "9999-01-01", "1677-09-20", "2262-04-12", "2017-13-01", "2017-02-30", "bad-date",
    "", None, "2017-02-03T25:00",
]


def test_iso_instant(spark):
    assert apply(spark, list(GOOD_DATES), iso_instant) == list(GOOD_DATES.values())
    assert apply(spark, BAD_DATES, iso_instant) == [None] * len(BAD_DATES)


def test_instant_range_ends(spark):
    inside = ["1677-09-21T00:12:43.145225", "2262-04-11T23:47:16.854775"]
    outside = ["1677-09-21T00:12:43.145223", "2262-04-11T23:47:16.854776"]
    assert None not in apply(spark, inside, iso_instant)
    assert apply(spark, outside, iso_instant) == [None, None]


@pytest.mark.parametrize(
    "value, money",
    [(1.005, "1.01"), (0.125, "0.13"), (1200.465, "1200.47"), (0.0, "0.00"), (1e10, None), (-2.345, "-2.35")],
)
def test_to_money(spark, value, money):
    expected = None if money is None else Decimal(money)
    assert apply(spark, [value], to_money, "double") == [expected]


def test_midpoint_ends_in_half_a_cent(spark):
    row = spark.createDataFrame([(1188.34, 1212.59)], "a double, b double")
    got = row.select(to_money(midpoint(F.col("a"), F.col("b")))).first()[0]
    assert got == Decimal("1200.47")
