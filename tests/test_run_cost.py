"""Steps of a run that are done once, or only where they are needed."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from pricetide.functions.text import WHITESPACE, strip
from pricetide.operators import cleaning
from pricetide.plans.pipeline import read_processed, write_processed
from pricetide.session import open_writers
from pricetide.sources.raw import CSV_OPTIONS, write_raw_files
from pricetide.sources.warehouse import Warehouse

LIMIT = "spark.sql.maxConcurrentOutputFileWriters"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_strip_gives_what_trimming_every_text_gives(spark):
    ends = ["", "a", "!", "~", "\x00", "\x7f", "\x80", "é", "​", "\U0001f600", *WHITESPACE]
    texts = [None, *(f"{a}{middle}{b}" for a in ends for b in ends for middle in ("", "x y", "\t", "é"))]
    frame = spark.createDataFrame([(text,) for text in texts], "t string")
    got = frame.select(strip(F.col("t")).alias("new"), F.btrim("t", F.lit(WHITESPACE)).alias("old")).collect()
    assert len(got) == len(texts) and all(r.new == r.old for r in got)


def test_plain_text_is_not_searched_for_white_space(spark):
    frame = spark.range(1).select(strip(F.concat(F.lit("a"), F.col("id").cast("string"))).alias("t"))
    assert "ELSE trim(" in plan(frame)


def test_clean_rows_and_rejects_are_written_without_a_sort(spark, tmp_path, feed, monkeypatch):
    during, parquet = [], DataFrameWriter.parquet

    def seen(self, *args, **options):
        during.append(int(spark.conf.get(LIMIT)))
        parquet(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    observed = cleaning.observe(feed({"id": "a"}, {"id": "b", "prices.amountMin": "x"}, {"id": "c"}))
    before = spark.conf.get(LIMIT)
    write_processed(observed, str(tmp_path / "processed"))
    assert during == [2] and spark.conf.get(LIMIT) == before
    rows = read_processed(spark, str(tmp_path / "processed"), observed).select("product_id", "outcome")
    assert sorted(map(tuple, rows.collect())) == [("a", "clean"), ("b", "rejected"), ("c", "clean")]


def test_limit_of_writers_is_put_back_after_an_error_and_never_lowered(spark):
    before = spark.conf.get(LIMIT)
    with pytest.raises(ZeroDivisionError), open_writers(spark, 7):
        with open_writers(spark, 3):
            assert spark.conf.get(LIMIT) == "7"
        1 / 0
    assert spark.conf.get(LIMIT) == before


def test_names_and_fresh_facts_are_computed_once(spark, tmp_path, feed, monkeypatch):
    plans, write = {}, Warehouse._write

    def kept(self, rows, *folder, **options):
        plans["/".join(folder)] = plan(rows)
        write(self, rows, *folder, **options)

    monkeypatch.setattr(Warehouse, "_write", kept)
    store = Warehouse(spark, str(tmp_path / "store"))
    path = str(tmp_path / "clean")
    for n, ids in enumerate(["ab", "abc", "abc"]):
        cleaning.clean(feed(*[{"id": i, "prices.merchant": f"shop {i}"} for i in ids])).write.parquet(f"{path}{n}")
        result = store.load(spark.read.parquet(f"{path}{n}"))
        assert (result.inserted, result.skipped) == [(2, 0), (1, 2), (0, 3)][n]
        # The numbering of merchants reads stored names, the range partitioner stored facts.
        assert "FileScan parquet [merchant#" not in plans[f"merchants/load={n + 1}"]
        assert "FileScan parquet [merchant#" in plans["staged/names"]
        if n:
            assert "Join" not in plans["staged/numbered"]
    assert Counter(r.merchant_name for r in store.merchants().collect()) == Counter(["shop a", "shop b", "shop c"])


def test_feeds_are_compressed_fast(spark, tmp_path, feed):
    rows = feed(*[{"id": f"{i * 7919 % 1000:03}", "name": f"name {i % 13}"} for i in range(2000)]).coalesce(1)
    write_raw_files(rows, str(tmp_path / "fast"))
    rows.write.options(compression="gzip", **CSV_OPTIONS).csv(str(tmp_path / "small"))
    fast, small = (next((tmp_path / n).glob("part-*.csv.gz")).stat().st_size for n in ("fast", "small"))
    assert fast > small
    assert spark.read.options(**CSV_OPTIONS).csv(str(tmp_path / "fast")).count() == 2000
