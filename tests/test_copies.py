"""Steps that shuffle hashes and possible copies instead of whole rows give what whole rows give."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from pricetide.operators import cleaning, facts, rows
from pricetide.operators.quality import count_copies, count_stored_copies
from pricetide.schema import LOAD_KEY, MERCHANTS
from pricetide.sources import raw as raw_source
from pricetide.sources.warehouse import Warehouse


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# xxhash64 skips NULL, so ("a", None) and (None, "a") have one hash and are still two rows.
ODD = [("a", None), (None, "a"), ("b", "c"), ("b", "c"), ("b", "c"), ("d", "e"), (None, None), (None, None)]


@pytest.mark.parametrize("sent", [0, 100])
def test_copies_are_counted_on_whole_rows(spark, monkeypatch, sent):
    monkeypatch.setattr(rows, "HASHES_SENT", sent)
    frame = spark.createDataFrame(ODD, "`x.y` string, z string")
    got = Counter({(r[0], r[1]): r[2] for r in rows.with_copies(frame, ["x.y", "z"]).collect()})
    assert got == Counter(ODD)


def test_rows_without_copies_are_not_shuffled(feed):
    raw = feed({"id": "a"}, {"id": "b"}, {"id": "c", "name": None})
    assert "Exchange" in plan(cleaning.dedup_exact(raw))
    assert "Exchange" not in plan(cleaning.dedup_stored(raw))


def test_stored_rows_are_cleaned_alike(feed):
    raw = feed({"id": "a"}, {"id": "a"}, {"id": "b", "prices.amountMin": "x"}, {"id": "c", "name": " n"}, {"id": "c"})
    raw = raw.withColumn("_batch_id", F.monotonically_increasing_id())
    for old, new in [
        (count_copies(raw), count_stored_copies(raw)),
        (cleaning.dedup_exact(raw, ["_batch_id"]), cleaning.dedup_stored(raw, ["_batch_id"])),
        (cleaning.clean(raw), cleaning.clean_stored(raw)),
        (facts.named_facts(cleaning.clean(raw)), facts.named_facts(cleaning.clean_stored(raw), stored=True)),
    ]:
        assert old.columns == new.columns
        assert Counter(map(tuple, old.collect())) == Counter(map(tuple, new.collect()))


@pytest.mark.parametrize("sent", [0, 100])
def test_new_facts_compares_whole_keys(spark, monkeypatch, sent):
    monkeypatch.setattr(facts, "HASHES_SENT", sent)
    kinds = "product_id string, merchant_id int, observed_at timestamp, price double, price_min double, price_max double, currency string, condition string"
    row = lambda product, currency, condition: (product, 1, None, 1.0, 1.0, 1.0, currency, condition)
    stored = spark.createDataFrame([row("a", "x", None), row("b", "x", "y")], kinds).select(*LOAD_KEY).fillna("x", ["condition"])
    batch = spark.createDataFrame([row("a", "x", "x"), row("b", "x", "y"), row("c", "x", "y")], kinds)
    batch, stored = (f.withColumn("observed_at", F.lit("2020-01-01").cast("timestamp")) for f in (batch, stored))
    fresh = facts.new_facts(batch, stored)
    assert fresh.columns == batch.columns and [r.product_id for r in fresh.collect()] == ["c"]


def test_first_load_does_not_shuffle_for_merchants(spark, tmp_path, feed):
    spark.createDataFrame([(1, "shop", None)], MERCHANTS).write.parquet(str(tmp_path / "added"))
    known = Warehouse(spark, str(tmp_path / "store")).merchants()
    merchants = known.unionByName(spark.read.schema(MERCHANTS).parquet(str(tmp_path / "added")))
    cleaning.clean(feed({"prices.merchant": "shop"})).write.parquet(str(tmp_path / "clean"))
    prepared = facts.prepare_facts(spark.read.parquet(str(tmp_path / "clean")), merchants)
    assert "SortMergeJoin" not in plan(prepared)
    assert [r.merchant_id for r in prepared.collect()] == [1]


def test_feeds_are_written_compressed(spark, tmp_path, feed, monkeypatch):
    monkeypatch.setattr(raw_source, "ROWS_PER_RAW_FILE", 2)
    rows_in = feed(*[{"id": f"{i:03}", "name": 'a "b", c'} for i in range(5)]).coalesce(1)
    raw_source.write_raw_files(rows_in, str(tmp_path / "feed"))
    assert len(list((tmp_path / "feed").glob("part-*.csv.gz"))) == 3
    scanned = raw_source.scan_raw_prices(spark, str(tmp_path / "feed")).drop(raw_source.MALFORMED)
    assert Counter(map(tuple, scanned.collect())) == Counter(map(tuple, rows_in.collect()))


def test_only_load_keys_are_shuffled_for_the_layout(spark, tmp_path, feed, monkeypatch):
    """Date, year and month follow from the key and are added after the shuffle, or are never moved."""
    plans, write = {}, Warehouse._write

    def kept(self, rows, *folder, **options):
        plans["/".join(folder)] = plan(rows)
        write(self, rows, *folder, **options)

    monkeypatch.setattr(Warehouse, "_write", kept)
    store = Warehouse(spark, str(tmp_path))
    clean = cleaning.clean(feed({"id": "a"}, {"id": "b", "prices.dateSeen": "2021-02-03"})).localCheckpoint()
    for _ in range(2):
        store.load(clean)
        assert "observed_date" not in plans["staged/numbered"].split("Exchange rangepartitioning")[1]
    assert "observed_date" not in plans["staged/facts"]
    dates = store.price_history().select("product_id", "observed_year", "observed_month", F.col("observed_date").cast("string"))
    assert sorted(map(tuple, dates.collect())) == [("a", 2020, 1, "2020-01-01"), ("b", 2021, 2, "2021-02-03")]
