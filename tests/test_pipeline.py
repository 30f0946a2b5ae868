import itertools
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from pricetide import session
from pricetide.errors import FeedRejected, LoadRejected, SharedFolderMissing
from pricetide.operators import cleaning
from pricetide.operators.quality import quality_trend
from pricetide.plans import replay
from pricetide.plans.ledger import RunLedger, run_summary
from pricetide.plans.pipeline import run_pipeline
from pricetide.sources import raw as raw_source
from pricetide.sources.warehouse import Warehouse
from pricetide.streaming.incremental import load_arrivals

HEADER = (
    "id,name,brand,categories,prices.amountMin,prices.amountMax,prices.currency,"
    "prices.dateSeen,prices.merchant,prices.condition"
)


def write(path, *lines, header=HEADER):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return str(path)


def line(product="p", low="1", high="2", date="2020-01-01", merchant="shop", currency="USD"):
    return f"{product},name,brand,cat,{low},{high},{currency},{date},{merchant},new"


def stored(spark, root):
    rows = Warehouse(spark, root).facts()
    return sorted(
        (r.product_id, r.merchant_name, r.observed_at, r.price, r.currency) for r in rows.collect()
    )


def test_csv_dialect(spark, tmp_path):
    path = write(
        tmp_path / "a.csv",
        '1,"a, ""quoted"" name",NA, NA,1,2,USD,"2020-01-01,2020-01-02",shop,x',
        "",
        '2,"two\nlines","",b,n/a,2,null,2020-01-01,shop,',
        header=HEADER,
    )
    rows = raw_source.scan_raw_prices(spark, path, multiline=True).collect()
    assert len(rows) == 2
    assert rows[0]["name"] == 'a, "quoted" name'
    assert (rows[0]["brand"], rows[0]["categories"]) == (None, " NA")
    assert rows[0]["prices.dateSeen"] == "2020-01-01,2020-01-02"
    assert rows[1]["name"] == "two\nlines"
    assert [rows[1][c] for c in ("brand", "prices.amountMin", "prices.currency", "prices.condition")] == [None] * 4


def test_ids_stay_text_and_extra_columns_are_kept(spark, tmp_path):
    path = write(tmp_path / "a.csv", "001,n,b,c,1.0,2,USD,2020-01-01,s,new,more", header=HEADER + ",extra")
    row = raw_source.scan_raw_prices(spark, path).first()
    assert (row["id"], row["prices.amountMin"], row["extra"]) == ("001", "1.0", "more")


def test_missing_file(spark, tmp_path):
    with pytest.raises(LoadRejected, match="cannot be read"):
        raw_source.scan_raw_prices(spark, str(tmp_path / "none.csv"))


def test_landing_keeps_text_and_repeats_safely(spark, tmp_path):
    path = write(tmp_path / "a.csv", line(low="n/a"), line())
    table = str(tmp_path / "raw")
    for _ in range(2):
        landed = raw_source.land_raw(spark, path, table, "b1")
    assert landed.count() == 2
    raw_text = spark.read.parquet(table)
    assert raw_text.where("`prices.amountMin` = 'n/a'").count() == 1
    row = landed.first()
    assert row._batch_id == "b1" and row._source_file.endswith("a.csv") and row._ingested_at is not None


def test_pipeline_loads_once(spark, tmp_path):
    path = write(tmp_path / "a.csv", line(), line(), line(date='"2020-01-01, 2020-02-01"'), line(date="bad"), line(merchant=""))
    root = str(tmp_path / "store")
    first = run_pipeline(spark, path, root)
    assert (first.load.received, first.load.inserted, first.load.rejected) == (4, 2, 1)
    assert first.load.skipped == 1
    again = run_pipeline(spark, path, root)
    assert again.load.inserted == 0
    assert len(stored(spark, root)) == 2
    runs = {r.run_id: r for r in RunLedger(spark, root).runs().collect()}
    assert [runs[i].status for i in (1, 2)] == ["SUCCESS", "SUCCESS"]
    assert (runs[1].records_received, runs[1].records_transformed, runs[1].records_loaded) == (5, 4, 2)
    assert runs[1].completed_at >= runs[1].started_at
    summary = run_summary(RunLedger(spark, root).runs()).first()
    assert (summary.runs, summary.records_received, summary.records_loaded) == (2, 10, 2)
    history = Warehouse(spark, root).price_history()
    assert history.select("price_id").distinct().count() == history.count() == 2


def test_strict_failure_is_recorded_and_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "store")
    run_pipeline(spark, write(tmp_path / "a.csv", line()), root)
    bad = write(tmp_path / "b.csv", line(product="q", date="2020-05-01"), line(low="x"))
    with pytest.raises(FeedRejected, match="null_prices"):
        run_pipeline(spark, bad, root)
    run = RunLedger(spark, root).runs().where("run_id = 2").first()
    assert (run.status, run.records_received, run.records_loaded) == ("FAILED", 2, 0)
    assert "null_prices" in run.error_message
    assert len(stored(spark, root)) == 1
    assert spark.read.json(f"{root}/reports/batch=2").first().status == "FAILED"
    kept = run_pipeline(spark, bad, root, policy="quarantine")
    assert kept.load.inserted == 1
    assert spark.read.parquet(f"{root}/failed/batch=3").first().reject_reason == "price_missing"


def test_missing_source_and_column_fail_the_run(spark, tmp_path):
    root = str(tmp_path / "store")
    with pytest.raises(LoadRejected):
        run_pipeline(spark, str(tmp_path / "none.csv"), root)
    short = write(tmp_path / "s.csv", "1,n", header="id,name")
    with pytest.raises(FeedRejected, match="Missing required columns"):
        run_pipeline(spark, short, root)
    assert [r.status for r in RunLedger(spark, root).runs().collect()] == ["FAILED", "FAILED"]


def test_blank_product_fails_a_strict_load(spark, tmp_path, feed):
    root = str(tmp_path / "store")
    clean = cleaning.clean(feed({"id": " "}, {"id": "a"}))
    with pytest.raises(LoadRejected, match="no product id"):
        Warehouse(spark, root).load(clean, policy="strict")
    assert Warehouse(spark, root).price_history().count() == 0
    result = Warehouse(spark, root).load(clean)
    assert (result.inserted, result.rejected) == (1, 1)


def test_uncommitted_load_is_invisible_and_repeatable(spark, tmp_path, feed, monkeypatch):
    root = str(tmp_path / "store")
    clean = cleaning.clean(feed({"id": "a"}))
    store = Warehouse(spark, root)
    monkeypatch.setattr("pricetide.sources.warehouse.require_loadable", lambda rows: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.load(clean)
    assert store.products().count() == store.merchants().count() == store.price_history().count() == 0
    monkeypatch.undo()
    assert store.load(clean).inserted == 1
    with pytest.raises(LoadRejected, match="already committed"):
        store.load(clean, load=1)


def test_order_of_overlapping_batches_does_not_matter(spark, tmp_path):
    one = write(tmp_path / "1.csv", line("a"), line("b", date="2020-03-01"))
    two = write(tmp_path / "2.csv", line("b", date="2020-03-01"), line("c", merchant="other"))
    results = []
    for i, order in enumerate(itertools.permutations([one, two])):
        root = str(tmp_path / f"store{i}")
        for path in order:
            run_pipeline(spark, path, root)
        results.append(stored(spark, root))
    assert results[0] == results[1]
    assert len(results[0]) == 3


def test_products_change_and_merchants_keep_their_ids(spark, tmp_path):
    root = str(tmp_path / "store")
    run_pipeline(spark, write(tmp_path / "1.csv", line("a", merchant="m1"), line("b", merchant="m2")), root)
    before = {r.merchant_name: r.merchant_id for r in Warehouse(spark, root).merchants().collect()}
    changed = line("a", merchant="m0", date="2020-02-01").replace("name", "renamed")
    run_pipeline(spark, write(tmp_path / "2.csv", changed), root)
    after = {r.merchant_name: r.merchant_id for r in Warehouse(spark, root).merchants().collect()}
    assert {k: after[k] for k in before} == before
    assert sorted(after.values()) == [1, 2, 3]
    names = {r.product_id: r.product_name for r in Warehouse(spark, root).products().collect()}
    assert names == {"a": "renamed", "b": "name"}
    products = Warehouse(spark, root).products().where("product_id = 'a'").first()
    assert products.updated_at > products.created_at


def test_stream_equals_batch_in_any_order_with_repeats(spark, tmp_path):
    lines = [line(f"p{i % 7}", high=str(2 + i % 3), date=f"2020-0{1 + i % 5}-01", merchant=f"m{i % 4}") for i in range(60)]
    batch_root = str(tmp_path / "batch")
    run_pipeline(spark, write(tmp_path / "all.csv", *lines), batch_root)
    root, folder = str(tmp_path / "stream"), tmp_path / "arrivals"
    arrivals = [lines[40:], lines[:25], lines[20:45], lines[40:]]
    for i, part in enumerate(arrivals):
        write(folder / f"{i}.csv", *part)
        if i % 2:
            load_arrivals(spark, str(folder), root, max_files=1).awaitTermination()
    assert stored(spark, root) == stored(spark, batch_root)
    loads = Warehouse(spark, root).commits().orderBy("load").collect()
    assert len(loads) == 4 and loads[-1].inserted == 0


def test_facts_are_laid_out_by_month(spark, tmp_path):
    root = str(tmp_path / "store")
    run_pipeline(spark, write(tmp_path / "1.csv", *[line(date=f"2020-0{m}-01") for m in range(1, 7)]), root)
    facts = Warehouse(spark, root).price_history().where("observed_year = 2020 and observed_month = 3")
    assert facts.count() == 1
    assert facts.first().observed_at == datetime(2020, 3, 1)
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "observed_month" in plan.split("PartitionFilters")[1][:300]
    assert facts.agg(F.max("price_id")).first()[0] >= 1


def test_validated_rows_count_copies(spark, tmp_path):
    path = write(tmp_path / "a.csv", line(), *[line(low="x")] * 3)
    root = str(tmp_path / "store")
    run_pipeline(spark, path, root, policy="quarantine")
    run = RunLedger(spark, root).runs().first()
    assert (run.records_received, run.records_validated, run.records_loaded) == (4, 1, 1)


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    names = HEADER.split(",")
    write(tmp_path / "feed" / "a.csv", line("p1"))
    turned = dict(zip(names, line("p2").split(",")))
    write(tmp_path / "feed" / "b.csv", ",".join(turned[n] for n in reversed(names)), header=",".join(reversed(names)))
    rows = raw_source.scan_raw_prices(spark, str(tmp_path / "feed")).orderBy("id").collect()
    assert [(r.id, r.name, r["prices.merchant"]) for r in rows] == [("p1", "name", "shop"), ("p2", "name", "shop")]


def test_rows_that_do_not_fit_are_set_aside(spark, tmp_path):
    path = write(tmp_path / "a.csv", line("a"), line("b") + ",x,y", '"c","two', 'lines",brand', line("d"))
    root = str(tmp_path / "store")
    with pytest.raises(FeedRejected, match="row_malformed: 3"):
        run_pipeline(spark, path, root)
    result = run_pipeline(spark, path, root, policy="quarantine")
    assert result.load.inserted == 2
    kept = spark.read.parquet(f"{root}/failed/batch=2").where("reject_reason = 'row_malformed'")
    assert sorted(r.row_text for r in kept.collect()) == sorted([line("b") + ",x,y", '"c","two', 'lines",brand'])


def test_stream_keeps_rejects_of_every_batch_and_a_run_each(spark, tmp_path):
    root, folder = str(tmp_path / "stream"), tmp_path / "arrivals"
    for i in range(2):
        write(folder / f"{i}.csv", line(f"p{i}"), line(f"p{i}", low="x"))
        load_arrivals(spark, str(folder), root).awaitTermination()
    rejects = spark.read.parquet(f"{root}/failed")
    assert sorted(r.product_id for r in rejects.collect()) == ["p0", "p1"]
    runs = RunLedger(spark, root).runs().orderBy("run_id").collect()
    assert [(r.status, r.records_received, r.records_loaded) for r in runs] == [("SUCCESS", 2, 1)] * 2
    assert spark.read.json(f"{root}/reports").count() == 2


def test_a_batch_that_was_committed_is_not_loaded_again(spark, tmp_path, feed):
    store, clean = Warehouse(spark, str(tmp_path / "store")), cleaning.clean(feed({"id": "a"}))
    first = store.load(clean, batch="stream-0")
    assert store.load(clean, batch="stream-0") == first and store.has("stream-0") and not store.has("stream-1")
    assert store.commits().count() == 1


def test_shared_folder_is_never_guessed(spark, tmp_path):
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=spark.sparkContext)
    with pytest.raises(SharedFolderMissing, match="spark.checkpoint.dir"):
        session.shared_folder(bare, "x")
    assert session.shared_folder(bare, "x", str(tmp_path)).startswith(str(tmp_path))


def test_a_small_batch_does_not_shuffle_the_store(spark, tmp_path, feed):
    from pricetide.operators.facts import new_facts
    from pricetide.schema import LOAD_KEY

    rows = [(f"p{i % 50}", 1, datetime(2020, 1, 1 + i % 28), 1.0, 1.0, 1.0, "USD", str(i)) for i in range(500)]
    columns = ["product_id", "merchant_id", "observed_at", "price", "price_min", "price_max", "currency", "condition"]
    stored = spark.createDataFrame(rows, columns).select(*LOAD_KEY)
    stored.write.parquet(str(tmp_path / "stored"))
    stored.limit(5).write.parquet(str(tmp_path / "batch"))
    fresh = new_facts(spark.read.parquet(str(tmp_path / "batch")), spark.read.parquet(str(tmp_path / "stored")))
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and fresh.count() == 0


# --- headers -----------------------------------------------------------------------------------


def test_headers_are_kept_and_the_feed_is_scanned_once(spark, tmp_path):
    names = HEADER.split(",")
    write(tmp_path / "feed" / "a.csv", line("p1"))
    write(tmp_path / "feed" / "b.csv", ",".join(reversed(line("p2").split(","))), header=",".join(reversed(names)))
    (tmp_path / "feed" / "empty.csv").write_text("")
    table = str(tmp_path / "raw")
    rows = raw_source.scan_for_landing(spark, str(tmp_path / "feed"), table, "b1")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2 and "Exchange" not in plan  # one scan for each kind of header
    raw_source.write_landed(rows, table, "b1")
    kept = {r.file.rsplit("/", 1)[1]: r.header for r in raw_source.landed_headers(spark, table).collect()}
    assert kept == {"a.csv": HEADER, "b.csv": ",".join(reversed(names))}
    landed = raw_source.landed(spark, table, "b1").orderBy("id").collect()
    assert [(r.id, r["prices.merchant"], r._source_file.rsplit("/", 1)[1]) for r in landed] == [("p1", "shop", "a.csv"), ("p2", "shop", "b.csv")]


def test_many_files_share_a_look(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(raw_source, "FILES_PER_LOOK", 3)
    files = [write(tmp_path / f"{i}.csv", line(f"p{i}"), header=HEADER + (",more" if i % 2 else "")) for i in range(7)]
    found = raw_source.file_headers(spark, files)
    assert sorted((r.file, r.header.endswith("more")) for r in found.collect()) == [(f, bool(i % 2)) for i, f in enumerate(files)]
    assert raw_source.scan_raw_prices(spark, files).where("more is null").count() == 7


def test_stream_takes_files_of_any_column_order(spark, tmp_path):
    root, folder, names = str(tmp_path / "stream"), tmp_path / "arrivals", HEADER.split(",")
    write(folder / "0.csv", line("p0"))
    write(folder / "1.csv", ",".join(reversed(line("p1").split(","))), header=",".join(reversed(names)))
    load_arrivals(spark, str(folder), root).awaitTermination()
    write(folder / "2.csv", "x," + line("p2"), header="extra," + HEADER)
    load_arrivals(spark, str(folder), root).awaitTermination()
    assert [r[:2] for r in stored(spark, root)] == [("p0", "shop"), ("p1", "shop"), ("p2", "shop")]


# --- ledger ------------------------------------------------------------------------------------


def test_openers_never_share_a_number(spark, tmp_path):
    root = str(tmp_path / "store")
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda _: RunLedger(spark, root).open(), range(8)))
    assert sorted(set(numbers)) == sorted(numbers) and len(numbers) == 8
    assert sorted(r.run_id for r in RunLedger(spark, root).runs().collect()) == sorted(numbers)


def test_dead_runs_are_closed_by_age(spark, tmp_path):
    ledger = RunLedger(spark, str(tmp_path / "store"))
    ended, dead = ledger.open(), ledger.open()
    ledger.close(ended, "SUCCESS", {"records_loaded": 3})
    assert ledger.close_dead(3600) == []
    third = ledger.open(dead_after=0)
    runs = {r.run_id: r for r in ledger.runs().collect()}
    assert [runs[i].status for i in (ended, dead, third)] == ["SUCCESS", "FAILED", "RUNNING"]
    assert runs[dead].error_message == "The run ended without a result"
    assert runs[dead].completed_at >= runs[dead].started_at and runs[ended].records_loaded == 3


# --- products and ids --------------------------------------------------------------------------


def test_a_load_writes_its_own_products_only(spark, tmp_path, feed):
    store = Warehouse(spark, str(tmp_path / "store"))
    store.load(cleaning.clean(feed(*[{"id": f"p{i}"} for i in range(20)])))
    store.load(cleaning.clean(feed({"id": "p3", "name": "new"})))
    assert spark.read.parquet(f"{store.root}/products/load=2").count() == 1
    before = sorted(map(str, store.products().collect()))
    assert store.products().where("product_name = 'new' and updated_at > created_at").count() == 1
    assert store.compact_products() == 3
    assert sorted(map(str, store.products().collect())) == before and len(before) == 20
    assert "Aggregate" not in store.products()._jdf.queryExecution().executedPlan().toString()
    store.load(cleaning.clean(feed({"id": "p4", "name": "newer", "prices.merchant": "another"})))
    assert store.products().count() == 20 and store.products().where("product_name = 'newer'").count() == 1
    assert sorted(r.merchant_id for r in store.merchants().collect()) == [1, 2]


def test_ids_are_dense_and_the_same_after_a_retry(spark, tmp_path, feed, monkeypatch):
    rows = [{"id": f"p{i % 37}", "prices.dateSeen": f"20{10 + i % 9}-0{1 + i % 9}-01"} for i in range(300)]
    clean = cleaning.clean(feed(*rows))
    store = Warehouse(spark, str(tmp_path / "store"))
    monkeypatch.setattr("pricetide.sources.warehouse.require_loadable", lambda rows: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.load(clean)
    monkeypatch.undo()
    first = spark.read.parquet(f"{store.root}/price_history/load=1").select("product_id", "observed_at", "price_id")
    first = sorted(map(tuple, first.collect()))
    n = store.load(clean).inserted
    again = sorted(map(tuple, store.price_history().select("product_id", "observed_at", "price_id").collect()))
    assert again == first and sorted(r[2] for r in again) == list(range(1, n + 1))
    store.load(cleaning.clean(feed({"id": "late", "prices.dateSeen": "2031-01-01"})))
    assert store.price_history().where("product_id = 'late'").first().price_id == n + 1


# --- rejects -----------------------------------------------------------------------------------


def test_repaired_rejects_load_once(spark, tmp_path):
    path = write(tmp_path / "a.csv", line("a"), line("b", low="5", high="2"), line("c", low="x"), line("d", low="9", high="3", date="bad"))
    root = str(tmp_path / "store")
    run_pipeline(spark, path, root, policy="quarantine")
    low, high = F.col("`prices.amountMin`"), F.col("`prices.amountMax`")
    rules = {"price_range": {"prices.amountMin": high, "prices.amountMax": low}}
    run = replay.replay_rejects(spark, root, rules)
    assert (run.run_id, run.load.inserted) == (2, 1)
    assert replay.replay_rejects(spark, root, rules) is None
    states = {r.id: r.run_id for r in replay.reject_states(spark, root).collect()}
    assert states == {"b": 2, "c": None, "d": None}
    assert [(r[0], r[3]) for r in stored(spark, root)] == [("a", Decimal("1.50")), ("b", Decimal("3.50"))]


def test_reports_are_followed_from_batch_to_batch(spark, tmp_path):
    root = str(tmp_path / "store")
    for i, bad in enumerate([0, 1, 3]):
        run_pipeline(spark, write(tmp_path / f"{i}.csv", line(), *[line(low="x", product=f"q{k}") for k in range(bad)]), root, policy="quarantine")
    trend = quality_trend(spark.read.json(f"{root}/reports"), over=1).where("metric = 'null_price_rows'")
    rows = [(r.run_id, r.value, r.share, r.usual_share, r.change, r.first_failing) for r in trend.orderBy("run_id").collect()]
    assert rows == [(1, 0, 0.0, None, None, 2), (2, 1, 0.5, 0.0, 0.5, 2), (3, 3, 0.75, 0.5, 0.25, 2)]
