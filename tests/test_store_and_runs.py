"""Stored catalogue, whole runs, reports and the streaming monitor."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import RECORD_DDL, record
from shelfwatch.operators import report
from shelfwatch.operators.derive import add_derived_columns
from shelfwatch.operators.prices import constraint_violations, previous_prices
from shelfwatch.plans import parted
from shelfwatch.plans.run import run_batch, run_pages, run_status
from shelfwatch.plans.store import CatalogStore, ConstraintError
from shelfwatch.schema import CSV_REPORT_COLUMNS, PRODUCT_COLUMNS
from shelfwatch.streaming.monitor import Monitor
from test_listings import ROOT, card, page, pages, sidebar

DAY = datetime(2024, 5, 1, tzinfo=timezone.utc)


@pytest.fixture
def store(spark, tmp_path):
    catalogue = CatalogStore(spark, str(tmp_path / "catalog"))
    catalogue.init()
    return catalogue


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), RECORD_DDL)


FIRST = [
    record(1, "Lamp", "lamp_1", 51.77, category="Home", availability="In stock", rating=3.0),
    record(2, "Desk", "desk_2", 53.74, category="Home"),
    record(3, "Chair", "chair_3"),
]


def write(store, rows, day, **options):
    run = store.start_run(now=DAY + timedelta(days=day))
    n = store.write_batch(rows, run, "ord", DAY + timedelta(days=day), **options)
    store.finish_run(run, "success", {"records_found": n}, DAY + timedelta(days=day))
    return run


def test_init_is_idempotent(spark, store):
    write(store, batch(spark, *FIRST), 0)
    store.init()
    assert store.count_products() == 3
    assert CatalogStore(spark, store.root).products().columns == PRODUCT_COLUMNS


def test_empty_store(store):
    assert store.count_products() == 0 and store.runs().count() == 0
    assert store.history().count() == 0 and store.previous_prices(1).count() == 0


def test_run_log(spark, store):
    one = store.start_run(now=DAY)
    two = store.start_run(now=DAY)
    store.finish_run(one, "partial", {"records_found": 5, "records_rejected": 1, "pages_visited": 2}, DAY)
    assert (one, two) == (1, 2)
    first, second = store.runs().collect()
    assert (first.id, first.status, first.records_found, first.pages_visited) == (1, "partial", 5, 2)
    assert (second.status, second.finished_at, second.records_found) == ("running", None, 0)
    assert store.run(1).first().status == "partial" and store.run(9).count() == 0


def test_upsert_keeps_first_seen_and_overwrites_with_nulls(spark, store):
    write(store, batch(spark, *FIRST), 0)
    changed = [
        record(1, "Lamp XL", "lamp_1", None),
        record(2, "Shelf", "shelf_4", 9.5),
    ]
    write(store, batch(spark, *changed), 1)
    rows = {r.source_product_id: r for r in store.products().collect()}
    assert set(rows) == {"lamp_1", "desk_2", "chair_3", "shelf_4"}
    lamp = rows["lamp_1"]
    assert (lamp.name, lamp.price, lamp.category, lamp.rating) == ("Lamp XL", None, None, None)
    assert lamp.last_seen_at - lamp.first_seen_at == timedelta(days=1)
    assert rows["desk_2"].last_seen_at == lamp.first_seen_at and rows["desk_2"].price == 53.74


def test_same_batch_twice(spark, store):
    rows = batch(spark, *FIRST)
    write(store, rows, 0)
    run = write(store, rows, 1)
    assert store.count_products() == 3 and store.history().count() == 6
    previous = {r.source_product_id: r.previous_price for r in store.previous_prices(run).collect()}
    assert previous == {"lamp_1": 51.77, "desk_2": 53.74}
    assert store.previous_prices(1).count() == 0


def test_snapshot_lookup_equals_history_lookup(spark, store):
    prices = [(5.0, None, 3.0), (None, 2.0, 4.0), (6.0, None, None), (7.0, 8.0, 9.0)]
    for day, run in enumerate(prices):
        rows = [record(i, f"P{i}", f"p_{i}", p) for i, p in enumerate(run)]
        rows += [record(9, "P0 again", "p_0", None if day % 2 else 1.5)]
        write(store, batch(spark, *rows), day)
    for run in range(1, 6):
        fast = sorted(tuple(r) for r in store.previous_prices(run).collect())
        slow = sorted(tuple(r) for r in previous_prices(store.history(), run).collect())
        assert fast == slow
        assert slow == sorted(tuple(r) for r in store.previous_prices_from_history(run).collect())


def test_repeated_url_in_a_batch_keeps_the_last_row(spark, store):
    write(store, batch(spark, FIRST[0], record(7, "Lamp new", "lamp_1", 49.99)), 0)
    row = store.products().first()
    assert (row.name, row.price) == ("Lamp new", 49.99) and store.history().count() == 2


def test_broken_constraint_stores_nothing(spark, store):
    write(store, batch(spark, *FIRST), 0)
    clash = [record(1, "Other", "other_9", 1.0, source_product_id="lamp_1"), record(2, "New", "new_5", 2.0)]
    run = store.start_run()
    with pytest.raises(ConstraintError, match="lamp_1"):
        store.write_batch(batch(spark, *clash), run, "ord")
    assert store.count_products() == 3 and store.history().count() == 3
    assert store.previous_prices(run + 1).count() == 2
    write(store, batch(spark, record(1, "New", "new_5", 2.0)), 1)
    assert store.count_products() == 4


def test_replayed_run_changes_nothing(spark, store):
    run = write(store, batch(spark, *FIRST), 0)
    again = store.write_batch(batch(spark, record(1, "X", "x_1", 1.0)), run, "ord")
    assert again == 3 and store.count_products() == 3 and store.history().count() == 3


def _files(table, run):
    """Parts of the base a run wrote of a table, and its rows of changes."""
    bases = table.spark._jvm.java.io.File(table.base_path(run)).list() or []
    changes = table.spark._jvm.java.io.File(table.change_path(run)).exists()
    rows = table.spark.read.parquet(table.change_path(run)).count() if changes else 0
    return sum(n.startswith("part=") for n in bases), rows


def test_a_batch_writes_what_it_changes(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "catalog"), parts=4)
    store.init()
    many = [record(i, f"P{i}", f"p_{i}", 1.0 + i) for i in range(400)]
    first = write(store, batch(spark, *many), 0)
    assert _files(store.product_table, first) == (4, 0) and _files(store.id_table, first) == (4, 0)
    # Scattered over all parts, and yet a row is written for each of its own only.
    some = [record(i, f"P{i} new", f"p_{i}", 3.0) for i in range(0, 400, 40)]
    run = write(store, batch(spark, *some), 1)
    assert _files(store.product_table, run) == (0, 10) and _files(store.id_table, run) == (0, 0)
    assert store.count_products() == 400 and store.snapshot(before=run).filter("price = 3.0").count() == 1
    assert store.products().filter("name like '% new' and price = 3.0").count() == 10
    previous = {r.source_product_id: r.previous_price for r in store.previous_prices(run).collect()}
    assert previous["p_40"] == 41.0 and len(previous) == 400
    changes = store.price_changes(run)
    assert changes.count() == 10 and {r.current_price for r in changes.collect()} == {3.0}
    # A part whose changes would pass a quarter of it is written anew, with them.
    most = [record(i, f"P{i}", f"p_{i}", 5.0) for i in range(0, 400, 3)]
    last = write(store, batch(spark, *most), 2)
    assert _files(store.product_table, last) == (4, 0) and store.price_changes(last).count() == len(most)
    assert store.products().filter("price = 5.0").count() == len(most) + 1
    # A writer that asks for another number of parts gets the store's own.
    other = CatalogStore(spark, store.root, parts=3)
    other.init()
    assert other.parts == 4
    gone = store.remove_superseded(last)
    counts = [path for path in gone if path.startswith((store.tallies.bases, store.tallies.changes))]
    assert len(gone) - len(counts) == 4 + 1 and store.count_products() == 400
    # The counts' first base, the second run's changes, and those that went into the new base.
    assert len(counts) == 3 and store.kpis().first()["total_products"] == 400


def plain_catalogue(runs):
    """url: (name, price, known price) after runs of (url, name, price)."""
    now = {}
    for rows in runs:
        for url, name, price in rows:
            known = price if price is not None else now.get(url, (None, None, None))[2]
            now[url] = (name, price, known)
    return now


def test_many_small_batches_equal_a_plain_catalogue(spark, tmp_path, monkeypatch):
    """Changes, bases and merged changes in every mixture, also as they were at any time."""
    monkeypatch.setattr(parted, "MOST_CHANGES", 2)
    store = CatalogStore(spark, str(tmp_path / "catalog"), parts=3, segment=8)
    store.init()
    draw, runs, ids = random.Random(3), [], []
    for day in range(9):
        size = 40 if day == 0 else draw.choice([1, 2, 3, 12])
        picked = draw.sample(range(50), size)
        rows = [record(i, f"P{i} {day}", f"p_{i}", draw.choice([None, 1.0 + day])) for i in picked]
        ids.append(write(store, batch(spark, *rows), day, unique_urls=True))
        runs.append([(r[2], r[1], r[3]) for r in rows])
        reader = CatalogStore(spark, store.root, segment=8)
        got = {r.url: (r["name"], r.price, r.known_price) for r in reader.snapshot().collect()}
        assert got == plain_catalogue(runs), day
    for day, run in enumerate(ids):
        got = {r.url: r.known_price for r in store.snapshot(before=run).collect()}
        assert got == {u: v[2] for u, v in plain_catalogue(runs[:day]).items()}
        assert store.price_changes(run).count() == sum(
            price is not None and plain_catalogue(runs[:day]).get(url, (0, 0, None))[2] is not None
            for url, _, price in runs[day]
        )
    fast = sorted(tuple(r) for r in store.previous_prices(ids[-1]).collect())
    assert fast == sorted(tuple(r) for r in store.previous_prices_from_history(ids[-1]).collect())


def test_old_versions_go_with_keep(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "catalog"), parts=2, keep=1)
    store.init()
    for day in range(4):
        rows = [record(i, f"P{i}", f"p_{i}", float(day)) for i in range(10)]
        run = write(store, batch(spark, *rows), day)
    kept = sorted(p.name for p in (tmp_path / "catalog" / "products").glob("run_id=*") if list(p.glob("part=*")))
    assert kept == [f"run_id={run - 1}", f"run_id={run}"] and store.count_products() == 10
    assert store.previous_prices(run).first().previous_price == 2.0


def test_the_log_reads_few_files_however_many_runs(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "catalog"), segment=8)
    store.init()
    for day in range(30):
        run = store.start_run(now=DAY, key=f"k/{day}")
        store.finish_run(run, "success", {"records_found": day}, DAY)
    reader = CatalogStore(spark, store.root, segment=8)
    read = []
    plain = reader.log._read_events
    reader.log._read_events = lambda *a: read.append(plain(*a)) or read[-1]
    assert reader.start_run(now=DAY) == 31 and reader.start_run(key="k/3") == 4
    assert max(map(len, read)) <= 8
    log = {r.id: r for r in reader.runs().collect()}
    assert len(log) == 31 and log[30].records_found == 29
    # A run taken up again is open until it is closed again.
    assert log[4].status == "running" and log[5].status == "success"


def test_ids_move_and_come_free(spark, store):
    write(store, batch(spark, *[record(i, f"P{i}", f"p_{i}", 1.0) for i in range(20)]), 0)
    moved = [record(1, "P1", "p_1", 1.0, source_product_id="other"), record(2, "N", "n_1", 1.0, source_product_id="p_1")]
    write(store, batch(spark, *moved), 1, unique_urls=True)
    run = store.start_run()
    with pytest.raises(ConstraintError, match="other"):
        store.write_batch(batch(spark, record(3, "N", "n_2", 1.0, source_product_id="other")), run, "ord")
    write(store, batch(spark, record(1, "P1", "p_1", 1.0, source_product_id=None)), 2)
    write(store, batch(spark, record(3, "N", "n_2", 1.0, source_product_id="other")), 3)
    got = sorted(r.source_product_id for r in store.products().collect() if r.source_product_id)
    assert got == sorted([f"p_{i}" for i in range(20)] + ["other"])


def test_a_batch_reads_only_the_id_parts_it_touches(spark, store, monkeypatch):
    write(store, batch(spark, *[record(i, f"P{i}", f"p_{i}", 1.0) for i in range(60)]), 0)
    asked = []
    for table in (store.product_table, store.id_table):
        plain = table.read
        monkeypatch.setattr(table, "read", lambda s, t=None, gone=False, plain=plain, table=table: (
            asked.append((table.keys[0], t)) or plain(s, t, gone)))
    write(store, batch(spark, record(1, "P1 new", "p_1", 2.0)), 1)
    assert {k for k, _ in asked} == {"url"} and all(len(t) == 1 for _, t in asked)
    asked.clear()
    write(store, batch(spark, record(1, "New", "n_1", 2.0)), 2)
    assert {k for k, _ in asked} == {"url", "source_product_id"} and all(len(t) == 1 for _, t in asked)


def test_id_clash_with_an_untouched_part(spark, store):
    write(store, batch(spark, *[record(i, f"P{i}", f"p_{i}", 1.0) for i in range(40)]), 0)
    run = store.start_run()
    clash = [record(i, "N", f"new_{i}", 1.0, source_product_id=f"p_{i}") for i in range(9)]
    with pytest.raises(ConstraintError, match="9 broken"):
        store.write_batch(batch(spark, *clash), run, "ord")
    listed = spark.read.parquet(f"{store.root}/violations/run_id={run}")
    assert listed.count() == 9 and store.count_products() == 40


def test_a_run_stored_late_comes_after_the_others(spark, store):
    early = store.start_run(now=DAY)
    late = write(store, batch(spark, record(1, "Lamp", "lamp_1", 5.0), FIRST[1]), 1)
    out = run_batch(store, batch(spark, FIRST[0]), "ord", run_id=early)
    assert (out.status, out.run_id) == ("success", early) and late > early
    assert {r["name"]: r.price for r in store.products().collect()} == {"Lamp": 51.77, "Desk": 53.74}
    assert [r.previous_price for r in out.analysis.price_changes.collect()] == [5.0]
    assert store.previous_prices(late).count() == 0 and store.previous_prices(early).count() == 2
    for run in (late, early):
        fast = sorted(tuple(r) for r in store.previous_prices(run).collect())
        assert fast == sorted(tuple(r) for r in store.previous_prices_from_history(run).collect())


def test_failed_analysis_closes_the_run(spark, store, sample, monkeypatch, tmp_path):
    def broken(*_, **__):
        raise RuntimeError("no analysis today")

    monkeypatch.setattr("shelfwatch.plans.run.analyze", broken)
    out = run_batch(store, sample, "ord", report_dir=str(tmp_path / "r"))
    assert out.status == "partial" and out.ok and "no analysis" in out.error
    assert store.runs().first().status == "partial" and store.count_products() == 3


def test_a_key_names_a_run(spark, store):
    one = store.start_run(key="a/0")
    assert store.start_run(key="b/0") == one + 1 and store.start_run(key="a/0") == one


def test_constraint_report(spark):
    rows = spark.createDataFrame(
        [("A", "u1", "1"), (None, "u1", "1"), ("B", "u2", None), ("C", None, None)],
        "name string, url string, source_product_id string",
    )
    found = {(r.constraint, r.key, r.n) for r in constraint_violations(rows).collect()}
    assert found == {
        ("required", "name", 1), ("required", "url", 1), ("unique url", "u1", 2), ("unique source_product_id", "1", 2),
    }


# -- whole runs ----------------------------------------------------------------
def test_status_rules():
    assert run_status(0, 3) == "no_data" and run_status(3, 0) == "success"
    assert run_status(3, 1) == "partial" and run_status(3, 0, report_failed=True) == "partial"
    assert run_status(3, 0, failed=True) == "failed"


def test_two_runs_and_reports(spark, store, sample, tmp_path):
    folder = str(tmp_path / "reports")
    first = run_batch(store, sample, "ord", report_dir=folder, source="shop", now=DAY)
    assert first.status == "success" and first.ok
    assert (first.records_scraped, first.records_accepted, first.records_stored) == (4, 4, 3)
    assert first.details["duplicates_removed_in_cleaning"] == 1
    assert first.analysis.price_changes.count() == 0

    second = batch(
        spark,
        record(1, "Lamp", "lamp_1", 48.0),
        record(2, "Desk", "desk_2", 53.74),
        record(3, "Chair", "chair_3", 44.10),
    )
    out = run_batch(store, second, "ord", report_dir=folder, source="shop", now=DAY + timedelta(days=1))
    assert out.run_id == 2 and store.count_products() == 3
    previous = {r.source_product_id: r.previous_price for r in store.previous_prices(2).collect()}
    assert previous == {"lamp_1": 51.77, "desk_2": 53.74}
    changes = {r.name: r.change for r in out.analysis.price_changes.collect()}
    assert changes == {"Lamp": -3.77, "Desk": 0.0}

    tables = {name: spark.read.parquet(f"{out.report_path}/{name}") for name in (
        "dashboard", "product_data", "category_analysis", "top_rated", "cheapest", "price_changes",
        "metadata", "chart_categories", "chart_availability", "chart_price",
    )}
    board = [(r.label, r.value) for r in tables["dashboard"].orderBy("pos").collect()]
    assert board[0] == ("Total products", "3") and board[9] == ("Average rating", "n/a") and len(board) == 10
    notes = [(r.label, r.value) for r in tables["metadata"].orderBy("pos").collect()]
    assert [label for label, _ in notes[5:]] == [
        "database", "duplicates_removed_in_cleaning", "records_rejected", "run_id",
    ]
    assert notes[0] == ("Generated at (UTC)", "2024-05-02 00:00:00 UTC") and notes[4][1] == "false"
    assert tables["price_changes"].count() == 2 and tables["cheapest"].first().price == 44.10
    log = store.runs().collect()
    assert [r.status for r in log] == ["success", "success"] and log[0].records_found == 4


def test_no_price_changes_table_without_changes(spark, store, sample, tmp_path):
    out = run_batch(store, sample, "ord", report_dir=str(tmp_path / "r"), now=DAY)
    assert not (tmp_path / "r" / "run_id=1" / "price_changes").exists()
    assert (tmp_path / "r" / "run_id=1" / "dashboard").exists() and out.csv_path.endswith("products_20240501_000000.csv")


def test_rejects_make_a_run_partial(spark, store):
    out = run_batch(store, batch(spark, FIRST[0], record(5, "  ", "x_1", 1.0)), "ord")
    assert (out.status, out.records_rejected, out.rejected.count()) == ("partial", 1, 1)


def test_no_valid_record(spark, store):
    out = run_batch(store, batch(spark, record(5, " ", "x_1", 1.0)), "ord")
    assert out.status == "no_data" and out.ok and out.analysis is None
    assert store.count_products() == 0 and store.runs().first().status == "no_data"


def test_storage_failure_fails_the_run(spark, store):
    rows = batch(spark, FIRST[0], record(2, "Other", "other_9", 1.0, source_product_id="lamp_1"))
    out = run_batch(store, rows, "ord")
    assert out.status == "refused" and not out.ok and "lamp_1" in out.error
    assert store.count_products() == 0 and store.runs().first().status == "refused"


def test_run_on_a_fresh_folder(spark, sample, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "new"))
    assert run_batch(store, sample, "ord").status == "success" and store.count_products() == 3


def test_failure_in_cleaning_closes_the_run(spark, store, sample, monkeypatch):
    def broken(*_):
        raise RuntimeError("no cleaning today")

    monkeypatch.setattr("shelfwatch.plans.run.clean", broken)
    out = run_batch(store, sample, "ord")
    assert out.status == "failed" and "no cleaning" in out.error
    assert store.runs().first().status == "failed"


def test_csv_failure_leaves_the_tables(spark, store, sample, tmp_path, monkeypatch):
    def broken(*_):
        raise OSError("disk full")

    monkeypatch.setattr("shelfwatch.operators.report.write_products_csv", broken)
    out = run_batch(store, sample, "ord", report_dir=str(tmp_path / "r"))
    assert out.status == "partial" and "disk full" in out.error and out.csv_path is None
    assert spark.read.parquet(f"{out.report_path}/dashboard").count() == 10


def test_report_failure_keeps_the_data(spark, store, sample, tmp_path):
    (tmp_path / "file").write_text("in the way")
    out = run_batch(store, sample, "ord", report_dir=str(tmp_path / "file"))
    assert out.status == "partial" and "report failed" in out.error and store.count_products() == 3


def test_run_from_pages(spark, store):
    site = {
        "index.html": page(side=sidebar("home")),
        "list/home-1.html": page(card("lamp_1", "Lamp", "£9.50"), card("desk_2", "Desk"), onward="home-2.html"),
    }
    out = run_pages(store, pages(spark, site), ROOT + "index.html", now=DAY)
    assert (out.status, out.records_stored) == ("success", 2)
    row = store.runs().first()
    assert (row.categories, row.pages_visited, row.pages_failed, row.records_found) == (1, 1, 1, 2)
    lost = run_pages(store, pages(spark, site), ROOT + "gone.html", now=DAY)
    assert lost.status == "failed" and store.runs().count() == 2 and store.count_products() == 2


# -- reports -------------------------------------------------------------------
def test_csv(spark, sample, tmp_path):
    rows = add_derived_columns(sample).withColumn("extra", F.lit(' pad "q", x '))
    path = report.write_products_csv(rows, str(tmp_path), DAY, "out.csv")
    parts = sorted((tmp_path / "out.csv").glob("*.csv"))
    assert parts and all(p.read_bytes().startswith(b"\xef\xbb\xbfname,url") for p in parts)
    back = spark.read.options(header=True, escape='"').csv(path)
    assert back.columns == [*CSV_REPORT_COLUMNS, "ord", "extra"] and back.count() == 4
    assert back.first().extra == ' pad "q", x ' and back.filter("price is null").count() == 1


def test_empty_csv_has_a_header(spark, tmp_path):
    empty = add_derived_columns(spark.createDataFrame([], RECORD_DDL)).drop("ord")
    report.write_products_csv(empty, str(tmp_path), DAY, "empty.csv")
    (part,) = (tmp_path / "empty.csv").glob("*.csv")
    assert part.read_text("utf-8-sig").strip() == ",".join(CSV_REPORT_COLUMNS)


def test_column_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "z int, url int, name int")
    assert report.product_sheet(df).columns == ["name", "url"]
    assert report.product_csv(df).columns == ["name", "url", "z"]


def test_chart_takes_the_ten_largest(spark):
    rows = [(f"c{i:02d}", i, float(i)) for i in range(15)]
    df = spark.createDataFrame(rows, "category string, product_count long, avg_price double")
    top = report.chart_top_categories(df)
    assert [r.category for r in top.collect()] == [f"c{i:02d}" for i in range(14, 4, -1)]


# -- streaming -----------------------------------------------------------------
def test_monitor_runs_each_batch_once(spark, store, tmp_path):
    landing = str(tmp_path / "landing")
    schema = batch(spark, *FIRST).schema
    monitor = Monitor(store, "ord")
    for rows in (FIRST, [record(1, "Lamp", "lamp_1", 48.0), record(2, "Chair", "chair_3", 44.1)]):
        batch(spark, *rows).write.mode("append").json(landing)
        stream = spark.readStream.schema(schema).json(landing)
        outcomes = monitor.run(stream, str(tmp_path / "offsets"))
        assert len(outcomes) == 1 and outcomes[0].status == "success"
    assert [r.id for r in store.runs().collect()] == [1, 2]
    assert store.count_products() == 3 and store.history().count() == 5
    changes = {r.name: r.change for r in outcomes[0].analysis.price_changes.collect()}
    assert changes == {"Lamp": -3.77}
    stream = spark.readStream.schema(schema).json(landing)
    assert monitor.run(stream, str(tmp_path / "offsets")) == []
    # Another checkpoint is another stream: its batch is stored, not taken for a replay.
    other = Monitor(store, "ord").run(stream, str(tmp_path / "other-offsets"))
    assert [o.run_id for o in other] == [3] and store.count_products() == 3 and store.history().count() > 5


def test_monitor_meets_a_store_with_runs(spark, store, tmp_path):
    run_batch(store, batch(spark, FIRST[0]), "ord")
    landing = str(tmp_path / "landing")
    batch(spark, FIRST[1]).write.json(landing)
    stream = spark.readStream.schema(batch(spark, *FIRST).schema).json(landing)
    (out,) = Monitor(store, "ord").run(stream, str(tmp_path / "offsets"))
    assert (out.run_id, out.status) == (2, "success") and store.count_products() == 2


def test_monitor_stops_at_a_failure_and_takes_the_batch_up_again(spark, store, tmp_path, monkeypatch):
    landing = str(tmp_path / "landing")
    batch(spark, *FIRST).write.json(landing)
    stream = spark.readStream.schema(batch(spark, *FIRST).schema).json(landing)
    monitor, write_batch = Monitor(store, "ord"), store.write_batch

    def broken(*_, **__):
        raise OSError("store is away")

    monkeypatch.setattr(store, "write_batch", broken)
    with pytest.raises(StreamingQueryException, match="store is away"):
        monitor.run(stream, str(tmp_path / "offsets"))
    assert store.count_products() == 0
    monkeypatch.setattr(store, "write_batch", write_batch)
    (out,) = monitor.run(stream, str(tmp_path / "offsets"))
    assert (out.run_id, out.status) == (1, "success") and store.count_products() == 3
    assert [r.status for r in store.runs().collect()] == ["success"]


def test_monitor_keeps_a_batch_that_comes_back_after_a_newer_run(spark, store, tmp_path, monkeypatch):
    landing = str(tmp_path / "landing")
    batch(spark, *FIRST[:2]).write.json(landing)
    stream = spark.readStream.schema(batch(spark, *FIRST).schema).json(landing)
    monitor, write_batch = Monitor(store, "ord"), store.write_batch

    def broken(*_, **__):
        raise OSError("store is away")

    monkeypatch.setattr(store, "write_batch", broken)
    with pytest.raises(StreamingQueryException, match="store is away"):
        monitor.run(stream, str(tmp_path / "offsets"))
    monkeypatch.setattr(store, "write_batch", write_batch)
    assert run_batch(store, batch(spark, FIRST[2]), "ord").run_id == 2
    (out,) = monitor.run(stream, str(tmp_path / "offsets"))
    assert (out.run_id, out.status) == (1, "success")
    assert sorted(r["name"] for r in store.products().collect()) == ["Chair", "Desk", "Lamp"]
    assert monitor.run(stream, str(tmp_path / "offsets")) == []


def test_monitor_passes_over_a_refused_batch(spark, store, tmp_path):
    landing, schema = tmp_path / "landing", batch(spark, *FIRST).schema
    rows = [[FIRST[0], record(2, "Other", "other_9", 1.0, source_product_id="lamp_1")], [FIRST[1]]]
    for i, part in enumerate(rows):
        batch(spark, *part).coalesce(1).write.json(str(landing / f"d{i}"))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    stream = stream.option("maxFilesPerTrigger", 1).json(str(landing))
    out = Monitor(store, "ord", keep=1).run(stream, str(tmp_path / "offsets"))
    assert sorted(r.status for r in store.runs().collect()) == ["refused", "success"]
    assert len(out) == 1 and store.count_products() == 1


def test_monitor_stops_after_a_number_of_runs(spark, store, tmp_path):
    landing = tmp_path / "landing"
    schema = batch(spark, *FIRST).schema
    for i in range(3):
        batch(spark, record(1, f"P{i}", f"p_{i}", 1.0)).coalesce(1).write.json(str(landing / f"d{i}"))
    stream = lambda: (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", True)
        .json(str(landing))
    )
    monitor = Monitor(store, "ord")
    assert len(monitor.run(stream(), str(tmp_path / "offsets"), max_runs=2)) == 2
    assert store.count_products() == 2
    rest = monitor.run(stream(), str(tmp_path / "offsets"))
    assert [o.run_id for o in rest] == [3] and store.count_products() == 3


def test_history_is_not_dealt_by_run(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "catalog"))
    store.init()
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, -1)
    try:
        plan = store.history()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
