"""Counts kept beside the snapshot, and price movement from keyed state."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest

from conftest import RECORD_DDL, record
from shelfwatch.operators import analyze as an
from shelfwatch.operators.derive import add_derived_columns
from shelfwatch.plans import tallies
from shelfwatch.plans.store import TALLIES, CatalogStore, ConstraintError
from shelfwatch.schema import TALLY_KEYS
from shelfwatch.streaming.moves import write_moves

DAY = datetime(2024, 5, 1, tzinfo=timezone.utc)


def batch(spark, rows):
    return spark.createDataFrame(rows, RECORD_DDL)


def write(store, rows, day):
    run = store.start_run(now=DAY + timedelta(days=day))
    store.write_batch(rows, run, "ord", DAY + timedelta(days=day))
    return run


def some_rows(rng, n, products):
    return [
        record(
            i, f"Item {slug}", f"item_{slug}", rng.choice([None, 1.0, 1.5, 12.25, 55.0]),
            category=rng.choice([None, "Home", "Garden"]), rating=rng.choice([None, 1.0, 4.5]),
            availability=rng.choice([None, "In stock", "Out of stock"]),
        )
        for i, slug in enumerate(rng.choices(range(products), k=n))
    ]


def counted(rows):
    return Counter({tuple(r[c] for c in TALLY_KEYS): r["n"] for r in rows.collect()})


def recounted(products):
    return Counter(tuple(r[c] for c in TALLY_KEYS) for r in products.collect())


def test_counts_equal_the_catalogue_after_every_run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tallies, "MOST_CHANGES", 2)
    monkeypatch.setattr(tallies, "SHARE", 0.9)
    store = CatalogStore(spark, str(tmp_path / "catalog"), parts=2)
    store.init()
    assert counted(store.tally()) == Counter()
    rng = random.Random(5)
    wanted, kinds = {}, set()
    for day, n in enumerate([120, 6, 5, 4, 3, 5, 60, 2]):
        run = write(store, batch(spark, some_rows(rng, n, 90)), day)
        wanted[run] = recounted(store.snapshot())
        assert counted(store.tally()) == wanted[run]
        event = store.log.stored_event(run)
        versions = store.log.versions_of(event, TALLIES)
        kinds |= {(v.base, TALLIES in event["merged"]) for v in versions}
    assert kinds == {(True, False), (False, False), (False, True)}  # bases, changes, merged changes
    again = CatalogStore(spark, store.root)  # from the log alone
    for run in list(wanted)[1:]:
        assert counted(again.tally(before=run)) == wanted[run - 1]


def test_a_small_batch_writes_few_counts(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "catalog"))
    store.init()
    write(store, batch(spark, [record(i, f"I{i}", f"item_{i}", float(i)) for i in range(300)]), 0)
    run = write(store, batch(spark, [record(1, "I7", "item_7", 7.5), record(2, "I8", "item_8", 8.0)]), 1)
    rows = spark.read.parquet(store.tallies.change_path(run)).select("price", "n").collect()
    assert sorted(map(tuple, rows)) == [(7.0, -1), (7.5, 1)]  # a product that stayed as it was adds nothing
    files = " ".join(store.tally().inputFiles())
    assert "/products" not in files and "/tallies" in files


def test_figures_of_the_store_equal_a_full_pass(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "catalog"))
    store.init()
    rng = random.Random(8)
    for day, n in enumerate([200, 20, 20]):
        write(store, batch(spark, some_rows(rng, n, 150)), day)
    whole = add_derived_columns(store.snapshot())
    full = an.summarize(whole)
    assert store.kpis().collect() == an.kpis(whole).collect()
    kept = store.summary()
    for table in (an.by_category, an.availability_breakdown, an.rating_distribution, an.price_distribution):
        assert table(kept).collect() == table(full).collect()


def test_figures_of_an_empty_store(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "catalog"))
    store.init()
    found = store.kpis().first()
    assert found["total_products"] == 0 and found["median_price"] is None
    write(store, batch(spark, []), 0)
    assert store.kpis().first()["unique_products"] == 0 and store.summary().isEmpty()
    write(store, batch(spark, [record(1, "Lamp", "lamp_1", 5.0)]), 1)
    assert store.kpis().first()["median_price"] == 5.0


def test_a_refused_run_counts_nothing_and_a_replay_once(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "catalog"))
    store.init()
    lamp = batch(spark, [record(1, "Lamp", "lamp_1", 5.0)])
    run = write(store, lamp, 0)
    store.write_batch(lamp, run, "ord", DAY)
    with pytest.raises(ConstraintError):
        write(store, batch(spark, [record(1, None, "desk_2", 6.0)]), 1)
    assert counted(store.tally()) == recounted(store.snapshot())
    assert store.kpis().first()["total_products"] == 1


def test_a_store_from_before_the_counts_gets_them(spark, tmp_path, monkeypatch):
    store = CatalogStore(spark, str(tmp_path / "catalog"))
    store.init()
    rng = random.Random(3)
    with monkeypatch.context() as old:
        old.setattr(tallies.Tallies, "write", lambda *args: ([], False))
        write(store, batch(spark, some_rows(rng, 40, 30)), 0)
    assert counted(store.tally()) == recounted(store.snapshot())
    write(store, batch(spark, some_rows(rng, 10, 30)), 1)
    assert store.log.state()[TALLIES].bases
    assert counted(store.tally()) == recounted(store.snapshot())


def test_old_counts_go_with_keep(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tallies, "SHARE", 0.0)  # every run writes a base
    store = CatalogStore(spark, str(tmp_path / "catalog"), keep=1)
    store.init()
    rng = random.Random(4)
    for day in range(4):
        last = write(store, batch(spark, some_rows(rng, 20, 30)), day)
    assert counted(store.tally()) == recounted(store.snapshot())
    assert [run for run in range(1, last + 1) if store.log.exists(store.tallies.base_path(run, 0))] == [last - 1, last]
    assert counted(store.tally(before=last)) == recounted(store.snapshot(before=last))


# -- price movement from keyed state -------------------------------------------
@pytest.fixture
def deliver(spark, tmp_path):
    """Appends a file to a stream, runs the stream to its end, returns all moves so far."""

    def deliver(rows, **extra):
        frame = batch(spark, rows)
        for name, value in extra.items():
            frame = frame.selectExpr("*", f"{value} AS {name}")
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "landing"))
        stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "landing"))
        write_moves(stream, "ord", str(tmp_path / "moves"), str(tmp_path / "offsets")).awaitTermination()
        schema = "url string, name string, previous_price double, current_price double, change double"
        moves = spark.read.schema(schema).parquet(str(tmp_path / "moves"))
        return sorted((r["name"], r["previous_price"], r["current_price"], r["change"]) for r in moves.collect())

    return deliver


def test_moves_across_restarts(deliver):
    assert deliver([record(1, "Lamp", "lamp_1", 5.0), record(2, "Desk", "desk_2"), record(3, "Mug", "mug_3", 2.0)]) == []
    # A desk's first price moves nothing; a lamp without a price keeps the one it had.
    second = deliver([record(1, "Desk", "desk_2", 9.0), record(2, "Lamp", "lamp_1"), record(3, "Mug", "mug_3", 2.0)])
    assert second == [("Mug", 2.0, 2.0, 0.0)]
    third = deliver([record(1, "Lamp", "lamp_1", 5.25), record(2, "Desk", "desk_2", 8.1)])
    assert third == [("Desk", 9.0, 8.1, -0.9), ("Lamp", 5.0, 5.25, 0.25), *second]


def test_the_first_of_many_rows_counts(deliver):
    deliver([record(1, "Lamp", "lamp_1", 5.0)])
    many = [record(i, "Lamp", "lamp_1", float(i)) for i in range(30_000, 1, -1)]
    assert deliver(many) == [("Lamp", 5.0, 2.0, -3.0)]
    # The known price is that of the first row, too.
    assert deliver([record(1, "Lamp", "lamp_1", 3.0)]) == [("Lamp", 2.0, 3.0, 1.0), ("Lamp", 5.0, 2.0, -3.0)]


def test_odd_records_move_nothing(deliver):
    odd = [
        record(1, None, "lamp_1", 5.0), record(2, "  ", "desk_2", 4.0), record(3, "Mug", "mug_3", -1.0),
        (4, "Cup", None, 3.0, *[None] * 7), (5, "Pot", " ", 3.0, *[None] * 7),
    ]
    assert deliver(odd) == deliver(odd) == []
    assert deliver([]) == []


def test_extra_columns_and_clashing_names(deliver):
    clash = {"_order": "'x'", "change": "'y'", "previous_price": "1"}
    deliver([record(1, "Lamp", "lamp_1", 5.0)], **clash)
    assert deliver([record(1, "Lamp", "lamp_1", 6.0)], **clash) == [("Lamp", 5.0, 6.0, 1.0)]
