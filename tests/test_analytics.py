"""KPIs, distributions, rankings, price movement and order statistics."""

from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from shelfwatch.operators import analyze as an
from shelfwatch.functions.price import money
from shelfwatch.operators.ranks import exact_median, integer_slice, values_at_ranks

DDL = (
    "name string, url string, price double, currency string, category string, "
    "availability string, availability_status string, rating double"
)


@pytest.fixture
def shelf(spark):
    rows = [
        ("A", "u1", 10.0, "GBP", "Travel", None, "Available", 5.0),
        ("B", "u2", 30.0, "EUR", "Travel", None, "Available", 3.0),
        ("C", "u3", 55.0, "GBP", "Mystery", None, "Unavailable", 4.0),
        ("D", "u4", None, None, "Mystery", None, "Unknown", None),
    ]
    return spark.createDataFrame(rows, DDL)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], DDL)


def test_kpis(shelf):
    k = an.kpis(shelf).first()
    assert (k.total_products, k.unique_products, k.categories, k.currency) == (4, 4, 2, "GBP")
    assert (k.avg_price, k.median_price, k.min_price, k.max_price) == (31.67, 30.0, 10.0, 55.0)
    assert (k.price_span, k.avg_rating, k.in_stock, k.out_of_stock) == (45.0, 4.0, 2, 1)


def test_kpis_of_nothing(nothing):
    k = an.kpis(nothing).first()
    assert (k.total_products, k.unique_products, k.categories, k.in_stock) == (0, 0, 0, 0)
    assert k.currency is None and k.avg_price is None and k.median_price is None and k.price_span is None


def test_kpis_without_prices_and_with_copies(shelf):
    k = an.kpis(shelf.withColumn("price", F.lit(None).cast("double"))).first()
    assert k.avg_price is None and k.avg_rating == 4.0
    k = an.kpis(shelf.unionByName(shelf)).first()
    assert (k.total_products, k.unique_products) == (8, 4)


def test_currency_tie_takes_the_smallest(spark, shelf):
    tied = shelf.filter("name in ('A', 'B')")
    assert an.kpis(tied).first().currency == "EUR"


def test_by_category(spark, shelf):
    extra = spark.createDataFrame([("E", "u5", 1.0, None, None, None, "Unknown", None)], DDL)
    rows = {r.category: r for r in an.by_category(an.summarize(shelf.unionByName(extra))).collect()}
    assert set(rows) == {"Travel", "Mystery", None}
    travel = rows["Travel"]
    assert (travel.product_count, travel.in_stock, travel.avg_price) == (2, 2, 20.0)
    assert (travel.min_price, travel.max_price, travel.avg_rating) == (10.0, 30.0, 4.0)
    assert rows[None].avg_rating is None and rows["Mystery"].avg_price == 55.0


def test_distributions(shelf, nothing):
    summary = an.summarize(shelf)
    assert [tuple(r) for r in an.rating_distribution(summary).collect()] == [
        ("3 star", 1), ("4 star", 1), ("5 star", 1),
    ]
    assert {tuple(r) for r in an.price_distribution(summary).collect()} == {
        ("0-10", 0), ("10-20", 1), ("20-30", 0), ("30-40", 1), ("40-50", 0), ("50+", 1),
    }
    assert [tuple(r) for r in an.availability_breakdown(summary).collect()] == [
        ("Available", 2), ("Unavailable", 1), ("Unknown", 1),
    ]
    assert an.price_distribution(an.summarize(nothing)).count() == 0
    raw = an.availability_breakdown(shelf, "availability").collect()
    assert [tuple(r) for r in raw] == [("Unknown", 4)]


def test_half_ratings_round_to_even(spark):
    rows = [(str(i), f"u{i}", None, None, None, None, None, r) for i, r in enumerate([0.5, 1.5, 2.5, 3.5])]
    summary = an.summarize(spark.createDataFrame(rows, DDL))
    assert [tuple(r) for r in an.rating_distribution(summary).collect()] == [
        ("0 star", 1), ("2 star", 2), ("4 star", 1),
    ]


def test_rankings(spark, shelf):
    tie = spark.createDataFrame(
        [("E", "u5", 9.0, None, None, None, None, 5.0), ("F", "u6", None, None, None, None, None, 5.0)], DDL
    )
    rows = shelf.unionByName(tie)
    assert [r.name for r in an.top_rated(rows, 4).collect()] == ["E", "A", "F", "C"]
    assert [r.name for r in an.cheapest(rows, 2).collect()] == ["E", "A"]
    assert an.top_rated(rows).columns == ["name", "category", "rating", "price", "url"]
    assert an.cheapest(rows).columns == ["name", "category", "price", "rating", "url"]


def test_price_changes(spark, shelf):
    before = spark.createDataFrame([("u1", 12.0), ("u2", 30.0), ("u3", 50.0), ("u4", 1.0)], "url string, previous_price double")
    rows = {r.name: r.change for r in an.price_changes(shelf, before).collect()}
    assert rows == {"A": -2.0, "B": 0.0, "C": 5.0}
    assert an.price_changes(shelf, before.limit(0)).columns == [
        "name", "category", "previous_price", "current_price", "change",
    ]


def test_bundle(spark, shelf, nothing):
    none = spark.createDataFrame([], "url string, previous_price double")
    full = an.analyze(shelf, an.price_changes(shelf, none), top_n=2)
    assert full.has_data and full.kpis.first().total_products == 4
    assert full.top_rated.count() == 2 and full.price_changes.count() == 0
    empty = an.analyze(nothing, an.price_changes(nothing, none))
    assert not empty.has_data and empty.kpis.count() == 0 and empty.by_category.count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_exact_median(spark, seed):
    rnd = random.Random(seed)
    kinds = [
        lambda: round(rnd.uniform(0, 60), 2),
        lambda: rnd.choice([1.0, 2.0, 2.0, 1e12]),
        lambda: rnd.uniform(-1, 1) * 10 ** rnd.randrange(-300, 300),
    ]
    numbers = [kinds[seed]() for _ in range(rnd.choice([500, 501]))] + [0.0, 5e-324, -0.5, 1e300]
    df = spark.createDataFrame([(n,) for n in numbers] + [(None,)], "p double")
    assert exact_median(df, "p").first().median == pytest.approx(statistics.median(numbers), rel=1e-12)


@pytest.mark.parametrize("last_values", [1, 7])
def test_median_narrowed_to_few_values(spark, monkeypatch, last_values):
    monkeypatch.setattr("shelfwatch.operators.ranks.LAST_VALUES", last_values)
    numbers = [1.0 + i * 1e-9 for i in range(200)] + [1.001, 1.001, 1.005]
    df = spark.createDataFrame([(n,) for n in numbers], "p double")
    assert exact_median(df, "p").first().median == pytest.approx(statistics.median(numbers), rel=1e-15)


def test_figures_are_rounded_from_their_binary_value(spark):
    values = [57.025, 2.675, 0.125, -57.025, 1e15 + 0.3, float("nan"), float("inf"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.m for r in df.select("i", money(F.col("v")).alias("m")).orderBy("i").collect()]
    assert got[:5] == [round(v, 2) for v in values[:5]] and got[5] != got[5] and got[6:] == [float("inf"), None]


def test_nth_integer(spark):
    rnd = random.Random(9)
    numbers = [rnd.randrange(1 << 62) for _ in range(300)] + list(range(50))
    df = spark.createDataFrame([(n,) for n in numbers], "o long")
    for nth in (0, 10, 49, 50, 349):
        got = values_at_ranks(df, "o", lambda n: F.array(F.lit(nth).cast("bigint")), integer_slice)
        assert got.first()["value"] == sorted(numbers)[nth]
    beyond = values_at_ranks(df, "o", lambda n: F.array(F.lit(350).cast("bigint")), integer_slice)
    assert beyond.first() is None
