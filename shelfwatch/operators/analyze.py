"""KPIs, distributions, rankings and price movement over cleaned products."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions.price import money, price_band, round_half_even
from shelfwatch.functions.product import availability_status, star_label
from shelfwatch.operators.ranks import exact_median
from shelfwatch.runtime import materialize
from shelfwatch.schema import PRICE_BANDS

_BANDS = [label for label, _, _ in PRICE_BANDS]


def summarize(df: DataFrame) -> DataFrame:
    """Counts and sums per (category, currency, status, stars, price band).

    One scan and one shuffle; the KPI totals, the category table and all
    distributions are sums over this small table.
    """
    price, rating = F.col("price"), F.col("rating")
    return df.groupBy(
        "category",
        "currency",
        "availability_status",
        F.rint("rating").alias("stars"),
        price_band(price).alias("band"),
    ).agg(
        F.count("*").alias("n"),
        F.count(price).alias("n_price"),
        F.sum(price).alias("sum_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.count(rating).alias("n_rating"),
        F.sum(rating).alias("sum_rating"),
    )


def summarize_tally(tally: DataFrame) -> DataFrame:
    """:func:`summarize` from counts: each row of *tally* stands for ``n`` products."""
    price, rating, n = F.col("price"), F.col("rating"), F.col("n")

    def counted(value: Column) -> Column:
        return F.coalesce(F.sum(F.when(value.isNotNull(), n)), F.lit(0))

    return tally.groupBy(
        "category",
        "currency",
        availability_status(F.col("availability")).alias("availability_status"),
        F.rint("rating").alias("stars"),
        price_band(price).alias("band"),
    ).agg(
        F.sum(n).alias("n"),
        counted(price).alias("n_price"),
        F.sum(price * n).alias("sum_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        counted(rating).alias("n_rating"),
        F.sum(rating * n).alias("sum_rating"),
    )


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")


def _mean(total: str, count: str) -> Column:
    return money(F.sum(total) / F.nullif(F.sum(count), F.lit(0)))


def kpis(
    df: DataFrame, summary: DataFrame | None = None, unique_urls: bool = False, weight: str | None = None
) -> DataFrame:
    """The headline figures as one row; an empty input gives zeros and nulls.

    Each distinct count and the median is an aggregation of its own over the one
    column it needs, so nothing is expanded and no value set sits in one task.
    With *unique_urls* (cleaned rows) counting rows is enough for the URLs. With
    *weight* a row stands for so many products; pass its *summary* then, too.
    """
    if summary is None:
        # Three passes follow; the columns they read are worked out once.
        df = materialize(df.select(*_KPI_INPUT), "kpi-rows")
        summary = materialize(summarize(df), "summary")
    status = F.col("availability_status")
    totals = summary.agg(
        _total("n").alias("total_products"),
        _mean("sum_price", "n_price").alias("avg_price"),
        money(F.min("min_price")).alias("min_price"),
        money(F.max("max_price")).alias("max_price"),
        _mean("sum_rating", "n_rating").alias("avg_rating"),
        F.coalesce(F.sum(F.when(status == "Available", F.col("n"))), F.lit(0)).alias("in_stock"),
        F.coalesce(F.sum(F.when(status == "Unavailable", F.col("n"))), F.lit(0)).alias(
            "out_of_stock"
        ),
        money(F.max("max_price") - F.min("min_price")).alias("price_span"),
    )
    if unique_urls:
        urls = summary.agg(_total("n").alias("unique_products"))
    else:
        urls = df.select("url").distinct().agg(F.count("url").alias("unique_products"))
    shelves = summary.select("category").distinct().agg(F.count("category").alias("categories"))
    middle = exact_median(df, "price", weight).select(money(F.col("median")).alias("median_price"))
    pieces = [totals, urls, shelves, most_common_currency(summary), middle]
    rows = pieces[0]
    for piece in pieces[1:]:
        rows = rows.unionByName(piece, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in _KPI_COLUMNS])


_KPI_INPUT = ["url", "price", "rating", "category", "currency", "availability_status"]
_KPI_COLUMNS = [
    "total_products",
    "unique_products",
    "categories",
    "currency",
    "avg_price",
    "median_price",
    "min_price",
    "max_price",
    "avg_rating",
    "in_stock",
    "out_of_stock",
    "price_span",
]


def most_common_currency(summary: DataFrame) -> DataFrame:
    """The most frequent currency, the smallest of several; no row if none is set."""
    return (
        summary.filter(F.col("currency").isNotNull())
        .groupBy("currency")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "currency")
        .limit(1)
        .select("currency")
    )


def by_category(summary: DataFrame) -> DataFrame:
    """Counts, prices and rating per category, largest first; null is a category."""
    in_stock = F.sum(F.when(F.col("availability_status") == "Available", F.col("n")))
    return (
        summary.groupBy("category")
        .agg(
            F.sum("n").alias("product_count"),
            F.coalesce(in_stock, F.lit(0)).alias("in_stock"),
            _mean("sum_price", "n_price").alias("avg_price"),
            money(F.min("min_price")).alias("min_price"),
            money(F.max("max_price")).alias("max_price"),
            _mean("sum_rating", "n_rating").alias("avg_rating"),
        )
        .orderBy(F.desc("product_count"), F.asc_nulls_last("category"))
    )


def availability_breakdown(summary: DataFrame, column: str = "availability_status") -> DataFrame:
    """Products per availability; null is counted apart and shown as Unknown."""
    count = F.sum("n") if "n" in summary.columns else F.count("*")
    return (
        summary.groupBy(F.col(column).alias("status"))
        .agg(count.alias("product_count"))
        .select(F.coalesce("status", F.lit("Unknown")).alias("availability"), "product_count")
        .orderBy(F.desc("product_count"), "availability")
    )


def rating_distribution(summary: DataFrame) -> DataFrame:
    """Products per rounded rating (ties to even), lowest first."""
    return (
        summary.filter(F.col("stars").isNotNull())
        .groupBy("stars")
        .agg(F.sum("n").alias("product_count"))
        .orderBy("stars")
        .select(star_label(F.col("stars")).alias("rating"), "product_count")
    )


def price_distribution(summary: DataFrame) -> DataFrame:
    """Products per price band, every band listed; no rows if nothing is priced."""
    counts = summary.agg(
        F.sum("n_price").alias("priced"),
        *[
            F.coalesce(F.sum(F.when(F.col("band") == b, F.col("n"))), F.lit(0)).alias(b)
            for b in _BANDS
        ],
    ).filter("priced > 0")
    return counts.unpivot("priced", _BANDS, "price_bucket", "product_count").drop("priced")


def top_rated(df: DataFrame, n: int = 10, order: str = "url") -> DataFrame:
    """The *n* best rated; cheaper first among equals, then by *order*."""
    return (
        df.filter(F.col("rating").isNotNull())
        .orderBy(F.desc("rating"), F.asc_nulls_last("price"), order)
        .limit(n)
        .select("name", "category", "rating", "price", "url")
    )


def cheapest(df: DataFrame, n: int = 10, order: str = "url") -> DataFrame:
    """The *n* lowest prices, ties by *order*."""
    return (
        df.filter(F.col("price").isNotNull())
        .orderBy("price", order)
        .limit(n)
        .select("name", "category", "price", "rating", "url")
    )


def price_changes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Price movement against the previous price of the same URL; 0.0 is listed."""
    priced = current.filter(F.col("price").isNotNull()).select("name", "category", "url", "price")
    return priced.join(previous.select("url", "previous_price"), "url").select(
        "name",
        "category",
        "previous_price",
        F.col("price").alias("current_price"),
        round_half_even(F.col("price") - F.col("previous_price")).alias("change"),
    )


@dataclass(frozen=True)
class Analysis:
    """All report tables of one run, still lazy but for the shared summary."""

    has_data: bool
    kpis: DataFrame
    by_category: DataFrame
    availability: DataFrame
    rating_distribution: DataFrame
    price_distribution: DataFrame
    top_rated: DataFrame
    cheapest: DataFrame
    price_changes: DataFrame


def analyze(
    df: DataFrame,
    changes: DataFrame,
    top_n: int = 10,
    order: str = "url",
    unique_urls: bool = False,
) -> Analysis:
    """Every table over one dataset; *changes* comes from :func:`price_changes`.

    An empty dataset is flagged by ``has_data`` and its tables are empty.
    """
    summary = materialize(summarize(df), "summary")
    has_data = not summary.isEmpty()
    headline = kpis(df, summary, unique_urls)
    return Analysis(
        has_data,
        headline if has_data else headline.limit(0),
        by_category(summary),
        availability_breakdown(summary),
        rating_distribution(summary),
        price_distribution(summary),
        top_rated(df, top_n, order),
        cheapest(df, top_n, order),
        changes,
    )
