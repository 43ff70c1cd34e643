"""Cleaning: canonical columns, one row per URL, and quality counters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.functions.price import price_amount, price_currency
from shelfwatch.functions.product import canonical_label, rating_in_scale
from shelfwatch.functions.text import blank_to_null, collapse, number_or_null
from shelfwatch.functions.url import clean_url
from shelfwatch.operators.dedup import first_per_key
from shelfwatch.sources.records import add_missing_columns, normalize_headers, snake_case

_COLLAPSED = [
    "name",
    "currency",
    "category",
    "availability",
    "image_url",
    "source_product_id",
]


@dataclass(frozen=True)
class Cleaned:
    """The cleaned rows, a lazy one-row frame of counters, and schema notes."""

    frame: DataFrame
    counters: DataFrame
    notes: list[str] = field(default_factory=list)


def _tidy(col: Column) -> Column:
    return blank_to_null(collapse(col.cast("string")))


def _as_number(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.NumericType):
        return F.col(name).cast("double")
    return number_or_null(F.col(name).cast("string"))


def _timestamp(df: DataFrame, name: str) -> Column:
    """The column as an instant; text or a local time without a zone means UTC."""
    col, dtype = F.col(name), df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.NullType)):
        return col.cast("timestamp")
    zoneless = col.try_cast("timestamp_ntz")
    as_utc = F.convert_timezone(F.lit("UTC"), F.current_timezone(), zoneless).cast("timestamp")
    if not isinstance(dtype, T.StringType):
        return as_utc
    has_zone = F.rtrim(col).rlike(r":.*([A-Za-z]|[+-]\d{1,2}(:?\d{2})?)$")
    return F.when(has_zone, col.try_cast("timestamp")).otherwise(as_utc)


def _standardized(df: DataFrame) -> DataFrame:
    """All per-row steps but the URL; the ``_bad_*`` flags feed the counters.

    Done in three projections, so that a value several columns are made from is
    worked out once.
    """
    if isinstance(df.schema["price"].dataType, T.NumericType):
        raw, from_tag = F.nanvl(F.col("price").cast("double"), F.lit(None)), False
    else:
        raw, from_tag = F.col("price").cast("string"), True
    tidied = df.withColumns(
        {
            **{c: _tidy(F.col(c)) for c in _COLLAPSED},
            "_raw": raw,
            "_stars": F.nanvl(_as_number(df, "rating"), F.lit(None)),
            "scraped_at": _timestamp(df, "scraped_at"),
        }
    )
    raw, stars = F.col("_raw"), F.col("_stars")
    labelled = tidied.withColumns(
        {
            "_label": canonical_label(F.col("availability")),
            "_amount": price_amount(raw) if from_tag else raw,
            "image_url": clean_url(F.col("image_url")),
        }
    )
    tag_currency = price_currency(raw) if from_tag else F.lit(None).cast("string")
    return labelled.withColumns(
        {
            "currency": F.coalesce(F.col("currency"), tag_currency),
            "raw_price": raw.cast("string"),
            "price": F.col("_amount"),
            "rating": rating_in_scale(stars),
            "availability": F.col("_label"),
            "_bad_price": raw.isNotNull() & F.col("_amount").isNull(),
            "_bad_rating": F.coalesce(~stars.between(0, 5), F.lit(False)),
            "_relabelled": F.coalesce(F.col("availability") != F.col("_label"), F.lit(False)),
        }
    ).drop("_raw", "_stars", "_label", "_amount")


def standardize(df: DataFrame) -> DataFrame:
    """The per-row part of :func:`clean`, which a stream can go through, too: all rows stay."""
    full, _ = add_missing_columns(normalize_headers(df))
    keyed = full.withColumn("url", clean_url(F.col("url").cast("string")))
    return _standardized(keyed).drop("_bad_price", "_bad_rating", "_relabelled")


def clean(df: DataFrame, order: str) -> Cleaned:
    """Clean raw records; *order* names the unique column giving arrival order.

    Of several rows with one URL the first to arrive stays, even when it is then
    dropped for having no name. Only the URL is cleaned before that choice: what
    the shuffle carries are raw rows, and only the rows that stay are worked on.
    """
    named = normalize_headers(df)
    full, notes = add_missing_columns(named)
    order = snake_case(order)
    keyed = full.withColumn("url", clean_url(F.col("url").cast("string")))
    kept = first_per_key(keyed, ["url"], order).filter(F.col("url").isNotNull())
    frame = _standardized(kept).filter(F.col("name").isNotNull())
    return Cleaned(
        frame.drop("_bad_price", "_bad_rating", "_relabelled"),
        _counters(_standardized(keyed), order),
        notes,
    )


def _counters(rows: DataFrame, order: str) -> DataFrame:
    """Quality counters as one aggregate.

    Accumulator metrics count a task twice when its stage is run again, so these
    are plain aggregates: per URL first (partially aggregated before the one
    shuffle), then over all URLs.
    """
    per_url = rows.groupBy("url").agg(
        F.count("*").alias("n"),
        F.min_by(F.col("name").isNotNull(), order).alias("named"),
        F.count_if("_bad_price").alias("bad_price"),
        F.count_if("_bad_rating").alias("bad_rating"),
        F.count_if("_relabelled").alias("relabelled"),
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")

    return per_url.agg(
        total("n").alias("rows_in"),
        F.count_if(F.col("url").isNotNull() & F.col("named")).alias("rows_out"),
        (total("n") - F.count("*")).alias("duplicates_removed"),
        total("bad_price").alias("invalid_prices"),
        total("bad_rating").alias("invalid_ratings"),
        total("relabelled").alias("normalised_availability"),
    )
