"""Ratings, availability and product identity as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwatch.functions.text import blank_to_null, collapse, label_lookup
from shelfwatch.schema import AVAILABILITY_LABELS, RATING_MAX, RATING_MIN, RATING_WORDS


def star_rating(class_text: Column) -> Column:
    """1 to 5 from a class attribute; the lowest number word present wins."""
    return F.coalesce(
        *[
            F.when(class_text.rlike(rf"(?iU)\b{word}\b"), F.lit(value))
            for word, value in RATING_WORDS.items()
        ]
    )


def rating_in_scale(rating: Column) -> Column:
    return F.when(rating.between(RATING_MIN, RATING_MAX), rating)


def rating_band(rating: Column) -> Column:
    return (
        F.when(rating.isNull() | F.isnan(rating), None)
        .when(rating < 3, "Low (1-2)")
        .when(rating < 4, "Medium (3)")
        .otherwise("High (4-5)")
    )


def star_label(stars: Column) -> Column:
    """``"4 star"`` for an already rounded rating."""
    return F.concat(stars.cast("bigint").cast("string"), F.lit(" star"))


def canonical_label(tidy: Column) -> Column:
    """Label of an already collapsed availability text; unknown text is kept."""
    return F.coalesce(label_lookup(AVAILABILITY_LABELS, F.lower(tidy)), tidy)


def canonical_availability(text: Column) -> Column:
    """Canonical label of a known phrase; other text is kept, blank is null."""
    return canonical_label(blank_to_null(collapse(text)))


def availability_status(text: Column) -> Column:
    """Available / Unavailable / Unknown by substring; "in stock" is tested first."""
    low = F.lower(text)

    def mentions(*phrases: str) -> Column:
        hit = F.lit(False)
        for phrase in phrases:
            hit = hit | low.contains(phrase)
        return hit

    return (
        F.when(mentions("in stock", "instock"), "Available")
        .when(mentions("out of stock", "outofstock"), "Unavailable")
        .otherwise("Unknown")
    )


def source_product_id(url: Column) -> Column:
    """Last path part, or the one before it when the last is an index page.

    Null when the URL has fewer than two non-empty parts.
    """
    trimmed = F.rtrim(url, F.lit("/"))
    last = F.substring_index(trimmed, "/", -1)
    head = F.substring(trimmed, F.lit(1), F.length(trimmed) - F.length(last))
    before = F.substring_index(F.rtrim(head, F.lit("/")), "/", -1)
    # With nothing before the last part there are fewer than two parts.
    return F.when(before != "", F.when(last.startswith("index"), before).otherwise(last))
