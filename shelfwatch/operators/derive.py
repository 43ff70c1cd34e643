"""Banding columns on top of the cleaned records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions.price import price_band
from shelfwatch.functions.product import availability_status, rating_band


def add_derived_columns(df: DataFrame) -> DataFrame:
    """Add ``price_bucket``, ``availability_status`` and ``rating_band``."""
    return df.withColumns(
        {
            "price_bucket": price_band(F.col("price")),
            "availability_status": availability_status(F.col("availability")),
            "rating_band": rating_band(F.col("rating")),
        }
    )
