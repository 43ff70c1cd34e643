"""Price movement of a stream from state keyed by URL, without reading the catalogue.

Each URL keeps one number, its newest known price. A micro-batch is a run: of several
accepted records of a URL in it the first to arrive counts, as in cleaning, a record
without a name or price is passed over, and a URL seen before yields a row of price
movement (0.0 if the price stayed). State and offsets lie in the stream's checkpoint,
so a restart goes on where the stream was, and a replayed batch gives the same rows.

Before the shuffle each Arrow batch is reduced to one row per URL, so a URL with very
many records sends few; the state of a URL is read and written once per micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfwatch.functions.price import round_half_even
from shelfwatch.operators.clean import standardize
from shelfwatch.operators.validate import accepted, validate
from shelfwatch.sources.records import to_records

_MOVED = "url string, name string, category string, previous_price double, current_price double"


def _first_per_url(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        yield rows.sort_values("_order").drop_duplicates("url")


def _move(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Compare the first record of a URL in this micro-batch to the price the URL has."""
    first = None
    for rows in parts:
        row = rows.loc[rows["_order"].idxmin()]
        if first is None or row["_order"] < first["_order"]:
            first = row
    if first is None or pd.isna(first["name"]) or pd.isna(first["price"]):
        return
    price = float(first["price"])
    if state.exists:
        category = None if pd.isna(first["category"]) else first["category"]
        yield pd.DataFrame(
            {
                "url": [key[0]],
                "name": [first["name"]],
                "category": pd.Series([category], dtype=object),
                "previous_price": [state.get[0]],
                "current_price": [price],
            }
        )
    state.update((price,))


def price_moves(records: DataFrame, order: str) -> DataFrame:
    """``url, name, category, previous_price, current_price, change`` of a stream of raw records.

    *order* is the unique integer column giving arrival order within a micro-batch.
    """
    good = standardize(accepted(validate(to_records(records, keep=(order,)))))
    slim = good.filter(F.col("url").isNotNull()).select(
        F.col(order).cast("bigint").alias("_order"), "url", "name", "category", "price"
    )
    moved = (
        slim.mapInPandas(_first_per_url, slim.schema)
        .groupBy("url")
        .applyInPandasWithState(_move, _MOVED, "price double", "append", GroupStateTimeout.NoTimeout)
    )
    change = round_half_even(F.col("current_price") - F.col("previous_price"))
    return moved.withColumn("change", change)


def write_moves(
    records: DataFrame, order: str, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Append the price movement of a stream to a Parquet folder: over what is there, or every *interval*."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        price_moves(records, order)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
