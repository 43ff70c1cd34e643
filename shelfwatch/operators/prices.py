"""Previous prices and the keyed upsert of the product snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions.price import round_half_even
from shelfwatch.schema import PRODUCT_VALUES, SNAPSHOT_SCHEMA, TALLY_KEYS

#: The column of :func:`changed_rows` with the id a product had before.
OLD_ID = "old_product_id"
#: The column of :func:`changed_rows` with the counted values a product had before; null if it is new.
OLD_VALUES = "old_values"


def previous_prices(history: DataFrame, run_id: int, *order: str) -> DataFrame:
    """Per URL the newest non-null price recorded before *run_id*.

    *order* names the columns giving insertion order (default ``run_id, seq``).
    Aggregates on the map side, so a URL with very many observations sends one
    row per task. With a single integer as order and only the price wanted, it is
    a hash aggregation.
    """
    keys = order or ("run_id", "seq")
    newest = F.struct(*keys) if len(keys) > 1 else F.col(keys[0])
    return (
        history.filter((F.col("run_id") < run_id) & F.col("price").isNotNull())
        .groupBy("url")
        .agg(
            F.max_by("source_product_id", newest).alias("source_product_id"),
            F.max_by("price", newest).alias("previous_price"),
        )
        .select("source_product_id", "url", "previous_price")
    )


def _one_row_per_url(batch: DataFrame, order: str | None) -> DataFrame:
    """Batch rows by URL: the last row's values, and the last price that is set."""
    price, product_id = F.col("price"), F.col("source_product_id")
    if order is None:
        return batch.select(
            "url",
            *PRODUCT_VALUES,
            price.alias("seen_price"),
            F.when(price.isNotNull(), product_id).alias("seen_id"),
        )
    priced = F.when(price.isNotNull(), F.col(order))
    rows = batch.groupBy("url").agg(
        F.max_by(F.struct(*PRODUCT_VALUES), order).alias("row"),
        F.max_by("price", priced).alias("seen_price"),
        F.max_by("source_product_id", priced).alias("seen_id"),
    )
    return rows.select("url", "row.*", "seen_price", "seen_id")


def _laid_over(old: DataFrame, new: DataFrame, run_id: int, now: Column, how: str) -> DataFrame:
    """The columns of the snapshot from old rows and one new row per URL, and the old id."""
    old, new = old.alias("old"), new.alias("new")
    # A row of a batch has a URL, or met no old row.
    touched = F.col("new.url").isNotNull() | F.col("old.url").isNull()

    def pick(fresh: Column, name: str) -> Column:
        return F.when(touched, fresh).otherwise(F.col(f"old.{name}"))

    known, known_id = F.col("old.known_price"), F.col("old.known_price_id")
    priced = F.col("new.seen_price").isNotNull()
    columns = {
        **{c: pick(F.col(f"new.{c}"), c) for c in PRODUCT_VALUES},
        "url": F.coalesce("new.url", "old.url"),
        "first_seen_at": F.coalesce(F.col("old.first_seen_at"), now),
        "last_seen_at": pick(now, "last_seen_at"),
        "touched_run": pick(F.lit(run_id).cast("bigint"), "touched_run"),
        "known_price": F.when(priced, F.col("new.seen_price")).otherwise(known),
        "known_price_id": F.when(priced, F.col("new.seen_id")).otherwise(known_id),
        "prior_price": pick(known, "prior_price"),
        "prior_price_id": pick(known_id, "prior_price_id"),
    }
    return old.join(new, F.col("old.url") == F.col("new.url"), how).select(
        *[columns[name].alias(name) for name in SNAPSHOT_SCHEMA.names],
        F.col("old.source_product_id").alias(OLD_ID),
        F.when(F.col("old.url").isNotNull(), F.struct(*[F.col(f"old.{c}").alias(c) for c in TALLY_KEYS])).alias(
            OLD_VALUES
        ),
    )


def upsert(
    snapshot: DataFrame, batch: DataFrame, run_id: int, now: Column, order: str | None = None
) -> DataFrame:
    """The snapshot after writing *batch* into it by ``url``.

    A URL in the batch overwrites everything but ``first_seen_at``, also with
    nulls; other rows are left alone. The result also carries the newest known
    price and the one known before this run, so price movement needs no look into
    the history. Give *order* if a URL may occur more than once in the batch; the
    last row then wins.
    """
    return _laid_over(snapshot, _one_row_per_url(batch, order), run_id, now, "full").drop(OLD_ID, OLD_VALUES)


def changed_rows(
    snapshot: DataFrame, batch: DataFrame, run_id: int, now: Column, order: str | None = None
) -> DataFrame:
    """The rows of :func:`upsert` that the batch touches, with the id and values their URL had before.

    Without *order* each row of the batch is one row, so a URL that occurs twice shows.
    """
    return _laid_over(snapshot, _one_row_per_url(batch, order), run_id, now, "right")


def id_changes(changed: DataFrame) -> DataFrame:
    """What the rows of :func:`changed_rows` change in the table of ids: id, url, whether it holds.

    A product that keeps its id changes nothing, so an ordinary batch has few rows here.
    """
    new, old = F.col("source_product_id"), F.col(OLD_ID)
    entries = F.array(
        F.struct(old.alias("id"), F.lit(False).alias("live")),
        F.struct(new.alias("id"), F.lit(True).alias("live")),
    )
    return (
        changed.filter(~new.eqNullSafe(old))
        .select("url", F.explode(entries).alias("e"))
        .filter(F.col("e.id").isNotNull())
        .select(F.col("e.id").alias("source_product_id"), "url", F.col("e.live").alias("live"))
    )


def movement(snapshot: DataFrame, run_id: int) -> DataFrame:
    """Price changes of a run, read off the snapshot it wrote.

    The upsert left the price known before the run next to the new one, so this is
    a filter: no join and no shuffle. Unchanged prices are listed with 0.0.
    """
    return snapshot.filter(
        (F.col("touched_run") == run_id)
        & F.col("price").isNotNull()
        & F.col("prior_price").isNotNull()
    ).select(
        "name",
        "category",
        F.col("prior_price").alias("previous_price"),
        F.col("price").alias("current_price"),
        round_half_even(F.col("price") - F.col("prior_price")).alias("change"),
    )


def repeated_keys(rows: DataFrame, column: str) -> DataFrame:
    """``constraint, key, n`` of the values that occur more than once; null may."""
    return (
        rows.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key"))
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .select(F.lit(f"unique {column}").alias("constraint"), "key", "n")
    )


def missing_values(rows: DataFrame, *columns: str) -> DataFrame:
    """``constraint, key, n`` of the required columns that are null somewhere."""
    return (
        rows.select(F.explode(F.array(*[_null_flag(c) for c in columns])).alias("key"))
        .filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.count("*").alias("n"))
        .select(F.lit("required").alias("constraint"), "key", "n")
    )


def constraint_violations(rows: DataFrame) -> DataFrame:
    """``constraint, key, n`` of every broken rule: required columns and unique keys."""
    return (
        missing_values(rows, "name", "url")
        .unionByName(repeated_keys(rows, "url"))
        .unionByName(repeated_keys(rows, "source_product_id"))
    )


def _null_flag(column: str) -> Column:
    return F.when(F.col(column).isNull(), F.lit(column))
