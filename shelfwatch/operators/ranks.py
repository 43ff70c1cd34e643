"""Exact order statistics without sorting a whole column in one place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.runtime import Scratch

# Slices per refinement step: the tables of slice totals stay this small.
SLICES = 65536
# Distinct values that may be put in order in one place.
LAST_VALUES = 100_000


def octave_slice(value: Column) -> Column:
    """Fixed slices of about one per cent, for any double, rising with the value.

    64 slices per power of two and sign: at most 270 000 for the whole range.
    """

    def size(v: Column) -> Column:
        return F.lit(100_000) + F.floor(F.log2(v) * 64).cast("int")

    infinite = F.lit(float("inf"))
    return (
        F.when(value == infinite, F.lit(300_000))
        .when(value == -infinite, F.lit(-300_000))
        .when(value > 0, size(F.when((value > 0) & (value < infinite), value)))
        .when(value < 0, -size(F.when((value < 0) & (value > -infinite), -value)))
        .otherwise(F.lit(0))
    )


def integer_slice(value: Column) -> Column:
    """Slices of a non-negative 63-bit integer by its top bits."""
    return F.shiftright(value, 47)


def values_at_ranks(
    df: DataFrame,
    value: str,
    ranks: Callable[[Column], Column],
    coarse: Callable[[Column], Column] = octave_slice,
    weight: str | None = None,
) -> DataFrame:
    """The values at the 0-based *ranks* (an array made from the row count).

    With *weight*, a column of whole numbers, a row stands for so many rows.

    Equal values are counted together first. Passes over the counts then narrow
    each rank to a coarse slice, and to one of 65 536 equal parts of what is left,
    until few distinct values are; only those are put in order. The counts are
    written once for all passes; what is ordered in one place is the slice totals,
    whose number is fixed, and the last part, which is small.
    """
    job = Scratch(df.sparkSession, "ranks")
    counted = job.write(
        df.filter(F.col(value).isNotNull())
        .groupBy(F.col(value).alias("v"))
        .agg((F.sum(weight) if weight else F.count("*")).alias("n"))
        .withColumn("slice", coarse(F.col("v"))),
        "counted",
    )
    extent = [
        F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"),
        F.count("*").alias("size"),
    ]
    running = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    targets = (
        counted.groupBy("slice")
        .agg(*extent)
        .withColumns({"end": F.sum("n").over(running), "count": F.sum("n").over(everything)})
        .withColumn("rank", F.explode(F.array_distinct(ranks(F.col("count")))))
        .filter(_holds_rank())
        .select("slice", "rank", "low", "high", "size", (F.col("end") - F.col("n")).alias("base"))
    )
    targets = job.write(targets, "targets")
    while (targets.agg(F.max("size")).first()[0] or 0) > LAST_VALUES:
        span = F.col("high") - F.col("low")
        part = F.when(span > 0, F.floor((F.col("v") - F.col("low")) / span * SLICES)).otherwise(0)
        in_rank = Window.partitionBy("rank").orderBy("part").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        finer = (
            _within(counted, targets)
            .withColumn("part", part)
            .groupBy("slice", "rank", "base", "part")
            .agg(*extent)
            .withColumn("end", F.col("base") + F.sum("n").over(in_rank))
            .filter(_holds_rank())
            .select("slice", "rank", "low", "high", "size", (F.col("end") - F.col("n")).alias("base"))
        )
        targets = job.write(finer, "targets")
    last = Window.partitionBy("rank").orderBy("v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        _within(counted, targets)
        .withColumn("end", F.col("base") + F.sum("n").over(last))
        .filter(_holds_rank())
        .select("rank", F.col("v").alias("value"))
    )


def _holds_rank() -> Column:
    return (F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("n"))


def _within(counted: DataFrame, targets: DataFrame) -> DataFrame:
    """The counted values inside each target; one row per asked rank is sent out."""
    sent = F.broadcast(targets.select("slice", "rank", "low", "high", "base"))
    return counted.join(sent, "slice").filter(F.col("v").between(F.col("low"), F.col("high")))


def exact_median(df: DataFrame, value: str, weight: str | None = None) -> DataFrame:
    """One row ``median``: the middle value or the mean of the two middle ones."""
    middle = values_at_ranks(
        df,
        value,
        lambda n: F.array(F.floor((n - 1) / 2).cast("bigint"), F.floor(n / 2).cast("bigint")),
        weight=weight,
    )
    return middle.agg(F.avg("value").alias("median"))
