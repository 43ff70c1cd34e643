"""How many products have which values, kept beside the snapshot as signed counts.

Every figure of the whole catalogue follows from the number of products per
combination of category, currency, availability, price and rating. A stored run adds
one row per combination that its batch made more or less frequent, so it writes in
proportion to the batch, and the figures are read from counts instead of products.
Sums, means and the median are those of the values themselves. Counts of a run become
visible with its ``stored`` event, like its products.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.operators.prices import OLD_VALUES
from shelfwatch.plans.parted import MOST_CHANGES, SHARE, TableState, Version
from shelfwatch.schema import TALLY_KEYS, TALLY_SCHEMA


def total(rows: DataFrame) -> DataFrame:
    """The counts of several tables of counts; what comes to nothing has no row."""
    return rows.groupBy(*TALLY_KEYS).agg(F.sum("n").alias("n")).filter("n <> 0")


def tally_rows(products: DataFrame) -> DataFrame:
    """The counts of a table of products."""
    return products.groupBy(*TALLY_KEYS).agg(F.count("*").alias("n"))


def tally_changes(changed: DataFrame) -> DataFrame:
    """What the rows of ``changed_rows`` add to the counts: new values once more, old ones once less."""
    one = F.lit(1).cast("bigint")
    new = F.struct(*TALLY_KEYS, one.alias("n"))
    old = F.struct(*[F.col(f"{OLD_VALUES}.{c}").alias(c) for c in TALLY_KEYS], (-one).alias("n"))
    moves = F.array(new, F.when(F.col(OLD_VALUES).isNotNull(), old))
    return total(changed.select(F.explode(moves).alias("move")).filter("move is not null").select("move.*"))


class Tallies:
    """The counts under a root folder: a base, and signed changes to it.

    The versions that count are in a :class:`TableState` with one part. Changes
    beyond a share of the base make a new base, many change tables become one.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.bases, self.changes = f"{root}/tallies", f"{root}/tally_changes"

    def base_path(self, run: int, part: int | None = None) -> str:
        return f"{self.bases}/run_id={run}" + ("" if part is None else f"/part={part}")

    def change_path(self, run: int) -> str:
        return f"{self.changes}/run_id={run}"

    def _load(self, paths: list[str]) -> list[DataFrame]:
        return [self.spark.read.schema(TALLY_SCHEMA).parquet(*paths)] if paths else []

    def _pending(self, state: TableState) -> list[str]:
        return [self.change_path(run) for _, run in state.changes]

    def read(self, state: TableState) -> DataFrame:
        bases = [self.base_path(run, part) for part, (_, run, _) in state.bases.items()]
        stored = self._load(bases + self._pending(state))
        return total(stored[0]) if stored else self.spark.createDataFrame([], TALLY_SCHEMA)

    def write(self, state: TableState, delta: DataFrame, run: int) -> tuple[list[Version], bool]:
        """Store the counts a run adds; returns the versions made and whether they hold all changes."""
        if not state.bases:
            return [Version(0, self._store(delta, self.base_path(run, 0)), True)], False
        merge = len(state.changes) >= MOST_CHANGES
        if merge:
            delta = total(reduce(DataFrame.unionByName, self._load(self._pending(state)), delta))
        rows = self._store(delta, self.change_path(run))
        pending = rows if merge else rows + state.pending(0)
        if pending <= SHARE * state.bases[0][2]:
            return ([Version(0, rows, False)] if rows else []), merge
        kept = [self.base_path(state.bases[0][1], 0), self.change_path(run)]
        whole = total(self._load(kept if merge else kept + self._pending(state))[0])
        return [Version(0, self._store(whole, self.base_path(run, 0)), True)], False

    def _store(self, rows: DataFrame, path: str) -> int:
        rows.select(*TALLY_SCHEMA.names).write.mode("overwrite").parquet(path)
        return self._load([path])[0].count()
