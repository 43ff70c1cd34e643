"""A keyed table in parts by a hash of one column, read as base files and later changes.

A run writes the rows it changes as one small table, sorted by part, so its cost goes
with the batch however the batch is scattered. Readers lay the newest change of each
key over the base of its part. A part whose changes would pass a share of its base is
written anew as a base in the same run, and many small change tables are merged into
one, so a read never meets more than a few of them. Which versions count is for the
caller to record (:class:`TableState`); files that no record names are never read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A part is written anew when its changes pass this share of its base's rows.
SHARE = 0.25
#: Change tables that a reader may meet before the next run merges them.
MOST_CHANGES = 16


@dataclass(frozen=True)
class Version:
    """What a run wrote of one part: its whole base, or changes to it."""

    part: int
    rows: int
    base: bool


@dataclass
class TableState:
    """The versions that make up a table after a commit; a few numbers per part."""

    #: part: (commit, run, rows)
    bases: dict[int, tuple[int, int, int]] = field(default_factory=dict)
    #: (commit, run): rows by part
    changes: dict[tuple[int, int], dict[int, int]] = field(default_factory=dict)

    def add(self, commit: int, run: int, versions: list[Version], merged: bool = False) -> None:
        """Take in what a run wrote; *merged*: its changes hold all earlier ones."""
        if merged:
            self.changes = {}
        for v in versions:
            if v.base:
                self.bases[v.part] = (commit, run, v.rows)
            else:
                self.changes.setdefault((commit, run), {})[v.part] = v.rows
        for key, rows in list(self.changes.items()):
            live = {p: n for p, n in rows.items() if p not in self.bases or self.bases[p][0] < key[0]}
            if live:
                self.changes[key] = live
            else:
                del self.changes[key]

    def pending(self, part: int) -> int:
        return sum(rows.get(part, 0) for rows in self.changes.values())

    def records(self) -> list[tuple[int, int, int, int, bool]]:
        """(commit, run, part, rows, base) of every version that counts."""
        bases = [(c, r, p, n, True) for p, (c, r, n) in self.bases.items()]
        return bases + [(c, r, p, n, False) for (c, r), rows in self.changes.items() for p, n in rows.items()]


class PartedTable:
    """The files of one table under a root folder."""

    def __init__(
        self, spark: SparkSession, root: str, name: str, schema: T.StructType, keys: list[str], parts: int,
        live: str | None = None,
    ):
        """Rows are dealt by the first of *keys*; those whose *live* column is false are gone."""
        self.spark, self.schema, self.keys, self.parts, self.live = spark, schema, keys, parts, live
        self.bases, self.changes = f"{root}/{name}", f"{root}/{name}_changes"
        self._marked = T.StructType([
            *schema.fields, T.StructField("part", T.IntegerType()), T.StructField("commit", T.LongType())
        ])

    def part(self) -> Column:
        return F.pmod(F.xxhash64(self.keys[0]), F.lit(self.parts)).cast("int")

    def parts_of(self, rows: DataFrame) -> dict[int, int]:
        """Rows in each part; at most as many numbers as the table has parts."""
        return {r["part"]: r["count"] for r in rows.groupBy(self.part().alias("part")).count().collect()}

    def base_path(self, run: int, part: int | None = None) -> str:
        return f"{self.bases}/run_id={run}" + ("" if part is None else f"/part={part}")

    def change_path(self, run: int) -> str:
        return f"{self.changes}/run_id={run}"

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def _latest(self, state: TableState, touched: set[int] | None) -> DataFrame | None:
        """The newest change of each key that its part's base does not hold yet."""
        runs = [k for k, rows in state.changes.items() if touched is None or touched & rows.keys()]
        if not runs:
            return None
        rows = self.spark.read.schema(self._marked).parquet(*[self.change_path(run) for _, run in runs])
        if touched is not None:
            rows = rows.filter(F.col("part").isin(sorted(touched)))
        oldest = min(commit for commit, _ in runs)
        newer = [(p, c) for p, (c, _, _) in state.bases.items() if c >= oldest]
        if newer:
            bases = self.spark.createDataFrame(newer, "part int, since bigint")
            rows = rows.join(bases, "part", "left").filter("since is null or commit > since")
        rest = [c for c in self.schema.names if c not in self.keys]
        if len(runs) > 1:
            newest = F.max_by(F.struct(*rest), "commit").alias("newest")
            rows = rows.groupBy(*self.keys).agg(newest).select(*self.keys, "newest.*")
        return rows.select(*self.schema.names)

    def read(self, state: TableState, touched: set[int] | None = None, gone: bool = False) -> DataFrame:
        """The table, or its *touched* parts only; with *gone* the rows that are no longer live, too."""
        paths = [
            self.base_path(run, part)
            for part, (_, run, _) in sorted(state.bases.items())
            if touched is None or part in touched
        ]
        rows = self.spark.read.schema(self.schema).parquet(*paths) if paths else self._empty()
        latest = self._latest(state, touched)
        if latest is not None:
            rows = rows.join(latest.select(*self.keys), self.keys, "left_anti").unionByName(latest)
        return rows.filter(self.live) if self.live and not gone else rows

    def write(
        self, state: TableState, rows: DataFrame, run: int, commit: int, counts: dict[int, int] | None = None
    ) -> tuple[list[Version], bool]:
        """Write one row per changed key; returns the versions made and whether they hold all changes.

        *rows* is read several times: pass a stored table. *counts* are its rows by part,
        if the caller has them.
        """
        counts = self.parts_of(rows) if counts is None else counts
        anew = {
            p for p, n in counts.items() if state.pending(p) + n > SHARE * state.bases.get(p, (0, 0, 0))[2]
        }
        placed = rows.select(*self.schema.names).withColumn("part", self.part())
        versions: list[Version] = []
        merge = False
        if counts.keys() - anew:
            changed = placed.filter(~F.col("part").isin(sorted(anew))) if anew else placed
            merge = len(state.changes) >= MOST_CHANGES
            if merge:
                older = set(range(self.parts)) - anew
                before = self._latest(state, older)
                if before is not None:
                    before = before.withColumn("part", self.part())
                    changed = before.join(changed.select(*self.keys), self.keys, "left_anti").unionByName(changed)
            out = changed.withColumn("commit", F.lit(commit).cast("bigint")).repartition("part")
            path = self.change_path(run)
            out.sortWithinPartitions("part", *self.keys).write.mode("overwrite").parquet(path)
            if merge:
                written = self.spark.read.schema(self._marked).parquet(path).groupBy("part").count()
                sizes = {r["part"]: r["count"] for r in written.collect()}
            else:
                sizes = {p: n for p, n in counts.items() if p not in anew}
            versions += [Version(p, n, False) for p, n in sizes.items()]
        if anew:
            fresh = placed.filter(F.col("part").isin(sorted(anew)))
            kept = self.read(state, anew).withColumn("part", self.part())
            whole = kept.join(fresh.select(*self.keys), self.keys, "left_anti").unionByName(fresh)
            if self.live:
                whole = whole.filter(self.live)
            path = self.base_path(run)
            whole.hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(path)
            fresh_only = not self.live and not any(p in state.bases or state.pending(p) for p in anew)
            sizes = {p: counts[p] for p in anew} if fresh_only else self._sizes(path, anew)
            versions += [Version(p, n, True) for p, n in sizes.items()]
        return versions, merge

    def _sizes(self, path: str, parts: set[int]) -> dict[int, int]:
        """Rows of the bases a run wrote; a part that lost all its rows has an empty one."""
        marked = T.StructType([*self.schema.fields, T.StructField("part", T.IntegerType())])
        sizes = {r["part"]: r["count"] for r in
                 self.spark.read.schema(marked).parquet(path).groupBy("part").count().collect()}
        for part in parts - sizes.keys():
            self._empty().write.mode("overwrite").parquet(f"{path}/part={part}")
        return {p: sizes.get(p, 0) for p in parts}

    def written(self, run: int, versions: list[Version]) -> DataFrame:
        """All rows that a run wrote, whole bases included."""
        paths = [self.base_path(run, v.part) for v in versions if v.base]
        if any(not v.base for v in versions):
            paths.append(self.change_path(run))
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self._empty()
