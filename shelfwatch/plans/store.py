"""The stored catalogue: product snapshot, price history and run log as Parquet.

Data of a run is written under its own folder and becomes visible only with the
run's ``stored`` event, which is written last. A run that dies before that leaves
folders no reader looks at, and running it again overwrites them. Runs get their place
when they are stored, not when they begin: the ``stored`` event carries a commit
number, and "newest" and "before" go by it. So a run that is taken up again after a
younger one was stored loses nothing.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.operators import analyze
from shelfwatch.operators.prices import (
    changed_rows,
    id_changes,
    missing_values,
    movement,
    previous_prices,
    repeated_keys,
)
from shelfwatch.plans.parted import PartedTable, TableState
from shelfwatch.plans.runlog import FINISHED, SEGMENT, STARTED, STORED, RunLog, summarize_runs, utc_now
from shelfwatch.plans.tallies import Tallies, tally_changes, tally_rows, total
from shelfwatch.runtime import Scratch, materialize, remove_folder
from shelfwatch.schema import HISTORY_SCHEMA, ID_SCHEMA, PRODUCT_COLUMNS, SNAPSHOT_SCHEMA

DATASET = "dataset"
PRODUCTS, IDS, TALLIES = "products", "ids", "tallies"


class ConstraintError(ValueError):
    """A batch would break a key or a required column; nothing of it is stored."""


def _instant(now: datetime):
    return F.timestamp_seconds(F.lit(int(now.timestamp())))


class CatalogStore:
    """One catalogue under a root folder that every executor can reach.

    There is one writer at a time; readers may come and go. The snapshot lies in
    *parts* by a hash of ``url``, and what a run changes is laid over them (see
    :mod:`shelfwatch.plans.parted`), so a run writes in proportion to its batch. A
    second table, parted by a hash of the id, tells which product has an id; only
    ids that are new or have moved are looked up there. Counts of products by their
    values (:mod:`shelfwatch.plans.tallies`) give the figures of the whole catalogue
    without reading it. The number of parts is fixed when the store is made: take one
    that gives parts of a few hundred megabytes. With *keep* the versions that no
    snapshot of the last *keep* stored runs needs are deleted after each run.
    """

    def __init__(
        self, spark: SparkSession, root: str, parts: int = 16, keep: int | None = None, segment: int = SEGMENT
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep
        self.log = RunLog(spark, self.root, segment)
        self._wanted_parts = parts

    # -- layout ----------------------------------------------------------------
    def _path(self, table: str, run_id: int | None = None) -> str:
        path = f"{self.root}/{table}"
        return path if run_id is None else f"{path}/run_id={run_id}"

    def init(self) -> None:
        """Create what is missing of the store's tables."""
        layout = self.spark.range(1).select(F.lit(self._wanted_parts).alias("parts"))
        layout.coalesce(1).write.mode("ignore").parquet(self._path("layout"))
        history = self.spark.createDataFrame([], HISTORY_SCHEMA)
        history.write.mode("ignore").parquet(self._path("price_history", 0))

    @cached_property
    def parts(self) -> int:
        """Number of parts of the snapshot, as the store was made."""
        return self.spark.read.schema("parts int").parquet(self._path("layout")).first()["parts"]

    @cached_property
    def product_table(self) -> PartedTable:
        return PartedTable(self.spark, self.root, PRODUCTS, SNAPSHOT_SCHEMA, ["url"], self.parts)

    @cached_property
    def id_table(self) -> PartedTable:
        keys = ["source_product_id", "url"]
        return PartedTable(self.spark, self.root, IDS, ID_SCHEMA, keys, self.parts, live="live")

    @cached_property
    def tallies(self) -> Tallies:
        return Tallies(self.spark, self.root)

    # -- run log ---------------------------------------------------------------
    def start_run(
        self, run_id: int | None = None, now: datetime | None = None, key: str | None = None
    ) -> int:
        """Register a run as ``running`` and return its id.

        Without *run_id* the run gets the next free one. A run started before under
        the same *key* is taken up again under its id, so a batch that comes twice
        is one run whatever ids others have taken; one already stored is left as it
        is in the log.
        """
        if run_id is None and key is not None:
            run_id = self.log.run_of_key(key)
        if run_id is None:
            run_id = self.log.last_run() + 1
        elif self.is_stored(run_id):
            return run_id
        self.log.append(run_id, STARTED, "running", now or utc_now(), key=key)
        return run_id

    def finish_run(
        self, run_id: int, status: str, counters: dict[str, int], now: datetime | None = None
    ) -> None:
        """Close a run with its status and counters."""
        self.log.append(run_id, FINISHED, status, now or utc_now(), counters)

    def runs(self) -> DataFrame:
        """All runs by id; a run that was never closed shows as ``running``."""
        return summarize_runs(self.log.events()).orderBy("id")

    def run(self, run_id: int) -> DataFrame:
        return self.runs().filter(F.col("id") == run_id).select("id", "started_at", "status")

    # -- committed versions ----------------------------------------------------
    def is_stored(self, run_id: int) -> bool:
        return self.log.stored_event(run_id) is not None

    def _state(self, table: str, before: int | None = None) -> TableState:
        """The versions of a table now, or before a run was stored."""
        event = None if before is None else self.log.stored_event(before)
        return self.log.state(event).get(table, TableState())

    def snapshot(self, before: int | None = None) -> DataFrame:
        """The catalogue now, or as it was before a run was stored."""
        return self.product_table.read(self._state(PRODUCTS, before))

    def _written(self, run_id: int) -> DataFrame:
        """The rows of the snapshot that a stored run wrote."""
        event = self.log.stored_event(run_id)
        return self.product_table.written(run_id, self.log.versions_of(event, PRODUCTS))

    def remove_superseded(self, before: int) -> list[str]:
        """Delete the versions that no snapshot since run *before* was stored needs; returns their folders."""
        event = self.log.stored_event(before)
        # As many rows as there are stored runs up to that one.
        runs = [r["run_id"] for r in self.log.stored_runs().filter(F.col("commit") <= event["commit"]).collect()]
        last = self.log.state(event)
        old = []
        for name, table in ((PRODUCTS, self.product_table), (IDS, self.id_table), (TALLIES, self.tallies)):
            state = last.get(name, TableState())
            state.add(event["commit"], before, self.log.versions_of(event, name), name in event["merged"])
            needed = {table.base_path(run, part) for part, (_, run, _) in state.bases.items()}
            needed |= {table.change_path(run) for _, run in state.changes}
            for run in runs:
                parts = self.log.numbers(table.base_path(run), "part")
                paths = [table.base_path(run, p) for p in parts]
                if self.log.exists(table.change_path(run)):
                    paths.append(table.change_path(run))
                old += [p for p in paths if p not in needed]
        for path in old:
            remove_folder(self.spark, path)
        return old

    def products(self) -> DataFrame:
        """The current catalogue by category (unset first) and name."""
        return (
            self.snapshot()
            .select(*PRODUCT_COLUMNS)
            .orderBy(F.asc_nulls_first("category"), "name")
        )

    def product_count(self) -> DataFrame:
        """One row ``products``: the size of the catalogue."""
        return self.snapshot().agg(F.count("*").alias("products"))

    def count_products(self) -> int:
        return self.product_count().first()["products"]

    # -- figures of the whole catalogue ----------------------------------------
    def tally(self, before: int | None = None) -> DataFrame:
        """Products per combination of counted values, now or before a run was stored."""
        state = self._state(TALLIES, before)
        # A store made before there were counts gets them with its next run.
        return self.tallies.read(state) if state.bases else tally_rows(self.snapshot(before))

    def summary(self, before: int | None = None) -> DataFrame:
        """What the tables of :mod:`shelfwatch.operators.analyze` are sums over."""
        return analyze.summarize_tally(self.tally(before))

    def kpis(self, before: int | None = None) -> DataFrame:
        """The headline figures of the catalogue as one row."""
        tally = materialize(self.tally(before), "tally")
        return analyze.kpis(tally, analyze.summarize_tally(tally), unique_urls=True, weight="n")

    def history(self) -> DataFrame:
        """All observations of committed runs, with ``run_id``."""
        return self._committed_history().drop("commit")

    def _committed_history(self) -> DataFrame:
        schema = T.StructType([*HISTORY_SCHEMA.fields, T.StructField("run_id", T.LongType())])
        rows = self.spark.read.schema(schema).parquet(self._path("price_history"))
        # A row a run: joined by run, all observations of a large run would meet in one task.
        return rows.join(F.broadcast(self.log.stored_runs()), "run_id").select(*schema.names, "commit")

    def previous_prices(self, run_id: int) -> DataFrame:
        """Newest price per URL before *run_id* was stored, read from the snapshot of that time.

        Equal to looking through the history (:func:`previous_prices`), at the cost
        of one product table instead of all observations ever made.
        """
        before = self.snapshot(before=run_id)
        return before.filter(F.col("known_price").isNotNull()).select(
            F.col("known_price_id").alias("source_product_id"),
            "url",
            F.col("known_price").alias("previous_price"),
        )

    def previous_prices_from_history(self, run_id: int) -> DataFrame:
        event = self.log.stored_event(run_id)
        commit = event["commit"] if event else self.log.last_commit() + 1
        rows = self._committed_history().withColumn("run_id", F.col("commit"))
        return previous_prices(rows, commit)

    # -- writing a batch -------------------------------------------------------
    def write_batch(
        self,
        batch: DataFrame,
        run_id: int,
        order: str,
        now: datetime | None = None,
        unique_urls: bool = False,
    ) -> int:
        """Upsert the snapshot and append the history as one all-or-nothing step.

        Returns the number of rows of the batch. A broken constraint raises
        :class:`ConstraintError` and leaves the run invisible. A run that is
        already stored is left as it is, so a replayed batch changes nothing. Any
        other run comes after all that are stored, whatever its id.
        """
        now = now or utc_now()
        if self.is_stored(run_id):
            return self._rows_of_run(run_id)
        job = Scratch(self.spark, "batch")
        state = self.log.state()
        products, ids, counts_before = (state.get(t, TableState()) for t in (PRODUCTS, IDS, TALLIES))
        commit = self.log.last_commit() + 1
        in_batch = self.product_table.parts_of(batch)
        touched = set(in_batch)
        changed = job.write(
            changed_rows(
                self.product_table.read(products, touched), batch, run_id, _instant(now),
                None if unique_urls else order,
            ),
            "changed",
        )
        moved = job.write(id_changes(changed), "moved")
        self._check(changed, moved, ids, run_id, unique_urls)
        history = batch.select(
            F.col(order).cast("bigint").alias("seq"),
            "source_product_id",
            "name",
            "url",
            "price",
            "currency",
            _instant(now).alias("captured_at"),
        )
        history.write.mode("overwrite").parquet(self._path("price_history", run_id))
        written, merged = {}, []
        for name, table, old, rows in (
            (PRODUCTS, self.product_table, products, changed), (IDS, self.id_table, ids, moved)
        ):
            # One row per URL: the rows of the batch are the rows that change.
            counts = in_batch if unique_urls and name == PRODUCTS else None
            written[name], whole = table.write(old, rows, run_id, commit, counts)
            merged += [name] if whole else []
        delta = tally_changes(changed)
        if products.bases and not counts_before.bases:
            delta = total(tally_rows(self.product_table.read(products)).unionByName(delta))
        written[TALLIES], whole = self.tallies.write(counts_before, delta, run_id)
        merged += [TALLIES] if whole else []
        self.log.append(run_id, STORED, "stored", now, commit=commit, versions=written, merged=merged)
        job.drop(changed, moved)
        if self.keep is not None:
            self._remove_old(commit)
        return self._rows_of_run(run_id)

    def _remove_old(self, commit: int) -> None:
        oldest = self.log.stored_runs().filter(F.col("commit") == commit - self.keep).first()
        if oldest is not None:
            self.remove_superseded(oldest["run_id"])

    def _check(
        self, changed: DataFrame, moved: DataFrame, ids: TableState, run_id: int, unique_urls: bool
    ) -> None:
        """Raise if the run breaks a rule; the table of all violations stays in the store."""
        # Stored rows were checked before, so a new clash of ids involves an id that is
        # new or has moved: only the parts of the id table that hold one are read.
        fresh = moved.filter("live")
        touched = set(self.id_table.parts_of(fresh))
        checks = missing_values(changed, "name", "url")
        if touched:
            wanted = fresh.select("source_product_id").distinct()
            before = self.id_table.read(ids, touched).join(wanted, "source_product_id", "left_semi")
            keys = ["source_product_id", "url"]
            holders = before.join(moved.select(*keys), keys, "left_anti").select(*keys).unionByName(fresh.select(*keys))
            checks = checks.unionByName(repeated_keys(holders, "source_product_id"))
        if unique_urls:
            checks = checks.unionByName(repeated_keys(changed, "url"))
        n = checks.count()
        if n:
            path = self._path("violations", run_id)
            checks.write.mode("overwrite").parquet(path)
            worst = self.spark.read.schema(checks.schema).parquet(path).orderBy("constraint", "key").first()
            raise ConstraintError(
                f"{n} broken rule(s), all listed in {path}; "
                f"the first is {worst['constraint']}: {worst['key']} ({worst['n']})"
            )

    def violations(self, run_id: int) -> DataFrame:
        """The broken rules of a refused run: ``constraint, key, n``."""
        return self.spark.read.schema("constraint string, key string, n bigint").parquet(self._path("violations", run_id))

    def _rows_of_run(self, run_id: int) -> int:
        path = self._path("price_history", run_id)
        return self.spark.read.schema(HISTORY_SCHEMA).parquet(path).count()

    def dataset_path(self, run_id: int) -> str:
        """Where a run keeps its cleaned rows for the reports."""
        return self._path(DATASET, run_id)

    def price_changes(self, run_id: int) -> DataFrame:
        """Price movement of a committed run against the prices known before it."""
        return movement(self._written(run_id), run_id)
