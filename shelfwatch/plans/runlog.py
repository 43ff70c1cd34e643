"""The run log: numbered events, one small file each, folded every so often.

Events are numbered in the order they are written, in folders of ``SEGMENT`` events.
After each full folder the log is folded: the newest event of each run and kind, and
the versions that make up the tables, are written next to it. Whoever opens the log
reads the newest fold and the events after it, so the number of files read does not
grow with the number of runs. Older folds and events stay, and give the tables as
they were. One writer appends at a time.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from shelfwatch.plans.parted import TableState, Version
from shelfwatch.schema import RUN_COLUMNS, RUN_COUNTERS, RUN_EVENT_SCHEMA, VERSION_SCHEMA

STARTED, STORED, FINISHED = "started", "stored", "finished"
SEGMENT = 64


def utc_now() -> datetime:
    """The run's clock: UTC, whole seconds, taken once on the driver."""
    return datetime.now(timezone.utc).replace(microsecond=0)


def summarize_runs(events: DataFrame) -> DataFrame:
    """One row per run from its log events (``run_id, event, at, status, counters``)."""
    closing = F.col("event") == FINISHED

    def closed(column: str):
        return F.max(F.when(closing, F.col(column)))

    return (
        events.filter(F.col("event") != STORED)
        .groupBy(F.col("run_id").alias("id"))
        .agg(
            F.min(F.when(~closing, F.col("at"))).alias("started_at"),
            closed("at").alias("finished_at"),
            F.coalesce(closed("status"), F.lit("running")).alias("status"),
            *[F.coalesce(closed(c), F.lit(0)).alias(c) for c in RUN_COUNTERS],
        )
        .select(*RUN_COLUMNS)
    )


def newest_events(events: DataFrame) -> DataFrame:
    """The newest event of each run and kind; a run taken up again is not closed yet."""
    newest = F.row_number().over(Window.partitionBy("run_id", "event").orderBy(F.desc("seq")))
    kept = events.withColumn("_rank", newest).filter("_rank = 1").drop("_rank")
    began = F.max(F.when(F.col("event") == STARTED, F.col("seq"))).over(Window.partitionBy("run_id"))
    reopened = (F.col("event") == FINISHED) & (F.col("seq") < F.col("_began"))
    return kept.withColumn("_began", began).filter(~F.coalesce(reopened, F.lit(False))).drop("_began")


class RunLog:
    """The log under a root folder, and what a writer has to know of it."""

    def __init__(self, spark: SparkSession, root: str, segment: int = SEGMENT):
        self.spark, self.segment = spark, segment
        self.events_path, self.folds_path = f"{root}/run_log", f"{root}/run_folds"
        #: Events after the fold, by number, and the tables at the fold.
        self._recent: dict[int, Row] = {}
        self._fold = 0
        self._folded_state: dict[str, TableState] = {}

    # -- files -----------------------------------------------------------------
    def numbers(self, path: str, label: str) -> list[int]:
        """The numbers in the names ``label=number`` of a folder."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{label}="))

    def exists(self, path: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    def _event_path(self, seq: int) -> str:
        return f"{self.events_path}/segment={seq // self.segment}/seq={seq}"

    def _fold_path(self, seq: int, table: str) -> str:
        return f"{self.folds_path}/upto={seq}/{table}"

    def _fold_before(self, seq: int | None = None) -> int:
        """The newest finished fold, optionally of events before *seq*; 0 without any."""
        for upto in reversed(self.numbers(self.folds_path, "upto")):
            if (seq is None or upto < seq) and self.exists(self._fold_path(upto, "events") + "/_SUCCESS"):
                return upto
        return 0

    def _read_events(self, after: int, known: dict[int, Row], before: int | None = None) -> dict[int, Row]:
        """Events beyond *after*; the ones not *known* are read together."""
        numbers = []
        for segment in self.numbers(self.events_path, "segment"):
            if segment >= (after + 1) // self.segment and (before is None or segment <= before // self.segment):
                numbers += self.numbers(f"{self.events_path}/segment={segment}", "seq")
        numbers = [n for n in numbers if n > after and (before is None or n < before)]
        fresh = [self._event_path(n) for n in numbers if n not in known]
        found = {n: known[n] for n in numbers if n in known}
        if fresh:
            # At most a few segments of events, each a row.
            rows = self.spark.read.schema(RUN_EVENT_SCHEMA).parquet(*fresh).collect()
            found.update({r["seq"]: r for r in rows})
        return found

    def _read_state(self, upto: int) -> dict[str, TableState]:
        states: dict[str, TableState] = {}
        if upto:
            # A few rows per part of a table.
            rows = self.spark.read.schema(VERSION_SCHEMA).parquet(self._fold_path(upto, "versions")).collect()
            for r in sorted(rows, key=lambda r: (r["commit"], not r["base"])):
                state = states.setdefault(r["table"], TableState())
                state.add(r["commit"], r["run_id"], [Version(r["part"], r["rows"], r["base"])])
        return states

    def _refresh(self) -> None:
        fold = self._fold_before()
        if fold != self._fold:
            self._fold, self._folded_state = fold, self._read_state(fold)
        self._recent = self._read_events(fold, self._recent)

    # -- writing ---------------------------------------------------------------
    def append(
        self,
        run_id: int,
        event: str,
        status: str,
        at: datetime,
        counters: dict | None = None,
        key: str | None = None,
        commit: int | None = None,
        versions: dict[str, list[Version]] | None = None,
        merged: list[str] = (),
    ) -> None:
        self._refresh()
        seq = max(self._recent, default=self._fold) + 1
        row = Row(
            seq=seq, run_id=run_id, event=event, at=at, status=status, key=key, commit=commit,
            versions=[
                Row(table=t, part=v.part, rows=v.rows, base=v.base) for t, some in (versions or {}).items() for v in some
            ],
            merged=list(merged),
            **{c: int((counters or {}).get(c) or 0) for c in RUN_COUNTERS},
        )
        frame = self.spark.createDataFrame([row], RUN_EVENT_SCHEMA)
        frame.coalesce(1).write.mode("overwrite").parquet(self._event_path(seq))
        self._recent[seq] = row
        if (seq + 1) % self.segment == 0:
            self._write_fold(seq)

    def _write_fold(self, seq: int) -> None:
        records = [
            (table, *record) for table, state in self.state().items() for record in state.records()
        ]
        versions = self.spark.createDataFrame(records, VERSION_SCHEMA)
        versions.coalesce(1).write.mode("overwrite").parquet(self._fold_path(seq, "versions"))
        slim = self.events().withColumn("versions", F.lit(None).cast(RUN_EVENT_SCHEMA["versions"].dataType))
        slim.coalesce(1).write.mode("overwrite").parquet(self._fold_path(seq, "events"))

    # -- reading ---------------------------------------------------------------
    def events(self) -> DataFrame:
        """The newest event of each run and kind."""
        self._refresh()
        recent = self.spark.createDataFrame(list(self._recent.values()), RUN_EVENT_SCHEMA)
        if not self._fold:
            return newest_events(recent)
        folded = self.spark.read.schema(RUN_EVENT_SCHEMA).parquet(self._fold_path(self._fold, "events"))
        return newest_events(folded.unionByName(recent))

    def _find(self, condition, matches) -> list[Row]:
        """Events by a test on rows (recent ones) and a filter (folded ones)."""
        self._refresh()
        found = [r for r in self._recent.values() if matches(r)]
        if self._fold:
            folded = self.spark.read.schema(RUN_EVENT_SCHEMA).parquet(self._fold_path(self._fold, "events"))
            found += folded.filter(condition).collect()
        return found

    def stored_event(self, run_id: int) -> Row | None:
        """The event that made a run visible."""
        found = self._find(
            (F.col("run_id") == run_id) & (F.col("event") == STORED),
            lambda r: r["run_id"] == run_id and r["event"] == STORED,
        )
        return found[0] if found else None

    def run_of_key(self, key: str) -> int | None:
        found = self._find(
            (F.col("key") == key) & (F.col("event") == STARTED),
            lambda r: r["key"] == key and r["event"] == STARTED,
        )
        return min((r["run_id"] for r in found), default=None)

    def last_run(self) -> int:
        """The largest run id; one number comes from the fold."""
        self._refresh()
        last = max((r["run_id"] for r in self._recent.values()), default=0)
        if self._fold:
            folded = self.spark.read.schema(RUN_EVENT_SCHEMA).parquet(self._fold_path(self._fold, "events"))
            last = max(last, folded.agg(F.max("run_id").alias("id")).first()["id"] or 0)
        return last

    def stored_runs(self) -> DataFrame:
        """run_id and commit of the visible runs."""
        return self.events().filter(F.col("event") == STORED).select("run_id", "commit")

    def versions_of(self, event: Row, table: str) -> list[Version]:
        """What a stored run wrote of a table; a folded event is looked up in its own file."""
        if event["versions"] is None:
            path = self._event_path(event["seq"])
            event = self.spark.read.schema(RUN_EVENT_SCHEMA).parquet(path).first()
        return [Version(v["part"], v["rows"], v["base"]) for v in event["versions"] if v["table"] == table]

    def state(self, before: Row | None = None) -> dict[str, TableState]:
        """The tables' versions now, or just before a stored event."""
        if before is None:
            self._refresh()
            fold, events = self._fold, self._recent
        else:
            fold = self._fold_before(before["seq"])
            events = self._read_events(fold, self._recent, before["seq"])
        folded = self._folded_state if fold == self._fold else self._read_state(fold)
        states = {
            t: TableState(dict(s.bases), {k: dict(v) for k, v in s.changes.items()}) for t, s in folded.items()
        }
        for _, r in sorted(events.items()):
            if r["event"] == STORED:
                for table in {v["table"] for v in r["versions"]}:
                    state = states.setdefault(table, TableState())
                    state.add(r["commit"], r["run_id"], self.versions_of(r, table), table in r["merged"])
        return states

    def last_commit(self) -> int:
        """The commit number of the newest stored run."""
        self._refresh()
        last = max((r["commit"] or 0 for r in self._recent.values()), default=0)
        if last or not self._fold:
            return last
        folded = self.spark.read.schema(RUN_EVENT_SCHEMA).parquet(self._fold_path(self._fold, "events"))
        return folded.agg(F.max("commit").alias("last")).first()["last"] or 0
