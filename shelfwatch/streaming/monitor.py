"""Incremental monitoring: every micro-batch of observations is one run."""

from __future__ import annotations

import logging
from collections import deque

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from shelfwatch.plans.run import FAILED, REFUSED, RunOutcome, run_batch
from shelfwatch.plans.store import CatalogStore

log = logging.getLogger(__name__)


class _LimitReached(Exception):
    """Raised before a batch beyond the limit is touched, so it stays unread."""


class RunFailed(RuntimeError):
    """A run failed; its batch is not committed and comes again after a restart."""


class Monitor:
    """Runs a stream of raw records into a catalogue, one run per micro-batch.

    A run is found again by the stream's own id, kept in its checkpoint folder, and
    the number of the batch. A batch replayed after a failure so finds its run and
    changes nothing, and never meets a run of another stream or of a plain batch. A
    failed run stops the stream with its batch uncommitted; a batch that breaks a
    rule of the store would do so for ever, so it is logged as ``refused`` and
    passed over. The last *keep* outcomes are at hand in ``outcomes``.
    """

    def __init__(self, store: CatalogStore, order: str, keep: int = 20, **run_options):
        self.store = store
        self.order = order
        self.run_options = run_options
        self.outcomes: deque[RunOutcome] = deque(maxlen=keep)
        self._runs = 0
        self._limited = False
        self._stream_id: str | None = None

    def _key(self, checkpoint: str, batch_id: int) -> str:
        if self._stream_id is None:
            folder = checkpoint.rstrip("/")
            self._stream_id = self.store.spark.read.schema("id string").json(f"{folder}/metadata").first()["id"]
        return f"{self._stream_id}/{batch_id}"

    def _run(self, batch: DataFrame, batch_id: int, checkpoint: str, max_runs: int) -> None:
        if max_runs and self._runs >= max_runs:
            self._limited = True
            raise _LimitReached(f"limit of {max_runs} runs")
        key = self._key(checkpoint, batch_id)
        outcome = run_batch(self.store, batch, self.order, key=key, **self.run_options)
        self.outcomes.append(outcome)
        self._runs += 1
        if outcome.status == FAILED:
            raise RunFailed(f"run {outcome.run_id}: {outcome.error}")
        if outcome.status == REFUSED:
            log.error("run %s was refused: %s", outcome.run_id, outcome.error)

    def start(
        self,
        records: DataFrame,
        checkpoint: str,
        max_runs: int = 0,
        interval: str | None = None,
    ) -> StreamingQuery:
        """Start the query: over what is there, or every *interval* (``"60 minutes"``)."""
        self.store.init()
        self.outcomes.clear()
        self._runs, self._limited, self._stream_id = 0, False, None
        trigger = {"processingTime": interval} if interval else {"availableNow": True}
        return (
            records.writeStream.foreachBatch(lambda df, i: self._run(df, i, checkpoint, max_runs))
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )

    def run(self, records: DataFrame, checkpoint: str, max_runs: int = 0, interval: str | None = None):
        """Start and wait; ends when the input or the number of runs is used up."""
        query = self.start(records, checkpoint, max_runs, interval)
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if not self._limited:
                raise
        return list(self.outcomes)
