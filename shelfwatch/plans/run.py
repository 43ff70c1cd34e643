"""One monitoring run: validate, clean, derive, store, analyse, report, log."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.operators import report
from shelfwatch.operators.analyze import Analysis, analyze
from shelfwatch.operators.clean import clean
from shelfwatch.operators.derive import add_derived_columns
from shelfwatch.operators.validate import accepted, rejected, validate
from shelfwatch.plans.collect import collect_products
from shelfwatch.plans.store import CatalogStore, ConstraintError, utc_now
from shelfwatch.runtime import materialize
from shelfwatch.sources.records import to_records

log = logging.getLogger(__name__)

SUCCESS, PARTIAL, NO_DATA, FAILED = "success", "partial", "no_data", "failed"
#: A batch that breaks a rule of the store: it can never be stored, so it is not tried again.
REFUSED = "refused"


@dataclass
class RunOutcome:
    """What a caller needs to know about a run."""

    run_id: int
    status: str = FAILED
    records_scraped: int = 0
    records_accepted: int = 0
    records_rejected: int = 0
    records_stored: int = 0
    csv_path: str | None = None
    report_path: str | None = None
    analysis: Analysis | None = None
    rejected: DataFrame | None = None
    error: str | None = None
    details: dict[str, int] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return self.status not in (FAILED, REFUSED)


def run_status(accepted: int, rejected: int, failed: bool = False, report_failed: bool = False) -> str:
    """The status a run ends with."""
    if failed:
        return FAILED
    if not accepted:
        return NO_DATA
    return PARTIAL if rejected or report_failed else SUCCESS


def run_batch(
    store: CatalogStore,
    records: DataFrame,
    order: str,
    report_dir: str | None = None,
    source: str = "",
    top_n: int = 10,
    run_id: int | None = None,
    crawl_stats: dict[str, int] | None = None,
    now: datetime | None = None,
    key: str | None = None,
) -> RunOutcome:
    """Take one batch of raw records through the whole run.

    *order* is the unique integer column of *records* giving arrival order. The
    store is made if it is not there. A failure before the data is stored fails the
    run and stores nothing, and the run is closed in the log whatever happens; a
    batch that breaks a rule of the store is ``refused``. A failure of the analysis or
    of a report leaves the stored data and the other reports, and makes the run
    ``partial``. With *key* a batch that comes again is the same run, and is stored
    after whatever was stored in between.
    """
    now = now or utc_now()
    outcome = RunOutcome(0)
    try:
        store.init()
        outcome.run_id = store.start_run(run_id, now, key)
    except Exception as failure:  # without a log there is nothing to close
        outcome.error = f"opening the store failed: {failure}"
        return outcome
    try:
        dataset = _prepare(store, outcome, records, order)
        if dataset is None:
            outcome.error = "the batch holds no valid record"
            return _close(store, outcome, NO_DATA, crawl_stats, now)
        outcome.records_stored = store.write_batch(
            dataset, outcome.run_id, order, now, unique_urls=True
        )
    except Exception as failure:  # any failure up to here ends the run
        outcome.error = f"storing failed: {failure}"
        refused = isinstance(failure, ConstraintError)
        return _close(store, outcome, REFUSED if refused else FAILED, crawl_stats, now)

    report_failed = False
    try:
        changes = store.price_changes(outcome.run_id)
        outcome.analysis = analyze(dataset, changes, top_n, order, unique_urls=True)
    except Exception as failure:  # the data is stored: a later run can analyse it
        outcome.error, report_failed = f"analysis failed: {failure}", True
    if report_dir and outcome.analysis is not None:
        report_failed = not _write_reports(outcome, store, dataset.drop(order), report_dir, source, now)
    status = run_status(
        outcome.records_accepted, outcome.records_rejected, report_failed=report_failed
    )
    return _close(store, outcome, status, crawl_stats, now)


def _prepare(store: CatalogStore, outcome: RunOutcome, records: DataFrame, order: str) -> DataFrame | None:
    """Validate and clean; the cleaned rows as a table of the run, or None without any."""
    checked = materialize(validate(to_records(records, keep=(order,))), "checked")
    verdict = checked.agg(
        F.count("*").alias("found"), F.count_if("is_valid").alias("good")
    ).first()
    outcome.records_scraped = verdict["found"]
    outcome.records_accepted = verdict["good"]
    outcome.records_rejected = verdict["found"] - verdict["good"]
    outcome.rejected = rejected(checked)
    if not outcome.records_accepted:
        return None
    cleaned = clean(accepted(checked), order)
    counters = cleaned.counters.first()
    outcome.details = {
        "duplicates_removed_in_cleaning": counters["duplicates_removed"],
        "invalid_prices_in_cleaning": counters["invalid_prices"],
        "invalid_ratings_in_cleaning": counters["invalid_ratings"],
    }
    return _keep_dataset(store, add_derived_columns(cleaned.frame), outcome.run_id)


def run_pages(
    store: CatalogStore, pages: DataFrame, overview_url: str, now: datetime | None = None, **options
) -> RunOutcome:
    """Collect products from saved pages and run them as one batch.

    ``max_categories``, ``max_pages``, ``max_products`` and ``rules`` go to the
    collection, everything else to :func:`run_batch`.
    """
    now = now or utc_now()
    limits = {
        k: options.pop(k)
        for k in ("rules", "max_categories", "max_pages", "max_products")
        if k in options
    }
    try:
        store.init()
        run_id = store.start_run(options.pop("run_id", None), now, options.get("key"))
    except Exception as failure:
        return RunOutcome(0, error=f"opening the store failed: {failure}")
    try:
        collected = collect_products(pages, overview_url, now, **limits)
    except Exception as failure:  # any collection failure ends the run
        outcome = RunOutcome(run_id, error=f"collecting failed: {failure}")
        return _close(store, outcome, FAILED, None, now)
    options.setdefault("source", overview_url)
    return run_batch(
        store,
        collected.records,
        "ord",
        run_id=run_id,
        crawl_stats=collected.stats,
        now=now,
        **options,
    )


def _keep_dataset(store: CatalogStore, rows: DataFrame, run_id: int) -> DataFrame:
    """The cleaned rows as a table of the run: computed once, read column by column."""
    path = store.dataset_path(run_id)
    rows.write.mode("overwrite").parquet(path)
    return store.spark.read.schema(rows.schema).parquet(path)


def _write_reports(
    outcome: RunOutcome, store: CatalogStore, dataset: DataFrame, folder: str, source: str, now: datetime
) -> bool:
    """Write the CSV and the report tables, each whether or not the other fails."""
    errors = []
    try:
        outcome.csv_path = report.write_products_csv(dataset, folder, now)
    except Exception as failure:  # stored data and the tables stay
        errors.append(f"CSV report failed: {failure}")
    try:
        base = f"{folder.rstrip('/')}/run_id={outcome.run_id}"
        for name, table in report_tables(outcome, store, dataset, source, now).items():
            table.write.mode("overwrite").parquet(f"{base}/{name}")
        outcome.report_path = base
    except Exception as failure:
        errors.append(f"table report failed: {failure}")
    outcome.error = "; ".join(errors) or outcome.error
    return not errors


def report_tables(
    outcome: RunOutcome, store: CatalogStore, dataset: DataFrame, source: str, now: datetime
) -> dict[str, DataFrame]:
    """The report's tables by name; price changes are one of them only if there are any."""
    analysis = outcome.analysis
    extra = {
        "run_id": outcome.run_id,
        "records_rejected": outcome.records_rejected,
        "duplicates_removed_in_cleaning": outcome.details["duplicates_removed_in_cleaning"],
        "database": store.root,
    }
    kpis = materialize(analysis.kpis, "kpis")
    tables = {
        "dashboard": report.dashboard(kpis),
        "product_data": report.product_sheet(dataset),
        "category_analysis": analysis.by_category,
        "chart_categories": report.chart_top_categories(analysis.by_category),
        "chart_availability": analysis.availability,
        "chart_price": analysis.price_distribution,
        "rating_distribution": analysis.rating_distribution,
        "top_rated": analysis.top_rated,
        "cheapest": analysis.cheapest,
        "metadata": report.metadata(kpis, source, now, extra),
    }
    changes = materialize(analysis.price_changes, "changes")
    if not changes.isEmpty():
        tables["price_changes"] = changes
    return tables


def _close(
    store: CatalogStore,
    outcome: RunOutcome,
    status: str,
    crawl_stats: dict[str, int] | None,
    now: datetime,
) -> RunOutcome:
    """Write the closing entry; a failure to log must not hide the outcome."""
    outcome.status = status
    seen = crawl_stats or {}
    counters = {
        "categories": seen.get("categories_scraped", 0),
        "pages_visited": seen.get("pages_visited", 0),
        "pages_failed": seen.get("pages_failed", 0),
        "records_found": outcome.records_scraped,
        "records_accepted": outcome.records_accepted,
        "records_rejected": outcome.records_rejected,
    }
    try:
        store.finish_run(outcome.run_id, status, counters, max(now, utc_now()))
    except Exception as failure:
        log.error("run %s could not be closed in the run log: %s", outcome.run_id, failure)
    return outcome
