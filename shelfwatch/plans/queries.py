"""Every operator as a named query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.functions import price as fp
from shelfwatch.functions import product as fprod
from shelfwatch.functions import url as furl
from shelfwatch.functions.text import clean_text, strip
from shelfwatch.operators import analyze as an
from shelfwatch.operators import report
from shelfwatch.operators.clean import clean
from shelfwatch.operators.dedup import dedup_two_keys, first_per_key
from shelfwatch.operators.derive import add_derived_columns
from shelfwatch.operators.prices import constraint_violations, previous_prices, upsert
from shelfwatch.operators.validate import accepted, errors, issue_summary, rejected, validate
from shelfwatch.operators.walk import walk_listings
from shelfwatch.plans import adapters as ad
from shelfwatch.plans.collect import collect_products
from shelfwatch.plans.run import report_tables, run_batch, run_status
from shelfwatch.plans.store import FINISHED, STARTED, STORED, CatalogStore, ConstraintError, summarize_runs
from shelfwatch.runtime import materialize, scratch_dir
from shelfwatch.schema import RECORD_COLUMNS, RUN_COUNTERS, SNAPSHOT_SCHEMA
from shelfwatch.sources import listings as li
from shelfwatch.sources.records import normalize_headers, read_mixed_json, read_records, to_records
from shelfwatch.streaming.monitor import Monitor
from shelfwatch.streaming.moves import write_moves

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NAV_RULES = li.ListingRules(links="nav a", links_fallback="nav a", excluded_links=r"/the$")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _scratch(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _instant(text: str) -> Column:
    moment = datetime.fromisoformat(text).replace(tzinfo=timezone.utc)
    return F.timestamp_seconds(F.lit(int(moment.timestamp())))


def _utc_text(stamp: Column) -> Column:
    """An instant as UTC text, whatever the session zone is."""
    zoneless = F.convert_timezone(F.current_timezone(), F.lit("UTC"), stamp.cast("timestamp_ntz"))
    return F.date_format(zoneless, "yyyy-MM-dd HH:mm:ss")


def _last_run(rows: DataFrame) -> int:
    return rows.agg(F.max("run_id")).first()[0]


# -- scalar functions ----------------------------------------------------------
@query
def price_parse(spark: SparkSession, folder: str) -> DataFrame:
    tag = fp.parse_price(F.col("raw"))
    return ad.price_texts(spark, folder).select(
        "o_orderkey", "raw", tag.amount.alias("amount"), tag.currency.alias("currency")
    )


@query
def price_clean_currency(spark: SparkSession, folder: str) -> DataFrame:
    return ad.price_texts(spark, folder).select(
        "o_orderkey",
        F.col("raw").alias("raw_price"),
        fp.price_amount(F.col("raw")).alias("price"),
        fp.price_currency(F.col("raw")).alias("currency"),
    )


@query
def rating_parse(spark: SparkSession, folder: str) -> DataFrame:
    css = F.concat_ws(
        " ",
        F.lit("star-rating"),
        F.element_at(
            F.array(*[F.lit(w) for w in ("One", "TWO", "three", "Four Two", "Fiveish")]),
            F.substring("o_orderpriority", 1, 1).cast("int"),
        ),
        F.when(F.col("o_orderstatus") == "P", "five"),
    )
    return ad.table(spark, folder, "orders").select(
        "o_orderkey", css.alias("css_class"), fprod.star_rating(css).cast("bigint").alias("rating")
    )


@query
def availability_labels(spark: SparkSession, folder: str) -> DataFrame:
    shelf = F.col("availability")
    label = fprod.canonical_availability(shelf)
    return (
        ad.dirty_records(spark, folder)
        .groupBy(
            "availability",
            label.alias("canonical"),
            fprod.availability_status(label).alias("status"),
        )
        .agg(F.count("*").alias("n"))
    )


@query
def derived_bands(spark: SparkSession, folder: str) -> DataFrame:
    rows = ad.observations(spark, folder).withColumn("price", F.col("price") - 5)
    return add_derived_columns(rows).select(
        "event_id", "price", "price_bucket", "rating", "rating_band", "availability_status"
    )


@query
def clean_texts(spark: SparkSession, folder: str) -> DataFrame:
    tidy = clean_text(F.col("text"))
    return ad.table(spark, folder, "documents").select(
        "doc_id", F.md5(tidy).alias("text_md5"), F.length(tidy).cast("bigint").alias("n_chars")
    )


@query
def url_normalise(spark: SparkSession, folder: str) -> DataFrame:
    padded = F.concat(F.lit(" \t"), F.col("url"), F.lit("\n"))
    return ad.table(spark, folder, "pages").select(
        "page_id",
        furl.clean_url(padded).alias("clean_url"),
        furl.page_key(F.col("url")).alias("page_key"),
        furl.is_http_url(strip(padded)).alias("is_listing_url"),
    )


@query
def source_ids(spark: SparkSession, folder: str) -> DataFrame:
    return ad.table(spark, folder, "pages").select(
        "page_id", "url", fprod.source_product_id(F.col("url")).alias("source_product_id")
    )


# -- sources -------------------------------------------------------------------
@query
def header_normalise(spark: SparkSession, folder: str) -> DataFrame:
    odd = ad.table(spark, folder, "part").select(
        F.col("p_partkey").alias("partKey"),
        F.col("p_name").alias(" Name "),
        F.col("p_retailprice").alias("PRICE"),
        F.col("p_type").alias("Category!"),
        F.col("p_brand").alias("sourceProduct-ID"),
    )
    return to_records(normalize_headers(odd), keep=("part_key",))


@query
def records_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = _scratch(spark, "records")
    columns = [c for c in RECORD_COLUMNS if c != "scraped_at"]
    rows = ad.observations(spark, folder).select(*columns, _ntz("seen_at").alias("scraped_at"))
    rows.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return read_records(spark, path, "csv")


def _ntz(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")


@query
def validate_mixed_json(spark: SparkSession, folder: str) -> DataFrame:
    """Prices that are numbers in some records and text in others."""
    path = _scratch(spark, "mixed")
    kind, value = F.col("event_type"), F.col("value")
    name = F.concat(F.lit('{"name":"Item '), F.col("event_id"), F.lit('"'))
    price = (
        F.when(kind == "click", F.concat(F.lit('"£'), value, F.lit('"')))
        .when(kind == "error", F.lit("true"))
        .when(kind == "signup", F.lit("null"))
        .when(kind == "view", value.cast("string"))
    )
    parts = [
        name,
        F.lit(',"url":"https://shop.example/i"'),
        F.coalesce(F.concat(F.lit(',"price":'), price), F.lit("")),
        F.lit(',"currency":'),
        F.when(kind == "view", F.lit("826")).otherwise('"GBP"'),
        F.lit("}"),
    ]
    ad.table(spark, folder, "events").select(F.concat(*parts).alias("value")).write.text(path)
    return validate(read_mixed_json(spark, path)).select(
        "name", "price", "currency", issue_summary(F.col("issues")).alias("summary"), "is_valid"
    )


@query
def link_extract(spark: SparkSession, folder: str) -> DataFrame:
    return li.extract_links(ad.table(spark, folder, "pages"), NAV_RULES)


@query
def link_resolve(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    return ad.table(spark, folder, "pages").select(
        "page_id",
        furl.resolve_url(url, F.lit("/top/z")).alias("rooted"),
        furl.resolve_url(url, F.lit("https://other.example/q")).alias("absolute"),
        furl.resolve_url(url, F.lit("../x/./y")).alias("upward"),
        furl.resolve_url(furl.page_key(url), F.lit("?p=2")).alias("queried"),
    )


@query
def link_resolve_hrefs(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``href`` of the pages in its absolute form."""
    found = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)
    rows = ad.table(spark, folder, "pages").select("page_id", "url", F.posexplode(found).alias("nr", "href"))
    return rows.select(
        "page_id",
        F.col("nr").cast("bigint").alias("nr"),
        furl.resolve_url(F.col("url"), F.col("href")).alias("target"),
        furl.resolve_url(F.col("url"), F.concat(F.lit("a/../b"), F.col("href"))).alias("below"),
    )


@query
def product_extract(spark: SparkSession, folder: str) -> DataFrame:
    return li.extract_products(ad.listing_pages(spark, folder)).drop("category")


@query
def next_page_links(spark: SparkSession, folder: str) -> DataFrame:
    return li.next_pages(li.read_listings(ad.listing_pages(spark, folder)))


# -- iterative operators -------------------------------------------------------
@query
def listing_walk(spark: SparkSession, folder: str) -> DataFrame:
    seeds, links = ad.page_chains(spark, folder)
    return walk_listings(seeds, links).summary.drop("start_url")


@query
def listing_walk_visits(spark: SparkSession, folder: str) -> DataFrame:
    seeds, links = ad.page_chains(spark, folder)
    return walk_listings(seeds, links, max_pages=20).visits.select("seed", "depth", "url")


@query
def collect_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    now = datetime(2024, 5, 1, tzinfo=timezone.utc)
    found = collect_products(ad.listing_pages(spark, folder), f"{ad.SHOP}/index.html", now)
    return found.records.drop("ord")


@query
def collect_stats(spark: SparkSession, folder: str) -> DataFrame:
    """The counters of a collection as one row."""
    now = datetime(2024, 5, 1, tzinfo=timezone.utc)
    found = collect_products(ad.listing_pages(spark, folder), f"{ad.SHOP}/index.html", now)
    return found.counters


@query
def collect_shared(spark: SparkSession, folder: str) -> DataFrame:
    """Counters of a collection with a listing met twice and one whose page is missing."""
    now = datetime(2024, 5, 1, tzinfo=timezone.utc)
    pages = ad.listing_pages(spark, folder, ("list/page-0.html?again", "list/gone.html"))
    return collect_products(pages, f"{ad.SHOP}/index.html", now).counters


LIMITS = {"max_categories": 4, "max_pages": 2, "max_products": 45}


def _limited(spark: SparkSession, folder: str):
    now = datetime(2024, 5, 1, tzinfo=timezone.utc)
    return collect_products(ad.listing_pages(spark, folder), f"{ad.SHOP}/index.html", now, **LIMITS)


@query
def collect_limited(spark: SparkSession, folder: str) -> DataFrame:
    """The records that limits on categories, pages and products let through."""
    return _limited(spark, folder).records.select("category", "url", "price", "rating")


@query
def collect_limited_walks(spark: SparkSession, folder: str) -> DataFrame:
    """How far the limited walks came, and why they ended."""
    return _limited(spark, folder).walks.drop("start_url")


def _two_key_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Pages by user, ids by ``props``: neither key follows from the other."""
    k = F.regexp_extract("props", r"\d+", 0)
    return ad.table(spark, folder, "events").select(
        "event_id",
        F.concat(F.lit("https://shop.example/u/"), F.col("user_id"), F.lit("#"), F.col("event_type")).alias(
            "url"
        ),
        F.when(F.col("event_type") == "signup", "").otherwise(F.concat(F.lit("k"), k)).alias(
            "source_product_id"
        ),
    )


@query
def dedup_two_key(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_two_keys(_two_key_rows(spark, folder), "event_id").kept


@query
def dedup_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Rows linked in chains of 64, by page and by id in turn: each waits for the one before."""
    n = F.col("event_id")
    rows = ad.table(spark, folder, "events").select(
        "event_id",
        F.concat(F.lit("https://shop.example/c/"), F.floor(n / 2)).alias("url"),
        F.when(n % 64 != 0, F.concat(F.lit("k"), F.floor((n + 1) / 2))).alias("source_product_id"),
    )
    return dedup_two_keys(rows, "event_id").kept


@query
def dedup_in_run(spark: SparkSession, folder: str) -> DataFrame:
    rows = ad.observations(spark, folder).withColumn(
        "source_product_id", fprod.source_product_id(F.col("url"))
    )
    return dedup_two_keys(rows, "event_id").kept.select("event_id", "url", "source_product_id")


# -- validation and cleaning ---------------------------------------------------
@query
def validate_records(spark: SparkSession, folder: str) -> DataFrame:
    return validate(ad.dirty_records(spark, folder)).drop("issues")


@query
def validate_split(spark: SparkSession, folder: str) -> DataFrame:
    checked = validate(ad.dirty_records(spark, folder))
    counted = [
        part.agg(
            F.lit(name).alias("part"),
            F.count("*").alias("n"),
            F.count("price").alias("priced"),
            F.count("rating").alias("rated"),
        )
        for name, part in (("accepted", accepted(checked)), ("rejected", rejected(checked)))
    ]
    return counted[0].unionByName(counted[1])


@query
def validate_issues(spark: SparkSession, folder: str) -> DataFrame:
    return (
        validate(ad.dirty_records(spark, folder))
        # The outer form: a plain explode makes the planner test the array first, which
        # builds every issue list twice.
        .select(F.explode_outer("issues").alias("i"))
        .filter(F.col("i").isNotNull())
        .groupBy(F.col("i.issue_type").alias("issue_type"), F.col("i.field_name").alias("field_name"))
        .agg(F.count("*").alias("n"))
    )


@query
def reject_summary(spark: SparkSession, folder: str) -> DataFrame:
    named = F.transform(errors(F.col("issues")), lambda i: F.concat(i.issue_type, F.lit(":"), i.field_name))
    return rejected(validate(ad.dirty_records(spark, folder))).select(
        "event_id", F.array_join(named, "; ").alias("errors")
    )


def _dirty_tags(spark: SparkSession, folder: str) -> DataFrame:
    """The dirty records with their price as text, as an unvalidated landing table."""
    value = F.col("price")
    return ad.dirty_records(spark, folder).withColumn(
        "price",
        F.when(value < 0, "on request")
        .when(value > 250, F.concat(F.lit("€"), F.format_number(value * 100, 2)))
        .otherwise(F.concat(F.lit("£ "), F.format_number(value, 2))),
    )


@query
def clean_records(spark: SparkSession, folder: str) -> DataFrame:
    frame = clean(_dirty_tags(spark, folder), "event_id").frame
    return frame.withColumn("scraped_at", _utc_text(F.col("scraped_at")))


@query
def quality_counters(spark: SparkSession, folder: str) -> DataFrame:
    return clean(_dirty_tags(spark, folder), "event_id").counters


@query
def dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    return first_per_key(ad.observations(spark, folder), ["url"], "event_id").select(
        "event_id", "url", "name", "price", "category"
    )


# -- analytics -----------------------------------------------------------------
@query
def category_analysis(spark: SparkSession, folder: str) -> DataFrame:
    return an.by_category(an.summarize(ad.catalogue(spark, folder)))


@query
def catalog_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return an.kpis(ad.catalogue(spark, folder))


@query
def availability_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    return an.availability_breakdown(an.summarize(ad.catalogue(spark, folder)))


@query
def availability_raw(spark: SparkSession, folder: str) -> DataFrame:
    return an.availability_breakdown(ad.catalogue(spark, folder), "availability")


@query
def rating_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return an.rating_distribution(an.summarize(ad.catalogue(spark, folder)))


@query
def price_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return an.price_distribution(an.summarize(ad.catalogue(spark, folder)))


@query
def price_distribution_observed(spark: SparkSession, folder: str) -> DataFrame:
    rows = add_derived_columns(ad.observations(spark, folder))
    return an.price_distribution(an.summarize(rows))


@query
def top_rated(spark: SparkSession, folder: str) -> DataFrame:
    return an.top_rated(ad.observations(spark, folder), 10, "event_id")


@query
def cheapest(spark: SparkSession, folder: str) -> DataFrame:
    return an.cheapest(ad.observations(spark, folder), 10, "event_id")


@query
def price_changes(spark: SparkSession, folder: str) -> DataFrame:
    rows = ad.observations(spark, folder)
    run = _last_run(rows)
    current = first_per_key(rows.filter(F.col("run_id") == run), ["url"], "event_id")
    return an.price_changes(current, previous_prices(rows, run, "event_id"))


# -- stored catalogue ----------------------------------------------------------
@query
def previous_prices_asof(spark: SparkSession, folder: str) -> DataFrame:
    rows = ad.observations(spark, folder)
    return previous_prices(rows, _last_run(rows), "run_id", "event_id")


def _two_versions(spark: SparkSession, folder: str) -> DataFrame:
    rows = ad.observations(spark, folder)
    run = _last_run(rows)
    empty = spark.createDataFrame([], SNAPSHOT_SCHEMA)
    older = upsert(
        empty, rows.filter(F.col("run_id") < run), run - 1, _instant("2024-02-01"), "event_id"
    )
    return upsert(
        older, rows.filter(F.col("run_id") == run), run, _instant("2024-02-02"), "event_id"
    )


@query
def upsert_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return _two_versions(spark, folder).withColumns(
        {c: _utc_text(F.col(c)) for c in ("first_seen_at", "last_seen_at")}
    )


@query
def constraint_check(spark: SparkSession, folder: str) -> DataFrame:
    name = F.when(F.col("event_type") != "signup", "x")
    rows = ad.table(spark, folder, "events").select(
        name.alias("name"),
        F.concat(F.lit("https://shop.example/"), F.col("event_id")).alias("url"),
        F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("source_product_id"),
    )
    return constraint_violations(rows)


def _stored(spark: SparkSession, folder: str) -> tuple[CatalogStore, DataFrame]:
    """A catalogue holding the observations as two runs: all days but the last, and the last."""
    store = CatalogStore(spark, _scratch(spark, "catalog"))
    store.init()
    rows = ad.observations(spark, folder)
    last = _last_run(rows)
    for part, day in ((F.col("run_id") < last, 1), (F.col("run_id") == last, 2)):
        now = datetime(2024, 2, day, tzinfo=timezone.utc)
        run = store.start_run(now=now)
        store.write_batch(rows.filter(part), run, "event_id", now)
        store.finish_run(run, "success", {}, now)
    return store, rows


def _as_runs(spark: SparkSession, rows: DataFrame, runs: list[tuple[int, Column]]) -> CatalogStore:
    """A catalogue holding parts of the rows as runs, stored in the order of the list."""
    store = CatalogStore(spark, _scratch(spark, "catalog"))
    store.init()
    for run in sorted(run for run, _ in runs):
        store.start_run(run, datetime(2024, 2, run, tzinfo=timezone.utc))
    for run, part in runs:
        now = datetime(2024, 2, run, tzinfo=timezone.utc)
        store.write_batch(rows.filter(part), run, "event_id", now)
        store.finish_run(run, "success", {}, now)
    return store


_KNOWN = ("url", "name", "price", "touched_run", "known_price", "prior_price")


@query
def late_run(spark: SparkSession, folder: str) -> DataFrame:
    """The first run fails and is stored after the second: it comes last and loses nothing."""
    rows = ad.observations(spark, folder)
    last = _last_run(rows)
    store = _as_runs(spark, rows, [(2, F.col("run_id") == last), (1, F.col("run_id") < last)])
    return store.snapshot().select(*_KNOWN)


@query
def late_run_prices(spark: SparkSession, folder: str) -> DataFrame:
    """What the run that was stored late knew of prices, and how they moved."""
    rows = ad.observations(spark, folder)
    last = _last_run(rows)
    store = _as_runs(spark, rows, [(2, F.col("run_id") == last), (1, F.col("run_id") < last)])
    moved = store.price_changes(1).groupBy("category").agg(
        F.count("*").alias("n"), fp.money(F.sum("change")).alias("total")
    )
    known = store.previous_prices(1).agg(F.count("*").alias("n"), fp.money(F.sum("previous_price")).alias("total"))
    return moved.unionByName(known.withColumn("category", F.lit("known before")))


def _daily(spark: SparkSession, folder: str) -> CatalogStore:
    """A catalogue of all days but three, and three runs of one day each."""
    rows = ad.observations(spark, folder)
    last, day = _last_run(rows), F.col("run_id")
    days = [(k + 2, day == last - 2 + k) for k in range(3)]
    return _as_runs(spark, rows, [(1, day < last - 2), *days])


@query
def small_batches(spark: SparkSession, folder: str) -> DataFrame:
    """A base and three days of changes laid over it."""
    return _daily(spark, folder).snapshot().select(*_KNOWN)


@query
def store_kpis(spark: SparkSession, folder: str) -> DataFrame:
    """The headline figures of the stored catalogue, from the counts its runs kept."""
    return _daily(spark, folder).kpis()


@query
def store_categories(spark: SparkSession, folder: str) -> DataFrame:
    return an.by_category(_daily(spark, folder).summary())


@query
def store_distributions(spark: SparkSession, folder: str) -> DataFrame:
    """Availability, ratings and price bands before the last run and after it."""
    store = _daily(spark, folder)
    parts = []
    for when, before in (("before", 4), ("after", None)):
        summary = materialize(store.summary(before), "summary")
        for name, table in (
            ("availability", an.availability_breakdown(summary)),
            ("rating", an.rating_distribution(summary)),
            ("price", an.price_distribution(summary)),
        ):
            label, n = table.columns
            parts.append(
                table.select(
                    F.lit(when).alias("at"), F.lit(name).alias("table"), F.col(label).alias("label"),
                    F.col(n).cast("bigint").alias("n"),
                )
            )
    return reduce(DataFrame.unionByName, parts)


@query
def run_clock(spark: SparkSession, folder: str) -> DataFrame:
    """Every time a run writes is the one its clock showed at the start, whole seconds of UTC."""
    store = CatalogStore(spark, _scratch(spark, "catalog"))
    rows = ad.observations(spark, folder)
    last = _last_run(rows)
    for part, day in ((F.col("run_id") < last, 1), (F.col("run_id") == last, 2)):
        run_batch(store, rows.filter(part), "event_id", now=datetime(2024, 5, day, 12, 34, 56, tzinfo=timezone.utc))
    seen = store.history().groupBy("run_id").agg(
        F.min("captured_at").alias("first"), F.max("captured_at").alias("last"), F.count("*").alias("n")
    )
    runs = store.runs().select(F.col("id").alias("run_id"), F.col("started_at").alias("started"))
    touched = store.snapshot().groupBy(F.col("touched_run").alias("run_id")).agg(
        F.min("last_seen_at").alias("touched")
    )
    times = ("started", "first", "last", "touched")
    return runs.join(seen, "run_id").join(touched, "run_id").withColumns({c: _utc_text(F.col(c)) for c in times})


@query
def id_clashes(spark: SparkSession, folder: str) -> DataFrame:
    """New pages that claim the ids of stored products, as the table of ids finds them."""
    rows = ad.observations(spark, folder)
    store = _as_runs(spark, rows, [(1, F.lit(True))])
    claims = rows.filter(F.col("category") == "error").groupBy("source_product_id").agg(
        *[F.min(c).alias(c) for c in rows.columns if c not in ("source_product_id", "url")]
    )
    claims = claims.withColumn("url", F.concat(F.lit(f"{ad.SHOP}/copy/"), F.col("source_product_id")))
    try:
        store.write_batch(claims, 2, "event_id")
    except ConstraintError:
        return store.violations(2)
    return store.violations(2).limit(0)


@query
def history_append(spark: SparkSession, folder: str) -> DataFrame:
    store, _ = _stored(spark, folder)
    return (
        store.history()
        .groupBy("run_id")
        .agg(
            F.count("*").alias("n"),
            F.count("price").alias("priced"),
            F.countDistinct("url").alias("urls"),
            fp.money(F.sum("price")).alias("total"),
            _utc_text(F.max("captured_at")).alias("captured_at"),
        )
    )


@query
def snapshot_ordered(spark: SparkSession, folder: str) -> DataFrame:
    store, _ = _stored(spark, folder)
    return store.products().withColumns(
        {c: _utc_text(F.col(c)) for c in ("first_seen_at", "last_seen_at")}
    )


@query
def previous_prices_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    store, _ = _stored(spark, folder)
    return store.previous_prices(2)


def _logged(spark: SparkSession, folder: str) -> CatalogStore:
    """A store whose run log has a run per part of the observations, and one still open."""
    store = CatalogStore(spark, _scratch(spark, "catalog"))
    store.init()
    named = F.when(F.col("category") != "error", F.col("name"))
    rows = ad.observations(spark, folder).withColumn("name", named)
    last = _last_run(rows)
    for part, day in ((F.col("run_id") < last, 1), (F.col("run_id") == last, 2)):
        now = datetime(2024, 2, day, tzinfo=timezone.utc)
        run = store.start_run(now=now)
        verdict = validate(to_records(rows.filter(part)))
        found, good = verdict.agg(F.count("*"), F.count_if("is_valid")).first()
        counters = {"records_found": found, "records_accepted": good, "records_rejected": found - good}
        store.finish_run(run, run_status(good, found - good), counters, now)
    store.start_run(now=datetime(2024, 2, 3, tzinfo=timezone.utc))
    return store


@query
def store_runs(spark: SparkSession, folder: str) -> DataFrame:
    runs = _logged(spark, folder).runs()
    return runs.withColumns({c: _utc_text(F.col(c)) for c in ("started_at", "finished_at")})


@query
def run_by_id(spark: SparkSession, folder: str) -> DataFrame:
    return _logged(spark, folder).run(2).withColumn("started_at", _utc_text(F.col("started_at")))


@query
def history_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every stored observation with its run and place in the batch."""
    store, _ = _stored(spark, folder)
    return store.history().withColumn("captured_at", _utc_text(F.col("captured_at")))


@query
def snapshot_count(spark: SparkSession, folder: str) -> DataFrame:
    store, _ = _stored(spark, folder)
    return store.product_count()


@query
def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """The run log as readers see it, with one run per day of observations."""
    per_run = (
        validate(
            to_records(
                ad.observations(spark, folder).withColumn(
                    "name", F.when(F.col("category") != "error", F.col("name"))
                ),
                keep=("run_id", "seen_at"),
            )
        )
        .groupBy("run_id")
        .agg(
            F.min("seen_at").alias("opened"),
            F.max("seen_at").alias("closed"),
            F.count("*").alias("records_found"),
            F.count_if("is_valid").alias("records_accepted"),
            F.count_if(~F.col("is_valid")).alias("records_rejected"),
        )
    )
    status = (
        F.when(F.col("records_accepted") == 0, "no_data")
        .when(F.col("records_rejected") > 0, "partial")
        .otherwise("success")
    )
    zero = F.lit(0).cast("bigint")

    def event(kind: str, at: str, state: Column, counted: bool) -> DataFrame:
        return per_run.select(
            "run_id",
            F.lit(kind).alias("event"),
            F.col(at).alias("at"),
            state.alias("status"),
            *[
                (F.col(c) if counted and c.startswith("records") else zero).alias(c)
                for c in RUN_COUNTERS
            ],
        )

    events = (
        event(STARTED, "opened", F.lit("running"), False)
        .unionByName(event(STORED, "closed", F.lit("stored"), False))
        .unionByName(event(FINISHED, "closed", status, True))
    )
    return summarize_runs(events)


# -- reports -------------------------------------------------------------------
@query
def dashboard_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return report.dashboard(an.kpis(ad.catalogue(spark, folder)))


@query
def report_metadata(spark: SparkSession, folder: str) -> DataFrame:
    made = datetime(2024, 5, 1, 12, 30, 0)
    extra = {"run_id": 7, "records_rejected": 2, "duplicates_removed_in_cleaning": 5}
    return report.metadata(an.kpis(ad.catalogue(spark, folder)), ad.SHOP, made, extra)


@query
def chart_categories(spark: SparkSession, folder: str) -> DataFrame:
    return report.chart_top_categories(an.by_category(an.summarize(ad.catalogue(spark, folder))))


@query
def product_sheet(spark: SparkSession, folder: str) -> DataFrame:
    return report.product_sheet(add_derived_columns(ad.observations(spark, folder)))


@query
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = add_derived_columns(ad.observations(spark, folder)).drop("seen_at", "run_id")
    path = report.write_products_csv(
        rows, _scratch(spark, "csv"), datetime(2024, 5, 1, tzinfo=timezone.utc)
    )
    back = spark.read.option("header", True).csv(path)
    return back.select(
        *[F.col(c).cast(t) for c, t in rows.select(*back.columns).dtypes]
    )


@query
def analysis_bundle(spark: SparkSession, folder: str) -> DataFrame:
    """Every table of the analysis in one list: table, label, value."""
    rows = add_derived_columns(ad.observations(spark, folder))
    found = an.analyze(rows, price_changes(spark, folder), order="event_id")

    def part(name: str, table: DataFrame, label: str, value: str) -> DataFrame:
        return table.select(
            F.lit(name).alias("table"), F.col(label).cast("string").alias("label"), F.col(value).cast("double").alias("value")
        )

    headline = found.kpis.withColumn("label", F.lit("all"))
    parts = [part(f"kpi {c}", headline, "label", c) for c in ("total_products", "unique_products", "avg_price", "median_price")]
    parts += [
        part("category", found.by_category, "category", "avg_price"),
        part("availability", found.availability, "availability", "product_count"),
        part("rating", found.rating_distribution, "rating", "product_count"),
        part("price", found.price_distribution, "price_bucket", "product_count"),
        part("top", found.top_rated, "url", "rating"),
        part("cheapest", found.cheapest, "url", "price"),
        part("changes", found.price_changes, "name", "change"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def report_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """The report tables of two runs and their rows; price changes only where there are any."""
    root = _scratch(spark, "reports")
    store = CatalogStore(spark, f"{root}/catalog")
    rows = ad.observations(spark, folder)
    last = _last_run(rows)
    sizes = []
    for part in (F.col("run_id") < last, F.col("run_id") == last):
        now = datetime(2024, 5, 1, tzinfo=timezone.utc)
        outcome = run_batch(store, rows.filter(part), "event_id", f"{root}/reports", ad.SHOP, now=now)
        dataset = spark.read.parquet(store.dataset_path(outcome.run_id))
        for name in report_tables(outcome, store, dataset, ad.SHOP, now):
            table = spark.read.parquet(f"{outcome.report_path}/{name}")
            sizes.append(
                table.agg(F.count("*").alias("n")).select(
                    F.lit(outcome.run_id).cast("bigint").alias("run_id"), F.lit(name).alias("table"), "n"
                )
            )
    return reduce(DataFrame.unionByName, sizes)


# -- whole runs ----------------------------------------------------------------
@query
def monitor_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Two batch runs end to end: the price changes of the second."""
    store = CatalogStore(spark, _scratch(spark, "catalog"))
    store.init()
    rows = ad.observations(spark, folder)
    last = _last_run(rows)
    outcome = None
    for part in (F.col("run_id") < last, F.col("run_id") == last):
        outcome = run_batch(store, rows.filter(part), "event_id")
    return outcome.analysis.price_changes


@query
def monitor_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same two runs as micro-batches of a stream of files."""
    rows = ad.observations(spark, folder).withColumn("scraped_at", _ntz("seen_at"))
    rows = to_records(rows, keep=("event_id", "run_id"))
    last = _last_run(rows)
    root = _scratch(spark, "monitor")
    monitor = Monitor(CatalogStore(spark, f"{root}/catalog"), "event_id")
    outcomes = []
    for part in (F.col("run_id") < last, F.col("run_id") == last):
        rows.filter(part).write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/landing")
        outcomes = monitor.run(stream, f"{root}/offsets")
    return outcomes[-1].analysis.price_changes


def _landed(spark: SparkSession, folder: str, root: str) -> tuple[DataFrame, DataFrame]:
    """The observations as two deliveries of as many files each, and the stream of them."""
    rows = ad.observations(spark, folder).withColumn("scraped_at", _ntz("seen_at"))
    rows = to_records(rows, keep=("event_id", "run_id"))
    last = _last_run(rows)
    files = spark.sparkContext.defaultParallelism
    for part in (F.col("run_id") < last, F.col("run_id") == last):
        rows.filter(part).repartition(files).write.mode("append").parquet(f"{root}/landing")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files)
    return rows, stream.parquet(f"{root}/landing")


@query
def moves_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The price changes of two micro-batches, from state kept by URL."""
    root = _scratch(spark, "moves")
    _, stream = _landed(spark, folder, root)
    write_moves(stream, "event_id", f"{root}/moves", f"{root}/offsets").awaitTermination()
    return spark.read.parquet(f"{root}/moves").drop("url")


class _FailsOnce(CatalogStore):
    """A store whose first write fails, as a lost connection would make it."""

    failed = False

    def write_batch(self, *args, **options):
        if not self.failed:
            self.failed = True
            raise OSError("the store is away")
        return super().write_batch(*args, **options)


@query
def monitor_restart(spark: SparkSession, folder: str) -> DataFrame:
    """A stream whose first run fails, a plain run, and the stream again: nothing is lost."""
    root = _scratch(spark, "monitor")
    rows, stream = _landed(spark, folder, root)
    monitor = Monitor(_FailsOnce(spark, f"{root}/catalog"), "event_id")
    try:
        monitor.run(stream, f"{root}/offsets")
    except StreamingQueryException as failure:
        if "the store is away" not in str(failure):
            raise
    others = rows.withColumns({c: F.concat(c, F.lit("-other")) for c in ("url", "source_product_id")})
    run_batch(CatalogStore(spark, f"{root}/catalog"), others, "event_id")
    return monitor.run(stream, f"{root}/offsets")[-1].analysis.price_changes


@query
def monitor_limited(spark: SparkSession, folder: str) -> DataFrame:
    """A stream stopped after one run: the log and the catalogue hold the first file only."""
    root = _scratch(spark, "monitor")
    _, stream = _landed(spark, folder, root)
    store = CatalogStore(spark, f"{root}/catalog")
    Monitor(store, "event_id").run(stream, f"{root}/offsets", max_runs=1)
    return store.runs().select("id", "status", "records_found", "records_accepted").join(
        store.product_count(), F.col("id") == 1
    )
