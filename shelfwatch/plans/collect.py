"""From a table of saved pages to de-duplicated product records."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.operators.dedup import dedup_two_keys, first_per_key
from shelfwatch.operators.ranks import integer_slice, values_at_ranks
from shelfwatch.operators.walk import walk_listings
from shelfwatch.runtime import materialize
from shelfwatch.schema import RECORD_COLUMNS
from shelfwatch.sources.listings import ListingRules, cards, links, read_listings


STATS = (
    "categories_found",
    "categories_scraped",
    "pages_visited",
    "pages_failed",
    "parser_errors",
    "duplicates_in_run",
    "records_scraped",
)


class NoCategoriesError(ValueError):
    """The overview page is missing or lists no category."""


@dataclass(frozen=True)
class Collected:
    """Records in arrival order (column ``ord``) and what the run saw."""

    records: DataFrame
    walks: DataFrame
    counters: DataFrame

    @property
    def stats(self) -> dict[str, int]:
        """The counters (one row, worked out when asked for) by name."""
        return self.counters.first().asDict()


@dataclass(frozen=True)
class Arrival:
    """Arrival order as one integer: category, page of the category, card of the page.

    Each position gets the bits that the largest one at hand needs.
    """

    page_bits: int
    card_bits: int

    @classmethod
    def of(cls, rows: DataFrame) -> Arrival:
        top = rows.agg(*[F.max(c).alias(c) for c in ("seed", "depth", "card_pos")]).first()
        bits = [int(top[c] or 0).bit_length() for c in ("seed", "depth", "card_pos")]
        if sum(bits) > 63:
            raise OverflowError("categories times pages times cards exceed a 64-bit number")
        return cls(bits[1], bits[2])

    def number(self) -> Column:
        high = F.shiftleft(F.col("seed").cast("bigint"), self.page_bits + self.card_bits)
        return high + F.shiftleft(F.col("depth").cast("bigint"), self.card_bits) + F.col("card_pos")

    def position(self, order: Column) -> tuple[Column, Column]:
        """Category and page of an arrival number."""
        page = F.shiftright(order, self.card_bits).bitwiseAND((1 << self.page_bits) - 1)
        return F.shiftright(order, self.page_bits + self.card_bits), page


def collect_products(
    pages: DataFrame,
    overview_url: str,
    now: datetime,
    rules: ListingRules = ListingRules(),
    max_categories: int = 0,
    max_pages: int = 0,
    max_products: int = 0,
) -> Collected:
    """Read the categories of the overview page and collect their products.

    *pages* is ``url, html``; a page that is not there failed to load. Each page
    is read once, whatever asks for it. A limit of 0 means none.
    """
    # Of several copies of a page the first address stays, then one by its content.
    found_on = F.struct("url", F.xxhash64("cards", "links", "next_href"))
    read = read_listings(pages, rules).withColumn("_copy", found_on)
    listings = materialize(first_per_key(read, ["page_key"], "_copy").drop("_copy"), "listings")
    overview = listings.filter(F.col("page_key") == overview_url.split("#", 1)[0])
    found = materialize(links(overview, rules), "categories")
    n_found = found.count()
    if n_found == 0:
        raise NoCategoriesError(f"no categories on {overview_url}")
    chosen = found.filter(F.col("pos") <= max_categories) if max_categories else found
    seeds = chosen.select(
        F.col("pos").cast("bigint").alias("seed"),
        F.col("name").alias("category"),
        F.col("url").alias("start_url"),
    )
    walks = walk_listings(seeds, listings.select("url", "next_url"), max_pages)
    visits = materialize(walks.visits, "visits")
    on_page = cards(listings, "page_key")
    found_cards = materialize(
        visits.select("seed", "depth", F.col("page").alias("page_key"))
        .join(on_page, "page_key")
        .join(seeds.select("seed", "category"), "seed")
        .withColumn("scraped_at", F.lit(now.isoformat(timespec="seconds")))
        .select("seed", "depth", "card_pos", *RECORD_COLUMNS, "error"),
        "cards",
    )
    arrival = Arrival.of(found_cards)
    rows = found_cards.select(arrival.number().alias("ord"), *RECORD_COLUMNS, "error")
    good = rows.filter(F.col("error").isNull()).drop("error")
    unique = dedup_two_keys(good, "ord")
    records, dropped, summary = unique.kept, unique.dropped, walks.summary
    counts = {"errors": rows.filter(F.col("error").isNotNull()), "visits": visits}
    last = _limit_position(records, max_products)
    if last is not None:
        records = records.filter(F.col("ord") <= last)
        dropped = dropped.filter(F.col("ord") < last)
        counts, summary = _cut(counts, summary, last, arrival)
    summary = materialize(summary, "walks")
    seen = [
        _named("categories_found", F.count("*"), found),
        _named("categories_scraped", F.count("*"), summary),
        _named("pages_failed", F.sum("pages_failed"), summary),
        _named("pages_visited", F.count("*"), counts["visits"]),
        _named("parser_errors", F.count("*"), counts["errors"]),
        _named("duplicates_in_run", F.count("*"), dropped),
        _named("records_scraped", F.count("*"), records),
    ]
    # One row a counter, folded to one row.
    counters = reduce(DataFrame.unionByName, seen).agg(
        *[F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in STATS]
    )
    return Collected(records, summary, counters)


def _named(name: str, value: Column, table: DataFrame) -> DataFrame:
    total = table.agg(F.coalesce(value, F.lit(0)).alias("n"))
    return total.select(F.lit(name).alias("name"), "n")


def _limit_position(records: DataFrame, limit: int) -> int | None:
    """Arrival number of the last record a product limit admits, if it is reached."""
    if not limit:
        return None
    hit = values_at_ranks(
        records, "ord", lambda n: F.array(F.lit(limit - 1).cast("bigint")), integer_slice
    ).first()
    return None if hit is None else hit["value"]


def _cut(
    counts: dict[str, DataFrame], summary: DataFrame, last: int, arrival: Arrival
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Keep what happened up to the page on which the limit was reached.

    That page is still read to its end; its walk stops early there.
    """
    at_category = last >> (arrival.page_bits + arrival.card_bits)
    at_page = (last >> arrival.card_bits) & ((1 << arrival.page_bits) - 1)
    seed, depth = F.col("seed"), F.col("depth")
    error_seed, error_page = arrival.position(F.col("ord"))
    seen = (seed < at_category) | ((seed == at_category) & (depth <= at_page))
    errors_seen = (error_seed < at_category) | (
        (error_seed == at_category) & (error_page <= at_page)
    )
    cut_here = seed == at_category
    nothing = F.lit(0).cast("bigint")
    shortened = summary.filter(seed <= at_category).withColumns(
        {
            "pages_visited": F.when(cut_here, F.lit(at_page + 1).cast("bigint")).otherwise(
                F.col("pages_visited")
            ),
            "pages_failed": F.when(cut_here, nothing).otherwise(F.col("pages_failed")),
            "failed_url": F.when(~cut_here, F.col("failed_url")),
            "duplicates_detected": F.when(cut_here, nothing).otherwise(
                F.col("duplicates_detected")
            ),
            "stopped_early": cut_here | F.col("stopped_early"),
            "stopped_on_failure": ~cut_here & F.col("stopped_on_failure"),
        }
    )
    return {
        "errors": counts["errors"].filter(errors_seen),
        "visits": counts["visits"].filter(seen),
    }, shortened
