"""Following next-page links from many start pages at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions.url import page_key
from shelfwatch.runtime import materialize


@dataclass(frozen=True)
class Walks:
    """Pages visited in order, and one summary row per walk."""

    visits: DataFrame
    summary: DataFrame


def walk_listings(seeds: DataFrame, links: DataFrame, max_pages: int = 0) -> Walks:
    """Walk every listing of *seeds* (``seed, start_url``) along *links*.

    *links* holds one row ``url, next_url`` per page that loads (``next_url``
    null on the last page); a page not listed there failed to load. A walk ends at
    its last page, at ``max_pages`` (0 = no limit), at a page it has seen (URLs
    compare without fragment) or at a page that fails.

    Every page has one successor, so the walks are built by doubling: a table of
    2^k-step jumps takes each walk from its first 2^k pages to its first 2^(k+1).
    A listing of n pages needs about log2(n) rounds of joins rather than n, and
    visited pages are rows, never an array that grows with the listing.
    """
    pages = materialize(
        links.groupBy(page_key(F.col("url")).alias("page"))
        .agg(F.min("next_url").alias("next_url"))
        .withColumn("next_page", page_key(F.col("next_url"))),
        "pages",
    )
    known = pages.select("page")
    start = seeds.select("seed", page_key(F.col("start_url")).alias("page"))
    live = start.join(known, "page", "left_semi").select(
        "seed", F.lit(0).cast("bigint").alias("depth"), "page"
    )
    jumps = pages.filter(F.col("next_page").isNotNull()).select(
        "page", F.col("next_page").alias("target")
    )
    jumps = materialize(
        jumps.join(known.withColumnRenamed("page", "target"), "target", "left_semi").select(
            "page", "target"
        ),
        "jump",
    )
    finished: list[DataFrame] = []
    steps = 1
    while True:
        reached = live.join(jumps, "page").select(
            "seed", (F.col("depth") + steps).alias("depth"), F.col("target").alias("page")
        )
        if max_pages:
            reached = reached.filter(F.col("depth") < max_pages)
        # A repeated page is where the walk closes a loop: keeping the first visit
        # of each page drops the loop and everything behind it.
        longer = live.unionByName(reached).groupBy("seed", "page").agg(F.min("depth").alias("depth"))
        steps *= 2
        visited = materialize(longer, "walk")
        # Depths have no gaps, so the walks still going are those with the last depth.
        running = visited.filter(F.col("depth") == steps - 1).select("seed")
        if (max_pages and steps >= max_pages) or running.isEmpty():
            finished.append(visited)
            break
        finished.append(visited.join(running, "seed", "left_anti"))
        live = visited.join(running, "seed", "left_semi")
        jumps = materialize(
            jumps.join(
                jumps.select(F.col("page").alias("target"), F.col("target").alias("beyond")), "target"
            ).select("page", F.col("beyond").alias("target")),
            "jump",
        )
    steps_taken = finished[0]
    for part in finished[1:]:
        steps_taken = steps_taken.unionByName(part)
    steps_taken = materialize(
        steps_taken.join(pages, "page").select("seed", "depth", "page", "next_url", "next_page"),
        "steps",
    )
    return Walks(_visits(seeds, steps_taken), _summary(seeds, steps_taken, known, max_pages))


def _visits(seeds: DataFrame, steps: DataFrame) -> DataFrame:
    """``seed, depth, url, page`` with the address each page was reached by."""
    arrivals = seeds.select("seed", F.lit(0).cast("bigint").alias("depth"), F.col("start_url").alias("url"))
    onward = steps.filter(F.col("next_url").isNotNull()).select(
        "seed", (F.col("depth") + 1).alias("depth"), F.col("next_url").alias("url")
    )
    return steps.select("seed", "depth", "page").join(
        arrivals.unionByName(onward), ["seed", "depth"]
    )


def _summary(seeds: DataFrame, steps: DataFrame, known: DataFrame, max_pages: int) -> DataFrame:
    """Counters and end flags per walk, judged from its last visited page.

    The order of the tests is the order of a walk: page limit, then loop, then
    load failure. A next page that exists but was not visited closes a loop.
    """
    last = steps.groupBy("seed").agg(
        F.count("*").alias("pages_visited"),
        F.max_by("next_url", "depth").alias("next_url"),
        F.max_by("next_page", "depth").alias("next_page"),
    )
    ends = (
        seeds.join(last, "seed", "left")
        .withColumn("pages_visited", F.coalesce("pages_visited", F.lit(0)))
        .withColumn("failed_start", F.col("pages_visited") == 0)
        .withColumn("onward", F.when(F.col("failed_start"), F.col("start_url")).otherwise(F.col("next_url")))
    )
    loads = known.select(F.col("page").alias("next_page"), F.lit(True).alias("loads"))
    at_limit = (F.col("pages_visited") >= max_pages) if max_pages else F.lit(False)
    more = F.col("onward").isNotNull()
    stopped = more & at_limit
    looped = more & ~at_limit & F.coalesce("loads", F.lit(False))
    failed = more & ~at_limit & ~F.coalesce("loads", F.lit(False))
    return ends.join(loads, "next_page", "left").select(
        "seed",
        "start_url",
        "pages_visited",
        failed.cast("bigint").alias("pages_failed"),
        F.when(failed, F.col("onward")).alias("failed_url"),
        looped.cast("bigint").alias("duplicates_detected"),
        stopped.alias("stopped_early"),
        failed.alias("stopped_on_failure"),
    )
