"""Keep-first de-duplication on one key and on two keys at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.functions.text import blank_to_null
from shelfwatch.functions.url import page_key
from shelfwatch.operators.components import components
from shelfwatch.runtime import Scratch

#: Rows of a component that are gone through in arrival order in one go.
COMPONENT_ROWS = 10_000


def first_per_key(df: DataFrame, keys: list[str], order: str, descending: bool = False) -> DataFrame:
    """The first row of each key by the unique column *order* (or the last).

    The rank filter is pushed below the shuffle as a group limit, so each task
    sends at most one row per key however many copies a key has. Rows are sorted for it
    by a hash of the key first: addresses of one shop begin alike, and telling them apart
    takes a sort longer than all else.
    """
    by = F.col(order).desc() if descending else F.col(order).asc()
    rank = F.row_number().over(Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(by))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


@dataclass(frozen=True)
class TwoKeyResult:
    """Rows that stay, and the arrival numbers of the rows that go."""

    kept: DataFrame
    dropped: DataFrame


def dedup_two_keys(
    df: DataFrame, order: str, url: str = "url", identity: str = "source_product_id"
) -> TwoKeyResult:
    """Drop a row if its page or its id was already *kept*, in arrival order.

    A dropped row blocks nothing; an absent page or id matches nothing, so a row
    with neither stays. Copies of one (page, id) pair are folded first, so what follows
    sees narrow rows and each pair once; real catalogues, whose id is derived from the
    page, are done after one round.

    The rule is greedy, so it is worked out in rounds over the undecided rows. A row
    that none before it shares a key with stays. A row that exactly one before it shares
    a key with does the opposite of that one; such rows form chains, whose ends are found
    by doubling, so a chain of n rows takes log2(n) steps. What shares a key with a row
    that stays is dropped. When a round decides less than half, the rows left are split
    into connected components, and each component of at most ``COMPONENT_ROWS`` is gone
    through in arrival order; larger ones go on in rounds. (The rule on one dense
    component, ordered against it, is sequential by nature and may take many rounds.)
    """
    job = Scratch(df.sparkSession, "dedup")
    keyed = df.select(
        F.col(order).alias("ord"),
        page_key(F.col(url)).alias("page"),
        blank_to_null(F.col(identity)).alias("pid"),
    )
    has_key = F.col("page").isNotNull() | F.col("pid").isNotNull()
    pairs = keyed.filter(has_key).groupBy("page", "pid").agg(F.min("ord").alias("ord"))
    undecided = job.write(pairs, "pairs")
    left = undecided.count()
    winners = [keyed.filter(~has_key).select("ord")]
    while left:
        placed = job.write(_placed(undecided), "placed")
        stay = _decided(placed, job)
        winners.append(stay.select("ord"))
        rest = (
            placed.join(stay.select("ord"), "ord", "left_anti")
            .join(stay.select("page").dropna(), "page", "left_anti")
            .join(stay.select("pid").dropna(), "pid", "left_anti")
            .select("page", "pid", "ord")
        )
        before, undecided = undecided, job.write(rest, "undecided")
        job.drop(before, placed)
        was, left = left, undecided.count()
        if left > was / 2:
            done, undecided = _by_component(undecided, job)
            winners.append(done)
            left = undecided.count()
    kept = reduce(DataFrame.unionByName, winners).select(F.col("ord").alias(order))
    # Few rows go in practice: the planner can then broadcast the dropped numbers
    # (it knows their size on disk) and the wide rows are never shuffled.
    dropped = job.write(df.select(order).join(kept, order, "left_anti"), "dropped")
    return TwoKeyResult(df.join(dropped, order, "left_anti"), dropped)


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with the number of rows before them that share a key (0, 1, or 2 for more), and the only one."""
    found = []
    for key in ("page", "pid"):
        # A task sends the two first rows of a key at most, however many it has.
        rank = F.row_number().over(Window.partitionBy(key).orderBy("ord"))
        firsts = rows.filter(F.col(key).isNotNull()).select(key, "ord").withColumn("rank", rank).filter("rank <= 2")
        firsts = firsts.groupBy(key).agg(F.min("ord").alias(f"{key}_1"), F.max("ord").alias(f"{key}_2"))
        rows = rows.join(firsts, key, "left")
        first, second = F.col(f"{key}_1"), F.col(f"{key}_2")
        place = F.when(first.isNull() | (F.col("ord") == first), 0).when(F.col("ord") == second, 1).otherwise(2)
        found.append((place, first))
    (page, page_1), (pid, pid_1) = found
    return rows.select(
        "page",
        "pid",
        "ord",
        F.least(page + pid, F.lit(2)).alias("before"),
        F.when(page == 1, page_1).otherwise(pid_1).alias("only"),
    )


def _decided(placed: DataFrame, job: Scratch) -> DataFrame:
    """The rows that certainly stay: those without one before them, and those at an even place behind one."""
    heads = placed.filter("before = 0").select("page", "pid", "ord")
    open_ = _shortened(placed.filter("before = 1").select("ord", "only"), job)
    closed: list[DataFrame] = []
    while not open_.isEmpty():
        known = reduce(DataFrame.unionByName, [open_, *closed])
        known = known.select(F.col("ord").alias("at"), F.col("only").alias("next"), F.col("odd").alias("flip"))
        step = open_.join(known, F.col("only") == F.col("at"), "left").select(
            "ord",
            F.coalesce("next", "only").alias("only"),
            F.when(F.col("at").isNull(), F.col("odd")).otherwise(F.col("odd") != F.col("flip")).alias("odd"),
            F.col("at").isNotNull().alias("moved"),
        )
        step = job.write(step, "chains")
        closed.append(step.filter("not moved").select("ord", "only", "odd"))
        open_ = step.filter("moved").select("ord", "only", "odd")
    if not closed:
        return job.write(heads, "stay")
    even = reduce(DataFrame.unionByName, closed).filter("not odd")
    behind = even.join(heads.select(F.col("ord").alias("only")), "only", "left_semi")
    more = placed.join(behind.select("ord"), "ord", "left_semi").select("page", "pid", "ord")
    return job.write(heads.unionByName(more), "stay")


def _shortened(rows: DataFrame, job: Scratch) -> DataFrame:
    """ord, only and odd of the chains' rows, each led past the rows of its own batch.

    Rows lie in order of arrival, so a chain mostly stays within a batch and only its
    links between batches are left to joins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ord_, only = (b.column(c).to_numpy().copy() for c in ("ord", "only"))
            odd = np.ones(len(ord_), bool)
            while len(ord_):
                at = np.minimum(np.searchsorted(ord_, only), len(ord_) - 1)
                here = ord_[at] == only
                if not here.any():
                    break
                odd = np.where(here, odd ^ odd[at], odd)
                only = np.where(here, only[at], only)
            yield pa.RecordBatch.from_arrays([b.column("ord"), pa.array(only), pa.array(odd)], ["ord", "only", "odd"])

    kind = rows.schema["ord"].dataType.simpleString()
    ordered = rows.repartitionByRange("ord").sortWithinPartitions("ord")
    return job.write(ordered.mapInArrow(run, f"ord {kind}, only {kind}, odd boolean"), "batches")


def _by_component(rows: DataFrame, job: Scratch) -> tuple[DataFrame, DataFrame]:
    """Numbers of the rows that stay in small components, and the rows of large ones."""
    links = [
        rows.join(rows.groupBy(key).agg(F.min("ord").alias("b")), key).select(F.col("ord").alias("a"), "b")
        for key in ("page", "pid")
    ]
    groups = components(reduce(DataFrame.unionByName, links), job)
    whole = rows.join(groups.withColumnRenamed("node", "ord"), "ord", "left")
    whole = job.write(whole.withColumn("component", F.coalesce("component", "ord")), "components")
    large = whole.groupBy("component").count().filter(F.col("count") > COMPONENT_ROWS)
    large = job.write(large.select("component"), "large")
    small = whole.join(large, "component", "left_anti")
    rest = whole.join(large, "component", "left_semi").select("page", "pid", "ord")
    return job.write(_in_order(small), "in-order"), job.write(rest, "undecided")


def _in_order(rows: DataFrame) -> DataFrame:
    """The rows of each component that stay, found one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages: set[str] = set()
        ids: set[str] = set()
        at = None
        for b in batches:
            stay = []
            columns = [b.column(c).to_pylist() for c in ("component", "page", "pid")]
            for component, page, pid in zip(*columns):
                if component != at:
                    pages, ids, at = set(), set(), component
                free = page not in pages and pid not in ids
                stay.append(free)
                if free:
                    pages.update([page] if page is not None else [])
                    ids.update([pid] if pid is not None else [])
            yield pa.RecordBatch.from_arrays([b.column("ord").filter(pa.array(stay, pa.bool_()))], ["ord"])

    schema = T.StructType([rows.schema["ord"]])
    ordered = rows.select("component", "ord", "page", "pid").repartition("component")
    return ordered.sortWithinPartitions("component", "ord").mapInArrow(run, schema)
