"""What the planner makes of the jobs: pruning, no cross joins, hot keys split."""

from __future__ import annotations

import os
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from shelfwatch.operators import analyze as an
from shelfwatch.operators.dedup import first_per_key
from shelfwatch.operators.validate import validate
from shelfwatch.plans.queries import QUERIES
from shelfwatch.runtime import scratch_dir
from shelfwatch.sources.records import to_records

FOLDER = "/root/testdata/sf0.001"
LAZY = [
    "availability_labels", "category_analysis", "clean_records", "dedup_first", "derived_bands",
    "link_extract", "previous_prices_asof", "price_changes", "price_distribution", "price_parse",
    "product_extract", "quality_counters", "rating_distribution", "run_log", "upsert_snapshot",
    "validate_issues", "validate_records",
]
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **conf):
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class _Session:
    """Just enough of a session to ask for its scratch folder."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master, self.applicationId = master, f"app-{master}"


def test_scratch_folder():
    assert scratch_dir(_Session("yarn", "hdfs:///scratch/")) == "hdfs:///scratch"
    with pytest.raises(RuntimeError):
        scratch_dir(_Session("spark://head:7077"))
    local = _Session("local[2]")
    assert os.path.isdir(scratch_dir(local)) and scratch_dir(local) == scratch_dir(local)


@needs_tables
@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@needs_tables
def test_scans_read_only_what_is_needed(spark):
    text = plan(QUERIES["category_analysis"](spark, FOLDER))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    columns = {c.split(":")[0] for s in schemas for c in s.split(",")}
    assert columns and columns <= {
        "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "p_partkey", "p_type", "p_brand",
    }


def test_validation_does_not_shuffle(spark, sample):
    assert "Exchange" not in plan(validate(to_records(sample, keep=("ord",))))


def test_first_per_key_limits_groups_before_the_shuffle(spark, sample):
    text = plan(first_per_key(sample, ["url"], "ord"))
    below = text[text.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_rankings_never_sort_everything(spark, sample):
    for df in (an.top_rated(sample), an.cheapest(sample)):
        assert "TakeOrderedAndProject" in plan(df) and "Exchange" not in plan(df)


def test_a_hot_url_is_split(spark):
    """A third of all rows on one URL: the join handles it in several tasks."""
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    rows = spark.range(0, 300_000, numPartitions=4).select(
        F.rand(1).cast("string").alias("name"),
        F.lit("c").alias("category"),
        F.concat(F.lit("u"), hot).alias("url"),
        F.rand(2).alias("price"),
    )
    before = spark.range(0, 300_000).select(
        F.concat(F.lit("u"), F.col("id")).alias("url"), F.lit(0.5).alias("previous_price")
    )
    tight = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "400k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    with settings(spark, **tight):
        total = an.price_changes(rows, before).agg(F.count("*").alias("n"), F.max("name"), F.sum("change"))
        assert total.collect()[0].n == 300_000
        assert "skew=true" in plan(total)


def test_first_per_key_sorts_by_a_hash_first(spark):
    """Keys that begin alike are not compared text by text to sort them."""
    rows = [(1, "https://shop.example/a"), (0, "https://shop.example/b"), (2, "https://shop.example/a"), (3, None), (4, None)]
    found = first_per_key(spark.createDataFrame(rows, "n long, url string"), ["url"], "n")
    assert sorted(r["n"] for r in found.collect()) == [0, 1, 3] and found.columns == ["n", "url"]
    text = plan(found)
    sorts = re.findall(r"Sort \[(\w+)#", text)
    assert sorts and "url" not in sorts and "xxhash64(url#" in text
