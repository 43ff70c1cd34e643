"""Reading product records into the fixed contract."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.schema import RECORD_COLUMNS, RECORD_SCHEMA


def snake_case(header: str) -> str:
    """``"Product Name "`` and ``"productName"`` both become ``product_name``."""
    words = re.sub(r"\W+", "_", header.strip())
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", words).lower().strip("_")


def normalize_headers(df: DataFrame) -> DataFrame:
    """Rename every column to snake case; two headers meeting in one name raise."""
    names = [snake_case(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"headers collide after normalisation: {', '.join(clashes)}")
    return df.toDF(*names)


def add_missing_columns(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Add each absent contract column as null; returns the frame and the notes."""
    absent = [f for f in RECORD_SCHEMA.fields if f.name not in df.columns]
    if not absent:
        return df, []
    added = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
    return added, [f"added missing column {f.name!r}" for f in absent]


def to_records(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the contract columns (plus *keep*, e.g. the arrival order).

    Unknown columns are dropped and missing ones are null. Column types are left
    as they are, so text prices reach validation and cleaning unchanged.
    """
    full, _ = add_missing_columns(df)
    return full.select(*RECORD_COLUMNS, *keep)


def read_records(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Records from Parquet, ORC, JSON or CSV files, typed by the contract."""
    if fmt in ("parquet", "orc"):
        return to_records(spark.read.format(fmt).options(**options).load(path))
    if fmt == "csv":
        options.setdefault("header", "true")
    reader = spark.read.format(fmt).schema(RECORD_SCHEMA).options(**options)
    return reader.load(path)


def read_mixed_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines whose fields keep their own type per record, as VARIANT columns.

    A text price and a number price in the same file stay distinguishable, which
    the validation rules depend on. A line that is no JSON gives an empty record.
    """
    doc = F.try_parse_json("value")
    fields = [F.try_variant_get(doc, f"$.{name}", "variant").alias(name) for name in RECORD_COLUMNS]
    return spark.read.text(path).select(*fields)
