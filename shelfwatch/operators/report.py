"""Report tables: product list, dashboard, chart data and metadata."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.schema import (
    CSV_REPORT_COLUMNS,
    DASHBOARD_LABELS,
    METADATA_LABELS,
    PRODUCT_SHEET_COLUMNS,
)

CHART_CATEGORIES = 10
_BOM = "\ufeff"


def present_columns(df: DataFrame, order: list[str], extras: bool = False) -> DataFrame:
    """The columns of *order* that exist, then any others if *extras*."""
    listed = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c not in listed] if extras else []
    return df.select(*listed, *rest)


def product_csv(df: DataFrame) -> DataFrame:
    return present_columns(df, CSV_REPORT_COLUMNS, extras=True)


def product_sheet(df: DataFrame) -> DataFrame:
    return present_columns(df, PRODUCT_SHEET_COLUMNS)


def csv_name(now: datetime) -> str:
    return now.strftime("products_%Y%m%d_%H%M%S.csv")


def write_csv(df: DataFrame, path: str, bom: bool = True) -> None:
    """Write a folder of CSV part files, each with a header line (and BOM).

    Every part opens by itself in a spreadsheet, so the data never has to pass
    through a single task. An empty frame gives a header-only part.
    """
    out = df.withColumnRenamed(df.columns[0], _BOM + df.columns[0]) if bom else df
    out.write.mode("overwrite").options(
        header=True,
        escape='"',
        encoding="UTF-8",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


def write_products_csv(df: DataFrame, folder: str, now: datetime, name: str | None = None) -> str:
    path = f"{folder.rstrip('/')}/{name or csv_name(now)}"
    write_csv(product_csv(df), path)
    return path


def _label_rows(df: DataFrame, pairs: list[tuple[str, Column]]) -> DataFrame:
    rows = F.array(
        *[
            F.struct(
                F.lit(pos).cast("bigint").alias("pos"),
                F.lit(label).alias("label"),
                value.cast("string").alias("value"),
            )
            for pos, (label, value) in enumerate(pairs, start=1)
        ]
    )
    return df.select(F.inline(rows))


def dashboard(kpis: DataFrame) -> DataFrame:
    """``pos, label, value`` of the ten dashboard figures; an unset one is n/a."""
    shown = [
        (label, F.coalesce(F.col(kpi).cast("string"), F.lit("n/a")))
        for label, kpi in DASHBOARD_LABELS
    ]
    return _label_rows(kpis, shown)


def chart_top_categories(by_category: DataFrame, n: int = CHART_CATEGORIES) -> DataFrame:
    """Counts and average price of the largest categories."""
    return (
        by_category.orderBy(F.desc("product_count"), F.asc_nulls_last("category"))
        .limit(n)
        .select("category", "product_count", "avg_price")
    )


def metadata(
    kpis: DataFrame, source: str, generated: datetime, extra: dict[str, object] | None = None
) -> DataFrame:
    """``pos, label, value``: the fixed entries, then the extras by name."""
    values = [
        F.lit(generated.strftime("%Y-%m-%d %H:%M:%S UTC")),
        F.lit(source),
        F.coalesce(F.col("total_products"), F.lit(0)),
        F.col("avg_price").isNotNull(),
        F.col("avg_rating").isNotNull(),
    ]
    pairs = list(zip(METADATA_LABELS, values))
    pairs += [(key, F.lit(str(value))) for key, value in sorted((extra or {}).items())]
    return _label_rows(kpis, pairs)
