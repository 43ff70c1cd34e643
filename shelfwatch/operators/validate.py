"""Record validation: repaired columns, an issue list and a verdict per row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.functions.text import blank_to_null, strip
from shelfwatch.functions.url import is_http_url
from shelfwatch.schema import ISSUE_SCHEMA, RATING_MAX, RATING_MIN, RECORD_COLUMNS

MISSING_REQUIRED = "missing_required"
INVALID_VALUE = "invalid_value"
MISSING_OPTIONAL = "missing_optional"
WARNING = "warning"


@dataclass(frozen=True)
class _Cell:
    """One input cell seen through the questions the rules ask of it."""

    absent: Column
    number: Column
    text: Column
    shown: Column


def _cell(df: DataFrame, name: str) -> _Cell:
    """View a column by its type: only numbers are numeric, only text is text."""
    col, dtype = F.col(name), df.schema[name].dataType
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(dtype, T.VariantType):
        kind = F.schema_of_variant(col)
        is_number = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
        return _Cell(
            col.isNull() | F.is_variant_null(col),
            F.when(is_number, F.try_variant_get(col, "$", "double")),
            F.when(kind == "STRING", F.try_variant_get(col, "$", "string")),
            F.to_json(col),
        )
    if isinstance(dtype, T.NumericType):
        return _Cell(col.isNull(), col.cast("double"), no_text, col.cast("string"))
    if isinstance(dtype, T.StringType):
        return _Cell(col.isNull(), no_number, col, col)
    return _Cell(col.isNull(), no_number, no_text, col.cast("string"))


_TEXTS = [
    "name",
    "url",
    "currency",
    "category",
    "availability",
    "image_url",
    "source_product_id",
]
_NUMBERS = ["price", "rating"]


def _tidy(field: str) -> Column:
    return F.col(f"_tidy_{field}")


def _issue(kind: str, field: str, *message: str | Column) -> Column:
    parts = [p if isinstance(p, Column) else F.lit(p) for p in message]
    return F.struct(
        F.lit(kind).alias("issue_type"),
        F.lit(field).alias("field_name"),
        F.concat_ws("", *parts).alias("message"),
    )


def _optional(field: str, cell: _Cell, *bad: tuple[Column, str]) -> Column:
    """Absent gives ``missing_optional``; the first failing rule ``invalid_value``."""
    issue = F.when(cell.absent, _issue(MISSING_OPTIONAL, field, "absent"))
    for failed, reason in bad:
        issue = issue.when(failed, _issue(INVALID_VALUE, field, reason, ": ", cell.shown))
    return issue


def _issues(cells: dict[str, _Cell]) -> Column:
    """The issue array, in rule order."""
    price, rating = _tidy("price"), _tidy("rating")
    product_id = cells["source_product_id"]
    found = [
        F.when(_tidy("name").isNull(), _issue(MISSING_REQUIRED, "name", "required but empty")),
        F.when(_tidy("url").isNull(), _issue(MISSING_REQUIRED, "url", "required but empty")).when(
            ~F.col("_url_ok"),
            _issue(INVALID_VALUE, "url", "no http(s) address: ", cells["url"].shown),
        ),
        _optional(
            "price", cells["price"], (price.isNull(), "not a number"), (price < 0, "below zero")
        ),
        _optional(
            "rating",
            cells["rating"],
            (rating.isNull(), "not a number"),
            (~rating.between(RATING_MIN, RATING_MAX), "outside the scale"),
        ),
        *[
            _optional(f, cells[f], (_tidy(f).isNull(), "empty or not text"))
            for f in ("currency", "category", "availability")
        ],
        _optional("image_url", cells["image_url"], (~F.col("_image_ok"), "no http(s) address")),
        F.when(
            product_id.absent, _issue(WARNING, "source_product_id", "absent, URL is the only key")
        ),
    ]
    none = F.array().cast(T.ArrayType(ISSUE_SCHEMA))
    return F.concat(*[F.when(i.isNotNull(), F.array(i)).otherwise(none) for i in found])


def validate(df: DataFrame) -> DataFrame:
    """Check every record and add ``issues`` and ``is_valid``.

    The contract columns come back repaired: text stripped, unusable optional
    values null. Other columns pass through. All rules are column expressions
    without a shuffle; stripping, testing and repairing are separate projections,
    so each value is worked out once and the generated code stays small.
    """
    cells = {f: _cell(df, f) for f in RECORD_COLUMNS}
    tidied = df.select(
        "*",
        *[blank_to_null(strip(cells[f].text)).alias(f"_tidy_{f}") for f in _TEXTS],
        *[cells[f].number.alias(f"_tidy_{f}") for f in _NUMBERS],
    )
    tested = tidied.select(
        "*",
        is_http_url(_tidy("url")).alias("_url_ok"),
        is_http_url(_tidy("image_url")).alias("_image_ok"),
    )
    price, rating, stamp = _tidy("price"), _tidy("rating"), cells["scraped_at"]
    repaired = {
        "name": F.coalesce(_tidy("name"), cells["name"].text),
        "url": F.when(F.col("_url_ok"), _tidy("url")).otherwise(cells["url"].text),
        "price": F.when(price >= 0, price),
        "rating": F.when(rating.between(RATING_MIN, RATING_MAX), rating),
        "image_url": F.when(F.col("_image_ok"), _tidy("image_url")),
        "scraped_at": F.coalesce(stamp.text, stamp.shown),
        **{
            f: _tidy(f) for f in ("currency", "category", "availability", "source_product_id")
        },
    }
    return tested.select(
        *[repaired.get(c, F.col(c)).alias(c) for c in df.columns],
        _issues(cells).alias("issues"),
        (_tidy("name").isNotNull() & F.col("_url_ok")).alias("is_valid"),
    )


def errors(issues: Column) -> Column:
    """Issues that matter: everything but ``missing_optional``."""
    return F.filter(issues, lambda i: i.issue_type != MISSING_OPTIONAL)


def issue_summary(issues: Column) -> Column:
    """``type:field: message`` of every error, joined with ``"; "``."""
    return F.array_join(
        F.transform(
            errors(issues),
            lambda i: F.concat(i.issue_type, F.lit(":"), i.field_name, F.lit(": "), i.message),
        ),
        "; ",
    )


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter("is_valid").drop("issues", "is_valid")


def rejected(validated: DataFrame) -> DataFrame:
    """Rejected rows with their issues and the one-line summary."""
    return validated.filter(~F.col("is_valid")).withColumn("summary", issue_summary(F.col("issues")))
