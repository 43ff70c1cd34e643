"""Unicode-aware text helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python counts as white space; Java's \s and Spark's trim know fewer.
SPACE_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# The same set as the inside of a regular-expression class; needs the (?U) flag.
SPACE_CLASS = r"\s\x1c-\x1f"


def strip(text: Column) -> Column:
    """Cut white space off both ends (native ``btrim``, no regular expression)."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def collapse(text: Column) -> Column:
    """Turn every run of white space into one space and strip; null stays null."""
    return F.trim(F.regexp_replace(text, f"(?U)[{SPACE_CLASS}]+", " "))


def clean_text(text: Column) -> Column:
    """Collapsed text, with null as the empty string."""
    return F.coalesce(collapse(text), F.lit(""))


def is_blank(text: Column) -> Column:
    """True for null and for text made of white space only."""
    return F.coalesce(strip(text), F.lit("")) == ""


def label_lookup(table: dict[str, object], key: Column) -> Column:
    """Value of *key* in a literal map, null when the key is unknown."""
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), key)


def number_or_null(text: Column) -> Column:
    """Plain decimal text as a double; anything else is null, never an error."""
    plain = rf"(?iU)\A[{SPACE_CLASS}]*[+-]?([0-9]+\.?[0-9]*(e[+-]?[0-9]+)?|\.[0-9]+(e[+-]?[0-9]+)?|inf|infinity)[{SPACE_CLASS}]*\z"
    return F.when(text.rlike(plain), strip(text).try_cast("double"))
