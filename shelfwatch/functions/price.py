"""Price text parsing and price arithmetic as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwatch.functions.text import SPACE_CHARS, SPACE_CLASS, blank_to_null, label_lookup
from shelfwatch.schema import CURRENCY_SYMBOLS, PRICE_BANDS

_AMOUNT = r"[\p{Nd}.,]+"
_SYMBOL_RUN = rf"(?U)[^\p{{Nd}}.,{SPACE_CLASS}]+"
_TO_BLANK = " " * len(SPACE_CHARS)

_DIGITS = [c for c in map(chr, range(128, 0x1FFFF)) if unicodedata.category(c) == "Nd"]
_ASCII_FOR = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)


def _number(digits: Column) -> Column:
    """Digit text with thousands commas to double; malformed text is null."""
    plain = F.replace(digits, F.lit(","), F.lit(""))
    ascii_digits = F.when(
        plain.rlike("[^0-9.]"), F.translate(plain, "".join(_DIGITS), _ASCII_FOR)
    ).otherwise(plain)
    return ascii_digits.try_cast("double")


def currency_code(symbol: Column) -> Column:
    """ISO code of a currency symbol; an unknown symbol is kept, empty is null."""
    return F.coalesce(label_lookup(CURRENCY_SYMBOLS, symbol), blank_to_null(symbol))


def parse_price(text: Column) -> Column:
    """``struct(amount, currency)`` of a price tag whose symbol leads the amount.

    The amount is the first run of digits, points and commas; its symbol is the
    word that ends right before it, white space aside. Both are null when the text
    holds no readable amount.
    """
    digits = F.regexp_extract(text, _AMOUNT, 0)
    lead = F.translate(
        F.call_function("substring_index", text, digits, F.lit(1)), SPACE_CHARS, _TO_BLANK
    )
    symbol = F.substring_index(F.rtrim(lead), " ", -1)
    amount = _number(digits)
    return F.struct(
        amount.alias("amount"),
        F.when(amount.isNotNull(), currency_code(symbol)).alias("currency"),
    )


def price_amount(cell: Column) -> Column:
    """First number in a raw price text; commas are thousands separators."""
    return _number(F.regexp_extract(cell, _AMOUNT, 0))


def price_currency(cell: Column) -> Column:
    """First run of characters that can be no amount, mapped to its ISO code."""
    return currency_code(F.regexp_extract(cell, _SYMBOL_RUN, 0))


def price_band(price: Column) -> Column:
    """Label of the half-open band; null for null, NaN, negative and infinite."""
    band = F.lit(None).cast("string")
    for label, low, high in reversed(PRICE_BANDS):
        band = F.when((price >= low) & (price < high), label).otherwise(band)
    return band


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Round the way numpy does: scale, round ties to even, scale back."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def money(value: Column) -> Column:
    """Two-decimal figure of a report, rounded from the exact binary value.

    ``57.025`` is stored a little below that and becomes 57.02; rounding its
    shortest decimal form, as ``round`` does, would give 57.03.
    """
    number = value.cast("double")
    plain = F.isnan(number) | (F.abs(number) == float("inf"))
    return F.when(plain, number).otherwise(
        F.call_function("format_number", number, F.lit("0.00")).cast("double")
    )
