from __future__ import annotations

import random
import re
from urllib.parse import urljoin

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwatch.functions import price as fp
from shelfwatch.functions import product as fprod
from shelfwatch.functions import text as ft
from shelfwatch.functions import url as furl

CODES = {"£": "GBP", "$": "USD", "€": "EUR", "₹": "INR", "¥": "JPY"}


def values(spark, items, make, ddl="x string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, {ddl}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "text, amount, currency",
    [
        ("£51.77", 51.77, "GBP"),
        ("€8,00", 800.0, "EUR"),
        ("£1,052.15", 1052.15, "GBP"),
        ("$ 12.50", 12.5, "USD"),
        ("19.99", 19.99, None),
        ("10 £", 10.0, None),
        ("kr 5", 5.0, "kr"),
        ("-5.00", 5.0, "-"),
        ("1.2.3", None, None),
        ("not-a-price", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_parse_price(spark, text, amount, currency):
    assert values(spark, [text], fp.parse_price)[0] == (amount, currency)


def test_price_functions_agree_with_a_plain_model(spark):
    rnd = random.Random(3)
    alphabet = "£$€ab \t 12.,-5\xa0٣#"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(9))) for _ in range(3000)]

    def number(digits):
        try:
            return float(digits.replace(",", ""))
        except ValueError:
            return None

    def leading(t):
        m = re.search(r"([^\d.,\s]*?)\s*([\d.,]+)", t)
        amount = number(m[2]) if m else None
        return (None, None) if amount is None else (amount, CODES.get(m[1], m[1] or None))

    def anywhere(t):
        m = re.search(r"[^\d.,\s]+", t)
        return CODES.get(m[0], m[0]) if m else None

    def first(t):
        m = re.search(r"[\d.,]+", t)
        return number(m[0]) if m else None

    assert values(spark, texts, fp.parse_price) == [leading(t) for t in texts]
    assert values(spark, texts, fp.price_currency) == [anywhere(t) for t in texts]
    assert values(spark, texts, fp.price_amount) == [first(t) for t in texts]


def test_white_space_is_what_python_says(spark):
    chars = [chr(c) for c in range(1, 0x3100)]
    wrapped = [f"{c}a{c}{c}b{c}" for c in chars]
    assert values(spark, wrapped, ft.collapse) == [re.sub(r"\s+", " ", w).strip() for w in wrapped]
    assert values(spark, wrapped, ft.strip) == [w.strip() for w in wrapped]


def test_rating_words(spark):
    got = values(
        spark,
        ["star-rating One", "star-rating five", "THREE star", "Four Two", "Fiveish", "", None],
        fprod.star_rating,
    )
    assert got == [1, 5, 3, 2, None, None, None]


def test_availability(spark):
    texts = ["  In   stock ", "OUT OF STOCK", "unavailable", "Ships soon", " ", None]
    assert values(spark, texts, fprod.canonical_availability) == [
        "In Stock", "Out of Stock", "Out of Stock", "Ships soon", None, None,
    ]
    texts = ["In Stock", "not in stock", "OutOfStock", "out of stock", "soon", None]
    assert values(spark, texts, fprod.availability_status) == [
        "Available", "Available", "Unavailable", "Unavailable", "Unknown", "Unknown",
    ]


def test_bands(spark):
    inf, nan = float("inf"), float("nan")
    prices = [0.0, 9.99, 10.0, 49.99, 50.0, 1e9, -0.01, inf, nan, None]
    assert values(spark, prices, fp.price_band, "x double") == [
        "0-10", "0-10", "10-20", "40-50", "50+", "50+", None, None, None, None,
    ]
    assert values(spark, [0.0, 2.9, 3.0, 3.9, 4.0, 5.0, None], fprod.rating_band, "x double") == [
        "Low (1-2)", "Low (1-2)", "Medium (3)", "Medium (3)", "High (4-5)", "High (4-5)", None,
    ]
    odd = [0.125, 2.5, -2.345, 2.675, 1e9 / 3]
    assert values(spark, odd, fp.round_half_even, "x double") == list(np.round(odd, 2))


def test_source_id(spark):
    def model(url):
        parts = [p for p in url.split("/") if p]
        if len(parts) < 2:
            return None
        return parts[-2] if parts[-1].startswith("index") else parts[-1]

    rnd = random.Random(4)
    urls = ["https://e.x/a/light_1000/index.html", "https://e.x/a/light_1000", "one", "", "//"]
    pieces = ["/", "a", "index", "index.html", "//", ":", "b#"]
    urls += ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(8))) for _ in range(2000)]
    assert values(spark, urls, fprod.source_product_id) == [model(u) for u in urls]


def test_urls(spark):
    urls = ["http://a.b/c", "HTTPS://a", "ftp://a", "http://", "http://a b", "http://a\nb", "", None]
    assert values(spark, urls, furl.is_http_url) == [True, True, False, False, False, False, False, False]
    assert values(spark, [" https://a/b#c#d ", "#x", " ", None], furl.clean_url) == [
        "https://a/b", None, None, None,
    ]
    hrefs = ["../c", "/d", "?p=2", "#f", "https://o/x", "page-2.html", ""]
    base = "https://a.b/x/y/index.html#top"
    got = values(spark, hrefs, lambda h: furl.resolve_url(F.lit(base), h))
    assert got == [urljoin(base, h) for h in hrefs]
    assert values(spark, [None], lambda h: furl.resolve_url(F.lit(base), h)) == [None]


def test_number_text(spark):
    texts = ["4", " 4.5 ", "1e2", "4d", "0x10", "four", "-1", "", None]
    assert values(spark, texts, ft.number_or_null) == [4.0, 4.5, 100.0, None, None, None, -1.0, None, None]
