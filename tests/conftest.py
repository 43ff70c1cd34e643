from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfwatch.runtime import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": 4,
            "spark.default.parallelism": 2,
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shelfwatch-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


RECORD_DDL = (
    "ord long, name string, url string, price double, currency string, category string, "
    "availability string, rating double, image_url string, source_product_id string, scraped_at string"
)
SHOP = "https://shop.example/catalogue/"


def record(ord, name, slug, price=None, **other):
    base = {
        "currency": "GBP" if price is not None else None,
        "category": None,
        "availability": None,
        "rating": None,
        "image_url": None,
        "source_product_id": slug,
        "scraped_at": "2024-05-01T10:00:00+00:00",
    }
    base.update(other)
    return (
        ord,
        name,
        f"{SHOP}{slug}/index.html",
        price,
        *[base[k] for k in list(base)],
    )


@pytest.fixture
def sample(spark):
    """Four records, the third a copy of the first page at another price."""
    rows = [
        record(1, "Lamp", "lamp_1", 51.77, category="Home", availability="In stock", rating=3.0,
               image_url="https://img.example/1.jpg"),
        record(2, "Desk", "desk_2", 53.74, category="Home", availability="In stock", rating=1.0),
        record(3, "Lamp", "lamp_1", 49.99, category="Home", availability="In stock", rating=3.0),
        record(4, "Chair", "chair_3"),
    ]
    return spark.createDataFrame(rows, RECORD_DDL)
