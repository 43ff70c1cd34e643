"""Record contract, stored-table schemas and the fixed label sets."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _L, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


# --- fixed values: column names of records, stored tables and the run log ------
RECORD_SCHEMA = _struct(
    name=_S,
    url=_S,
    price=_D,
    currency=_S,
    category=_S,
    availability=_S,
    rating=_D,
    image_url=_S,
    source_product_id=_S,
    scraped_at=_S,
)
_PRODUCT = dict(
    source_product_id=_S,
    name=_S,
    url=_S,
    price=_D,
    currency=_S,
    category=_S,
    availability=_S,
    rating=_D,
    image_url=_S,
    first_seen_at=_TS,
    last_seen_at=_TS,
)
HISTORY_SCHEMA = _struct(
    seq=_L,
    source_product_id=_S,
    name=_S,
    url=_S,
    price=_D,
    currency=_S,
    captured_at=_TS,
)
RUN_COUNTERS = [
    "categories",
    "pages_visited",
    "pages_failed",
    "records_found",
    "records_accepted",
    "records_rejected",
]
RUN_COLUMNS = ["id", "started_at", "finished_at", "status", *RUN_COUNTERS]
ISSUE_SCHEMA = _struct(issue_type=_S, field_name=_S, message=_S)
# ------------------------------------------------------------------------------
RECORD_COLUMNS = RECORD_SCHEMA.names
PRODUCT_COLUMNS = list(_PRODUCT)
#: What a batch overwrites of a stored product: all but its key and the two times.
PRODUCT_VALUES = [c for c in PRODUCT_COLUMNS if c not in ("url", "first_seen_at", "last_seen_at")]

# One row of the stored snapshot. The columns after the product's are bookkeeping:
# which run touched the row last, the newest known price, and the newest price
# known before that run.
SNAPSHOT_SCHEMA = _struct(
    **_PRODUCT,
    touched_run=_L,
    known_price=_D,
    known_price_id=_S,
    prior_price=_D,
    prior_price_id=_S,
)
# The values whose combinations are counted over the whole catalogue.
TALLY_KEYS = ["category", "currency", "availability", "price", "rating"]
TALLY_SCHEMA = _struct(**{c: _PRODUCT[c] for c in TALLY_KEYS}, n=_L)
# Which entry of the products' ids is whose; false: the URL has another id by now.
ID_SCHEMA = _struct(source_product_id=_S, url=_S, live=T.BooleanType())
# An event of a run. `commit` numbers the stored runs in the order they became visible;
# `versions` is what the run wrote of each part of a table, `merged` names the tables
# whose changes hold all earlier ones.
_WRITTEN = _struct(table=_S, part=T.IntegerType(), rows=_L, base=T.BooleanType())
RUN_EVENT_SCHEMA = _struct(
    seq=_L,
    run_id=_L,
    event=_S,
    at=_TS,
    status=_S,
    key=_S,
    commit=_L,
    versions=T.ArrayType(_WRITTEN),
    merged=T.ArrayType(_S),
    **{name: _L for name in RUN_COUNTERS},
)
VERSION_SCHEMA = _struct(table=_S, commit=_L, run_id=_L, part=T.IntegerType(), rows=_L, base=T.BooleanType())

# --- fixed values: label sets, lookup tables and report column orders ---------
CURRENCY_SYMBOLS = {"£": "GBP", "$": "USD", "€": "EUR", "₹": "INR", "¥": "JPY"}
RATING_WORDS = {"One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}
AVAILABILITY_LABELS = {
    "in stock": "In Stock",
    "instock": "In Stock",
    "available": "In Stock",
    "out of stock": "Out of Stock",
    "outofstock": "Out of Stock",
    "unavailable": "Out of Stock",
}
PRICE_BANDS = [
    ("0-10", 0.0, 10.0),
    ("10-20", 10.0, 20.0),
    ("20-30", 20.0, 30.0),
    ("30-40", 30.0, 40.0),
    ("40-50", 40.0, 50.0),
    ("50+", 50.0, float("inf")),
]
RATING_MIN, RATING_MAX = 0.0, 5.0
CSV_REPORT_COLUMNS = [
    "name",
    "url",
    "price",
    "currency",
    "category",
    "availability",
    "availability_status",
    "rating",
    "rating_band",
    "price_bucket",
    "image_url",
    "source_product_id",
    "scraped_at",
]
PRODUCT_SHEET_COLUMNS = [
    "name",
    "price",
    "currency",
    "category",
    "availability",
    "availability_status",
    "rating",
    "rating_band",
    "price_bucket",
    "url",
    "image_url",
    "source_product_id",
    "scraped_at",
]
DASHBOARD_LABELS = [
    ("Total products", "total_products"),
    ("Unique products", "unique_products"),
    ("Categories", "categories"),
    ("In stock", "in_stock"),
    ("Out of stock", "out_of_stock"),
    ("Average price", "avg_price"),
    ("Median price", "median_price"),
    ("Min price", "min_price"),
    ("Max price", "max_price"),
    ("Average rating", "avg_rating"),
]
METADATA_LABELS = [
    "Generated at (UTC)",
    "Data source",
    "Total rows in dataset",
    "Report includes price data",
    "Report includes rating data",
]
# ------------------------------------------------------------------------------
