"""Sources, validation, cleaning and derived columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import RECORD_DDL, SHOP
from shelfwatch.operators.clean import clean
from shelfwatch.operators.derive import add_derived_columns
from shelfwatch.operators.validate import accepted, errors, rejected, validate
from shelfwatch.schema import RECORD_COLUMNS
from shelfwatch.sources.records import (
    add_missing_columns,
    normalize_headers,
    read_mixed_json,
    read_records,
    snake_case,
    to_records,
)

GOOD = {
    "name": "Lamp", "url": f"{SHOP}a", "price": 10.0, "currency": "GBP", "category": "Home",
    "availability": "In stock", "rating": 4.0, "image_url": "https://img.example/a.jpg",
    "source_product_id": "a", "scraped_at": "2024-05-01T10:00:00+00:00",
}


def one(spark, **change):
    row = {**GOOD, **change}
    ddl = RECORD_DDL.removeprefix("ord long, ")
    return validate(spark.createDataFrame([tuple(row[c] for c in RECORD_COLUMNS)], ddl)).first()


def kinds(row):
    return [(i.issue_type, i.field_name) for i in row.issues]


@pytest.mark.parametrize(
    "header, name",
    [(" Product Name ", "product_name"), ("productName", "product_name"), ("URL", "url"),
     ("price (GBP)", "price_gbp"), ("__x__", "x"), ("scrapedAt", "scraped_at")],
)
def test_snake_case(header, name):
    assert snake_case(header) == name


def test_headers_and_missing_columns(spark):
    df = spark.createDataFrame([("A", 1.0, "x")], "` Name ` string, PRICE double, other string")
    named = normalize_headers(df)
    full, notes = add_missing_columns(named)
    assert len(notes) == 8 and "added missing column 'url'" in notes
    assert to_records(named).columns == RECORD_COLUMNS
    with pytest.raises(ValueError):
        normalize_headers(spark.createDataFrame([(1, 2)], "`A b` int, a_b int"))


def test_clean_record_passes_without_issues(spark):
    row = one(spark)
    assert row.is_valid and row.issues == []


@pytest.mark.parametrize(
    "change, kind, valid",
    [
        ({"name": None}, ("missing_required", "name"), False),
        ({"name": "   "}, ("missing_required", "name"), False),
        ({"url": None}, ("missing_required", "url"), False),
        ({"url": "not-a-url"}, ("invalid_value", "url"), False),
        ({"price": None}, ("missing_optional", "price"), True),
        ({"price": -5.0}, ("invalid_value", "price"), True),
        ({"rating": 9.0}, ("invalid_value", "rating"), True),
        ({"rating": float("nan")}, ("invalid_value", "rating"), True),
        ({"currency": " "}, ("invalid_value", "currency"), True),
        ({"category": None}, ("missing_optional", "category"), True),
        ({"image_url": "a.jpg"}, ("invalid_value", "image_url"), True),
        ({"source_product_id": None}, ("warning", "source_product_id"), True),
    ],
)
def test_one_flaw(spark, change, kind, valid):
    row = one(spark, **change)
    assert kinds(row) == [kind] and row.is_valid is valid
    field = kind[1]
    if valid:
        assert row[field] is None


def test_blank_id_is_dropped_quietly_and_texts_are_stripped(spark):
    row = one(spark, source_product_id="  ", name="  Lamp\t", url=f" {SHOP}a ", currency=" EUR ")
    assert row.issues == [] and row.source_product_id is None
    assert (row.name, row.url, row.currency) == ("Lamp", f"{SHOP}a", "EUR")


def test_text_price_is_no_number(spark):
    df = spark.createDataFrame([("A", f"{SHOP}a", "cheap", 826)], "name string, url string, price string, currency int")
    row = validate(to_records(df)).first()
    assert ("invalid_value", "price") in kinds(row) and ("invalid_value", "currency") in kinds(row)
    assert row.price is None and row.currency is None and row.is_valid


def test_split_and_errors(spark):
    df = spark.createDataFrame(
        [("A", f"{SHOP}a"), (" ", f"{SHOP}b"), ("C", "nope")], "name string, url string"
    )
    checked = validate(to_records(df))
    assert [r.name for r in accepted(checked).collect()] == ["A"]
    bad = rejected(checked).orderBy("url").collect()
    assert len(bad) == 2 and bad[0].summary.startswith("missing_required:name: ")
    kept = checked.select(errors(F.col("issues")).alias("e")).collect()
    assert all(i.issue_type != "missing_optional" for r in kept for i in r.e)
    assert all(any(i.issue_type == "warning" for i in r.e) for r in kept)


def test_mixed_json_keeps_types(spark, tmp_path):
    lines = [
        '{"name":"A","url":"https://e.x/a","price":5,"rating":2.5,"junk":1}',
        '{"name":"B","url":"https://e.x/b","price":"5","rating":true}',
        '{"name":7,"url":"https://e.x/c","price":null}',
        "no json",
    ]
    (tmp_path / "in.json").write_text("\n".join(lines))
    rows = validate(read_mixed_json(spark, str(tmp_path))).collect()
    by_name = {r.name: r for r in rows}
    assert (by_name["A"].price, by_name["A"].rating) == (5.0, 2.5)
    assert {("invalid_value", "price"), ("invalid_value", "rating")} <= set(kinds(by_name["B"]))
    assert sum(not r.is_valid for r in rows) == 2


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_read_records(spark, sample, tmp_path, fmt):
    path = str(tmp_path / fmt)
    writer = sample.drop("ord", "rating").write
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)
    if fmt == "csv":
        sample.drop("ord").write.mode("overwrite").option("header", True).csv(path)
    back = read_records(spark, path, fmt)
    assert back.columns == RECORD_COLUMNS and back.count() == 4
    assert back.filter("price = 51.77").count() == 1


def frame(spark, rows, ddl):
    return clean(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "ord long, " + ddl), "ord")


def test_clean_text_and_url(spark):
    row = frame(
        spark,
        [("  Spaced   Out  ", "  https://e.x/a#reviews ", "  In   stock ", "  x_1 ")],
        "name string, url string, availability string, source_product_id string",
    ).frame.first()
    assert (row.name, row.url, row.availability, row.source_product_id) == (
        "Spaced Out", "https://e.x/a", "In Stock", "x_1",
    )


def test_clean_price_text(spark):
    out = frame(
        spark,
        [("A", "https://e.x/a", "£1,052.15"), ("B", "https://e.x/b", "not-a-price"), ("C", "https://e.x/c", None)],
        "name string, url string, price string",
    )
    rows = {r.name: r for r in out.frame.collect()}
    assert (rows["A"].price, rows["A"].currency, rows["A"].raw_price) == (1052.15, "GBP", "£1,052.15")
    assert (rows["B"].price, rows["B"].currency) == (None, "not-a-price")
    assert (rows["C"].price, rows["C"].currency, rows["C"].raw_price) == (None, None, None)
    assert out.counters.first().invalid_prices == 1


def test_clean_ratings_and_labels(spark):
    out = frame(
        spark,
        [("A", "https://e.x/a", "9", "In stock"), ("B", "https://e.x/b", "4", "Out of stock"),
         ("C", "https://e.x/c", "good", "In Stock"), ("D", "https://e.x/d", None, None)],
        "name string, url string, rating string, availability string",
    )
    rows = {r.name: r for r in out.frame.collect()}
    assert [rows[n].rating for n in "ABCD"] == [None, 4.0, None, None]
    assert rows["D"].availability is None and rows["D"].image_url is None
    counters = out.counters.first()
    assert counters.invalid_ratings == 1 and counters.normalised_availability == 2


def test_clean_keeps_first_even_if_nameless(spark, sample):
    out = clean(sample, "ord")
    assert sorted(r.ord for r in out.frame.collect()) == [1, 2, 4]
    counters = out.counters.first()
    assert (counters.rows_in, counters.rows_out, counters.duplicates_removed) == (4, 3, 1)
    hidden = frame(
        spark,
        [(" ", "https://e.x/a"), ("B", "https://e.x/a#1"), ("C", None), ("D", " ")],
        "name string, url string",
    )
    assert hidden.frame.count() == 0
    counters = hidden.counters.first()
    assert (counters.rows_in, counters.rows_out, counters.duplicates_removed) == (4, 0, 2)


def test_clean_accepts_malformed_and_empty_input(spark):
    odd = clean(spark.createDataFrame([(1, "A", "5")], "ord long, title string, cost string"), "ord")
    assert odd.frame.count() == 0 and set(RECORD_COLUMNS) <= set(odd.frame.columns)
    assert len(odd.notes) == 10
    empty = clean(spark.createDataFrame([], RECORD_DDL), "ord")
    assert empty.frame.count() == 0 and empty.counters.first().rows_in == 0


def test_clean_timestamps_row_by_row(spark):
    stamps = [
        ("2024-05-01T10:00:00+00:00", "2024-05-01 10:00:00"),
        ("2024-05-01T12:00:00+02:00", "2024-05-01 10:00:00"),
        ("2024-05-01 10:00:00", "2024-05-01 10:00:00"),
        ("2024-05-01", "2024-05-01 00:00:00"),
        ("2024-05-01T10:00:00Z", "2024-05-01 10:00:00"),
        ("yesterday", None),
    ]
    zone = spark.conf.get("spark.sql.session.timeZone")
    for session_zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", session_zone)
        try:
            out = frame(
                spark,
                [(str(i), f"https://e.x/{i}", s) for i, (s, _) in enumerate(stamps)],
                "name string, url string, scraped_at string",
            ).frame
            got = {
                r.name: r.at for r in out.select("name", F.unix_seconds("scraped_at").alias("at")).collect()
            }
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)
        for i, (_, want) in enumerate(stamps):
            expected = None if want is None else 1714521600 + (36000 if "10:00" in want else 0)
            assert got[str(i)] == expected, (session_zone, stamps[i])


def test_derived_columns(spark, sample):
    rows = {r.ord: r for r in add_derived_columns(clean(sample, "ord").frame).collect()}
    assert (rows[1].price_bucket, rows[1].availability_status, rows[1].rating_band) == (
        "50+", "Available", "Medium (3)",
    )
    assert (rows[4].price_bucket, rows[4].availability_status, rows[4].rating_band) == (None, "Unknown", None)
