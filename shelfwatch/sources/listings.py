"""Listing pages: product cards, category links and next-page links."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwatch.functions.price import parse_price
from shelfwatch.functions.product import source_product_id, star_rating
from shelfwatch.functions.text import blank_to_null, clean_text, collapse
from shelfwatch.functions.url import page_key
from shelfwatch.sources import markup

# --- fixed values: where a listing page keeps its data, and its error texts ---
CARD = "article.product_pod"
TITLE_LINK = "h3 a"
IMAGE = "img.thumbnail"
PRICE = "p.price_color"
STOCK = "p.instock.availability"
RATING = "p.star-rating"
CATEGORY_LINKS = "div.side_categories ul ul a"
CATEGORY_LINKS_FALLBACK = "div.side_categories a"
NEXT_LINK = "ul.pager li.next a"
ALL_PRODUCTS_URL = "category/books_1/"
NO_TITLE_OR_LINK = "product is missing a title or a link"
CARD_FAILED = "Failed to parse product card %d/%d: %s"
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class ListingRules:
    """Selectors of one site; replace them to read another site's pages."""

    card: str = CARD
    title_link: str = TITLE_LINK
    image: str = IMAGE
    price: str = PRICE
    stock: str = STOCK
    rating: str = RATING
    links: str = CATEGORY_LINKS
    links_fallback: str = CATEGORY_LINKS_FALLBACK
    next_link: str = NEXT_LINK
    excluded_links: str = ALL_PRODUCTS_URL

    def selectors(self) -> tuple[str, ...]:
        return (
            self.card,
            self.title_link,
            self.image,
            self.price,
            self.stock,
            self.rating,
            self.links,
            self.links_fallback,
            self.next_link,
        )


_CARD_FIELDS = ["href", "title", "alt", "price", "stock", "rating", "image", "url", "image_url", "broken"]
_LINK_FIELDS = ["href", "text", "url"]
_CARD_TYPE = T.StructType([T.StructField(n, T.StringType()) for n in _CARD_FIELDS])
_LINK_TYPE = T.StructType([T.StructField(n, T.StringType()) for n in _LINK_FIELDS])
_PARSED_ARROW = pa.struct(
    [
        ("cards", pa.list_(pa.struct([(n, pa.string()) for n in _CARD_FIELDS]))),
        ("links", pa.list_(pa.struct([(n, pa.string()) for n in _LINK_FIELDS]))),
        ("next_href", pa.string()),
        ("next_url", pa.string()),
    ]
)
_PARSED_SPARK = T.StructType(
    [
        T.StructField("cards", T.ArrayType(_CARD_TYPE)),
        T.StructField("links", T.ArrayType(_LINK_TYPE)),
        T.StructField("next_href", T.StringType()),
        T.StructField("next_url", T.StringType()),
    ]
)


def _read_card(html: str, nodes: list[markup.Node], base: str, rules: ListingRules) -> dict:
    """The raw strings of one card; what they mean is worked out by Spark."""
    link = markup.first(nodes, rules.title_link)
    image = markup.first(nodes, rules.image)
    price = markup.first(nodes, rules.price)
    stock = markup.first(nodes, rules.stock)
    rating = markup.first(nodes, rules.rating)
    card = {
        "href": link and link.get("href"),
        "title": link and link.get("title"),
        "alt": image and image.get("alt"),
        "price": price and markup.text_of(html, price),
        "stock": stock and markup.text_of(html, stock),
        "rating": rating and rating.get("class"),
        "image": image and image.get("src"),
    }
    try:
        card["url"] = urljoin(base, card["href"]) if card["href"] else None
        card["image_url"] = urljoin(base, card["image"]) if card["image"] else None
    except ValueError as failure:
        card["broken"] = str(failure)
    return card


def _resolved(base: str, href: str | None) -> str | None:
    try:
        return urljoin(base, href) if href else None
    except ValueError:
        return None


def _read_page(base: str, html: str | None, rules: ListingRules) -> dict:
    nodes = markup.read_nodes(html or "", rules.selectors())
    cards = []
    for at, node in enumerate(nodes):
        if markup.matches(node, rules.card):
            cards.append(_read_card(html, markup.descendants(nodes, at), base, rules))
    links = markup.select(nodes, rules.links) or markup.select(nodes, rules.links_fallback)
    onward = markup.first(nodes, rules.next_link)
    href = " ".join((onward and onward.get("href") or "").split()) or None
    return {
        "cards": cards,
        "links": [
            {
                "href": n.get("href"),
                "text": markup.text_of(html, n),
                "url": _resolved(base, n.get("href")),
            }
            for n in links
        ],
        "next_href": href,
        "next_url": _resolved(base, href),
    }


def read_listings(pages: DataFrame, rules: ListingRules = ListingRules()) -> DataFrame:
    """Read each page once: ``url, page_key, cards, links, next_href, next_url``.

    Only the address and the markup go to Python, in Arrow batches limited by
    size, and only the short strings of cards and links come back.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = batch.column(0).to_pylist()
            parsed = [
                _read_page(url, html.as_py(), rules) for url, html in zip(urls, batch.column(1))
            ]
            columns = pa.array(parsed, _PARSED_ARROW).flatten()
            yield pa.RecordBatch.from_arrays(
                [pa.array(urls, pa.string()), *columns], ["url", *_PARSED_SPARK.names]
            )

    schema = T.StructType([T.StructField("url", T.StringType()), *_PARSED_SPARK.fields])
    parsed = pages.select("url", "html").mapInArrow(read, schema)
    return parsed.withColumn("page_key", page_key(F.col("url")))


def _name(card: Column) -> Column:
    title = blank_to_null(clean_text(card.title))
    return F.coalesce(title, blank_to_null(clean_text(card.alt)))


def cards(listings: DataFrame, *keep: str) -> DataFrame:
    """One row per card: the record columns, its position, and an error or null."""
    rows = listings.select(
        *keep,
        F.size("cards").cast("bigint").alias("card_total"),
        F.posexplode("cards").alias("nth", "card"),
    )
    card = F.col("card")
    card_pos = (F.col("nth") + 1).cast("bigint")
    name = _name(card)
    reason = F.when(
        name.isNull() | F.coalesce(card.href == "", F.lit(True)), F.lit(NO_TITLE_OR_LINK)
    ).otherwise(card.broken)
    price = parse_price(collapse(card.price))
    return rows.select(
        *keep,
        card_pos.alias("card_pos"),
        "card_total",
        name.alias("name"),
        card.url.alias("url"),
        price.amount.alias("price"),
        price.currency.alias("currency"),
        blank_to_null(collapse(card.stock)).alias("availability"),
        star_rating(card.rating).cast("double").alias("rating"),
        card.image_url.alias("image_url"),
        source_product_id(card.url).alias("source_product_id"),
        F.when(
            reason.isNotNull(),
            F.format_string(CARD_FAILED, card_pos, F.col("card_total"), reason),
        ).alias("error"),
    )


def extract_products(
    pages: DataFrame, rules: ListingRules = ListingRules(), category: Column | None = None
) -> DataFrame:
    """All cards of all pages; rows with ``error`` set are cards that failed."""
    found = cards(read_listings(pages, rules).withColumnRenamed("url", "page_url"), "page_url")
    return found.withColumn("category", F.lit(None).cast("string") if category is None else category)


def links(listings: DataFrame, rules: ListingRules = ListingRules()) -> DataFrame:
    """Category links per page: ``page_url, pos, name, url``.

    A link without text or target is skipped, the all-products link is left out,
    and of several links to one address on a page the first is kept. ``pos``
    counts the kept links of the page from 1.
    """
    rows = listings.select(
        F.col("url").alias("page_url"), F.posexplode("links").alias("at", "link")
    ).select(
        "page_url",
        "at",
        F.col("link.url").alias("url"),
        blank_to_null(clean_text(F.col("link.text"))).alias("name"),
    )
    usable = rows.filter(F.col("url").isNotNull() & F.col("name").isNotNull()).filter(
        ~F.col("url").rlike(rules.excluded_links)
    )
    kept = usable.groupBy("page_url", "url").agg(
        F.min("at").alias("at"), F.min_by("name", "at").alias("name")
    )
    # A group here is the links of one page, which that page's size bounds.
    ordered = kept.groupBy("page_url").agg(
        F.sort_array(F.collect_list(F.struct("at", "name", "url"))).alias("links")
    )
    return ordered.select(
        "page_url", F.posexplode("links").alias("nth", "link")
    ).select(
        "page_url",
        (F.col("nth") + 1).cast("bigint").alias("pos"),
        F.col("link.name").alias("name"),
        F.col("link.url").alias("url"),
    )


def extract_links(pages: DataFrame, rules: ListingRules = ListingRules()) -> DataFrame:
    return links(read_listings(pages, rules), rules)


def next_pages(listings: DataFrame) -> DataFrame:
    """``url, next_href, next_url`` per page; null on the last page."""
    return listings.select("url", "next_href", "next_url")
