"""Shape the given tables into product records, observations and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.operators.derive import add_derived_columns

SHOP = "https://shop.example"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text(value: Column) -> Column:
    return value.cast("string")


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as price observations: one run per day, errors have no price."""
    kind = F.col("event_type")
    product = F.concat(F.lit("item_"), text(F.col("user_id")))
    return table(spark, folder, "events").select(
        F.col("event_id"),
        F.datediff(F.to_date("ts"), F.lit("2023-12-31").cast("date")).cast("bigint").alias("run_id"),
        F.concat(F.lit("Item "), text(F.col("user_id"))).alias("name"),
        F.concat(F.lit(f"{SHOP}/catalogue/"), product, F.lit("/index.html")).alias("url"),
        F.when(kind != "error", F.col("value")).alias("price"),
        F.when(kind != "signup", F.lit("GBP")).alias("currency"),
        kind.alias("category"),
        F.when(kind == "view", "In stock")
        .when(kind == "click", "Out of stock")
        .when(kind == "purchase", " instock ")
        .alias("availability"),
        F.when(kind != "click", F.rint(F.col("value") / 100)).alias("rating"),
        F.lit(None).cast("string").alias("image_url"),
        product.alias("source_product_id"),
        F.col("ts").alias("seen_at"),
    )


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """``lineitem`` with ``part`` as cleaned catalogue rows plus derived columns."""
    lines = table(spark, folder, "lineitem").select(
        "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    brand, flag = F.col("p_brand"), F.col("l_returnflag")
    return add_derived_columns(
        lines.join(parts, lines.l_partkey == parts.p_partkey).select(
            F.col("p_name").alias("name"),
            F.concat(F.lit(f"{SHOP}/part/"), text(F.col("p_partkey"))).alias("url"),
            (F.col("l_extendedprice") / F.col("l_quantity") / 100).alias("price"),
            F.when(brand == "Brand#7", "EUR").when(brand != "Brand#9", "GBP").alias("currency"),
            F.when(brand != "Brand#13", F.col("p_type")).alias("category"),
            F.when(flag == "A", "In Stock").when(flag == "R", "Out of Stock").alias("availability"),
            (F.col("l_quantity") / 10).alias("rating"),
        )
    )


def price_texts(spark: SparkSession, folder: str) -> DataFrame:
    """``orders`` with a price tag as written on some page."""
    amount = F.format_number("o_totalprice", 2)
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")

    def tag(*parts: str | Column) -> Column:
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    odd = (
        F.when(status == "F", "not-a-price").when(status == "O", "1.2.3").otherwise(tag("Price: ₹", amount))
    )
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(priority == "1-URGENT", tag("£", amount))
        .when(priority == "2-HIGH", tag("$  ", amount))
        .when(priority == "3-MEDIUM", tag(amount, " €"))
        .when(priority == "4-NOT SPECIFIED", odd)
        .when(status != "P", tag("-", amount))
        .alias("raw"),
    )


def dirty_records(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as raw records with every kind of flaw, chosen by ``props``."""
    k = F.regexp_extract("props", r"\d+", 0).cast("int")
    user, value = text(F.col("user_id")), F.col("value")
    page = F.concat(F.lit(f"  {SHOP}/catalogue/item_"), user, F.lit("/index.html#top "))
    return table(spark, folder, "events").select(
        "event_id",
        F.when(k < 5, None)
        .when(k < 10, "   ")
        .otherwise(F.concat(F.lit("\t Item  "), user, F.lit(" ")))
        .alias("name"),
        F.when(k.between(10, 14), None)
        .when(k.between(15, 19), F.concat(F.lit("ftp://shop.example/"), user))
        .when(k.between(20, 24), "not a url")
        .otherwise(page)
        .alias("url"),
        F.when(k.between(25, 29), None).when(k.between(30, 34), -value).otherwise(value).alias("price"),
        F.when(k < 50, "GBP").when(k < 55, " ").when(k >= 60, " EUR ").alias("currency"),
        F.col("event_type").alias("category"),
        F.when(k < 30, " In   stock")
        .when(k < 60, "OUT OF STOCK")
        .when(k < 90, "ships later")
        .alias("availability"),
        F.when(k.between(35, 39), None)
        .when(k.between(40, 44), value)
        .otherwise(value / 100)
        .alias("rating"),
        F.when(k < 70, F.concat(F.lit("https://img.example/"), user, F.lit(".jpg#x")))
        .when(k < 75, "img/none.jpg")
        .when(k >= 80, " ")
        .alias("image_url"),
        F.when(k < 90, F.concat(F.lit(" item_"), user)).when(k < 95, " ").alias("source_product_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("scraped_at"),
    )


CARDS_PER_PAGE = 20
LISTINGS = 10


def listing_pages(spark: SparkSession, folder: str, more: tuple[str, ...] = ()) -> DataFrame:
    """Listing markup made from ``part``: 20 cards a page, pages dealt to 10 listings.

    The overview page links the listings, and the addresses in *more*; one that ends
    in ``?again`` is served the first listing's pages a second time. A part of Brand#3 has no title on its
    link, one of Brand#5 neither title nor picture text, one of Brand#8 no price.
    """
    brand, size = F.col("p_brand"), F.col("p_size")
    key, name = text(F.col("p_partkey")), F.col("p_name")
    page_no = F.floor(F.col("p_partkey") / CARDS_PER_PAGE).cast("bigint")
    word = F.element_at(
        F.array(*[F.lit(w) for w in ("One", "Two", "Three", "Four", "Five")]),
        (size % 5 + 1).cast("int"),
    )

    def html(*parts: str | Column) -> Column:
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    title = F.when(brand.isin("Brand#3", "Brand#5"), "").otherwise(html(' title="', name, ' &amp; co"'))
    alt = F.when(brand == "Brand#5", "").otherwise(html(' alt="  ', name, '  "'))
    price = F.when(brand == "Brand#8", "").otherwise(
        html('<p class="price_color">£', F.format_number("p_retailprice", 2), "</p>")
    )
    stock = F.when(size < 25, "In stock").otherwise("Out of stock")
    card = html(
        '<li><article class="product_pod"><div class="image_container"><a href="../item_',
        key,
        '/index.html"><img src="../media/',
        key,
        '.jpg"',
        alt,
        ' class="thumbnail"></a></div><p class="star-rating ',
        word,
        '"><i class="icon"></i></p><h3><a href="../item_',
        key,
        '/index.html"',
        title,
        '>short</a></h3><div class="product_price">',
        price,
        '<p class="instock availability"><i class="icon"></i>\n  ',
        stock,
        "\n</p></div></article></li>",
    )
    rows = table(spark, folder, "part").select(
        page_no.alias("page_no"), F.col("p_partkey"), card.alias("card")
    )
    # A fixed number of partitions: reading the pages is work for the processor, which
    # a split by the few bytes of the compressed shuffle would leave to one task.
    spread = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "page_no")
    filled = spread.groupBy("page_no").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", "card"))), lambda c: c.card),
            "\n",
        ).alias("cards")
    )
    last_page = rows.agg(F.max("page_no")).first()[0]
    onward = F.when(
        F.col("page_no") + LISTINGS <= F.lit(last_page),
        html(
            '<li class="next"><a href="page-',
            text(F.col("page_no") + LISTINGS),
            '.html">next</a></li>',
        ),
    ).otherwise("")
    side = "".join(
        f'<li><a href="list/page-{i}.html"> Listing {i} </a></li>' for i in range(LISTINGS)
    ) + "".join(f'<li><a href="{url}"> More {i} </a></li>' for i, url in enumerate(more))
    pages = filled.select(
        page_url(F.col("page_no")).alias("url"),
        html(
            '<html><body><ol class="row">',
            F.col("cards"),
            '</ol><ul class="pager"><li class="current">Page</li>',
            onward,
            "</ul></body></html>",
        ).alias("html"),
    )
    home = spark.range(1).select(
        F.lit(f"{SHOP}/index.html").alias("url"),
        F.lit(
            '<html><body><div class="side_categories"><ul><li><a href="category/books_1/index.html">All'
            f"</a><ul>{side}</ul></li></ul></div></body></html>"
        ).alias("html"),
    )
    copy = pages.filter(F.col("url") == page_url(F.lit(0))).withColumn(
        "url", F.concat("url", F.lit("?again"))
    )
    return pages.unionByName(home).unionByName(copy) if more else pages.unionByName(home)


def page_url(number: Column) -> Column:
    return F.concat(F.lit(f"{SHOP}/list/page-"), text(number), F.lit(".html"))


def page_chains(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Seeds and next-page links over ``pages``: listings of 25, four kinds of end.

    A listing ends by itself, links back to its start, links to a missing page, or
    links back into its middle.
    """
    number = F.col("page_id")
    listing = F.floor(number / 25).cast("bigint")
    base = f"{SHOP}/walk/"

    def at(n: Column, tail: str = "") -> Column:
        return F.concat(F.lit(base), text(n), F.lit(tail))

    kind = listing % 4
    end = (
        F.when(kind == 1, at(number - 24, "#top"))
        .when(kind == 2, F.concat(F.lit(base + "gone/"), text(number)))
        .when(kind == 3, at(number - 10))
    )
    rows = table(spark, folder, "pages").select("page_id", listing.alias("listing"))
    links = rows.select(
        at(number).alias("url"), F.when(number % 25 == 24, end).otherwise(at(number + 1)).alias("next_url")
    )
    seeds = rows.groupBy("listing").agg(F.min("page_id").alias("page_id")).select(
        F.col("listing").alias("seed"), at(F.col("page_id")).alias("start_url")
    )
    return seeds, links
