"""Reading listing pages, walking them, and collecting products."""

from __future__ import annotations

import random
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from shelfwatch.operators.dedup import dedup_two_keys, first_per_key
from shelfwatch.operators.walk import walk_listings
from shelfwatch.plans.collect import NoCategoriesError, collect_products
from shelfwatch.sources import listings as li
from shelfwatch.sources import markup

ROOT = "https://shop.example/"
NOW = datetime(2024, 5, 1, tzinfo=timezone.utc)


def card(slug, title="x", price="£5.00", stock="In stock", stars="Three"):
    name = f' title="{title}"' if title else ""
    return f"""
    <li><article class="product_pod">
      <div class="image_container"><a href="../{slug}/index.html"><img src="../media/{slug}.jpg"
        alt="{title or ''}" class="thumbnail"></a></div>
      <p class="star-rating {stars}"><i class="icon-star"></i></p>
      <h3><a href="../{slug}/index.html"{name}>short ...</a></h3>
      <div class="product_price"><p class="price_color">{price}</p>
        <p class="instock availability"><i class="icon-ok"></i>
            {stock}
        </p></div></article></li>"""


BROKEN = '<li><article class="product_pod"><p class="price_color">£1</p></article></li>'


def page(*cards, onward=None, side=""):
    link = f'<li class="next"><a href="{onward}">next</a></li>' if onward else ""
    return f"""<!DOCTYPE html><html><body>{side}<ol class="row">{''.join(cards)}</ol>
    <ul class="pager"><li class="current">Page</li>{link}</ul></body></html>"""


def sidebar(*names):
    inner = "".join(f'<li><a href="list/{n}-1.html"> {n.title()}\n </a></li>' for n in names)
    return f"""<div class="side_categories"><ul><li><a href="category/books_1/index.html">All</a>
    <ul>{inner}</ul></li></ul></div>"""


def pages(spark, site):
    return spark.createDataFrame([(ROOT + u, h) for u, h in site.items()], "url string, html string")


def test_cards_of_a_page(spark):
    site = {
        "list/a-1.html": page(
            card("lamp_1", "A  Lamp", "£1,052.15", stars="Five"),
            card("desk_2", "Desk &amp; co", "", "  ", "Zero"),
            BROKEN,
            card("chair_3", None),
            onward="a-2.html",
        ),
        "list/empty.html": page(),
    }
    rows = {r.card_pos: r for r in li.extract_products(pages(spark, site)).collect()}
    assert len(rows) == 4
    lamp, desk = rows[1], rows[2]
    assert (lamp.name, lamp.price, lamp.currency, lamp.rating) == ("A Lamp", 1052.15, "GBP", 5.0)
    assert lamp.availability == "In stock" and lamp.url == ROOT + "lamp_1/index.html"
    assert lamp.image_url == ROOT + "media/lamp_1.jpg" and lamp.source_product_id == "lamp_1"
    assert desk.name == "Desk & co"
    assert (desk.price, desk.currency, desk.availability, desk.rating) == (None, None, None, None)
    assert rows[3].error == "Failed to parse product card 3/4: product is missing a title or a link"
    assert rows[4].error is not None and lamp.error is None


def test_next_page_and_categories(spark):
    site = {
        "index.html": page(side=sidebar("travel", "mystery", "travel"), onward="  "),
        "list/a-1.html": page(onward="a-2.html"),
        "flat.html": '<div class="side_categories"><a href="category/books_1/x.html">All</a>'
        '<a href="b.html">B</a><a href="">No</a><a href="c.html"> </a></div>',
    }
    listed = li.read_listings(pages(spark, site))
    onward = {r.url: r.next_url for r in li.next_pages(listed).collect()}
    assert onward[ROOT + "list/a-1.html"] == ROOT + "list/a-2.html" and onward[ROOT + "index.html"] is None
    found = li.links(listed).orderBy("page_url", "pos").collect()
    assert [(r.pos, r.name, r.url) for r in found] == [
        (1, "B", ROOT + "b.html"),
        (1, "Travel", ROOT + "list/travel-1.html"),
        (2, "Mystery", ROOT + "list/mystery-1.html"),
    ]


def test_markup_reader_copes_with_untidy_pages():
    html = """<!-- <p class="a">no</p> --><script>var x = '<p class="a">no</p>';</script>
    <div CLASS='b  c'><p class=a>one <b>two</b><p class="a">three &lt;x&gt;<ul><li><a title="p > q" href=x>l</a><li>m
    </div><p class="a d">four"""
    selectors = ("p.a", "div.b.c p.a", "div li a", "p.d.a", "ul p")
    nodes = markup.read_nodes(html, selectors)
    texts = [markup.text_of(html, n).strip() for n in markup.select(nodes, "p.a")]
    assert texts == ["one two", "three <x>", "four"]
    assert len(markup.select(nodes, "div.b.c p.a")) == 2 and markup.first(nodes, "ul p") is None
    link = markup.first(nodes, "div li a")
    assert (link.get("title"), link.get("href"), link.get("none")) == ("p > q", "x", None)
    assert markup.text_of(html, markup.first(nodes, "p.d.a")) == "four"


def model_walk(start, onward, limit):
    visited, seen, failed, looped, early, at = [], set(), None, 0, False, start
    while at:
        key = at.split("#")[0]
        if limit and len(visited) >= limit:
            early = True
        elif key in seen:
            looped = 1
        elif key not in onward:
            failed = at
        else:
            seen.add(key)
            visited.append(at)
            at = onward[key]
            continue
        break
    return visited, failed, looped, early


@pytest.mark.parametrize("limit", [0, 3, 8])
def test_walks_agree_with_a_sequential_walk(spark, limit):
    rnd = random.Random(limit)
    n = 40

    def onward(i):
        if rnd.random() < 0.07:
            return None
        return (f"p{i + 1}" if rnd.random() < 0.8 else f"p{rnd.randrange(n + 3)}") + rnd.choice(["", "#s"])

    graph = {f"p{i}": onward(i) for i in range(n)}
    graph["self"] = "self#section"
    starts = ["self", "gone", "p0#top", *[f"p{rnd.randrange(n + 2)}" for _ in range(12)]]
    seeds = spark.createDataFrame(list(enumerate(starts)), "seed long, start_url string")
    links = spark.createDataFrame(list(graph.items()), "url string, next_url string")
    walks = walk_listings(seeds, links, limit)
    visits = {}
    for r in walks.visits.orderBy("seed", "depth").collect():
        visits.setdefault(r.seed, []).append(r.url)
    summary = {r.seed: r for r in walks.summary.collect()}
    assert len(summary) == len(starts)
    for seed, start in enumerate(starts):
        want, failed, looped, early = model_walk(start, graph, limit)
        got = summary[seed]
        assert visits.get(seed, []) == want
        assert (got.pages_visited, got.failed_url, got.duplicates_detected, got.stopped_early) == (
            len(want), failed, looped, early,
        )
        assert got.pages_failed == (failed is not None) and got.stopped_on_failure == (failed is not None)


@pytest.mark.parametrize("seed", range(3))
def test_two_key_dedup_agrees_with_the_greedy_rule(spark, seed):
    rnd = random.Random(seed)
    hot = 0.4 if seed else 0.0

    def key(prefix):
        return f"{prefix}{0 if rnd.random() < hot else rnd.randrange(25)}"

    rows = [
        (i, key("u") + rnd.choice(["", "#z"]), rnd.choice([None, "", key("i"), key("i")]))
        for i in range(200)
    ]
    pages_kept, ids_kept, kept = set(), set(), []
    for i, url, pid in rows:
        if url.split("#")[0] in pages_kept or (pid and pid in ids_kept):
            continue
        pages_kept.add(url.split("#")[0])
        ids_kept.add(pid)
        kept.append(i)
    result = dedup_two_keys(spark.createDataFrame(rows, "ord long, url string, source_product_id string"), "ord")
    assert sorted(r.ord for r in result.kept.collect()) == kept
    assert result.dropped.count() == len(rows) - len(kept)


def test_dedup_edge_cases(spark):
    empty = spark.createDataFrame([], "ord long, url string, source_product_id string")
    assert dedup_two_keys(empty, "ord").kept.count() == 0
    rows = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (4, None)], "o long, k string")
    assert {r.o for r in first_per_key(rows, ["k"], "o").collect()} == {1, 2}
    assert {r.o for r in first_per_key(rows, ["k"], "o", descending=True).collect()} == {3, 4}


@pytest.fixture
def shop(spark):
    """Two categories that list the same products over two pages each."""
    site = {
        "index.html": page(side=sidebar("travel", "mystery")),
        "list/travel-1.html": page(card("a_1"), card("b_2"), BROKEN, onward="travel-2.html"),
        "list/travel-2.html": page(card("c_3"), card("d_4")),
        "list/mystery-1.html": page(card("a_1"), card("b_2"), onward="mystery-2.html"),
        "list/mystery-2.html": page(card("c_3"), card("d_4"), onward="mystery-3.html"),
    }
    return pages(spark, site)


def test_collect_across_categories(shop):
    got = collect_products(shop, ROOT + "index.html", NOW)
    assert got.stats == {
        "categories_found": 2, "categories_scraped": 2, "pages_visited": 4, "pages_failed": 1,
        "parser_errors": 1, "duplicates_in_run": 4, "records_scraped": 4,
    }
    rows = got.records.orderBy("ord").collect()
    assert [r.source_product_id for r in rows] == ["a_1", "b_2", "c_3", "d_4"]
    assert {r.category for r in rows} == {"Travel"} and rows[0].scraped_at == "2024-05-01T00:00:00+00:00"


def test_collect_limits(shop):
    one = collect_products(shop, ROOT + "index.html", NOW, max_categories=1)
    assert (one.stats["categories_found"], one.stats["categories_scraped"], one.stats["records_scraped"]) == (2, 1, 4)
    short = collect_products(shop, ROOT + "index.html", NOW, max_pages=1)
    assert (short.stats["pages_visited"], short.stats["records_scraped"]) == (2, 2)
    assert short.walks.filter("stopped_early").count() == 2


@pytest.mark.parametrize(
    "limit, pages_seen, errors, stopped", [(1, 1, 1, True), (2, 1, 1, True), (3, 2, 1, True), (9, 4, 1, False)]
)
def test_product_limit_stops_the_walk(shop, limit, pages_seen, errors, stopped):
    got = collect_products(shop, ROOT + "index.html", NOW, max_products=limit)
    assert got.records.count() == got.stats["records_scraped"] == min(limit, 4)
    assert got.stats["pages_visited"] == pages_seen and got.stats["parser_errors"] == errors
    assert got.stats["duplicates_in_run"] == (0 if stopped else 4)
    assert got.stats["categories_scraped"] == (1 if stopped else 2)
    assert (got.walks.filter("stopped_early").count() == 1) is stopped


def test_collect_without_categories(spark, shop):
    with pytest.raises(NoCategoriesError):
        collect_products(shop, ROOT + "missing.html", NOW)


# -- markup that is not well formed --------------------------------------------
def _texts(html, selector):
    nodes = markup.read_nodes(html, (selector,))
    return [markup.text_of(html, n) for n in markup.select(nodes, selector)]


def _hrefs(html, selector):
    nodes = markup.read_nodes(html, (selector,))
    return [n.get("href") for n in markup.select(nodes, selector)]


def test_blocks_count_whether_selected_or_not():
    assert _texts('<p class="price_color">£5<section>7</section>', "p.price_color") == ["£5"]
    assert _hrefs('<li class="next"><ol><li>x</li></ol><a href=q>n</a>', "li.next a") == ["q"]
    assert _hrefs('<li class="next">a<li><a href=q>n</a>', "li.next a") == []


def test_quotes_open_after_an_equals_sign_only():
    html = "<a href=it's>one</a> <a href=y>two</a> <a \"x href='z'>three</a>"
    assert _hrefs(html, "a") == ["it's", "y", "z"] and _texts(html, "a") == ["one", "two", "three"]
    assert _hrefs('<a href="never closed>one</a> <b>', "a") == ["never closed>one</a> <b>"]


@pytest.mark.parametrize("piece", ['<a href="x', '<a href=">', "<li>", "<div><p>", "<a href=x ", "<!--", "</b>"])
def test_reading_is_linear(piece):
    def seconds(n):
        html, begin = piece * n, time.process_time()
        nodes = markup.read_nodes(html, ("li a", "p.x"))
        for node in nodes[:50]:
            markup.text_of(html[:2000], node)
        return time.process_time() - begin

    seconds(100)
    assert seconds(40_000) < 5


# -- two keys -------------------------------------------------------------------
def _kept(spark, rows):
    df = spark.createDataFrame(rows, "ord long, url string, source_product_id string")
    return sorted(r.ord for r in dedup_two_keys(df, "ord").kept.collect())


def _greedy(rows):
    pages, ids, kept = set(), set(), []
    for order, url, pid in sorted(rows):
        url = url and url.split("#")[0]
        if (url is None or url not in pages) and (not pid or pid not in ids):
            kept.append(order)
            pages |= {url} - {None}
            ids |= {pid} - {None, ""}
    return kept


@pytest.mark.parametrize("component_rows", [0, 10_000])
def test_chains_and_absent_keys(spark, monkeypatch, component_rows):
    monkeypatch.setattr("shelfwatch.operators.dedup.COMPONENT_ROWS", component_rows)
    chain = [(n, f"u{n // 2}", f"k{(n + 1) // 2}") for n in range(9)]
    assert _kept(spark, chain) == [0, 2, 4, 6, 8]
    absent = [(1, None, None), (2, None, ""), (3, None, "a"), (4, None, "a"), (5, "u", None), (6, "u#x", "b"), (7, None, "b")]
    assert _kept(spark, absent) == _greedy(absent) == [1, 2, 3, 5, 7]


@pytest.mark.parametrize("component_rows", [0, 5, 10_000])
def test_any_rows_as_one_after_the_other(spark, monkeypatch, component_rows):
    monkeypatch.setattr("shelfwatch.operators.dedup.COMPONENT_ROWS", component_rows)
    rnd = random.Random(3)
    rows = [(n, rnd.choice(["a", "b", "c", "d", "e", None]), rnd.choice(["x", "y", "z", "", None])) for n in range(60)]
    assert _kept(spark, rows) == _greedy(rows)
    # Sparse keys leave chains and trees of every shape, in any order of arrival.
    rows = [(n, f"u{rnd.randrange(40)}", f"k{rnd.randrange(40)}") for n in range(60)]
    assert _kept(spark, rows) == _greedy(rows)
    # Each page with three rows, each later row on another's page: two before most rows.
    rows = [(n, f"u{n // 3}", f"k{(n + 1) // 3 if n % 3 else n}") for n in range(90)]
    assert _kept(spark, rows) == _greedy(rows)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """Each row shares a key with the one before: log2(n) steps, and no task sees the whole chain."""
    from shelfwatch.operators import dedup

    written = []
    plain = dedup.Scratch.write
    monkeypatch.setattr(dedup.Scratch, "write", lambda self, df, label, *a: written.append(label) or plain(self, df, label, *a))
    n = F.col("id")
    chain = spark.range(0, 100_000, numPartitions=4).select(
        n.alias("ord"),
        F.concat(F.lit("u"), F.floor(n / 2)).alias("url"),
        F.concat(F.lit("k"), F.floor((n + 1) / 2)).alias("source_product_id"),
    )
    kept = dedup_two_keys(chain, "ord").kept
    assert kept.filter("ord % 2 = 1").isEmpty() and kept.count() == 50_000
    assert written.count("chains") <= 18 and written.count("placed") == 1 and "in-order" not in written


def test_a_page_with_very_many_cards(spark):
    cards = "".join(card(f"item_{i}", f"P{i}") for i in range(70_000))
    site = {"index.html": page(side=sidebar("home")), "list/home-1.html": page(cards)}
    got = collect_products(pages(spark, site), ROOT + "index.html", NOW)
    assert got.stats["records_scraped"] == 70_000
    last = got.records.orderBy(F.desc("ord")).first()
    assert last.source_product_id == "item_69999"
