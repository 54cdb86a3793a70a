import pytest

from conftest import rows
from shelfmark.operators import pages

CARDS = """<html><body><div class="side_categories"><ul class="nav nav-list"><li><a href="index.html">
Books</a><ul><li><a href="catalogue/category/books/travel_2/index.html"> Travel </a></li>
<li><a href="plain"> Young Adult </a></li></ul></li></ul></div>
<article class="product_pod"><h3><a href="../../../item_1/index.html" title="One &amp; Only">One...</a></h3>
<div class="product_price"><p class="price_color">Â£51.77</p><p class="instock availability">
 In stock (22 available) </p></div><p class="star-rating Three"></p>
<img src="../../media/a.jpg" class="thumbnail"></article>
<article class="product_pod"><p>sold out</p></article>
<article class="product_pod"><h3><a href="http://x.org/b">Bare</a></h3></article>
<ul><li class="next"><a href="page-2.html">next</a></li></ul></body></html>"""

QUOTES = """<div class="quote"><span class="text">“Typographic”</span><span>by <small class="author">
A. Author </small><a href="/author/A-Author">(about)</a></span><div class="tags">
<a class="tag" href="/tag/x/">x</a><a class="tag">y</a><a class="tag">x</a></div></div>
<div class="quote"><span class="text">« Sans auteur »</span><div class="tags"></div></div>"""


@pytest.fixture(scope="module")
def book_page(spark):
    return spark.createDataFrame(
        [(1, "http://site.org/catalogue/category/c_2/index.html", "Travel", CARDS)],
        "page_id bigint, url string, category string, html string",
    )


@pytest.fixture(scope="module")
def quote_page(spark):
    return spark.createDataFrame([(1, "http://q.org/", QUOTES)], "page_id bigint, url string, html string")


def test_book_cards_and_quarantine(book_page):
    good, bad = pages.book_cards(book_page, site_root="http://site.org", source="s", batch_id="b")
    got = rows(good, "position", "title", "price", "rating", "availability", "url", "image_url")
    assert got == [
        (0, "One & Only", "£51.77", "3", "22", "http://site.org/catalogue/item_1/index.html",
         "http://site.org/media/a.jpg"),
        (2, "Bare", "N/A", "0", "0", "http://x.org/b", ""),
    ]
    assert rows(bad) == [("extract_books", "1#1", "title missing", "b")]


def test_normalised_cards_reject_what_lacks_a_field(book_page):
    good, bad = pages.book_cards_normalised(book_page, site_root="http://site.org/", batch_id="b")
    row = good.drop("image").first()
    assert (row.title, float(row.price), row.rating, row.availability) == ("One & Only", 51.77, 3, True)
    assert row.url_image == "http://site.org/media/a.jpg"
    assert bad.count() == 2


def test_menu_next_and_root(book_page):
    menu = pages.menu_links(book_page, ("div", "side_categories"), nested=True, site_root="http://site.org")
    assert rows(menu, "position", "name", "slug", "url") == [
        (0, "Travel", "travel_2", "http://site.org/catalogue/category/books/travel_2/index.html"),
        (1, "Young Adult", "young-adult", "http://site.org/plain"),
    ]
    for how in ("resolve", "sibling"):
        assert pages.next_page(book_page, how).first().next_url == (
            "http://site.org/catalogue/category/c_2/page-2.html"
        )


def test_quote_cards(quote_page):
    good, bad = pages.quote_cards(quote_page, site_root="http://q.org", source="s", batch_id="b")
    assert rows(good, "position", "text", "author", "author_url", "tags") == [
        (0, "“Typographic”", "A. Author", "http://q.org/author/A-Author", ["x", "y", "x"]),
        (1, "Sans auteur", "Unknown", None, []),
    ]
    assert bad.isEmpty()
    strict = pages.quote_cards(quote_page, site_root="", source="s", batch_id="b", strict=True)
    assert (strict.good.count(), strict.quarantine.first().reason) == (1, "author missing")
    assert rows(pages.all_tags(good)) == [("x",), ("y",)]
    assert pages.with_tag(good, "y").count() == 1
    assert pages.next_page(quote_page).first().next_url is None
    stats = pages.extract_stats(quote_page, strict.good, strict.quarantine).first()
    assert stats.asDict() == {
        "pages": 1, "records": 1, "errors": 1, "unique_authors": 1, "unique_tags": 2,
    }


def test_filters_do_not_read_the_markup_again(book_page):
    good, bad = pages.book_cards_normalised(book_page, site_root="http://site.org/", batch_id="b")
    for df in (good, bad):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("star-rating") - plan.count('class="star-rating') == 1
