"""Extraction of main texts and removal of site templates."""

import re

import pytest

from shelfmark.llm.html_text import _Page, extract, page_text


@pytest.mark.parametrize(
    "source,want",
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<html><head><title>T</title></head><body><nav>menu</nav><article><h1>A&eacute;</h1><p>one\n two<b>x</b>y<p>three<br>four</article><footer>f</footer>", "Aé\none twoxy\nthree four"),
        ("<body><div class='sidebar'>s</div><div id=content>text <script>var t='</p>';</script>more</div><div class=ad>buy</div></body>", "text more"),
        ("<article><header><h1>H</h1><p>by me</p></header><p>t</p><section class='comments'><p>c</p></section><form>f</form></article>", "H\nt"),
        ("<article class='comment'><p>short</p></article><article><p>the longer main one</p></article>", "the longer main one"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><!-- no --><p hidden>x</p></article>", "a\nb\nc\nd"),
        ("<p><b>bold.<br><p>next", "bold.\nnext"),
        ("<article><p>1 &lt; 2 &#x41;&#66;&nbsp;z</p></article>", "1 < 2 AB z"),
    ],
)
def test_pages(source, want):
    assert page_text(source) == want


def test_deep_and_long_pages():
    assert page_text("<div>" * 100_000 + "x" + "</div>" * 100_000) == "x"
    assert len(page_text("<article><p>" + "word " * 200_000 + "</p></article>")) == 999_999


def test_site_templates_go_and_shared_sentences_stay(spark):
    rows = []
    for i in range(30):
        body = f"<div class='box'><p>Welcome to our site</p></div><div><h2>t{i}</h2><p>own words {i}</p><p>All rights reserved.</p></div>"
        rows.append((i, f"http://a.example/{i}", f"<body>{body}</body>"))
    rows += [(100 + i, "http://b.example/x", "<body><div><p>the same page</p></div></body>") for i in range(40)]
    rows += [(200, None, None), (None, "http://a.example/1", "")] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in extract(df).collect()}
    for i in range(30):
        assert got[i].text == f"t{i}\nown words {i}\nAll rights reserved."
    assert all(got[100 + i].text == "the same page" for i in range(40))
    assert got[200].text == "" and got[200].n_chars == 0
    assert extract(df).count() == len(rows) and extract(df.limit(0)).collect() == []


def test_supplied_pages(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in extract(df).join(df.select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        plain = re.sub(r"<[^>]*>", "", inner)
        import html

        assert re.sub(r"\s", "", html.unescape(plain)) == re.sub(r"\s", "", r.text)


def test_sources_cross_the_network_compressed(spark):
    rows = [(i, f"http://h{i % 2}.example/{i}", None if i == 3 else f"<html><body><article><p>Tëxt {i} of the page.</p></article></body></html>") for i in range(8)]
    out = extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {x.page_id: x.text for x in out.collect()} == {i: "" if i == 3 else f"Tëxt {i} of the page." for i in range(8)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # read, then squeezed before they meet their templates
    assert plan.count("MapInArrow squeeze") == 1, plan


def test_only_main_text_meets_the_templates():
    box = "<div class='box'><p>Welcome</p><section><p>to us</p></section></div>"
    page = _Page(f"<body><nav>{'menu ' * 500}</nav><main><header><h1>H</h1><p>by</p></header>{box}<div><p>own &lt;words&gt;</p></div></main></body>")
    parents, marks, blocks, places = page.parts()
    assert blocks == ["H", "Welcome", "to us", "own <words>"] and all(up < i for i, up in enumerate(parents))
    inner, outer = marks[places[2]], marks[places[1]]
    assert marks[parents[places[2]]] == outer
    assert page.text({inner}) == ["H", "Welcome", "own <words>"]
    assert page.text({outer}) == ["H", "own <words>"] and page.text() == blocks
