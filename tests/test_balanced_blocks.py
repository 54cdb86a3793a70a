"""Blocks up to their own end tag: a stack over the tags gives the same elements as the depth scan."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.functions import markup as m
from shelfmark.operators import pages

TAG = re.compile(r"(?i)</?div(?:[\s/][^>]*)?>")


def brute(html, css_class=None):
    """Elements by a stack of open tags; an element left open gives nothing."""
    if html is None:
        return None
    found, stack, last = [], [], 0
    for t in TAG.finditer(html):
        tag = t.group(0)
        if tag.startswith("</"):
            if stack:
                start, keep = stack.pop()
                if keep:
                    found.append((start, html[start : t.start()]))
        elif not tag.endswith("/>"):
            keep = css_class is None or re.search(rf"""class\s*=\s*["'](?:[^"']*\s)?{css_class}(?:\s[^"']*)?["']""", tag) is not None
            stack.append((t.end(), keep))
        last = t.end()
    return [b for _, b in sorted(found)] if last >= 0 else None


PARTS = ["<div>", '<div class="quote">', "</div>", "<DIV class='x quote'>", "<div/>", "text", "<p>p</p>", "</div >", "é"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=14).map("".join), min_size=1, max_size=6))
def test_depth_scan_matches_a_stack(spark, htmls):
    df = spark.createDataFrame([(h,) for h in htmls], "html string")
    got = df.select(F.expr(m.balanced_blocks("html", "div")).alias("a"), F.expr(m.balanced_blocks("html", "div", "quote")).alias("q")).collect()
    for h, r in zip(htmls, got):
        assert r.a == brute(h)
        assert r.q == brute(h, "quote")


NESTED = """<div class="quote"><span class="text">One</span><div class="meta"><small class="author">Ann</small>
<a href="/author/Ann">(about)</a></div><div class="tags"><a class="tag">x</a><a class="tag">y</a></div></div>
<div class="quote"><div class="inner"><span class="text">Two</span></div><div class="quote"><span class="text">Three</span></div></div>"""


def test_nested_quote_cards(spark):
    page = spark.createDataFrame([(1, "http://q.org/page/1/", NESTED)], "page_id bigint, url string, html string")
    split = pages.quote_cards(page, site_root="http://q.org", source="q", batch_id="b")
    got = sorted((r.position, r.text, r.author, r.tags) for r in split.good.collect())
    # the first card keeps its tags after the inner divs; the third card lies inside the second
    assert got == [(0, "One", "Ann", ["x", "y"]), (1, "Two", "Unknown", []), (2, "Three", "Unknown", [])]
