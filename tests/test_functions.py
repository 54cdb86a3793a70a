import hashlib
import html
from decimal import Decimal
from html.entities import html5
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import fields, markup, privacy, text


def one(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_strip_knows_every_unicode_space(spark):
    values = ["  a ", "\tb\n", "　c d\x85", "", None]
    want = [v.strip() if v is not None else None for v in values]
    assert one(spark, text.strip, values) == want


def test_title_case_capitalises_every_letter_run(spark):
    values = ["SAINT-denis l'île", "aix en provence", "", None]
    want = [v.title() if v is not None else None for v in values]
    assert one(spark, text.title_case, values) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        (' "Be yourself." ', "Be yourself."),
        ("« Oser »", "Oser"),
        ('""twice""', '"twice"'),
        ("“kept”", "“kept”"),
        ('"', ""),
        ("", ""),
    ],
)
def test_strip_quotes(spark, raw, want):
    assert one(spark, text.strip_quotes, [raw]) == [want]


def test_hash_slug_and_tags(spark):
    assert one(spark, text.text_hash, [" ÉTÉ "]) == [hashlib.md5("été".encode()).hexdigest()]
    assert one(spark, text.slug, ["Young Adult"]) == ["young-adult"]
    assert one(spark, text.normalise_tags, [[" Life ", "LOVE"], None], "array<string>") == [
        ["life", "love"],
        [],
    ]


def test_prices(spark):
    values = ["£51.77", "Â£10.00", "12,50", "1,234.50", "N/A", None, " £ 3 "]
    got = one(spark, fields.parse_price, values)
    assert got == [Decimal("51.77"), None, Decimal("12.50"), None, None, Decimal("0.00"), Decimal("3.00")]
    assert one(spark, fields.tidy_price, ["Â£10.00 "]) == ["£10.00"]
    first = one(spark, fields.first_price, ["£51.77", "none", None, "1.2.3"])
    assert first == [Decimal("51.77"), Decimal("0.00"), Decimal("0.00"), None]


def test_conversion_is_exact_and_half_up(spark):
    got = one(spark, fields.convert, [Decimal("51.77"), Decimal("0.50")], "decimal(10,2)")
    assert got == [Decimal("60.57"), Decimal("0.59")]  # 0.585 rounds up


def test_ratings_and_stock(spark):
    assert one(spark, fields.parse_rating, ["Three", "4", "none", None, "five"]) == [3, 4, 0, 0, 5]
    assert one(spark, fields.rating_from_class, ["star-rating Two", "", None]) == [2, 0, 0]
    assert one(spark, fields.rating_from_second_class, ["star-rating Two", "star-rating two"]) == [2, None]
    stock = ["In stock (22 available)", "In stock", "gone", None]
    assert one(spark, fields.stock_from_text, stock) == [22, 1, 0, 0]
    assert one(spark, fields.in_stock, stock) == [True, True, False, False]
    assert one(spark, fields.stock_from_digits, ["7", "x", None]) == [7, 0, 0]


def test_entities_decode_like_a_browser(spark):
    values = ["&" + n for n in html5 if n.endswith(";")]
    values += ["&amp;lt; &#233;&#x1F600; &bogus; & x", "plain", ""]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = df.select("x", F.expr(markup.decode_entities("x")).alias("y")).collect()
    assert [r for r in got if r.y != html.unescape(r.x)] == []


def test_urls_join_by_the_rules(spark):
    bases = ["http://a.com/x/y.html?q=1#f", "https://a.com"]
    hrefs = ["../z.html", "/k", "//b.org/q", "?p=2", "#t", "http://q/", "w/./v/../u?s", "../../../r", ".."]
    df = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "b string, h string")
    for r in df.select("b", "h", F.expr(markup.join_url("b", "h")).alias("j")).collect():
        if r.b == "https://a.com" and r.h in ("?p=2", "#t"):
            continue  # an empty base path: both forms name the same page
        assert r.j == urljoin(r.b, r.h), r


def test_text_content_drops_scripts_and_tags(spark):
    page = '<p>a</p><script>var t="</p>";</script><!-- <p>no</p> --><b>caf&eacute;</b><style>p{}</style>'
    df = spark.createDataFrame([(page,)], "html string")
    assert df.select(F.expr(markup.text_content("html"))).first()[0] == "acafé"


def test_elements_and_attributes(spark):
    page = '<p class="x star-rating Two">v</p><div class="next-up">n</div><DIV class=\'next\'>y</DIV>'
    df = spark.createDataFrame([(page,)], "html string")
    got = df.selectExpr(
        markup.attribute("html", "p", "class", "star-rating"),
        markup.inner("html", "div", "next"),
        markup.inner("html", "div", "absent"),
        markup.attribute("html", "p", "id"),
    ).first()
    assert tuple(got) == ("x star-rating Two", "y", None, None)


def test_pseudonyms(spark):
    salt = "s"
    want = hashlib.sha256(b"s:a@b.org").hexdigest()
    assert one(spark, lambda c: privacy.pseudonym(c, salt), [" a@b.org ", "", None]) == [want, None, None]
    df = spark.createDataFrame(
        [("Ana B", "", " 01 "), (None, None, None), ("", "", "")], "n string, e string, p string"
    )
    got = df.select(privacy.contact_pseudonym(F.col("n"), F.col("e"), F.col("p"), salt)).collect()
    assert [r[0] for r in got] == [hashlib.sha256(b"s:Ana B|01").hexdigest(), None, None]


def test_initials_bands_and_formats(spark):
    assert one(spark, privacy.initials, ["Ana  van Berg", "Zoé", ""]) == ["AvB", "Z", ""]
    edges = [None, 99_999.99, 100_000.0, 250_000.0, 500_000.0, 1_000_000.0]
    assert one(spark, privacy.revenue_band, edges, "double") == [
        "Non renseigné", "< 100k€", "100k€ - 250k€", "250k€ - 500k€", "500k€ - 1M€", "> 1M€",
    ]
    phones = ["01 42.78-90.12", "142789012", "0042789012", "12345", "", None]
    assert one(spark, privacy.valid_phone, phones) == [True, True, False, False, True, True]
    assert one(spark, privacy.valid_postcode, ["75004", " 75004 ", "7500", "", None]) == [
        True, True, False, False, False,
    ]
    assert one(spark, privacy.valid_email, ["a.b@c.org", "a@b", "", None]) == [True, False, True, True]
