import random
from collections import defaultdict
from decimal import Decimal

import pytest

from conftest import rows
from shelfmark import schemas
from shelfmark.plans import analytics
from shelfmark.session import BROADCAST_ROWS, broadcast_if_small

CATEGORIES = [(1, "Fiction"), (2, "Fictional"), (3, "Travel"), (4, "Empty")]


@pytest.fixture(scope="module")
def books():
    """A hot category, a hot price inside it, unpriced books and orphans."""
    rng = random.Random(7)
    out = []
    for i in range(900):
        cat = rng.choice([1, 1, 1, 2, 3, None])
        price = rng.choice([None] + [Decimal("9.99")] * 6 + [Decimal(rng.randrange(100, 900)) / 100] * 6)
        out.append((i, cat, f"b{i}", price, price, i % 5 + 1, i % 7))
    return out


@pytest.fixture(scope="module")
def star(spark, books):
    cols = "book_id bigint, category_id bigint, title string, price_gbp decimal(10,2), price_eur decimal(10,2), rating int, availability int"
    cats = [(i, n, n.lower()) for i, n in CATEGORIES]
    quotes = [(1, 1, "q1", "h1"), (2, 1, "q2", "h2"), (3, 2, "q3", "h2"), (4, None, "q4", "h4")]
    shops = [(i, f"s{i}", "V", sp, None) for i, sp in enumerate(["Littérature", "Voyage", None])]
    return {
        "dim_categories": spark.createDataFrame(cats, "category_id bigint, category_name string, category_slug string"),
        "fact_books": spark.createDataFrame(books, cols).repartition(5).cache(),
        "dim_authors": spark.createDataFrame([(1, "a", 2), (2, "b", 1), (3, "c", None)], "author_id bigint, author_name string, quote_count bigint"),
        "fact_quotes": spark.createDataFrame(quotes, "quote_id bigint, author_id bigint, quote_text string, quote_hash string"),
        "dim_tags": spark.createDataFrame([(1, "x"), (2, "y")], "tag_id bigint, tag_name string"),
        "quote_tags": spark.createDataFrame([(1, 1), (1, 2), (3, 1)], schemas.QUOTE_TAGS),
        "dim_librairies": spark.createDataFrame(shops, "librairie_id bigint, nom string, ville string, specialite string, latitude decimal(10,8)"),
    }


def by_hand(books):
    """Rank, cheaper books and running total of every book, one category at a time."""
    names, groups, out = dict(CATEGORIES), defaultdict(list), {}
    for b in books:
        if b[1] is not None:
            groups[b[1]].append((b[3], b[0]))
    for cat, members in groups.items():
        members.sort(key=lambda m: (m[0] is not None, -(m[0] or 0), m[1]))
        total = None
        for pos, (price, book) in enumerate(members):
            if price is not None:
                total = (total or 0) + price
            above = sum(1 for p, _ in members if (p is None and price is not None) or (p is not None and price is not None and p > price))
            below = sum(1 for p, _ in members if p is not None and (price is None or p < price))
            out[book] = (names[cat], above + 1, total, round(100 * below / (len(members) - 1), 1))
    return out


def test_full_price_window_under_skew(star, books):
    want = by_hand(books)
    got = analytics.price_window_full(star).collect()
    assert len(got) == len(want)
    for r in got:
        name, rank, total, share = want[r.book_id]
        assert (r.categorie, r.rang, r.prix_cumule) == (name, rank, total)
        assert abs(float(r.percentile) - share) < 0.1001


def test_head_of_price_window_equals_the_full_one(star):
    full = analytics.price_window_full(star).orderBy("categorie", "rang", "book_id").limit(20)
    assert rows(analytics.price_window(star)) == rows(full)


def test_top_per_category_keeps_ties(star, books):
    want = {(b, r) for b, (_, r, _, _) in by_hand(books).items() if r <= 3}
    got = {(r.book_id, r.rang) for r in analytics.top_per_category(star).collect()}
    assert got == want


def test_author_view_counts_joined_rows_and_keeps_null_tags(star):
    got = rows(analytics.top_authors_view(star), "author_id", "nb_quotes", "nb_quotes_distinct", "tags_used")
    assert got == [(1, 3, 2, ["x", "y", None]), (2, 1, 1, ["x"])]
    top = analytics.author_profile(star).collect()
    assert [(r.auteur, r.tags) for r in top] == [("a", "x, y"), ("b", "x")]


def test_opportunity_squares_the_matching_categories(star):
    out = analytics.opportunity_score(star, limit=None)
    per_shop = {r["librairie_id"]: r["count"] for r in out.groupBy("librairie_id").count().collect()}
    # "Fiction" matches two categories: 2 x 2 rows; the default mapping does the same
    assert per_shop == {0: 4, 1: 1, 2: 4}
    linked = analytics.opportunity_score(star, limit=None, link_on_name=True)
    assert linked.filter("librairie_id = 0").count() == 2


def test_quality_report_and_dashboard(star):
    got = {r.controle: (r.nombre, r.statut) for r in analytics.dq_report(star, 1, 8).collect()}
    assert got["Citations sans auteur"] == (1, "ATTENTION")
    assert got["Citations en doublon (même hash)"] == (1, "ATTENTION")
    assert got["Librairies sans coordonnées GPS"] == (3, "ATTENTION")
    assert analytics.dq_report(star, short=True).count() == 3
    assert analytics.dashboard(star, short=True).first().total_livres == 900
    assert analytics.with_headings(analytics.dq_report(star), "dq_report").columns == ["Contrôle", "Nombre", "Statut"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_product_of_facts(star):
    for query in (analytics.category_stats, analytics.top_per_category, analytics.price_window_full, analytics.dashboard):
        assert "CartesianProduct" not in plan(query(star))
    assert "WindowGroupLimit" in plan(analytics.price_levels(star["fact_books"], 3))


def test_broadcast_only_below_the_bound(spark):
    # a cached-free aggregate whose size Catalyst cannot estimate as small
    big = spark.range(3_000_000).selectExpr("id % 500 as k", "id as v").groupBy("k").count()
    assert "ResolvedHint" in broadcast_if_small(big)._jdf.queryExecution().analyzed().toString()
    plain = broadcast_if_small(big, max_rows=10)
    assert "ResolvedHint" not in plain._jdf.queryExecution().analyzed().toString()
    assert BROADCAST_ROWS < 10**6


def test_hot_key_join_is_split(spark):
    """AQE splits the fact partition of a hot key instead of one task taking it."""
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        facts = spark.range(0, 400_000, 1, 8).selectExpr("if(id % 3 = 0, 7, id % 1000) as k", "id")
        dim = spark.range(1000).selectExpr("id as k", "concat('n', id) as name")
        joined = facts.join(dim, "k").groupBy("name").count()
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


