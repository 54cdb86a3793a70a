"""Runs of the normalised variant: numbers continue, stored members win, children follow them, repeats add nothing."""

from decimal import Decimal

from shelfmark.plans import runs


def _empty(spark, schemas):
    return {name: spark.createDataFrame([], s) for name, s in schemas.items()}


BATCH = "position long, text string, text_hash string, author string, tags array<string>"


def test_quotes_rekeyed_to_stored_parents(spark):
    stored = {
        "authors": spark.createDataFrame([(7, "Ann"), (3, "Bob")], runs.QUOTE_TABLES["authors"]),
        "quotes": spark.createDataFrame([(10, "old", "h-old", 7)], runs.QUOTE_TABLES["quotes"]),
        "tags": spark.createDataFrame([(4, "life")], runs.QUOTE_TABLES["tags"]),
        "quotes_tags": spark.createDataFrame([(10, 4)], runs.QUOTE_TABLES["quotes_tags"]),
    }
    batch = spark.createDataFrame(
        [
            (1, "old", "h-old", "Ann", ["life", "new"]),
            (2, "fresh", "h-fresh", "Cy", ["new", "life"]),
            (3, "by bob", "h-bob", "Bob", [None, "life"]),
            (4, "fresh", "h-fresh", "Cy", ["new"]),
            (5, "no author", "h-none", None, ["life"]),
        ],
        BATCH,
    )
    run = runs.quotes_run(stored, batch)
    after = runs.tables_after(stored, run)
    authors = {r.author_name: r.id_author for r in after["authors"].collect()}
    assert authors == {"Ann": 7, "Bob": 3, "Cy": 8}
    quotes = {r.text_hash: (r.id_quote, r.id_author) for r in after["quotes"].collect()}
    # the stored quotation keeps its number; new ones continue after 10, children point at stored authors
    assert quotes == {"h-old": (10, 7), "h-fresh": (11, 8), "h-bob": (12, 3)}
    tags = {r.tag_name: r.id_tag for r in after["tags"].collect()}
    assert tags == {"life": 4, "new": 5}
    pairs = sorted(tuple(r) for r in after["quotes_tags"].collect())
    assert pairs == [(10, 4), (10, 5), (11, 4), (11, 5), (12, 4)]
    # the same batch again adds nothing
    again = runs.quotes_run(after, batch)
    assert all(again[name].inserted.count() == 0 for name in again)


def test_revenue_follows_the_stored_shop(spark):
    empty = _empty(spark, runs.SHOP_TABLES)
    rows = "row long, nom_librairie string, adresse string, code_postal string, ville string, ca_annuel decimal(12,2)"
    first = spark.createDataFrame([(1, "A", "1 rue", "01000", "X", Decimal("10.00"))], rows)
    t1 = runs.tables_after(empty, runs.shops_run(empty, first))
    second = spark.createDataFrame(
        [(5, "B", "2 rue", "02000", "Y", Decimal("5.00")), (6, "A", "1 rue", "01000", "X", Decimal("11.00")), (7, "A", "1 rue", "01000", "X", Decimal("10.00"))],
        rows,
    )
    t2 = runs.tables_after(t1, runs.shops_run(t1, second))
    shops = {r.nom_librairie: r.id_librairie for r in t2["librairies"].collect()}
    assert shops == {"A": 1, "B": 2}
    revenue = sorted((r.id_ca_annuel, r.id_librairie, r.ca_annuel) for r in t2["ca_annuel"].collect())
    assert revenue == [(1, 1, Decimal("10.00")), (2, 2, Decimal("5.00")), (3, 1, Decimal("11.00"))]
    assert all(v.inserted.count() == 0 for v in runs.shops_run(t2, second).values())


def test_empty_batch(spark):
    empty = _empty(spark, runs.QUOTE_TABLES)
    run = runs.quotes_run(empty, spark.createDataFrame([], BATCH))
    assert all(run[name].inserted.count() == 0 for name in run)
