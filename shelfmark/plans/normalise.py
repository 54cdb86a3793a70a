"""The normalised variant: quotations in four tables, books, shops and revenue."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.fields import MONEY, RATE_GBP_EUR_NORMALISED, convert
from shelfmark.operators.cleaning import drop_duplicate_rows, fill_defaults
from shelfmark.operators.keys import number_rows
from shelfmark.operators.privacy import normalised_privacy, split_revenue


def _first_seen(rows: DataFrame, name: str, id_col: str, order: list[str]) -> DataFrame:
    """Distinct names numbered from 1 in order of first appearance."""
    first = rows.groupBy(name).agg(F.min(F.struct(*order)).alias("_first"))
    return number_rows(first, id_col, order=["_first"]).drop("_first")


def normalise_quotes(quotes: DataFrame, order: str = "position") -> dict[str, DataFrame]:
    """authors, quotes, tags, quotes_tags out of (order, text, author, tags).

    Keys follow first appearance. Names are numbered once distinct; the joins
    back carry keys only.
    """
    numbered = number_rows(quotes, "id_quote", order=[order])
    authors = _first_seen(
        numbered.select(F.col("author").alias("author_name"), "id_quote"),
        "author_name",
        "id_author",
        ["id_quote"],
    )
    pairs = numbered.select("id_quote", F.posexplode("tags").alias("n", "tag_name"))
    tags = _first_seen(pairs, "tag_name", "id_tag", ["id_quote", "n"])
    return {
        "authors": authors.select("id_author", "author_name"),
        "quotes": numbered.join(
            authors.withColumnRenamed("author_name", "author"), "author", "left"
        ).select("id_quote", "text", "id_author"),
        "tags": tags.select("id_tag", "tag_name"),
        "quotes_tags": pairs.join(tags, "tag_name").select("id_quote", "id_tag").distinct(),
    }


def convert_books(books: DataFrame, rate: Decimal = RATE_GBP_EUR_NORMALISED) -> DataFrame:
    """Prices in euro, as the stored money type rounds them."""
    return books.withColumn("price", convert(F.col("price"), rate).cast(MONEY))


def book_export(books: DataFrame) -> DataFrame:
    """Export form of a book: the image bytes stay out."""
    return books.select("title", "price", "rating", "availability", "category", "url_image")


def normalise_shops(partners: DataFrame, today: Column | None = None) -> DataFrame:
    """Deduplicated, filled and pseudonymised partner rows with their revenue."""
    return normalised_privacy(fill_defaults(drop_duplicate_rows(partners), today))


def shop_tables(shops: DataFrame, first_id: int = 1) -> dict[str, DataFrame]:
    """Shops and the confidential revenue table that shares their key."""
    numbered = number_rows(shops, "id_librairie", start=first_id)
    split = split_revenue(numbered)
    revenue = number_rows(split.revenue, "id_ca_annuel", start=first_id)
    return {"librairies": split.shops, "ca_annuel": revenue}
