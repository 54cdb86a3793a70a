"""Runs of the normalised variant that add to what earlier runs stored.

Each table has a natural key besides its number: an author or tag by its name,
a quotation by (text hash, author), a book by (title, category), a shop by
(name, address, postcode, town), a revenue row by (shop, amount). A run inserts
only members whose natural key is not stored yet, numbered on from the largest
stored number in order of first appearance in the batch; a member that is
stored already keeps its number, the old row wins. Children are re-keyed by a
join on the parent's natural key, so a quotation of a known author points at
that author's stored number, and a revenue row of a known shop at that shop.
Running the same batch again inserts nothing.

Rows whose natural key holds a null are not inserted (the stored columns are
NOT NULL); their children are left out with them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.keys import number_rows
from shelfmark.session import broadcast_if_small

QUOTE_TABLES = {
    "authors": "id_author bigint, author_name string",
    "quotes": "id_quote bigint, text string, text_hash string, id_author bigint",
    "tags": "id_tag bigint, tag_name string",
    "quotes_tags": "id_quote bigint, id_tag bigint",
}
SHOP_TABLES = {
    "librairies": "id_librairie bigint, nom_librairie string, adresse string, code_postal string, ville string",
    "ca_annuel": "id_ca_annuel bigint, ca_annuel decimal(10,2), id_librairie bigint",
}
BOOK_TABLES = {"books": "id_book bigint, title string, price decimal(10,2), rating int, availability boolean, category string"}
SHOP_KEY = ["nom_librairie", "adresse", "code_postal", "ville"]


@dataclass(frozen=True)
class Keyed:
    """``keys``: natural key and number of every member of the batch; ``inserted``: the new rows."""

    keys: DataFrame
    inserted: DataFrame


def keyed_insert(stored: DataFrame, incoming: DataFrame, key: list[str], id_col: str, order: list[str]) -> Keyed:
    """Insert the members of ``incoming`` whose ``key`` is not in ``stored``, numbered after its largest ``id_col``.

    ``incoming`` holds ``key``, ``order`` and the other columns of the table;
    of several rows with one key the first by ``order`` counts. Only distinct
    keys travel to the stored table; new members are numbered once distinct.
    """
    complete = F.lit(True)
    for k in key:
        complete = complete & F.col(k).isNotNull()
    first = incoming.where(complete).groupBy(*key).agg(F.min(F.struct(*order, *[c for c in incoming.columns if c not in key and c not in order])).alias("_first"))
    known = stored.groupBy(*key).agg(F.min(id_col).alias(id_col))
    top = stored.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint")).first()[0]
    fresh = first.join(known, key, "left_anti")
    numbered = number_rows(fresh, id_col, start=top + 1, order=[*[F.col(f"_first.{o}") for o in order], *key])
    inserted = numbered.select(id_col, *key, "_first.*").drop(*order)
    keys = known.join(first.select(*key), key, "left_semi").unionByName(inserted.select(*key, id_col))
    return Keyed(keys, inserted)


def _append(stored: DataFrame, inserted: DataFrame) -> DataFrame:
    return stored.unionByName(inserted.select(stored.columns))


def quotes_run(stored: dict[str, DataFrame], batch: DataFrame) -> dict[str, Keyed]:
    """Authors, tags, quotations and their pairs of a batch of cleaned quotations (position, text, text_hash, author, tags)."""
    rows = batch.select("position", "text", "text_hash", F.col("author").alias("author_name"), "tags")
    authors = keyed_insert(stored["authors"], rows.select("author_name", "position"), ["author_name"], "id_author", ["position"])
    pairs = rows.select("position", "text_hash", "author_name", F.posexplode("tags").alias("n", "tag_name"))
    tags = keyed_insert(stored["tags"], pairs.select("tag_name", "position", "n"), ["tag_name"], "id_tag", ["position", "n"])
    # children re-keyed by the parents' natural keys: stored numbers win
    with_author = rows.join(broadcast_if_small(authors.keys), "author_name")
    quotes = keyed_insert(stored["quotes"], with_author.select("text_hash", "id_author", "position", "text"), ["text_hash", "id_author"], "id_quote", ["position"])
    quote_of = with_author.select("position", "text_hash", "id_author").join(quotes.keys, ["text_hash", "id_author"])
    bridge = pairs.join(quote_of.select("position", "id_quote"), "position").join(broadcast_if_small(tags.keys), "tag_name")
    new_pairs = bridge.select("id_quote", "id_tag").distinct().join(stored["quotes_tags"], ["id_quote", "id_tag"], "left_anti")
    return {"authors": authors, "tags": tags, "quotes": quotes, "quotes_tags": Keyed(bridge.select("id_quote", "id_tag").distinct(), new_pairs)}


def shops_run(stored: dict[str, DataFrame], batch: DataFrame, order: str = "row") -> dict[str, Keyed]:
    """Shops and their revenue rows of a batch (``order``, shop columns, ca_annuel)."""
    shops = keyed_insert(stored["librairies"], batch.select(*SHOP_KEY, order), SHOP_KEY, "id_librairie", [order])
    revenue = batch.join(shops.keys, SHOP_KEY).select("id_librairie", F.col("ca_annuel").cast("decimal(10,2)").alias("ca_annuel"), order)
    found = keyed_insert(stored["ca_annuel"], revenue, ["id_librairie", "ca_annuel"], "id_ca_annuel", [order])
    return {"librairies": shops, "ca_annuel": found}


def books_run(stored: dict[str, DataFrame], batch: DataFrame, order: str = "row") -> dict[str, Keyed]:
    """Books of a batch (``order`` and the stored columns but the number)."""
    columns = [c for c in stored["books"].columns if c != "id_book"]
    return {"books": keyed_insert(stored["books"], batch.select(*columns, order), ["title", "category"], "id_book", [order])}


def tables_after(stored: dict[str, DataFrame], run: dict[str, Keyed]) -> dict[str, DataFrame]:
    """The stored tables with what a run inserted."""
    return {name: _append(stored[name], run[name].inserted) for name in stored}
