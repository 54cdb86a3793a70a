"""Idempotent loading, updates, deletes with cascade, counters and look-ups.

Loaders return :class:`Merge`: the table after loading and the rows that were
really inserted. Nothing is written here; storage is the caller's choice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import slug
from shelfmark.operators.keys import next_id, number_rows
from shelfmark.schemas import FOREIGN_KEYS, UNIQUE_KEYS
from shelfmark.session import broadcast_if_small, pinned


class Merge(NamedTuple):
    result: DataFrame
    inserted: DataFrame


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("created_at", F.current_timestamp())


def _appended(existing: DataFrame, inserted: DataFrame) -> Merge:
    inserted = inserted.select(
        *[F.col(c).cast(existing.schema[c].dataType).alias(c) for c in existing.columns]
    )
    return Merge(existing.unionByName(inserted), inserted)


# ------------------------------------------------------------ dimensions


def upsert_dimension(
    existing: DataFrame,
    members: DataFrame,
    *,
    name: str,
    id_col: str,
    slug_col: str | None = None,
    counter: str | None = None,
    order: str | None = None,
) -> Merge:
    """Insert the member names not stored yet; keys go on from the largest one.

    ``members`` holds one column ``name`` and, when given, ``order``: new keys
    then follow the first appearance of each name. Only distinct new names are
    numbered.
    """
    given = members.filter(F.col(name).isNotNull())
    rank = F.min(order).alias("_first") if order else F.first(F.lit(0)).alias("_first")
    new = given.groupBy(name).agg(rank).join(existing.select(name), name, "left_anti")
    by = ["_first", name] if order else [name]
    numbered = number_rows(new, id_col, start=next_id(existing, id_col), order=by).drop("_first")
    if slug_col:
        numbered = numbered.withColumn(slug_col, slug(F.col(name)))
    if counter:
        numbered = numbered.withColumn(counter, F.lit(0))
    if "created_at" in existing.columns:
        numbered = _stamped(numbered)
    return _appended(existing, numbered)


def upsert_categories(existing: DataFrame, books: DataFrame) -> Merge:
    return upsert_dimension(
        existing,
        books.select(F.col("category").alias("category_name")),
        name="category_name",
        id_col="category_id",
        slug_col="category_slug",
    )


def upsert_authors(existing: DataFrame, quotes: DataFrame) -> Merge:
    return upsert_dimension(
        existing,
        quotes.select(F.col("author").alias("author_name")),
        name="author_name",
        id_col="author_id",
        slug_col="author_slug",
        counter="quote_count",
    )


def upsert_tags(existing: DataFrame, quotes: DataFrame) -> Merge:
    return upsert_dimension(
        existing,
        quotes.select(F.explode("tags").alias("tag_name")),
        name="tag_name",
        id_col="tag_id",
        slug_col="tag_slug",
        counter="usage_count",
    )


def map_to_id(facts: DataFrame, column: str, dim: DataFrame, name: str, id_col: str) -> DataFrame:
    """Replace a member name by its key, NULL when unknown."""
    keys = broadcast_if_small(dim.select(F.col(name).alias(column), F.col(id_col)))
    return facts.join(keys, column, "left").drop(column)


# ----------------------------------------------------------------- facts


def load_books(existing: DataFrame, books: DataFrame, categories: DataFrame) -> Merge:
    """Plain append: books have no natural key, so a re-run adds them again."""
    mapped = map_to_id(books, "category", categories, "category_name", "category_id")
    numbered = number_rows(mapped, "book_id", start=next_id(existing, "book_id"))
    return _appended(existing, _stamped(numbered))


def load_shops(existing: DataFrame, shops: DataFrame) -> Merge:
    """Plain append of partner shops."""
    rows = shops.withColumn("imported_at", F.current_timestamp())
    numbered = number_rows(rows, "librairie_id", start=next_id(existing, "librairie_id"))
    return _appended(existing, _stamped(numbered))


def load_quotes(
    existing: DataFrame, quotes: DataFrame, authors: DataFrame, order: list | None = None
) -> Merge:
    """Insert quotations whose hash is not stored; ``quotes`` is already deduplicated."""
    new = quotes.join(
        existing.select(F.col("quote_hash").alias("text_hash")), "text_hash", "left_anti"
    )
    mapped = map_to_id(new, "author", authors, "author_name", "author_id")
    numbered = number_rows(mapped, "quote_id", start=next_id(existing, "quote_id"), order=order)
    rows = _stamped(
        numbered.withColumnsRenamed({"text": "quote_text", "text_hash": "quote_hash"})
    )
    return _appended(existing, rows)


def load_bridge(
    existing: DataFrame, inserted: DataFrame, quotes: DataFrame, tags: DataFrame
) -> Merge:
    """Tag pairs of the inserted quotations only; repeated and unknown tags are ignored."""
    pairs = (
        quotes.select(F.col("text_hash").alias("quote_hash"), F.explode("tags").alias("tag_name"))
        .join(inserted.select("quote_hash", "quote_id"), "quote_hash")
        .join(tags.select("tag_name", "tag_id"), "tag_name")
        .select("quote_id", "tag_id")
        .distinct()
    )
    return _appended(existing, pairs.join(existing, ["quote_id", "tag_id"], "left_anti"))


def _complete(key: Sequence[str]) -> Column:
    """Whether no column of the key is NULL; a NULL clashes with nothing."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(False)) for c in key], F.lit(True))


def _first_of_each_key(df: DataFrame, unique: Sequence[Sequence[str]], order: str) -> DataFrame:
    """Rows that come first on all their keys by ``order``, which no two rows share."""
    winners = df
    for key in unique:
        firsts = df.filter(_complete(key)).groupBy(*key).agg(F.min(order).alias("_first"))
        later = df.join(firsts, list(key)).filter(F.col(order) > F.col("_first")).select(order)
        winners = winners.join(later, order, "left_anti")
    return winners


def insert_ignore(
    existing: DataFrame, incoming: DataFrame, unique: Sequence[Sequence[str]], order: str
) -> Merge:
    """Insert rows in ``order``; a row that clashes on any unique key is ignored.

    The outcome is that of inserting one row after the other; of rows equal in
    ``order`` and in a key, any one counts as the earlier. A key with a NULL
    column clashes with nothing. With several keys a row only blocks others when
    it got in itself, so winners are settled in rounds: rows that come first on
    all their keys go in, rows that clash with them drop out, the rest meets
    again. Only keys and row numbers move in a round. The earliest row left
    always goes in, so the rounds end; a chain of rows that each clash with the
    next takes a round for every second one.
    """
    new = incoming
    for key in unique:
        new = new.join(existing.select(*key), list(key), "left_anti")
    if len(unique) == 1:
        (key,) = unique
        whole = new.filter(_complete(key))
        firsts = whole.groupBy(*key).agg(F.min(order).alias("_first"))
        first = whole.join(firsts, list(key)).filter(F.col(order).eqNullSafe(F.col("_first")))
        kept = first.dropDuplicates(list(key)).select(*new.columns)
        return _appended(existing, kept.unionByName(new.filter(~_complete(key))))
    # numbered and pinned once: rows equal in order then still come one after the other
    rows = pinned(new.withColumn("_row", F.monotonically_increasing_id()))
    keys = list(dict.fromkeys(c for key in unique for c in key))
    rest = rows.select(F.struct(F.col(order).alias("o"), "_row").alias("_at"), *keys)
    accepted = None
    while not rest.isEmpty():
        winners = pinned(_first_of_each_key(rest, unique, "_at"))
        if winners.isEmpty():
            raise RuntimeError("no row of the rest comes first on its keys")
        accepted = winners.select("_at") if accepted is None else accepted.unionByName(winners.select("_at"))
        rest = rest.join(winners.select("_at"), "_at", "left_anti")
        for key in unique:
            rest = rest.join(winners.select(*key), list(key), "left_anti")
        rest = pinned(rest)
    if accepted is not None:
        rows = rows.join(accepted.select(F.col("_at._row").alias("_row")), "_row", "left_semi")
    return _appended(existing, rows.drop("_row"))


def insert_into(existing: DataFrame, table: str, incoming: DataFrame, order: str) -> Merge:
    return insert_ignore(existing, incoming, UNIQUE_KEYS[table], order)


# -------------------------------------------------------------- counters


def refresh_counter(
    dim: DataFrame, facts: DataFrame, key: str, counter: str
) -> DataFrame:
    """Recompute a stored counter; members without facts count zero."""
    counts = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    return (
        dim.drop(counter)
        .join(counts, key, "left")
        .withColumn(counter, F.coalesce(F.col("_n"), F.lit(0)))
        .select(*dim.columns)
    )


def apply_counter_delta(
    dim: DataFrame, inserted: DataFrame | None, deleted: DataFrame | None, key: str, counter: str
) -> DataFrame:
    """Add inserted and subtract deleted facts without reading the whole fact table."""
    parts = [
        df.select(F.col(key), F.lit(sign).alias("_d"))
        for df, sign in ((inserted, 1), (deleted, -1))
        if df is not None
    ]
    if not parts:
        return dim
    moves = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    delta = moves.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum("_d").alias("_d"))
    return (
        dim.join(delta, key, "left")
        .withColumn(counter, F.coalesce(F.col(counter), F.lit(0)) + F.coalesce(F.col("_d"), F.lit(0)))
        .select(*dim.columns)
    )


# ----------------------------------------------------- update and delete


def update_by_key(
    table: DataFrame, changes: DataFrame, keys: Sequence[str], renames: Mapping[str, str] | None = None
) -> Merge:
    """Overwrite columns of the rows that match; ``inserted`` holds the changed rows.

    ``changes`` has one row per key. ``renames`` maps a column of ``changes`` to
    the column it overwrites, for updates that change the key itself.
    """
    keys = list(keys)
    renames = dict(renames or {})
    targets = {renames.get(c, c): c for c in changes.columns if c not in keys}
    new = changes.select(
        *keys, *[F.col(c).alias(f"_new_{t}") for t, c in targets.items()], F.lit(True).alias("_hit")
    )
    joined = table.join(broadcast_if_small(new), keys, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    out = [
        F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in targets else F.col(c)
        for c in table.columns
    ]
    return Merge(joined.select(*out), joined.filter(hit).select(*out))


class Deletion(NamedTuple):
    kept: DataFrame
    deleted: DataFrame


def delete_by_key(table: DataFrame, keys: DataFrame) -> Deletion:
    cols = keys.columns
    doomed = broadcast_if_small(keys.distinct())
    return Deletion(table.join(doomed, cols, "left_anti"), table.join(doomed, cols, "left_semi"))


def delete_cascade(
    tables: Mapping[str, DataFrame], table: str, keys: DataFrame
) -> dict[str, Deletion]:
    """Delete by key, then follow the cascading references from parent to child."""
    out = {table: delete_by_key(tables[table], keys)}
    frontier = [table]
    while frontier:
        parent = frontier.pop(0)
        for child, column, owner, owner_key, cascades in FOREIGN_KEYS:
            if owner != parent or not cascades or child not in tables:
                continue
            doomed = out[parent].deleted.select(F.col(owner_key).alias(column))
            before = out[child].kept if child in out else tables[child]
            step = delete_by_key(before, doomed)
            gone = step.deleted if child not in out else out[child].deleted.unionByName(step.deleted)
            out[child] = Deletion(step.kept, gone)
            frontier.append(child)
    return out


# -------------------------------------------------------------- look-ups


def lookup(table: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``table`` for a set of keys."""
    return table.join(broadcast_if_small(keys.distinct()), keys.columns, "left_semi")


def lookup_one(table: DataFrame, **key: object) -> DataFrame:
    """Rows for one key; the comparison reaches the scan."""
    condition: Column = F.lit(True)
    for name, value in key.items():
        condition = condition & (F.col(name) == F.lit(value))
    return table.filter(condition)


def quotes_with_authors(quotes: DataFrame, authors: DataFrame) -> DataFrame:
    return quotes.join(authors, "id_author", "left").select("id_quote", "text", "author_name")


def tags_of_quotes(
    pairs: DataFrame, quotes: DataFrame, authors: DataFrame, tags: DataFrame
) -> DataFrame:
    """Quotation, author and tag of every pair."""
    return (
        pairs.join(tags, "id_tag")
        .join(quotes, "id_quote")
        .join(authors, "id_author")
        .select("id_quote", "text", "author_name", "tag_name")
    )


def revenue_with_shops(revenue: DataFrame, shops: DataFrame) -> DataFrame:
    """Revenue joined on the shop key, which is the only one both tables share."""
    return revenue.join(shops, "id_librairie").select(
        "id_ca_annuel",
        *[c for c in shops.columns if c not in ("id_librairie", "latitude", "longitude")],
        "ca_annuel",
    )
