import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shelfmark import schemas
from shelfmark.operators import cleaning, keys, merge


def sequential_insert(stored, incoming):
    """What inserting one row after the other gives with two unique keys."""
    ids, names = {r[0] for r in stored}, {r[1] for r in stored}
    out = []
    for i, n, pos in sorted(incoming, key=lambda r: r[2]):
        if i not in ids and n not in names:
            ids.add(i)
            names.add(n)
            out.append((i, n))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_insert_ignore_equals_sequential_inserts(spark, seed):
    rng = random.Random(seed)
    incoming = [(rng.randrange(25), f"n{rng.randrange(25)}", i) for i in range(120)]
    stored = [(1, "n1"), (2, "n9")]
    merged = merge.insert_into(
        spark.createDataFrame(stored, schemas.NORMALISED["tags"]),
        "tags",
        spark.createDataFrame(incoming, "id_tag bigint, tag_name string, pos bigint"),
        "pos",
    )
    assert rows(merged.inserted) == sorted(sequential_insert(stored, incoming), key=repr)


def test_numbers_are_gap_free_and_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v")).repartition(7)
    out = keys.number_rows(df, "n", start=5, order=[F.desc("v")]).orderBy("n").collect()
    assert [r.n for r in out] == list(range(5, 1005))
    assert [r.v for r in out] == list(range(999, -1, -1))
    loose = keys.number_rows(df, "n").agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()
    assert tuple(loose) == (1, 1000, 1000)
    assert keys.number_rows(df.limit(0), "n").count() == 0


def raw_quotes(spark, texts):
    data = [(t, "A", ["x", "x", "Y "], i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "text string, author string, tags array<string>, position bigint")
    return df.withColumn(
        "_metadata",
        F.struct(F.lit("s").alias("source"), F.current_timestamp().alias("scraped_at")),
    )


def test_dedup_keeps_the_first_by_case_and_space(spark):
    raw = raw_quotes(spark, ["Hello", " hello ", "HELLO", "other"])
    out = cleaning.clean_quotes(raw, batch_id="b")
    assert rows(out, "position", "text", "tag_count") == [(0, "Hello", 3), (3, "other", 3)]


def empty(spark, table):
    return spark.createDataFrame([], schemas.GOLD[table])


def test_loading_twice_changes_nothing(spark):
    quotes = cleaning.clean_quotes(raw_quotes(spark, ["a", "b", "A"]), batch_id="b").cache()
    authors, tags = empty(spark, "dim_authors"), empty(spark, "dim_tags")
    facts, bridge = empty(spark, "fact_quotes"), empty(spark, "quote_tags")
    seen = []
    for _ in range(2):
        authors = merge.upsert_authors(authors, quotes).result.cache()
        tags = merge.upsert_tags(tags, quotes).result.cache()
        loaded = merge.load_quotes(facts, quotes, authors)
        inserted = loaded.inserted.cache()
        bridge = merge.load_bridge(bridge, inserted, quotes, tags).result.cache()
        facts = facts.unionByName(inserted).cache()
        seen.append([df.count() for df in (authors, tags, facts, bridge)])
    assert seen == [[1, 2, 2, 4], [1, 2, 2, 4]]
    counted = merge.refresh_counter(tags, bridge, "tag_id", "usage_count")
    assert rows(counted, "tag_name", "usage_count") == [("x", 2), ("y", 2)]


def test_cascade_reaches_pairs_but_not_tags(spark):
    n = schemas.NORMALISED
    t = {
        "authors": spark.createDataFrame([(1, "a")], n["authors"]),
        "quotes": spark.createDataFrame([(1, "q", 1)], n["quotes"]),
        "tags": spark.createDataFrame([(i, f"t{i}") for i in range(4)], n["tags"]),
        "quotes_tags": spark.createDataFrame([(1, i) for i in range(4)], n["quotes_tags"]),
    }
    assert merge.tags_of_quotes(t["quotes_tags"], t["quotes"], t["authors"], t["tags"]).count() == 4
    out = merge.delete_cascade(t, "authors", spark.createDataFrame([(1,)], "id_author bigint"))
    assert {k: (d.deleted.count(), d.kept.count()) for k, d in out.items()} == {
        "authors": (1, 0), "quotes": (1, 0), "quotes_tags": (4, 0),
    }
    assert "tags" not in out


def test_update_and_counter_delta(spark):
    table = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, name string, n int")
    changes = spark.createDataFrame([(2, None), (9, "z")], "id int, name string")
    done = merge.update_by_key(table, changes, ["id"])
    assert rows(done.result) == [(1, "a", 5), (2, None, 6)]
    assert rows(done.inserted) == [(2, None, 6)]
    facts = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    delta = merge.apply_counter_delta(table, facts, facts.limit(1), "id", "n")
    assert rows(delta, "id", "n")[1] == (2, 6)


def test_null_keys_never_clash(spark):
    held = spark.createDataFrame([(1, "a", 0)], "id int, name string, place int")
    data = [(1, "x", 1), (None, "a", 2), (None, "y", 3), (None, "y", 4), (5, None, 5), (6, None, 6), (5, "z", 7)]
    new = spark.createDataFrame(data, held.schema)
    one = merge.insert_ignore(held, new, [("id",)], "place").inserted
    assert sorted(r.place for r in one.collect()) == [2, 3, 4, 5, 6]
    two = merge.insert_ignore(held, new, [("id",), ("name",)], "place").inserted
    assert sorted(r.place for r in two.collect()) == [3, 5, 6]


def test_chain_of_clashes_and_repeated_order(spark):
    held = spark.createDataFrame([], "a int, b int, place int")
    chain = spark.createDataFrame([(i // 2, (i + 1) // 2, i) for i in range(12)], held.schema)
    got = merge.insert_ignore(held, chain, [("a",), ("b",)], "place").inserted
    seen_a, seen_b, expected = set(), set(), []
    for r in sorted(chain.collect(), key=lambda r: r.place):
        if r.a not in seen_a and r.b not in seen_b:
            seen_a.add(r.a), seen_b.add(r.b), expected.append(r.place)
    assert sorted(r.place for r in got.collect()) == expected
    tied = spark.createDataFrame([(1, 1, 0), (1, 2, 0), (2, 2, 0)], held.schema)
    out = merge.insert_ignore(held, tied, [("a",), ("b",)], "place").inserted.collect()
    assert len({r.a for r in out}) == len({r.b for r in out}) == len(out) > 0
    single = merge.insert_ignore(held, tied, [("a",)], "place").inserted.collect()
    assert sorted(r.a for r in single) == [1, 2]
