"""Keys, idempotent loading, counters, updates, deletes and look-ups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import bindings as b
from shelfmark.functions.text import stable_key
from shelfmark.operators import cleaning, keys, merge
from shelfmark.plans.normalise import normalise_quotes as split_quotes
from shelfmark.plans.normalise import shop_tables
from shelfmark.registry.base import query, sql_key, with_normalised, with_star
from shelfmark.registry.cleaning import _QUOTES, BATCH
from shelfmark.session import pinned


@query(
    "surrogate_keys",
    """
select o_orderkey, row_number() over (order by o_totalprice desc, o_orderkey) + 99 as order_no
from orders""",
)
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    numbered = keys.number_rows(
        orders, "order_no", start=100, order=[F.desc("o_totalprice"), "o_orderkey"]
    )
    return numbered.select("o_orderkey", "order_no")


def _stored_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors stored by an earlier run: the customers of the first nations."""
    return (
        b.table(spark, sf_dir, "customer")
        .filter("c_nationkey < 10")
        .select(
            (F.col("c_custkey") + 1).alias("author_id"),
            F.col("c_name").alias("author_name"),
            F.lower("c_name").alias("author_slug"),
            F.lit(0).alias("quote_count"),
        )
    )


@query(
    "dim_upsert",
    """
with stored as (select c_custkey + 1 as author_id, c_name as author_name from customer
                where c_nationkey < 10),
fresh as (select c_name as author_name, min(o_orderkey) as first_seen
          from orders join customer on o_custkey = c_custkey
          where c_name not in (select author_name from stored) group by c_name)
select author_id, author_name, lower(author_name) as author_slug from stored
union all
select (select max(author_id) from stored) + row_number() over (order by first_seen, author_name),
       author_name, lower(author_name) from fresh""",
)
def dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = b.table(spark, sf_dir, "orders").join(
        b.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    merged = merge.upsert_dimension(
        _stored_authors(spark, sf_dir),
        seen.select(F.col("c_name").alias("author_name"), "o_orderkey"),
        name="author_name",
        id_col="author_id",
        slug_col="author_slug",
        counter="quote_count",
        order="o_orderkey",
    )
    return merged.result.select("author_id", "author_name", "author_slug")


def _quote_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Silver batch, stored before it is loaded as a run does it."""
    raw = b.raw_quotes(b.table(spark, sf_dir, "documents"))
    return pinned(cleaning.clean_quotes(raw, batch_id=BATCH))


_QUOTE_STORE = "quote_id bigint, author_id bigint, quote_text string, quote_hash string"


def _loaded_quotes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, merge.Merge]:
    """French documents are stored already; all documents come in."""
    batch = _quote_batch(spark, sf_dir)
    docs = b.table(spark, sf_dir, "documents").filter("lang = 'fr'").select("doc_id")
    stored = batch.join(docs, F.col("position") == F.col("doc_id"), "left_semi").select(
        F.col("position").alias("quote_id"),
        stable_key(F.col("author")).alias("author_id"),
        F.col("text").alias("quote_text"),
        F.col("text_hash").alias("quote_hash"),
    )
    authors = batch.select(F.col("author").alias("author_name")).distinct()
    authors = authors.withColumn("author_id", stable_key(F.col("author_name")))
    return batch, merge.load_quotes(stored, batch, authors, order=["position"])


_LOADED = f"""
with {_QUOTES},
first as (select * from quotes where position in (select min(position) from quotes group by text_hash)),
stored as (select * from first where position in (select doc_id from documents where lang = 'fr')),
inserted as (
  select (select max(position) from stored) + row_number() over (order by position) as quote_id,
         {sql_key('author')} as author_id, text_hash as quote_hash, text, tags
  from first where text_hash not in (select text_hash from stored)),
dim_tags as (select distinct unnest(tags) as tag_name from inserted)
"""


@query(
    "fact_insert_if_absent",
    _LOADED + "select quote_id, author_id, quote_hash from inserted",
)
def fact_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, merged = _loaded_quotes(spark, sf_dir)
    return merged.inserted.select("quote_id", "author_id", "quote_hash")


def _bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag pairs of the inserted quotations; the tag ``de`` is unknown."""
    batch, merged = _loaded_quotes(spark, sf_dir)
    names = batch.select(F.explode("tags").alias("tag_name")).distinct()
    tags = names.filter("tag_name <> 'de'").withColumn("tag_id", stable_key(F.col("tag_name")))
    none = merged.result.select("quote_id", F.col("author_id").alias("tag_id")).limit(0)
    return merge.load_bridge(none, merged.inserted, batch, tags).inserted


_PAIRS = f"""
select distinct quote_id, {sql_key('tag_name')} as tag_id
from (select quote_id, unnest(tags) as tag_name from inserted) where tag_name <> 'de'
"""


@query("bridge_load", _LOADED + _PAIRS)
def bridge_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bridge(spark, sf_dir)


@query(
    "tag_counters",
    with_star(
        """
select tag_name, count(quote_id) as usage_count
from dim_tags t left join quote_tags q on t.tag_id = q.tag_id group by tag_name"""
    ),
)
def tag_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = b.star(spark, sf_dir)
    counted = merge.refresh_counter(t["dim_tags"], t["quote_tags"], "tag_id", "usage_count")
    return counted.select("tag_name", "usage_count")


@query(
    "counter_delta",
    with_star(
        """
select author_id,
       quote_count + (select count(*) from fact_quotes q where q.author_id = a.author_id
                      and quote_hash < '8')
                   - (select count(*) from fact_quotes q where q.author_id = a.author_id
                      and quote_hash >= 'c') as quote_count
from dim_authors a"""
    ),
)
def counter_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = b.star(spark, sf_dir)
    moved = t["fact_quotes"].select("author_id", "quote_hash")
    counted = merge.apply_counter_delta(
        t["dim_authors"],
        moved.filter("quote_hash < '8'"),
        moved.filter("quote_hash >= 'c'"),
        "author_id",
        "quote_count",
    )
    return counted.select("author_id", "quote_count")


@query(
    "map_names_to_ids",
    with_star(
        f"""
select p_partkey, category_id from part left join
  (select * from dim_categories where category_name <> 'SMALL') c on p_type = category_name"""
    ),
)
def map_names_to_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = b.table(spark, sf_dir, "part")
    known = b.dim_categories(part).filter("category_name <> 'SMALL'")
    return merge.map_to_id(
        part.select("p_partkey", "p_type"), "p_type", known, "category_name", "category_id"
    )


@query(
    "insert_ignore",
    """
select cast(l_orderkey as bigint) as quote_id, min(l_linenumber * 100000000 + l_partkey) as first
from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')
group by l_orderkey""",
)
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order gets in, the smallest by line, unless the order is stored."""
    incoming = b.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("quote_id"),
        (F.col("l_linenumber").cast("bigint") * 100_000_000 + F.col("l_partkey")).alias("first"),
    )
    stored = (
        b.table(spark, sf_dir, "orders")
        .filter("o_orderstatus = 'F'")
        .select(F.col("o_orderkey").alias("quote_id"), F.lit(0).cast("bigint").alias("first"))
    )
    return merge.insert_ignore(stored, incoming, [("quote_id",)], "first").inserted.distinct()


@query("insert_ignore_two_keys")
def insert_ignore_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags whose id and name must both be new; the outcome depends on the order of rows."""
    incoming = b.table(spark, sf_dir, "part").select(
        (F.col("p_partkey") % 40).alias("id_tag"),
        F.concat("p_brand", F.lit(" "), "p_type").alias("tag_name"),
        F.col("p_partkey").alias("position"),
    )
    stored = incoming.limit(0)
    return merge.insert_into(stored, "tags", incoming, "position").inserted


_NEW_PRICE = "cast(s_suppkey as double) + 0.5"


@query(
    "update_by_key",
    f"""
select p_partkey, coalesce(s_name, p_name) as p_name,
       case when s_suppkey is not null then {_NEW_PRICE} else p_retailprice end as p_retailprice
from part left join supplier on p_partkey = s_suppkey""",
)
def update_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _updated(spark, sf_dir).result


@query(
    "update_by_key_returning",
    f"""
select s_suppkey as p_partkey, s_name as p_name, {_NEW_PRICE} as p_retailprice
from supplier where s_suppkey in (select p_partkey from part)""",
)
def update_by_key_returning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _updated(spark, sf_dir).inserted


def _updated(spark: SparkSession, sf_dir: str) -> merge.Merge:
    books = b.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    changes = b.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("p_partkey"),
        F.col("s_name").alias("p_name"),
        (F.col("s_suppkey").cast("double") + 0.5).alias("p_retailprice"),
    )
    return merge.update_by_key(books, changes, ["p_partkey"])


@query(
    "update_pair",
    with_normalised(
        """
select case when id_quote in (select s_suppkey from supplier) then id_quote + 1000000000
            else id_quote end as id_quote, id_tag from quotes_tags"""
    ),
)
def update_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An update that moves pairs to another quotation: the key itself changes."""
    pairs = b.normalised(spark, sf_dir)["quotes_tags"]
    moving = b.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id_quote"), (F.col("s_suppkey") + 1_000_000_000).alias("new_id")
    )
    return merge.update_by_key(pairs, moving, ["id_quote"], {"new_id": "id_quote"}).result


_CASCADE = """
gone_authors as (select id_author from authors where id_author in
                 (select c_custkey from customer where c_mktsegment = 'BUILDING')),
gone_quotes as (select id_quote from quotes where id_author in (select id_author from gone_authors)),
gone_pairs as (select * from quotes_tags where id_quote in (select id_quote from gone_quotes))
"""


def _cascade(spark: SparkSession, sf_dir: str) -> dict[str, merge.Deletion]:
    t = b.normalised(spark, sf_dir)
    doomed = (
        b.table(spark, sf_dir, "customer")
        .filter("c_mktsegment = 'BUILDING'")
        .select(F.col("c_custkey").alias("id_author"))
    )
    return merge.delete_cascade(t, "authors", doomed)


@query(
    "delete_cascade",
    with_normalised(
        f""", {_CASCADE}
select 'authors' as tbl, (select count(*) from gone_authors) as deleted,
       (select count(*) from authors) - (select count(*) from gone_authors) as kept
union all select 'quotes', (select count(*) from gone_quotes),
       (select count(*) from quotes) - (select count(*) from gone_quotes)
union all select 'quotes_tags', (select count(*) from gone_pairs),
       (select count(*) from quotes_tags) - (select count(*) from gone_pairs)"""
    ),
)
def delete_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [
        spark.range(0, 1, 1, 1).select(
            F.lit(name).alias("tbl"),
            d.deleted.select(F.count("*")).scalar().alias("deleted"),
            d.kept.select(F.count("*")).scalar().alias("kept"),
        )
        for name, d in _cascade(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query(
    "delete_cascade_pairs",
    with_normalised(
        f""", {_CASCADE}
select id_quote, id_tag from quotes_tags where id_quote not in (select id_quote from gone_quotes)"""
    ),
)
def delete_cascade_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cascade(spark, sf_dir)["quotes_tags"].kept


@query(
    "lookup_batch",
    with_normalised(
        """
select qt.id_quote, text, author_name, tag_name
from quotes_tags qt join tags t on qt.id_tag = t.id_tag join quotes q on qt.id_quote = q.id_quote
     join authors a on q.id_author = a.id_author
where qt.id_quote in (select s_suppkey from supplier)"""
    ),
)
def lookup_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = b.normalised(spark, sf_dir)
    wanted = b.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id_quote"))
    pairs = merge.lookup(t["quotes_tags"], wanted)
    return merge.tags_of_quotes(pairs, t["quotes"], t["authors"], t["tags"])


@query(
    "lookup_quotes_with_authors",
    with_normalised(
        """
select id_quote, text, author_name from quotes q left join authors a on q.id_author = a.id_author"""
    ),
)
def lookup_quotes_with_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = b.normalised(spark, sf_dir)
    return merge.quotes_with_authors(t["quotes"], t["authors"])


@query(
    "revenue_with_shops",
    with_star(
        """
select row_number() over (order by librairie_id) as id_ca_annuel, nom, ville, specialite,
       cast(ca_annuel as double) as ca_annuel from dim_librairies"""
    ),
)
def revenue_with_shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    shops = b.dim_shops(*[b.table(spark, sf_dir, n) for n in ("supplier", "nation", "region")])
    rows = shops.withColumnRenamed("librairie_id", "id_librairie").select(
        "id_librairie", "nom", "ville", "specialite", "ca_annuel"
    )
    revenue = keys.number_rows(
        rows.select("id_librairie", "ca_annuel"), "id_ca_annuel", order=["id_librairie"]
    )
    return merge.revenue_with_shops(revenue, rows.drop("ca_annuel"))


@query(
    "normalise_quotes",
    f"""
with {_QUOTES},
numbered as (select *, row_number() over (order by position) as id_quote from quotes),
authors as (
  select author, row_number() over (order by min(id_quote)) as id_author from numbered group by author),
pairs as (
  select id_quote, unnest(tags) as tag, generate_subscripts(tags, 1) as n from numbered),
tags as (
  select tag, row_number() over (order by min(id_quote * 10 + n)) as id_tag from pairs group by tag)
select distinct p.id_quote, id_author, a.author as author_name, id_tag, t.tag as tag_name
from pairs p join numbered q on p.id_quote = q.id_quote join authors a on q.author = a.author
     join tags t on p.tag = t.tag""",
)
def normalise_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = b.raw_quotes(b.table(spark, sf_dir, "documents"))
    tidy = raw.select(
        "position",
        "text",
        F.coalesce(F.trim("author"), F.lit("Unknown")).alias("author"),
        F.transform("tags", lambda t: F.lower(F.trim(t))).alias("tags"),
    )
    t = split_quotes(tidy)
    return (
        t["quotes_tags"]
        .join(t["quotes"], "id_quote")
        .join(t["authors"], "id_author")
        .join(t["tags"], "id_tag")
        .select("id_quote", "id_author", "author_name", "id_tag", "tag_name")
    )


@query(
    "shop_tables",
    with_star(
        """
select nom, cast(ca_annuel as double) as ca_annuel from dim_librairies"""
    ),
)
def shop_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    shops = b.dim_shops(*[b.table(spark, sf_dir, n) for n in ("supplier", "nation", "region")])
    t = shop_tables(shops.select("nom", "ca_annuel"))
    return t["librairies"].join(t["ca_annuel"], "id_librairie").select("nom", "ca_annuel")
