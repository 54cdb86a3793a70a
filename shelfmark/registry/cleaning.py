"""Cleaning of raw books, quotations and partner rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import bindings as b
from shelfmark.functions import fields, text
from shelfmark.operators import cleaning
from shelfmark.registry.base import query, sql_strip

BATCH = "batch_20240115_080000_0a1b2c3d"

RAW_BOOKS_SQL = """
raw_books as (
  select p_partkey, '  ' || p_name || chr(32) || chr(9) as title,
         case when p_partkey % 97 = 0 then 'N/A'
              when p_partkey % 83 = 0 then '£1,' || price
              when p_partkey % 79 = 0 then null
              when p_partkey % 5 = 0 then replace(price, '.', ',')
              else '£' || price end as price,
         case when p_partkey % 71 <> 0
              then ['One', 'two', 'THREE', 'Four', 'five', '4', 'none'][p_partkey % 7 + 1] end as rating,
         case when p_partkey % 13 = 0 then 'In stock'
              when p_partkey % 67 <> 0 then cast(p_size as varchar) end as availability,
         case when p_partkey % 31 <> 0 then p_type end as category,
         'https://books.example.org/catalogue/' || p_partkey as url
  from (select *, cast(cast(p_retailprice as decimal(10,2)) as varchar) as price from part))
"""

_PARSED_BOOKS = f"""
with {RAW_BOOKS_SQL},
parsed as (
  select *, case when price is null then cast(0 as decimal(10,2))
                 else try_cast({sql_strip("replace(replace(price, '£', ''), ',', '.')")} as decimal(10,2))
            end as price_gbp
  from raw_books)
"""

_RATING = """
case lower(coalesce(rating, '0')) when 'one' then 1 when 'two' then 2 when 'three' then 3
     when 'four' then 4 when 'five' then 5
     else case when regexp_matches(rating, '^[0-9]+$') then cast(rating as bigint) else 0 end end
"""


@query(
    "clean_books",
    _PARSED_BOOKS
    + f"""
select p_partkey, {sql_strip('title')} as title, coalesce(category, 'Uncategorized') as category,
       cast(price_gbp as double) as price_gbp,
       cast(round(price_gbp * cast(1.17 as decimal(3,2)), 2) as double) as price_eur,
       {_RATING} as rating,
       case when regexp_matches(availability, '^[0-9]+$') then cast(availability as bigint) else 0 end
         as availability,
       url, '' as image_url, '2024-01-15 08:00:00' as scraped_at, 'books' as source,
       'price_gbp_to_eur|rating_normalized|text_cleaned' as transformations
from parsed where price_gbp is not null""",
)
def clean_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = b.raw_books(b.table(spark, sf_dir, "part"))
    good = cleaning.clean_books(raw, batch_id=BATCH, keep=("p_partkey",)).good
    return good.select(
        "*", F.col("_metadata.source"), F.col("_metadata.transformations")
    ).drop("_metadata")


@query(
    "clean_books_quarantine",
    _PARSED_BOOKS
    + f"""
select 'transform_books' as stage, {sql_strip('title')} as key,
       'price not a number: ' || price as reason, '{BATCH}' as batch_id
from parsed where price_gbp is null""",
)
def clean_books_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = b.raw_books(b.table(spark, sf_dir, "part"))
    return cleaning.clean_books(raw, batch_id=BATCH).quarantine


@query(
    "normalised_price",
    f"""
with {RAW_BOOKS_SQL}
select p_partkey, cast(price_gbp as double) as price_gbp,
       cast(round(price_gbp * cast(1.15 as decimal(3,2)), 2) as double) as price_eur,
       coalesce(contains(lower(availability), 'in stock'), false)::varchar as in_stock
from (select *, case when price is null or regexp_extract(price, '[0-9.]+') = '' then cast(0 as decimal(10,2))
                     else try_cast(regexp_extract(price, '[0-9.]+') as decimal(10,2)) end as price_gbp
      from raw_books)""",
)
def normalised_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = b.raw_books(b.table(spark, sf_dir, "part"))
    price = fields.first_price(F.col("price"))
    return raw.select(
        "p_partkey",
        price.alias("price_gbp"),
        fields.convert(price, fields.RATE_GBP_EUR_NORMALISED).alias("price_eur"),
        fields.in_stock(F.col("availability")).alias("in_stock"),
    )


_QUOTES = f"""
quotes as (
  select doc_id as position, {sql_strip('text')} as text,
         md5(lower({sql_strip('text')})) as text_hash,
         case when doc_id % 29 <> 0 then 'Author ' || source else 'Unknown' end as author,
         case when doc_id % 29 <> 0 then '-author-' || source else '' end as author_slug,
         [lower(lang), lower(source), case when n_chars > 1000 then 'long' else 'short' end, lower(lang)]
           as tags
  from documents)
"""


@query(
    "clean_quotes",
    f"""
with {_QUOTES}
select position, text, text_hash, author, author_slug, array_to_string(tags, '|') as tags,
       len(tags) as tag_count, length(text) as text_length, '2024-01-15 08:00:00' as scraped_at,
       'quotes' as source
from quotes where position in (select min(position) from quotes group by text_hash)""",
)
def clean_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = b.raw_quotes(b.table(spark, sf_dir, "documents"))
    out = cleaning.clean_quotes(raw, batch_id=BATCH)
    return out.withColumn("source", F.col("_metadata.source")).drop("_metadata")


@query(
    "dedup_keep_first",
    f"""
select min(doc_id) as doc_id, md5(lower({sql_strip('text')})) as text_hash
from documents group by all""",
)
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = b.table(spark, sf_dir, "documents").select(
        "doc_id", text.text_hash(F.col("text")).alias("text_hash")
    )
    return cleaning.keep_first(docs, "text_hash", "doc_id")


PARTNERS_SQL = """
partners as (
  select c_custkey + 2 as row_number,
         case when c_custkey % 61 <> 0 then c_name end as nom_librairie,
         case when c_custkey % 59 <> 0 then (c_custkey % 40 + 1) || ' Rue du PORT' end as adresse,
         case when c_custkey % 17 = 0 then '1234'
              else lpad(cast(c_custkey % 95 * 1000 + 1000 as varchar), 5, '0') end as code_postal,
         case when c_custkey % 47 <> 0 then replace(n_name, '_', '-') end as ville,
         case when c_custkey % 43 <> 0
              then 'Ana ' || lower(c_mktsegment) || '  B' || c_custkey end as contact_nom,
         case when c_custkey % 41 = 0 then ''
              when c_custkey % 19 = 0 then 'contact' || c_custkey || '@nowhere'
              else ' contact' || c_custkey || '@mail.example.org ' end as contact_email,
         case when c_custkey % 37 = 0 then null
              when c_custkey % 23 = 0 then '00' || digits
              when c_custkey % 3 = 0 then '1' || digits
              else '01.' || left(digits, 4) || '-' || right(digits, 4) end as contact_telephone,
         case when c_custkey % 53 <> 0
              then cast(cast(c_acctbal as decimal(10,2)) * 150 as varchar) end as ca_annuel,
         cast(date '2015-01-01' + cast(c_custkey % 900 as integer) as varchar) as date_partenariat,
         case when c_custkey % 71 <> 0 then r_name end as specialite
  from (select *, lpad(cast(c_custkey % 100000000 as varchar), 8, '0') as digits from customer)
       join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
"""


@query(
    "fill_defaults",
    f"""
with {PARTNERS_SQL}
select row_number, coalesce(nom_librairie, 'Unknown') as nom_librairie,
       coalesce(adresse, 'Unknown') as adresse, code_postal, coalesce(ville, 'Unknown') as ville,
       coalesce(contact_nom, 'Unknown') as contact_nom, contact_email,
       coalesce(contact_telephone, '0000000000') as contact_telephone,
       cast(coalesce(ca_annuel, '0') as double) as ca_annuel, date_partenariat,
       coalesce(specialite, 'Unknown') as specialite
from partners""",
)
def fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.fill_defaults(b.partners(spark, sf_dir))


@query(
    "drop_duplicate_rows",
    "select distinct o_orderpriority, o_orderstatus, o_custkey from orders",
)
def drop_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = b.table(spark, sf_dir, "orders")
    return cleaning.drop_duplicate_rows(
        orders.select("o_orderpriority", "o_orderstatus", "o_custkey")
    )


@query(
    "text_functions",
    f"""
select doc_id, left(text, 80) || '...' as excerpt, lower(replace(source, ' ', '-')) as slug,
       length({sql_strip('text')}) as n
from documents""",
)
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = b.table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        text.excerpt(F.col("text")).alias("excerpt"),
        text.slug(F.col("source")).alias("slug"),
        F.length(text.strip(F.col("text"))).alias("n"),
    )

