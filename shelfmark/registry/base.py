"""Registration of queries, and the SQL views of the domain tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.text import WHITESPACE
from shelfmark.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

NULL_MARK = "∅"


def flat(df: DataFrame) -> DataFrame:
    """One plain form per type for comparison: 64-bit numbers, texts, joined lists."""

    def plain(field: T.StructField):
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType | T.FloatType):
            col = col.cast("double")
        elif isinstance(kind, T.IntegralType):
            col = col.cast("bigint")
        elif isinstance(kind, T.TimestampType):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DateType | T.BooleanType):
            col = col.cast("string")
        elif isinstance(kind, T.ArrayType):
            col = F.array_join(col, "|", NULL_MARK)
        return col.alias(field.name)

    return df.select([plain(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its comparison SQL."""

    def register(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return flat(fn(configure(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


# ----------------------------------------------- pieces of comparison SQL

# the white-space characters as an SQL text literal
SQL_WS = "'" + WHITESPACE + "'"


def sql_strip(x: str) -> str:
    return f"trim({x}, {SQL_WS})"


def sql_key(x: str) -> str:
    return f"cast('0x' || left(md5({x}), 15) as bigint)"


def sql_mean(x: str, scale: int = 2) -> str:
    return f"cast(round(cast(avg({x}) as decimal(18,6)), {scale}) as double)"


def sql_list(x: str) -> str:
    """A list column as the joined text that :func:`flat` makes of it."""
    return f"array_to_string(list_transform({x}, lambda e: coalesce(e, '{NULL_MARK}')), '|')"


STAR_SQL = f"""
dim_categories as (
  select {sql_key('category_name')} as category_id, category_name
  from (select distinct p_type as category_name from part union all select 'UNUSED')),
fact_books as (
  select book_id, category_id, title, price_gbp, rating, availability,
         cast(round(price_gbp * cast(1.17 as decimal(3,2)), 2) as decimal(10,2)) as price_eur
  from (select p_partkey as book_id,
               case when p_partkey % 53 <> 0 then {sql_key('p_type')} end as category_id,
               p_name as title,
               case when p_partkey % 89 <> 0 then cast(p_retailprice as decimal(10,2)) end as price_gbp,
               p_size % 5 + 1 as rating, p_size as availability
        from part)),
fact_quotes as (
  select quote_id, author_id, quote_text, md5(lower(quote_text)) as quote_hash
  from (select o_orderkey as quote_id,
               case when o_orderkey % 101 <> 0 then o_custkey end as author_id,
               'A quotation of priority ' || o_orderpriority || ' in state ' || o_orderstatus
               || ' kept since ' || strftime(o_orderdate, '%Y-%m-%d')
               || ' by customer number ' || o_custkey as quote_text
        from orders)),
dim_authors as (
  select c_custkey as author_id, c_name as author_name, coalesce(n, 0) as quote_count
  from customer left join (select author_id, count(*) as n from fact_quotes
                           where author_id is not null group by author_id) q
       on c_custkey = q.author_id),
dim_tags as (
  select {sql_key('tag_name')} as tag_id, tag_name
  from (select distinct p_brand as tag_name from part)),
quote_tags as (
  select distinct l_orderkey as quote_id, {sql_key('p_brand')} as tag_id
  from lineitem join part on l_partkey = p_partkey),
dim_librairies as (
  select s_suppkey as librairie_id, s_name as nom, n_name as ville,
         case when s_suppkey % 11 <> 0 then r_name end as specialite,
         case when s_suppkey % 7 <> 0 then
           cast(43.12 as decimal(10,8)) + cast(s_suppkey % 500 as decimal(10,2)) * cast(0.01 as decimal(4,2))
         end as latitude,
         case when s_suppkey % 7 <> 0 then
           cast(-1.34 as decimal(10,8)) + cast(s_suppkey % 500 as decimal(10,2)) * cast(0.01 as decimal(4,2))
         end as longitude,
         date '2015-01-01' + cast(s_suppkey % 900 as integer) as date_partenariat,
         cast(s_acctbal as decimal(10,2)) * 100 as ca_annuel
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
"""

NORMALISED_SQL = f"""
{STAR_SQL},
authors as (select c_custkey as id_author, c_name as author_name from customer),
quotes as (select quote_id as id_quote, quote_text as text, author_id as id_author
           from fact_quotes where author_id is not null),
tags as (select tag_id as id_tag, tag_name from dim_tags),
quotes_tags as (select quote_id as id_quote, tag_id as id_tag from quote_tags),
books as (select p_partkey as id_book, p_name as title from part),
librairies as (select s_suppkey as id_librairie, s_name as nom_librairie from supplier)
"""


def with_star(body: str) -> str:
    return f"with {STAR_SQL} {body}"


def with_normalised(body: str) -> str:
    return f"with {NORMALISED_SQL} {body}"
