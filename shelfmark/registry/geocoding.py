"""Look-ups in saved geocoder responses, and the nearest address of a point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import bindings as b
from shelfmark.operators import geocode as g
from shelfmark.registry.base import query
from shelfmark.registry.cleaning import BATCH

ENDPOINT = "https://geo.example.org/search/"

_REQUESTS = """
requests as (
  select c_custkey as id, ' ' || (c_custkey % 40 + 1) || ' Rue/du PORT' as address,
         case when c_custkey % 6 <> 0 then n_name end as city,
         case when c_custkey % 4 <> 0 then lpad(cast(c_nationkey * 1000 + 1000 as varchar), 5, '0') end
           as postcode
  from customer join nation on c_nationkey = n_nationkey),
keyed as (
  select *, concat_ws('|', trim(lower(address)), lower(city), postcode) as key,
         concat_ws(' ', address, city, postcode) as query
  from requests),
answers as (
  select key, k, case when k % 9 = 0 or k % 10 = 0 or k % 11 = 0 then null
                      else cast('4' || (k % 9) || '.' || lpad(cast(k % 97 as varchar), 2, '0') as double)
                 end as latitude,
         case when k % 9 = 0 or k % 10 = 0 or k % 11 = 0 then null
              else cast((k % 7) || '.5' as double) end as longitude
  from (select key, min(id) as k from keyed group by key having min(id) % 13 <> 0))
"""


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = b.table(spark, sf_dir, "customer"), b.table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.alias("id"),
        F.concat(F.lit(" "), key % 40 + 1, F.lit(" Rue/du PORT")).alias("address"),
        F.when(~b.every("c_custkey", 6), F.col("n_name")).alias("city"),
        F.when(
            ~b.every("c_custkey", 4),
            F.lpad((F.col("c_nationkey") * 1000 + 1000).cast("string"), 5, "0"),
        ).alias("postcode"),
    )


def _responses(requests: DataFrame) -> DataFrame:
    """A saved body per key: found, empty, broken or too short; some keys have none."""
    parts = [F.col(c) for c in ("address", "city", "postcode")]
    k = F.col("k")
    full = F.format_string(
        '{"features": [{"geometry": {"coordinates": [%d.5, 4%d.%02d]}, "properties": '
        '{"label": "Place %d", "score": 0.%d, "city": "C%d", "postcode": "%05d"}}]}',
        k % 7, k % 9, k % 97, k, k % 10, k % 5, k % 90000,
    )
    body = (
        F.when(k % 9 == 0, F.lit('{"features": []}'))
        .when(k % 10 == 0, F.lit('{"features": [{"geom'))
        .when(k % 11 == 0, F.lit('{"features": [{"geometry": {"coordinates": [2.5]}}]}'))
        .otherwise(full)
    )
    return (
        requests.groupBy(g.lookup_key(*parts).alias("key"))
        .agg(F.min("id").alias("k"))
        .filter(k % 13 != 0)
        .select("key", body.alias("body"))
    )


def _answers(requests: DataFrame) -> DataFrame:
    return g.parse_responses(_responses(requests))


@query(
    "geocode_requests",
    f"""
with {_REQUESTS}
select id, key, query,
       '{ENDPOINT}?q=' || replace(url_encode(query), '%2F', '/') || '&limit=1'
       || coalesce('&postcode=' || postcode, '') as url
from keyed""",
)
def geocode_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts: list[Column] = [F.col(c) for c in ("address", "city", "postcode")]
    return _requests(spark, sf_dir).select(
        "id",
        g.lookup_key(*parts).alias("key"),
        g.query_text(*parts).alias("query"),
        g.query_url(ENDPOINT, *parts).alias("url"),
    )


@query(
    "distinct_lookups",
    f"with {_REQUESTS} select key, min(query) as query from keyed group by key",
)
def distinct_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.distinct_lookups(_requests(spark, sf_dir))


@query(
    "geocode_parse",
    f"""
with {_REQUESTS}
select key, latitude, longitude, case when latitude is not null then 'Place ' || k end as label,
       case when latitude is not null then cast('0.' || (k % 10) as double) end as score,
       case when latitude is not null then 'C' || (k % 5) end as city,
       case when latitude is not null then lpad(cast(k % 90000 as varchar), 5, '0') end as postcode,
       case when latitude is not null then '' end as context
from answers""",
)
def geocode_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(_requests(spark, sf_dir)).drop("type", "raw_response")


@query(
    "geocode_join",
    f"""
with {_REQUESTS}
select id as original_id, latitude, longitude, case when latitude is null then 'not_found' end as error
from keyed left join answers on keyed.key = answers.key""",
)
def geocode_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = _requests(spark, sf_dir)
    return g.geocode(requests, _answers(requests)).select(
        "original_id", "latitude", "longitude", "error"
    )


@query(
    "geocode_enrich",
    f"""
with {_REQUESTS}
select id, coalesce(latitude, cast(id as double)) as latitude,
       case when latitude is null then -1.0::double else longitude end as longitude
from keyed left join answers on keyed.key = answers.key""",
)
def geocode_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = _requests(spark, sf_dir)
    shops = requests.select(
        "id", F.col("id").cast("double").alias("latitude"), F.lit(-1.0).alias("longitude")
    )
    return g.enrich(shops, g.geocode(requests, _answers(requests)), "id")


@query(
    "geocode_bronze",
    f"""
with {_REQUESTS}
select id as original_id, latitude, longitude, 'geocoder' as source, '{BATCH}' as batch_id
from keyed join answers on keyed.key = answers.key where latitude is not null""",
)
def geocode_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = _requests(spark, sf_dir)
    found = g.found_only(
        g.geocode(requests, _answers(requests)), source="geocoder", batch_id=BATCH
    )
    return found.select(
        "result.original_id", "result.latitude", "result.longitude",
        "_metadata.source", "_metadata.batch_id",
    )


@query(
    "geocode_stats",
    f"""
with {_REQUESTS}, keys as (select key, count(*) as n from keyed group by key)
select count(*) filter (a.key is not null) as requests_made,
       cast(sum(n - 1) filter (a.key is not null) as bigint) as cache_hits,
       count(*) filter (latitude is not null) as successful,
       count(*) filter (a.key is not null and latitude is null) as not_found,
       cast(coalesce(sum(n) filter (a.key is null), 0) as bigint) as errors
from keys left join answers a on keys.key = a.key""",
)
def geocode_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = _requests(spark, sf_dir)
    return g.geocode_stats(requests, _answers(requests))


_LAT = "cast({k} * 7919 % 1700023 as double) / 10000 - 85"
_LON = "cast({k} * 104729 % 3599969 as double) / 10000 - 180"


def _spread(df: DataFrame, key: str, name: str) -> DataFrame:
    """Irregular coordinates over the whole globe."""
    return df.select(
        F.col(key).alias(name),
        F.expr(_LAT.format(k=key)).alias("latitude"),
        F.expr(_LON.format(k=key)).alias("longitude"),
    )


@query(
    "reverse_geocode",
    f"""
with points as (select c_custkey as point_id, {_LAT.format(k='(c_custkey + 11)')} as lat,
                       {_LON.format(k='(c_custkey + 11)')} as lon from customer),
places as (select p_partkey as address_id, {_LAT.format(k='p_partkey')} as plat,
                  {_LON.format(k='p_partkey')} as plon, p_name as label from part),
pairs as (
  select point_id, address_id, label,
         pow(sin(radians(plat - lat) / 2), 2)
         + cos(radians(lat)) * cos(radians(plat)) * pow(sin(radians(plon - lon) / 2), 2) as h
  from points, places)
select point_id, arg_min(address_id, h) as address_id, arg_min(label, h) as label,
       round(2 * 6371.0088 * asin(sqrt(min(h))), 3) as distance_km
from pairs group by point_id""",
)
def reverse_geocode(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = b.table(spark, sf_dir, "customer").withColumn("k", F.col("c_custkey") + 11)
    points = _spread(customer, "k", "kk").select(
        (F.col("kk") - 11).alias("point_id"), "latitude", "longitude"
    )
    part = b.table(spark, sf_dir, "part")
    gazetteer = _spread(part, "p_partkey", "address_id").join(
        part.select(F.col("p_partkey").alias("address_id"), F.col("p_name").alias("label")),
        "address_id",
    )
    out = g.reverse_geocode(points, gazetteer)
    return out.withColumn("distance_km", F.round("distance_km", 3))
