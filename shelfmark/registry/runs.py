"""Two runs of the normalised variant: an earlier one stored, a second one adds to it."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import bindings as b
from shelfmark.plans import runs
from shelfmark.registry.base import query
from shelfmark.registry.cleaning import _QUOTES
from shelfmark.registry.loading import _quote_batch

# the second run's revenue: a year of growth
GROWTH = Decimal("1.10")


def _empty(spark: SparkSession, schemas: dict[str, str]) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in schemas.items()}


def _quote_runs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """French documents were loaded by an earlier run; the second run reads all of them."""
    batch = _quote_batch(spark, sf_dir).select("position", "text", "text_hash", "author", "tags")
    french = b.table(spark, sf_dir, "documents").filter("lang = 'fr'").select(F.col("doc_id").alias("position"))
    empty = _empty(spark, runs.QUOTE_TABLES)
    first = runs.tables_after(empty, runs.quotes_run(empty, batch.join(french, "position", "left_semi")))
    return runs.tables_after(first, runs.quotes_run(first, batch))


_RUNS = f"""
with {_QUOTES},
first as (select * from quotes where position in (select min(position) from quotes group by text_hash)),
b1 as (select * from first where position in (select doc_id from documents where lang = 'fr')),
a1 as (select author as author_name, row_number() over (order by min(position), author) as id_author from b1 group by author),
a2 as (select * from a1 union all
       select author, (select coalesce(max(id_author), 0) from a1) + row_number() over (order by min(position), author)
       from first where author not in (select author_name from a1) group by author),
q1 as (select text_hash, id_author, row_number() over (order by min(position), text_hash, id_author) as id_quote
       from b1 join a1 on author = author_name group by text_hash, id_author),
q2 as (select * from q1 union all
       select f.text_hash, a.id_author,
              (select coalesce(max(id_quote), 0) from q1) + row_number() over (order by min(position), f.text_hash, a.id_author)
       from first f join a2 a on f.author = a.author_name
       where not exists (select 1 from q1 where q1.text_hash = f.text_hash and q1.id_author = a.id_author)
       group by f.text_hash, a.id_author),
p1 as (select position, unnest(tags) as tag_name, generate_subscripts(tags, 1) as n from b1),
t1 as (select tag_name, row_number() over (order by min(position * 10 + n), tag_name) as id_tag from p1 group by tag_name),
p2 as (select position, text_hash, author, unnest(tags) as tag_name, generate_subscripts(tags, 1) as n from first),
t2 as (select * from t1 union all
       select tag_name, (select coalesce(max(id_tag), 0) from t1) + row_number() over (order by min(position * 10 + n), tag_name)
       from p2 where tag_name not in (select tag_name from t1) group by tag_name)
"""


@query(
    "normalised_run_quotes",
    _RUNS + "select id_quote, text_hash, q2.id_author, author_name from q2 join a2 using (id_author)",
)
def normalised_run_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _quote_runs(spark, sf_dir)
    return t["quotes"].join(t["authors"], "id_author").select("id_quote", "text_hash", "id_author", "author_name")


@query(
    "normalised_run_quote_tags",
    _RUNS
    + """
select distinct q2.id_quote, t2.id_tag, t2.tag_name
from p2 join a2 on p2.author = a2.author_name
join q2 on q2.text_hash = p2.text_hash and q2.id_author = a2.id_author
join t2 on t2.tag_name = p2.tag_name""",
)
def normalised_run_quote_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _quote_runs(spark, sf_dir)
    return t["quotes_tags"].join(t["tags"], "id_tag").select("id_quote", "id_tag", "tag_name")


def _shop_runs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Shops of the first nations were loaded earlier; the second run brings all shops with a new year's revenue."""
    shops = b.dim_shops(*[b.table(spark, sf_dir, n) for n in ("supplier", "nation", "region")])
    batch = shops.select(F.col("librairie_id").alias("row"), F.col("nom").alias("nom_librairie"), "adresse", "code_postal", "ville", "ca_annuel")
    early = b.table(spark, sf_dir, "nation").filter("n_nationkey < 10").select(F.col("n_name").alias("ville"))
    empty = _empty(spark, runs.SHOP_TABLES)
    first = runs.tables_after(empty, runs.shops_run(empty, batch.join(early, "ville", "left_semi")))
    grown = batch.withColumn("ca_annuel", F.round(F.col("ca_annuel") * F.lit(GROWTH), 2))
    return runs.tables_after(first, runs.shops_run(first, grown))


_SHOPS = f"""
with s as (
  select s_suppkey as r, s_name as nom_librairie, cast(s_suppkey % 40 + 1 as varchar) || ' rue du Port' as adresse,
         lpad(cast(s_suppkey % 95 * 1000 + 1000 as varchar), 5, '0') as code_postal, n_name as ville, n_nationkey,
         cast(s_acctbal as decimal(10,2)) * 100 as ca
  from supplier join nation on s_nationkey = n_nationkey),
l1 as (select nom_librairie, adresse, code_postal, ville, row_number() over (order by min(r), nom_librairie, adresse, code_postal, ville) as id_librairie
       from s where n_nationkey < 10 group by nom_librairie, adresse, code_postal, ville),
l2 as (select * from l1 union all
       select nom_librairie, adresse, code_postal, ville,
              (select coalesce(max(id_librairie), 0) from l1) + row_number() over (order by min(r), nom_librairie, adresse, code_postal, ville)
       from s where not exists (select 1 from l1 where l1.nom_librairie = s.nom_librairie and l1.adresse = s.adresse
                                and l1.code_postal = s.code_postal and l1.ville = s.ville)
       group by nom_librairie, adresse, code_postal, ville),
r1 as (select l1.id_librairie, cast(ca as decimal(10,2)) as ca_annuel, min(r) as r
       from s join l1 using (nom_librairie, adresse, code_postal, ville) where ca is not null group by 1, 2),
c1 as (select id_librairie, ca_annuel, row_number() over (order by r, id_librairie, ca_annuel) as id_ca_annuel from r1),
r2 as (select l2.id_librairie, cast(round(ca * {GROWTH}, 2) as decimal(10,2)) as ca_annuel, min(r) as r
       from s join l2 using (nom_librairie, adresse, code_postal, ville) where ca is not null group by 1, 2),
c2 as (select id_librairie, ca_annuel, id_ca_annuel from c1 union all
       select id_librairie, ca_annuel, (select coalesce(max(id_ca_annuel), 0) from c1) + row_number() over (order by r, id_librairie, ca_annuel)
       from r2 where not exists (select 1 from c1 where c1.id_librairie = r2.id_librairie and c1.ca_annuel = r2.ca_annuel))
"""


@query(
    "normalised_run_shops",
    _SHOPS + "select id_ca_annuel, id_librairie, nom_librairie, cast(ca_annuel as double) as ca_annuel from c2 join l2 using (id_librairie)",
)
def normalised_run_shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _shop_runs(spark, sf_dir)
    return t["ca_annuel"].join(t["librairies"], "id_librairie").select("id_ca_annuel", "id_librairie", "nom_librairie", "ca_annuel")
