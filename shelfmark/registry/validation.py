"""Row validation, contracts, keys and references."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import bindings as b
from shelfmark.operators import validation as v
from shelfmark.operators.cleaning import clean_books
from shelfmark.registry.base import query, sql_strip, with_star
from shelfmark.registry.cleaning import BATCH, PARTNERS_SQL, RAW_BOOKS_SQL
from shelfmark.session import checkpoint_dir

_EMAIL = "^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$"

CHECKED_SQL = f"""
{PARTNERS_SQL},
checked as (
  select *, list_filter([
      case when coalesce(nom_librairie, '') = '' then 'nom_librairie manquant' end,
      case when coalesce(adresse, '') = '' then 'adresse manquante' end,
      case when not coalesce(regexp_matches({sql_strip('code_postal')}, '^[0-9]{{5}}$'), false)
           then 'code_postal invalide' end,
      case when coalesce(ville, '') = '' then 'ville manquante' end,
      case when coalesce(contact_email, '') <> ''
                and not regexp_matches({sql_strip('contact_email')}, '{_EMAIL}') then 'email invalide' end,
      case when coalesce(contact_telephone, '') <> ''
                and not regexp_matches(regexp_replace(contact_telephone, '[\\s.-]', '', 'g'),
                                       '^(0[1-9][0-9]{{8}}|[1-9][0-9]{{8}})$') then 'téléphone invalide' end
    ], lambda e: e is not null) as errors
  from partners)
"""


@query(
    "validate_contacts",
    f"with {CHECKED_SQL} select row_number, array_to_string(errors, '|') as errors from checked",
)
def validate_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.partners(spark, sf_dir).select("row_number", v.row_errors().alias("errors"))


@query(
    "partner_quarantine",
    f"""
with {CHECKED_SQL}
select 'import_shops' as stage, cast(row_number as varchar) as key,
       'Ligne ' || row_number || ': ' || unnest(errors) as reason, '{BATCH}' as batch_id
from checked""",
)
def partner_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.validate_partners(b.partners(spark, sf_dir), batch_id=BATCH).quarantine


# rows of a written partner file at most
FILE_ROWS = 100_000


@query(
    "partner_file_lines",
    f"""
with {PARTNERS_SQL}
select n_regionkey as region, c_custkey // {FILE_ROWS} as part,
       1 + row_number() over (partition by n_regionkey, c_custkey // {FILE_ROWS} order by c_custkey) as row_number,
       p.nom_librairie
from partners p join customer on c_custkey = p.row_number - 2 join nation on c_nationkey = n_nationkey""",
)
def partner_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partner rows written as delimited files, one per region and block of keys, read back and numbered file by file."""
    keys = b.table(spark, sf_dir, "customer").join(b.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = b.partners(spark, sf_dir).join(keys.select("c_custkey", "n_regionkey"), F.col("row_number") - 2 == F.col("c_custkey"))
    sheet = [c for c in rows.columns if c not in ("row_number", "c_custkey", "n_regionkey")]
    placed = rows.select(*sheet, F.col("n_regionkey").alias("region"), F.floor(F.col("c_custkey") / FILE_ROWS).alias("part"), "c_custkey")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/partner-files-{uuid.uuid4().hex}"
    # each file is written by one task in key order: its lines are the rows in that order
    ordered = placed.repartition("region", "part").sortWithinPartitions("region", "part", "c_custkey").drop("c_custkey")
    ordered.write.partitionBy("region", "part").option("header", True).csv(folder)
    files = spark.read.option("header", True).csv(folder)
    numbered = v.number_lines_per_file(files)
    return numbered.select(F.col("region").cast("bigint"), F.col("part").cast("bigint"), "row_number", "nom_librairie")


@query(
    "validation_stats",
    f"""
with {CHECKED_SQL}
select count(*) as rows_read, count(*) filter (len(errors) = 0) as rows_valid,
       count(*) filter (len(errors) > 0) as rows_invalid,
       count(*) filter (len(errors) = 0 and {sql_strip(
           "coalesce(contact_nom, '') || coalesce(contact_email, '') || coalesce(contact_telephone, '')"
       )} <> '') as personal_data_hashed,
       cast(sum(len(errors)) as bigint) as validation_errors
from checked""",
)
def validation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.import_stats(b.partners(spark, sf_dir))


@query(
    "validation_error_summary",
    f"""
with {CHECKED_SQL},
e as (select row_number as line, 'Ligne ' || row_number || ': ' || unnest(errors) as message from checked)
select * from (select line, message from e order by line, message limit 5)
union all select null, '... et ' || (count(*) - 5) || ' autres' from e having count(*) > 5""",
)
def validation_error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.error_summary(v.validate_partners(b.partners(spark, sf_dir), batch_id=BATCH).quarantine)


@query(
    "raw_contract_report",
    f"""
with {RAW_BOOKS_SQL}, violations as (
  select unnest([case when rating is null then 'rating: required' end,
                 case when availability is null then 'availability: required' end,
                 case when category is null then 'category: required' end,
                 case when availability is not null and try_cast(availability as integer) is null
                      then 'availability: not int' end]) as violation
  from raw_books)
select violation, count(*) as n_rows from violations where violation is not null group by violation""",
)
def raw_contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = (
        *v.CONTRACTS["raw_books"],
        v.Rule("rating", required=True),
        v.Rule("availability", required=True, is_type="int"),
        v.Rule("category", required=True),
    )
    return v.contract_report(b.raw_books(b.table(spark, sf_dir, "part")), rules)


@query(
    "contract_report",
    """
with v as (
  select unnest([case when p_size > 40 then 'p_size: above 40' end,
                 case when p_size < 5 then 'p_size: below 5' end,
                 case when length(p_name) > 10 then 'p_name: longer than 10' end]) as violation
  from part
  union all
  select case when abs(round(o_totalprice, 2)) >= 100000 then 'o_totalprice: overflows decimal(7,2)' end
  from orders)
select violation, count(*) as n_rows from v where violation is not null group by violation""",
)
def contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = v.contract_report(
        b.table(spark, sf_dir, "part"),
        [v.Rule("p_size", required=True, low=5, high=40), v.Rule("p_name", max_length=10)],
    )
    orders = v.contract_report(
        b.table(spark, sf_dir, "orders"), [v.Rule("o_totalprice", decimal=(7, 2))]
    )
    return parts.unionByName(orders)


@query(
    "load_contract",
    f"""
with {RAW_BOOKS_SQL}, cleaned as (
  select {sql_strip('title')} as title,
         case lower(coalesce(rating, '0')) when 'one' then 1 when 'two' then 2 when 'three' then 3
              when 'four' then 4 when 'five' then 5 when '4' then 4 else 0 end as rating
  from raw_books
  where price is null
        or try_cast({sql_strip("replace(replace(price, '£', ''), ',', '.')")} as decimal(10,2)) is not null)
select 'load_books' as stage, title as key, 'rating: below 1' as reason, '{BATCH}' as batch_id
from cleaned where rating < 1""",
)
def load_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = clean_books(b.raw_books(b.table(spark, sf_dir, "part")), batch_id=BATCH).good
    return v.enforce_contract(
        books, v.CONTRACTS["fact_books"], stage="load_books", key="title", batch_id=BATCH
    ).quarantine


@query(
    "duplicate_keys",
    with_star(
        """
select quote_hash, count(*) as n_rows from fact_quotes group by quote_hash having count(*) > 1"""
    ),
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.duplicate_keys(b.fact_quotes(b.table(spark, sf_dir, "orders")), ["quote_hash"])


@query(
    "orphans",
    """
select o_orderkey, o_custkey from orders
where o_custkey not in (select c_custkey from customer where c_mktsegment <> 'BUILDING')""",
)
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = b.table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "BUILDING")
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return v.orphans(orders, "o_custkey", customers, "c_custkey").select("o_orderkey", "o_custkey")
