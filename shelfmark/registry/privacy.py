"""Pseudonyms, bands, retention and erasure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import bindings as b
from shelfmark.functions import privacy as px
from shelfmark.operators import cleaning, validation
from shelfmark.operators import privacy as p
from shelfmark.registry.base import query, sql_strip, with_star
from shelfmark.registry.cleaning import BATCH, PARTNERS_SQL
from shelfmark.registry.validation import CHECKED_SQL

SALT = "pepper-for-tests"
NOW = "2024-02-15 00:00:00"

_PARTS = [
    f"nullif({sql_strip(c)}, '')" for c in ("contact_nom", "contact_email", "contact_telephone")
]
_JOINED = f"nullif(concat_ws('|', {', '.join(_PARTS)}), '')"
_HASH = f"case when {_JOINED} is not null then sha256('{SALT}:' || {_JOINED}) end"
_BAND = """
case when ca is null then 'Non renseigné' when ca < 100000 then '< 100k€'
     when ca < 250000 then '100k€ - 250k€' when ca < 500000 then '250k€ - 500k€'
     when ca < 1000000 then '500k€ - 1M€' else '> 1M€' end
"""


@query(
    "pseudonymise",
    f"""
with {PARTNERS_SQL}
select row_number,
       case when coalesce(contact_email, '') <> ''
            then sha256('{SALT}:' || {sql_strip('contact_email')}) end as email_hash,
       case when coalesce(contact_nom, '') <> ''
            then sha256('{SALT}:' || {sql_strip('contact_nom')}) end as name_hash
from partners""",
)
def pseudonymise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.partners(spark, sf_dir).select(
        "row_number",
        px.pseudonym(F.col("contact_email"), SALT).alias("email_hash"),
        px.pseudonym(F.col("contact_nom"), SALT).alias("name_hash"),
    )


@query(
    "contact_hash",
    f"with {PARTNERS_SQL} select row_number, {_HASH} as contact_hash from partners",
)
def contact_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.partners(spark, sf_dir).select(
        "row_number", p.contact_hash(SALT).alias("contact_hash")
    )


_CLEAN_SHOPS = f"""
select row_number, {sql_strip('nom_librairie')} as nom, {sql_strip('adresse')} as adresse,
       {sql_strip('code_postal')} as code_postal,
       'Nation-' || split_part(ville, '-', 2) as ville, specialite, date_partenariat,
       {_BAND} as ca_annuel_range, {_HASH} as contact_hash
from (select *, cast(ca_annuel as double) as ca from checked) where len(errors) = 0
"""


def _imported(spark: SparkSession, sf_dir: str) -> p.Import:
    valid = validation.validate_partners(b.partners(spark, sf_dir), batch_id=BATCH).good
    return p.import_partners(valid, source="partners", batch_id=BATCH, salt=SALT)


@query("clean_shops", f"with {CHECKED_SQL} {_CLEAN_SHOPS}")
def clean_shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _imported(spark, sf_dir).silver.withColumn(
        "row_number", F.col("_metadata.row_number")
    )
    out = cleaning.clean_shops(silver, source="partners", batch_id=BATCH, keep=("row_number",))
    return out.drop("_metadata", "latitude", "longitude")


@query(
    "personal_markers",
    f"""
with {CHECKED_SQL}
select row_number, 'true' as contains_personal_data, 'true' as anonymized
from checked where len(errors) = 0""",
)
def personal_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, bronze = _imported(spark, sf_dir)
    marked = bronze.select(
        F.col("_metadata.row_number").alias("row_number"),
        F.col("_metadata.contains_personal_data").alias("contains_personal_data"),
    )
    flagged = silver.select(
        F.col("_metadata.row_number").alias("row_number"),
        F.col("_metadata.anonymized").alias("anonymized"),
    )
    return marked.join(flagged, "row_number")


@query(
    "initials_md5",
    f"""
with {PARTNERS_SQL}
select row_number,
       list_reduce(list_transform(
           list_filter(regexp_split_to_array({sql_strip("coalesce(contact_nom, 'Unknown')")}, '\\s+'),
                       lambda w: w <> ''), lambda w: left(w, 1)), lambda a, c: a || c) as contact_initiales,
       md5(contact_email) as contact_email,
       md5(coalesce(contact_telephone, '0000000000')) as contact_telephone
from partners""",
)
def initials_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = cleaning.fill_defaults(b.partners(spark, sf_dir))
    return p.normalised_privacy(filled).select(
        "row_number", "contact_initiales", "contact_email", "contact_telephone"
    )


@query(
    "revenue_bands",
    with_star(
        f"""
select ca_annuel_range, count(*) as n from (
  select {_BAND} as ca_annuel_range
  from (select case when c_custkey % 53 <> 0 then cast(c_acctbal as decimal(10,2)) * 150 end as ca
        from customer)) group by all"""
    ),
)
def revenue_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = b.partners(spark, sf_dir).select(
        px.revenue_band(F.col("ca_annuel").cast("double")).alias("ca_annuel_range")
    )
    return bands.groupBy("ca_annuel_range").agg(F.count("*").alias("n"))


@query(
    "split_revenue",
    with_star(
        "select librairie_id as id_librairie, cast(ca_annuel as double) as ca_annuel from dim_librairies"
    ),
)
def split_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    shops = b.dim_shops(*[b.table(spark, sf_dir, n) for n in ("supplier", "nation", "region")])
    return p.split_revenue(shops.withColumnRenamed("librairie_id", "id_librairie")).revenue


@query(
    "minimise",
    f"with {PARTNERS_SQL} select row_number, nom_librairie, ville from partners",
)
def minimise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.minimise(b.partners(spark, sf_dir), ("row_number", "nom_librairie", "ville"))


@query(
    "retention_purge",
    f"""
select event_id, user_id from events
where not ts < timestamp '{NOW}' - interval 30 day""",
)
def retention_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = b.table(spark, sf_dir, "events")
    kept = p.purge_expired(events, F.lit(NOW).cast("timestamp"), column="ts")
    return kept.select("event_id", "user_id")


@query(
    "retention_purge_count",
    f"select count(*) as purged from events where ts < timestamp '{NOW}' - interval 30 day",
)
def retention_purge_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = b.table(spark, sf_dir, "events")
    return p.expired_count(events, F.lit(NOW).cast("timestamp"), column="ts")


_REQUESTS = """
requests as (
  select 'email' as identifier_type, 'contact' || s_suppkey || '@mail.example.org' as identifier
  from supplier
  union all
  select 'telephone', '1' || lpad(cast((s_suppkey + 500) % 100000000 as varchar), 8, '0') from supplier
  union all
  select 'nom', 'Ana building  B' || (s_suppkey + 700) from supplier)
"""


def _erasure(spark: SparkSession, sf_dir: str) -> p.Erasure:
    """Every supplier number asks for the removal of up to three partner contacts."""
    silver, bronze = _imported(spark, sf_dir)
    key = F.col("s_suppkey")
    asked = {
        "email": F.concat(F.lit("contact"), key, F.lit("@mail.example.org")),
        "telephone": F.concat(F.lit("1"), F.lpad(((key + 500) % 100000000).cast("string"), 8, "0")),
        "nom": F.concat(F.lit("Ana building  B"), key + 700),
    }
    kinds = F.array(
        *[F.struct(F.lit(kind).alias("t"), value.alias("i")) for kind, value in asked.items()]
    )
    requests = (
        b.table(spark, sf_dir, "supplier")
        .select(F.explode(kinds).alias("r"))
        .select(F.col("r.t").alias("identifier_type"), F.col("r.i").alias("identifier"))
    )
    gold = silver.select(F.col("_metadata.row_number").alias("row_number"), "contact_hash")
    flat_silver = silver.withColumn("row_number", F.col("_metadata.row_number"))
    return p.erase(bronze, flat_silver, gold, requests, salt=SALT)


_ERASED = f"""
with {CHECKED_SQL}, {_REQUESTS},
stored as (select *, {_HASH} as contact_hash from checked where len(errors) = 0),
hit as (
  select * from stored
  where {sql_strip('contact_email')} in (select identifier from requests where identifier_type = 'email')
     or {sql_strip('contact_telephone')} in (select identifier from requests where identifier_type = 'telephone')
     or {sql_strip('contact_nom')} in (select identifier from requests where identifier_type = 'nom'))
"""


@query(
    "erase_requests",
    _ERASED
    + """
select row_number, contact_hash from stored
where contact_hash is null or contact_hash not in (select contact_hash from hit)""",
)
def erase_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _erasure(spark, sf_dir).silver.select("row_number", "contact_hash")


@query(
    "erase_counts",
    _ERASED
    + """
select (select count(*) from hit) as bronze_deleted,
       (select count(*) from stored where contact_hash in (select contact_hash from hit)) as silver_deleted,
       (select count(*) from stored where contact_hash in (select contact_hash from hit)) as gold_deleted""",
)
def erase_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _erasure(spark, sf_dir).counts


@query(
    "erasure_log",
    _ERASED
    + f"""
, named as (
  select 'email' as kind, {sql_strip('contact_email')} as value from stored
  union select 'telephone', {sql_strip('contact_telephone')} from stored
  union select 'nom', {sql_strip('contact_nom')} from stored)
select 'RGPD_DELETION' as action, identifier_type,
       left(sha256('{SALT}:' || identifier), 16) || '...' as identifier_hash,
       if(kind is null, 'not_found', 'completed') as status
from requests left join named on kind = identifier_type and value = identifier""",
)
def erasure_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _erasure(spark, sf_dir).log.drop("timestamp")


@query(
    "identity_map",
    f"""
with {CHECKED_SQL}, stored as (select *, {_HASH} as contact_hash from checked where len(errors) = 0),
entries as (
  select 'email' as identifier_type, {_PARTS[1]} as identifier, contact_hash from stored
  union all select 'nom', {_PARTS[0]}, contact_hash from stored
  union all select 'telephone', {_PARTS[2]}, contact_hash from stored)
select distinct identifier_type, sha256('{SALT}:' || identifier) as identifier_hash, contact_hash
from entries where identifier is not null""",
)
def identity_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.identity_map(_imported(spark, sf_dir).bronze, SALT)
