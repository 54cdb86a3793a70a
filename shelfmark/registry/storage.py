"""Stored layers, exports, object folders, incremental ingest and the whole run.

These write below the session's checkpoint folder, which every executor reaches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import bindings as b
from shelfmark.plans import analytics, pipeline
from shelfmark.registry.base import query, sql_mean
from shelfmark.registry.cleaning import _QUOTES, BATCH
from shelfmark.registry.extraction import QUOTES_SITE, SITE, book_pages, quote_pages
from shelfmark.registry.privacy import _CLEAN_SHOPS, SALT
from shelfmark.registry.validation import CHECKED_SQL
from shelfmark.session import checkpoint_dir
from shelfmark.sources import exports, layers, objects, partner
from shelfmark.streaming import ingest


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/run-{uuid.uuid4().hex[:12]}"


@query(
    "layer_roundtrip",
    """
select p_partkey, p_name, case when p_size > 25 then 'late' else 'early' end as batch_id from part""",
)
def layer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches appended; the second is written twice in replacing mode."""
    root = _folder(spark)
    part = b.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    early = part.filter("not p_size > 25").drop("p_size")
    late = part.filter("p_size > 25").drop("p_size")
    layers.append_layer(early, root, layers.BRONZE, "parts", "early")
    for _ in range(2):
        layers.append_layer(late, root, layers.BRONZE, "parts", "late", replace_batch=True)
    return layers.read_layer(spark, root, layers.BRONZE, "parts", "p_partkey bigint, p_name string")


@query(
    "export_roundtrip",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders",
)
def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = b.table(spark, sf_dir, "orders").drop("o_orderdate")
    path = exports.export_json(orders, _folder(spark), "orders")
    return spark.read.schema(orders.schema).json(path)


@query("export_csv_roundtrip", "select c_custkey, c_name, c_acctbal from customer")
def export_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = b.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = exports.export_csv(customer, _folder(spark), "customer")
    return spark.read.schema(customer.schema).option("header", True).csv(path)


@query(
    "export_erased_fields",
    "select p_partkey, p_brand from part",
)
def export_erased_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export re-read without an erased column and an erased nested field."""
    part = b.table(spark, sf_dir, "part").select(
        "p_partkey", F.struct("p_name", "p_brand").alias("about"), "p_type"
    )
    path = exports.export_json(part, _folder(spark), "part")
    erased = exports.drop_fields(spark.read.schema(part.schema).json(path), ["p_type", "about.p_name"])
    return erased.select("p_partkey", "about.*")


@query("backup_roundtrip", "select n_nationkey, n_name, n_regionkey from nation")
def backup_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = b.table(spark, sf_dir, "nation")
    return spark.read.schema(nation.schema).parquet(exports.backup(nation, _folder(spark)))


@query(
    "partner_roundtrip",
    "select n_nationkey::varchar as n_nationkey, n_name, 'nations' as sheet from nation "
    "union all select lpad(r_regionkey::varchar, 5, '0'), r_name, 'regions' from region",
)
def partner_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sheets; leading zeros survive because nothing is inferred."""
    root = _folder(spark)
    nation = b.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    region = b.table(spark, sf_dir, "region").select(
        F.lpad(F.col("r_regionkey").cast("string"), 5, "0").alias("n_nationkey"),
        F.col("r_name").alias("n_name"),
    )
    nation.write.option("header", True).csv(f"{root}/nations")
    region.write.option("header", True).csv(f"{root}/regions")
    sheets = partner.read_partner(spark, root)
    frames = [df.withColumn("sheet", F.lit(name)) for name, df in sheets.items()]
    return frames[0].unionByName(frames[1])


@query(
    "image_table",
    """
select lower(replace(replace(p_name || '/' || p_partkey, ' ', '_'), '/', '_')) || '.jpeg' as name,
       p_name as content from part""",
)
def image_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = b.table(spark, sf_dir, "part").select(
        F.concat("p_name", F.lit("/"), "p_partkey").alias("title"),
        F.col("p_name").cast("binary").alias("image"),
    )
    return exports.image_table(books).select("name", F.col("content").cast("string").alias("content"))


def _objects(spark: SparkSession, sf_dir: str) -> str:
    root = _folder(spark)
    tables = [b.table(spark, sf_dir, n) for n in ("nation", "region", "supplier")]
    for table in tables:
        exports.export_json(table.coalesce(1), f"{root}/exports", table.columns[0])
    exports.backup(tables[0].coalesce(1), f"{root}/backups")
    return root


@query(
    "object_listing",
    "select 'exports' as bucket, unnest(['n_nationkey', 'r_regionkey', 's_suppkey']) as prefix, 1 as n",
)
def object_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = objects.list_exports(spark, _objects(spark, sf_dir))
    data = listed.filter(F.col("name").contains("part-") & (F.col("size") > 0))
    prefix = F.regexp_extract("name", "^([a-z]+_[a-z]+)_", 1)
    return data.groupBy("bucket", prefix.alias("prefix")).agg(F.count("*").alias("n"))


@query("storage_stats")
def storage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects.storage_stats(spark, _objects(spark, sf_dir))


# ---------------------------------------------------------------- full runs


def _settings(root: str) -> pipeline.Settings:
    return pipeline.Settings(root=root, salt=SALT, book_site=SITE, quote_site=QUOTES_SITE)


def _inputs(spark: SparkSession, sf_dir: str) -> pipeline.Inputs:
    documents = b.table(spark, sf_dir, "documents")
    return pipeline.Inputs(
        book_pages=book_pages(b.table(spark, sf_dir, "part")),
        quote_pages=quote_pages(documents).withColumn("page_no", F.col("page_id")),
        partners=b.partners(spark, sf_dir).drop("row_number"),
    )


_FIRST_DOCS = f"""
{_QUOTES},
first as (select * from quotes where position in (select min(position) from quotes group by text_hash))
"""


@query(
    "pipeline_summary",
    f"""
with {CHECKED_SQL}, {_FIRST_DOCS}, shops as ({_CLEAN_SHOPS})
select 'books' as entity, 'extracted' as stage, count(*) as n_rows from part
union all select 'books', 'transformed', count(*) from part
union all select 'books', 'loaded', count(*) from part where p_partkey % 6 <> 5
union all select 'quotes', 'extracted', count(*) from documents
union all select 'quotes', 'transformed', count(*) from first
union all select 'quotes', 'loaded', count(*) from first
union all select 'librairies', unnest(['extracted', 'transformed', 'loaded']), count(*) from shops""",
)
def pipeline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and partner rows through all three layers; rows per entity and stage."""
    run = pipeline.Run(spark, _settings(_folder(spark)), BATCH)
    return run.run(_inputs(spark, sf_dir)).drop("batch_id")


@query(
    "pipeline_report",
    f"""
select p_type as categorie, count(*) as nb_livres,
       {sql_mean('cast(round(cast(p_retailprice as decimal(10,2)) * cast(1.17 as decimal(3,2)), 2) as decimal(10,2))')}
         as prix_moyen,
       cast(sum(case when p_partkey % 9 = 0 then 1 else p_size end) as bigint) as stock_total
from part where p_partkey % 6 <> 5 group by p_type""",
)
def pipeline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category statistics of the star schema that a run over listing pages has loaded."""
    root = _folder(spark)
    run = pipeline.Run(spark, _settings(root), BATCH)
    run.run(pipeline.Inputs(book_pages=book_pages(b.table(spark, sf_dir, "part"))))
    stats = analytics.category_stats(pipeline.gold_tables(spark, root))
    return stats.select("categorie", "nb_livres", "prix_moyen", "stock_total")


@query(
    "incremental_ingest",
    f"""
with {_FIRST_DOCS}, pairs as (select distinct text_hash, author, unnest(tags) as tag_name from first)
select author as author_name, count(distinct text_hash) as quote_count, count(*) as n_pairs
from pairs group by author""",
)
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotations land in two drops, the second repeating the first; each is taken once."""
    root = _folder(spark)
    landing, state = f"{root}/landing", f"{root}/state"
    raw = b.raw_quotes(b.table(spark, sf_dir, "documents"))
    half = raw.filter(F.col("position") < raw.select(F.max("position") / 2).scalar())
    for drop in (half, raw):
        drop.write.mode("append").parquet(landing)
        query = ingest.ingest_quotes(spark, _settings(root), landing, state)
        query.awaitTermination()
    gold = pipeline.gold_tables(spark, root)
    pairs = gold["quote_tags"].join(gold["fact_quotes"].select("quote_id", "author_id"), "quote_id")
    counted = pairs.groupBy("author_id").agg(F.count("*").alias("n_pairs"))
    return gold["dim_authors"].join(counted, "author_id").select(
        "author_name", "quote_count", "n_pairs"
    )


