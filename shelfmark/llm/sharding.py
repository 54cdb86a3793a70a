"""Random sharding by a two-pass external shuffle.

Pass one scatters the rows into buckets of a size that fits in memory, by a
seeded hash. Pass two shuffles each bucket by itself (Spark's ``shuffle`` is a
Fisher-Yates shuffle of the array) and writes it. Buckets in a row, each in its
new order, are a random permutation of all rows; a bucket's place in it is the
number of rows in the buckets before. The permutation is cut into shards of
equal counts, so the law that holds is ``rows``: counts differ by one at most.

No task holds more than its buckets; hot sources or groups of copies play no
part, as the hash is of the id and the text. Row counts come from one row per
bucket, added up along a tree.

Cases: a null text weighs one byte and has checksum 0; ids may repeat or be null (equal
rows share a bucket); an empty table gives empty shards. Other columns pass
through; ``bucket``, ``shard`` and ``slot`` replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import query, running_totals, shared_folder, table

SHARDS = 16
BUCKET_BYTES = 8 << 20
SEED = 7


def write_shards(
    df: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
    seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, folder: str | None = None,
) -> DataFrame:
    """Write ``df`` to ``folder``, one sub-folder a shard, and return what was written, with ``shard`` and ``slot``."""
    spark = df.sparkSession
    rows = df.drop("bucket", "shard", "slot")
    bytes_, n = rows.agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint") + 1), F.count("*")).first()
    buckets = max(shards, -(-(bytes_ or 0) // bucket_bytes))
    key = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    bucket = F.pmod(key, F.lit(buckets))
    counts = rows.select(bucket.alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
    before = running_totals(counts, "bucket", "n", "_before")
    scattered = rows.select(bucket.alias("bucket"), F.struct(key.alias("_key"), *[F.col(f"`{c}`") for c in rows.columns]).alias("_row"))
    held = scattered.join(before, "bucket").groupBy("bucket", "_before").agg(F.array_sort(F.collect_list("_row")).alias("_rows"))
    held = held.sortWithinPartitions("bucket").withColumn("_rows", F.shuffle("_rows", seed))
    placed = held.select("_before", F.posexplode("_rows").alias("_at", "_row"))
    place = F.col("_before") + F.col("_at")
    shard = F.expr(f"(_before + _at) * {shards}L div {max(n, 1)}L")
    placed = placed.select(*[F.col(f"_row.`{c}`").alias(c) for c in rows.columns], place.alias("_place"), shard.cast("int").alias("shard"))
    first = F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")
    placed = placed.withColumn("slot", F.col("_place") - first).drop("_place").sortWithinPartitions("shard", "slot")
    folder = folder or shared_folder(spark, "shards")
    placed.write.option("compression", "snappy").partitionBy("shard").parquet(folder)
    return spark.read.schema(placed.schema).parquet(folder)


@query("op8_sharding")
def op8_sharding(spark, sf_dir) -> DataFrame:
    written = write_shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return written.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
