"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import checkpoint_dir, configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# fixed values: the characters that separate words, as a class of a regular expression
SPACES = r"[ \t\n\x0B\f\r]"

# children of a node in running_totals and following_id
_FAN_BITS = 9


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with comparison SQL if there is any."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name inside the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, codec: str = "snappy", folder: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    folder = folder or shared_folder(spark, label)
    df.write.option("compression", codec).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def text_bytes(df: DataFrame, text_col: str) -> int:
    """Bytes of all texts, from one pass that moves a row per task."""
    return int(df.agg(F.sum(F.octet_length(text_col).cast("bigint"))).first()[0] or 0)


def words(text):
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text column; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES + "+"), "")


def _levels(df: DataFrame, key: str) -> tuple[int, int]:
    """The smallest key, and the levels of a tree over the keys counted from it."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    if low is None:
        return 0, 1
    return low, max(1, -(-(high - low).bit_length() // _FAN_BITS))


def running_totals(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``key`` and the total of ``value`` over all smaller keys, as ``name``.

    ``key`` is a unique bigint; keys may span 2**62 at most. Sums climb a tree with 512 keys to a node, so a
    window never holds more than 512 rows whatever the table's size. An empty
    table gives an empty one.
    """
    from pyspark.sql import Window

    rows = df.select(F.col(key).cast("bigint").alias("_k"), F.col(value).cast("bigint").alias("_v"))
    low, levels = _levels(rows, "_k")
    rows = rows.withColumn("_k", F.col("_k") - F.lit(low).cast("bigint"))
    node = F.shiftright("_k", _FAN_BITS)
    before = Window.partitionBy("_n").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    up, layers = rows, []
    for _ in range(levels):
        layers.append(up.withColumn("_n", node).withColumn("_b", F.coalesce(F.sum("_v").over(before), F.lit(0))))
        up = up.groupBy(node.alias("_k")).agg(F.sum("_v").alias("_v"))
    totals = layers.pop().select("_k", "_b")
    for layer in reversed(layers):
        above = totals.select(F.col("_k").alias("_n"), F.col("_b").alias("_a"))
        totals = layer.join(above, "_n").select("_k", (F.col("_b") + F.col("_a")).alias("_b"))
    return totals.select((F.col("_k") + F.lit(low).cast("bigint")).alias(key), F.col("_b").alias(name))


def next_values(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``key`` and the ``value`` at the next larger key, as ``name`` (null after the last).

    ``key`` is a unique bigint; keys may span 2**62 at most. Works along the
    same tree as :func:`running_totals`: no window holds more than 512 rows.
    """
    from pyspark.sql import Window

    rows = df.select(F.col(key).cast("bigint").alias("_k"), F.col(value).alias("_v"))
    low, levels = _levels(rows, "_k")
    rows = rows.withColumn("_k", F.col("_k") - F.lit(low).cast("bigint"))
    node = F.shiftright("_k", _FAN_BITS)
    order = Window.partitionBy("_n").orderBy("_k")
    up, layers = rows, []
    for _ in range(levels):
        layers.append(up.withColumn("_n", node).withColumn("_b", F.lead(F.struct("_v")).over(order)))
        up = up.groupBy(node.alias("_k")).agg(F.min_by("_v", "_k").alias("_v"))
    found = layers.pop().select("_k", "_b")
    for layer in reversed(layers):
        above = found.select(F.col("_k").alias("_n"), F.col("_b").alias("_a"))
        found = layer.join(above, "_n").select("_k", F.coalesce("_b", "_a").alias("_b"))
    return found.select((F.col("_k") + F.lit(low).cast("bigint")).alias(key), F.col("_b._v").alias(name))


# rows of at most a few numbers that may be shipped whole to every executor
BROADCAST_ROWS = 200_000


def small_side(df: DataFrame, label: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a few numbers a row), written once and counted: marked for broadcast up to ``most`` rows, else joined by a shuffle."""
    rows = stored(df, label)
    return F.broadcast(rows) if rows.count() <= most else rows
