"""Bronze / Silver / Gold folders: scan, append, rewrite, stamp."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"


def layer_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def new_batch_id(prefix: str = "batch", now: datetime | None = None) -> str:
    """Prefix, UTC time and eight random hex digits; made once, passed everywhere."""
    now = now or datetime.now(timezone.utc)
    return f"{prefix}_{now:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


def metadata(
    source: str | Column,
    batch_id: str,
    *,
    at: str = "transformed_at",
    when: Column | None = None,
    transformations: Iterable[str] | None = None,
    **flags: object,
) -> Column:
    """The ``_metadata`` struct: source, time, batch, optional steps and flags."""
    fields = [
        (source if isinstance(source, Column) else F.lit(source)).alias("source"),
        (when if when is not None else F.current_timestamp()).alias(at),
        F.lit(batch_id).alias("batch_id"),
    ]
    if transformations is not None:
        fields.append(F.array(*[F.lit(t) for t in transformations]).alias("transformations"))
    for name, value in flags.items():
        fields.append((value if isinstance(value, Column) else F.lit(value)).alias(name))
    return F.struct(*fields)


def with_metadata(df: DataFrame, source: str | Column, batch_id: str, **kw: object) -> DataFrame:
    return df.withColumn("_metadata", metadata(source, batch_id, **kw))


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = _fs(spark, path)
    return fs.exists(jvm_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    fs, gone = _fs(spark, path)
    fs.delete(gone, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders (or files) directly under ``path``; driver-side listing."""
    fs, jvm_path = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(jvm_path)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def read_layer(
    spark: SparkSession, root: str, layer: str, name: str, schema: str, batch_id: str | None = None
) -> DataFrame:
    """All batches of a stored collection, or one; an absent collection is empty.

    ``batch_id`` is the partition column, so one batch reads only its folder.
    """
    path = layer_path(root, layer, name)
    full = f"{schema}, batch_id string"
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    df = spark.read.schema(full).parquet(path)
    return df if batch_id is None else df.filter(F.col("batch_id") == batch_id)


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents, one per line; a line that does not fit lands in ``_corrupt_record``."""
    return (
        spark.read.schema(f"{schema}, _corrupt_record string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )


def append_layer(
    df: DataFrame, root: str, layer: str, name: str, batch_id: str, replace_batch: bool = False
) -> str:
    """Write one batch. Appends by default; ``replace_batch`` makes a re-run idempotent."""
    path = layer_path(root, layer, name)
    if replace_batch:
        _replace_partition(df, path, "batch_id", batch_id)
    else:
        df.withColumn("batch_id", F.lit(batch_id)).write.partitionBy("batch_id").mode("append").parquet(path)
    return path


def _replace_partition(df: DataFrame, path: str, partition: str, value: str) -> None:
    """Put the rows of ``df`` in place of one partition; without rows the partition goes.

    A dynamic overwrite leaves a partition alone for which no row arrives, so
    the written rows are counted on the way and the folder is removed for none.
    """
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("n")).withColumn(partition, F.lit(value))
    rows.write.partitionBy(partition).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    if not seen.get["n"]:
        fs, gone = _fs(df.sparkSession, f"{path}/{partition}={value}")
        fs.delete(gone, True)


def rewrite_batches(
    kept: DataFrame, path: str, touched: Iterable[str], partition: str = "batch_id"
) -> None:
    """Replace only the ``touched`` batches of a stored table by their kept rows.

    ``kept`` may read ``path`` itself: the rows are first written beside it, so a
    failure half-way never loses data. Batches left without rows are removed.
    """
    spark = kept.sparkSession
    touched = sorted(set(touched))
    if not touched:
        return
    staging = f"{path.rstrip('/')}_staging_{uuid.uuid4().hex[:8]}"
    kept.filter(F.col(partition).isin(touched)).write.partitionBy(partition).parquet(staging)
    survivors = {n.removeprefix(f"{partition}=") for n in child_folders(spark, staging)}
    if survivors:
        staged = spark.read.schema(kept.schema).parquet(staging)
        staged.write.partitionBy(partition).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).parquet(path)
    for batch in touched:
        if batch not in survivors:
            fs, gone = _fs(spark, f"{path}/{partition}={batch}")
            fs.delete(gone, True)
    fs, stage_path = _fs(spark, staging)
    fs.delete(stage_path, True)


def write_gold(df: DataFrame, root: str, table: str, batch_id: str, append: bool = False) -> str:
    """Store the rows one batch adds to a Gold table, in a folder of their own.

    A repeated batch replaces its own rows, so a load cut half-way can simply
    run again. ``append`` keeps them (dimensions, which only gain members).
    """
    path = layer_path(root, GOLD, table)
    if append:
        df.withColumn("load_batch", F.lit(batch_id)).write.partitionBy("load_batch").mode("append").parquet(path)
    else:
        _replace_partition(df, path, "load_batch", batch_id)
    return path


def read_gold(
    spark: SparkSession,
    root: str,
    table: str,
    schema: str,
    *,
    without_batch: str | None = None,
    only_batch: str | None = None,
) -> DataFrame:
    """A Gold table, without what one batch has loaded before or with nothing else."""
    path = layer_path(root, GOLD, table)
    full = f"{schema}, load_batch string"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(full).parquet(path)
    if without_batch is not None:
        df = df.filter(F.col("load_batch") != without_batch)
    if only_batch is not None:
        df = df.filter(F.col("load_batch") == only_batch)
    return df.drop("load_batch")


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    """Optional relational sink for an address the user supplies."""
    df.write.mode(mode).options(**options).jdbc(url, table)


def register_views(tables: Mapping[str, DataFrame]) -> list[str]:
    """Name the given frames as temporary views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)
