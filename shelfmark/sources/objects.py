"""Folders of objects: list, read, measure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import literal_rows

# fixed values: default folder names under a storage root
IMAGES, EXPORTS, BACKUPS = "images", "exports", "backups"


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)


def read_objects(spark: SparkSession, root: str, bucket: str, name: str = "") -> DataFrame:
    """(path, modificationTime, length, content) of one object or of a whole folder."""
    return _files(spark, f"{root.rstrip('/')}/{bucket}/{name}")


def list_objects(spark: SparkSession, root: str, bucket: str, prefix: str = "") -> DataFrame:
    """(bucket, name, size, modified), recursive. The content column is pruned, bytes stay unread."""
    listed = _files(spark, f"{root.rstrip('/')}/{bucket}").select(
        F.lit(bucket).alias("bucket"),
        F.regexp_extract("path", rf"/{bucket}/(.+)$", 1).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )
    return listed.filter(F.col("name").startswith(prefix)) if prefix else listed


def list_images(spark: SparkSession, root: str) -> DataFrame:
    return list_objects(spark, root, IMAGES)


def list_exports(spark: SparkSession, root: str) -> DataFrame:
    return list_objects(spark, root, EXPORTS)


def list_backups(spark: SparkSession, root: str) -> DataFrame:
    return list_objects(spark, root, BACKUPS)


def storage_stats(
    spark: SparkSession, root: str, buckets: tuple[str, ...] = (EXPORTS, BACKUPS)
) -> DataFrame:
    """Object count and bytes per bucket; an empty bucket counts zero."""
    listed = reduce(
        DataFrame.unionByName, [list_objects(spark, root, bucket) for bucket in buckets]
    )
    names = literal_rows(spark, [(b,) for b in buckets], "bucket string")
    counted = listed.groupBy("bucket").agg(
        F.count("*").alias("n_objects"), F.sum("size").alias("n_bytes")
    )
    return names.join(counted, "bucket", "left").fillna(0, ["n_objects", "n_bytes"])
