"""The pair of accepted and rejected rows that splitting operators return."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUARANTINE = "stage string, key string, reason string, batch_id string"


class Split(NamedTuple):
    good: DataFrame
    quarantine: DataFrame


def quarantine_rows(
    df: DataFrame, stage: str, key: Column, reason: Column, batch_id: str
) -> DataFrame:
    return df.select(
        F.lit(stage).alias("stage"),
        key.cast("string").alias("key"),
        reason.alias("reason"),
        F.lit(batch_id).alias("batch_id"),
    )


def split_on(
    df: DataFrame, reason: Column, *, stage: str, key: Column, batch_id: str, drop: tuple = ()
) -> Split:
    """Rows whose ``reason`` is NULL are good, the others are quarantined with it."""
    marked = df.withColumn("_reason", reason)
    good = marked.filter(F.col("_reason").isNull()).drop("_reason", *drop)
    bad = marked.filter(F.col("_reason").isNotNull())
    return Split(good, quarantine_rows(bad, stage, key, F.col("_reason"), batch_id))


def failure_report(quarantine: DataFrame, shown: int = 5) -> DataFrame:
    """The first few failures by stage and key, for the end-of-run summary."""
    return quarantine.orderBy("stage", "key", "reason").limit(shown)
