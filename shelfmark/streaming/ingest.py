"""Newly landed Bronze batches, loaded once each with the batch functions.

The file source with ``availableNow`` takes every file that is not in the
checkpoint yet and stops; each micro-batch goes through the same conflict-ignoring
load as a full run, so a repeated micro-batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shelfmark import schemas
from shelfmark.operators import cleaning
from shelfmark.plans.pipeline import Run, Settings, load_quotes


def landed(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """Stream of files under ``path``; the schema is declared, never inferred."""
    return spark.readStream.schema(schema).format(fmt).load(path)


def ingest(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Process everything that has landed, then stop."""
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_quotes(
    spark: SparkSession, settings: Settings, landing: str, checkpoint: str, fmt: str = "parquet"
) -> StreamingQuery:
    """Raw quotations -> Gold. The batch id follows the micro-batch number."""

    def handle(raw: DataFrame, number: int) -> None:
        batch_id = f"stream_{number:08d}"
        # runs may be cut at any point: the load below only inserts what is missing
        quotes = cleaning.clean_quotes(raw, batch_id=batch_id)
        load_quotes(Run(spark, settings, batch_id), quotes.drop("position"))

    schema = schemas.RAW_QUOTES + ", position bigint"
    return ingest(landed(spark, landing, schema, fmt), handle, checkpoint)
