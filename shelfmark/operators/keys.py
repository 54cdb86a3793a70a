"""Surrogate keys without a window over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.session import pinned

# monotonically_increasing_id puts the partition above this many row bits
_ROW_BITS = 33


def number_rows(
    df: DataFrame,
    name: str,
    start: int | Column = 1,
    order: list | None = None,
    pin: Callable[[DataFrame], DataFrame] = pinned,
) -> DataFrame:
    """Add a gap-free sequence ``start, start+1, ...`` as ``name``.

    Rows are range-partitioned and sorted by ``order`` when it is given, else
    taken in scan order with no shuffle. The position inside a partition comes
    from the row id; partition offsets come from a count per partition (one row
    per task, so the offset table is bounded by the number of tasks and is
    broadcast). The rows are pinned first: numbers never change on a retry.
    ``pin`` stores them elsewhere than in the checkpoint folder.
    """
    spark = df.sparkSession
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = pin(df.withColumn("_row", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_row"), _ROW_BITS)
    counts = rows.groupBy(part.alias("_part")).count().collect()
    offsets, total = [], 0
    for r in sorted(counts, key=lambda r: r["_part"]):
        offsets.append((r["_part"], total))
        total += r["count"]
    table = spark.createDataFrame(offsets, "_part bigint, _offset bigint")
    first = start if isinstance(start, Column) else F.lit(start)
    local = F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        rows.withColumn("_part", part)
        .join(F.broadcast(table), "_part")
        .withColumn(name, (first + F.col("_offset") + local).cast("bigint"))
        .drop("_row", "_part", "_offset")
    )


def next_id(existing: DataFrame, id_col: str) -> int:
    """One past the largest stored key; 1 for an empty table."""
    top = existing.agg(F.max(id_col)).first()[0]
    return 1 if top is None else int(top) + 1
