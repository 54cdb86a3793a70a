"""Time-stamped exports, backups and image tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

EXPORT_STAMP = "%Y%m%dT%H%M%S"
BACKUP_STAMP = "%Y%m%d_%H%M%S"


def _now() -> datetime:
    return datetime.now(timezone.utc)


def export_json(df: DataFrame, folder: str, prefix: str, now: datetime | None = None) -> str:
    """One JSON object per line under ``{prefix}_{time}``; empty fields are written."""
    path = f"{folder.rstrip('/')}/{prefix}_{(now or _now()).strftime(EXPORT_STAMP)}"
    df.write.mode("errorifexists").option("ignoreNullFields", False).json(path)
    return path


def export_csv(df: DataFrame, folder: str, prefix: str, now: datetime | None = None) -> str:
    path = f"{folder.rstrip('/')}/{prefix}_{(now or _now()).strftime(EXPORT_STAMP)}"
    df.write.mode("errorifexists").option("header", True).csv(path)
    return path


def backup(df: DataFrame, folder: str, prefix: str = "backup", now: datetime | None = None) -> str:
    path = f"{folder.rstrip('/')}/{prefix}_{(now or _now()).strftime(BACKUP_STAMP)}"
    df.write.mode("errorifexists").parquet(path)
    return path


def drop_fields(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """An export re-read without erased columns or nested fields (``a.b``)."""
    for name in fields:
        if "." in name:
            outer, leaf = name.split(".", 1)
            df = df.withColumn(outer, F.col(outer).dropFields(leaf))
        else:
            df = df.drop(name)
    return df


def image_name(title: Column) -> Column:
    """Spaces and slashes become underscores, lower case, ``.jpeg``."""
    return F.concat(F.lower(F.translate(title, " /", "__")), F.lit(".jpeg"))


def image_table(books: DataFrame, title: str = "title", image: str = "image") -> DataFrame:
    """(name, content) rows of the books that carry an image."""
    return books.filter(F.col(image).isNotNull()).select(
        image_name(F.col(title)).alias("name"), F.col(image).alias("content")
    )


def write_image_files(images: DataFrame, folder: str) -> str:
    """Write each image as a file in a folder that every executor mounts."""

    def save(rows: Iterator[Row]) -> None:
        target = Path(folder)
        target.mkdir(parents=True, exist_ok=True)
        for row in rows:
            (target / row["name"]).write_bytes(bytes(row["content"]))

    images.select("name", "content").foreachPartition(save)
    return folder
