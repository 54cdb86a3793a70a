"""Partner tables: one folder holds one sub-path per sheet, every column text."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.schemas import PARTNER_COLUMNS
from shelfmark.sources.layers import child_folders, path_exists

SUFFIXES = {"csv": (".csv", ".csv.gz", ".txt"), "json": (".json", ".jsonl"), "parquet": (".parquet",)}


def read_partner(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    sheets: Iterable[str] | None = None,
    **options: str,
) -> dict[str, DataFrame]:
    """``{sheet: frame}``. Text columns keep leading zeros; nothing is inferred.

    A delimited sheet takes its column names from its own header line, so extra
    columns stay visible to :func:`check_partner_columns`.
    """
    frames = {}
    for sheet in sheets or child_folders(spark, path):
        location = f"{path.rstrip('/')}/{sheet}"
        reader = spark.read.options(**options)
        if fmt == "csv":
            frame = reader.option("header", True).option("inferSchema", False).csv(location)
        elif fmt == "json":
            frame = reader.option("primitivesAsString", True).json(location)
        else:
            frame = reader.format(fmt).load(location)
        name = sheet.rsplit(".", 1)[0] if sheet.endswith(SUFFIXES.get(fmt, ())) else sheet
        frames[name] = frame.select([F.col(f"`{c}`").cast("string").alias(c) for c in frame.columns])
    return frames


@dataclass
class FileCheck:
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.errors


def check_partner_columns(df: DataFrame, expected: Iterable[str] = PARTNER_COLUMNS) -> FileCheck:
    """Missing columns and an empty table are errors, extra columns only a warning."""
    expected = list(expected)
    check = FileCheck()
    missing = [c for c in expected if c not in df.columns]
    extra = [c for c in df.columns if c not in expected]
    if missing:
        check.errors.append("Colonnes manquantes: " + ", ".join(missing))
    if extra:
        check.warnings.append("Colonnes supplémentaires ignorées: " + ", ".join(extra))
    if df.isEmpty():
        check.errors.append("Le fichier est vide")
    return check


def check_partner_path(spark: SparkSession, path: str, fmt: str = "csv") -> FileCheck:
    """The path must exist; a single file must carry a suffix of its format."""
    check = FileCheck()
    if not path_exists(spark, path):
        check.errors.append(f"Fichier non trouvé: {path}")
        return check
    leaf = path.rstrip("/").rsplit("/", 1)[-1]
    if "." in leaf and not leaf.lower().endswith(SUFFIXES.get(fmt, (f".{fmt}",))):
        check.errors.append("Extension invalide. Attendu: " + " ou ".join(SUFFIXES[fmt]))
    return check
