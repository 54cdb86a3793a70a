"""From raw documents to packed training sequences, in five stages.

Each stage takes the rows that its predecessor kept, with the columns of
``documents``, and is written as Parquet and read again before the next. Texts
that a stage changes get a new ``n_chars``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import near_dedup, packing, quality_rules, secret_scan, substring_dedup
from shelfmark.llm.common import stored, table
from shelfmark.session import configure

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# packing has no SQL; the stages are tested against plain Python instead
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines are cut out; documents that the quality rules reject go."""
    clean = quality_rules.cleaned(docs.select(COLUMNS))
    return clean.withColumn("n_chars", F.when(F.col("n_cut") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near texts the document with the smallest id stays; rows without an id stay."""
    classes = near_dedup.near_classes(docs.select("doc_id", "text"))
    return docs.join(classes.where("doc_id <> class_id").select("doc_id"), "doc_id", "left_anti").select(COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out; a document with nothing left goes, one without any keeps its text as it is."""
    cut = substring_dedup.cut_repeats(docs.select(COLUMNS))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    left = cut.where((F.col("n_words") == 0) | (F.col("n_removed") < F.col("n_words"))).withColumn("text", text)
    return left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("n_secrets") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    import public_tokenizers

    return packing.digest(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("substring_dedup", substrings),
    ("secret_scan", secrets),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
