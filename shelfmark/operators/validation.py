"""Row validation, table contracts, keys and references."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions import privacy
from shelfmark.functions.text import WHITESPACE
from shelfmark.operators.keys import number_rows
from shelfmark.operators.splits import Split, quarantine_rows
from shelfmark.session import broadcast_if_small, pinned

# a data file counts its header as line 1
FIRST_DATA_LINE = 2


def _partner_rules(pad_postcode: bool) -> list[tuple[Column, str]]:
    postcode = F.col("code_postal")
    if pad_postcode:
        postcode = F.when(
            F.btrim(postcode, F.lit(WHITESPACE)).rlike("^[0-9]{4}$"),
            F.lpad(F.btrim(postcode, F.lit(WHITESPACE)), 5, "0"),
        ).otherwise(postcode)
    # fixed values: messages of the import log
    return [
        (privacy.present(F.col("nom_librairie")), "nom_librairie manquant"),
        (privacy.present(F.col("adresse")), "adresse manquante"),
        (privacy.valid_postcode(postcode), "code_postal invalide"),
        (privacy.present(F.col("ville")), "ville manquante"),
        (privacy.valid_email(F.col("contact_email")), "email invalide"),
        (privacy.valid_phone(F.col("contact_telephone")), "téléphone invalide"),
    ]


def row_errors(pad_postcode: bool = False) -> Column:
    """All error messages of a partner row. They carry no field values."""
    marks = [F.when(~ok, F.lit(message)) for ok, message in _partner_rules(pad_postcode)]
    return F.array_compact(F.array(*marks))


def number_lines(df: DataFrame, pin: Callable[[DataFrame], DataFrame] = pinned) -> DataFrame:
    """Add ``row_number`` as a file shows it, in scan order; ``pin`` stores the rows meanwhile."""
    return number_rows(df, "row_number", start=FIRST_DATA_LINE, pin=pin)


def number_lines_per_file(df: DataFrame, pin: Callable[[DataFrame], DataFrame] = pinned) -> DataFrame:
    """Add ``row_number`` as each file shows it, from ``FIRST_DATA_LINE`` in every file, and ``_file``.

    ``df`` must be read from files. A split of a file is read in file order by
    one task, so a row's place in its split is its row id less the split's
    first; splits of a file follow their start byte, and a running sum of
    their row counts, one row per split, gives each split its offset. Rows are
    pinned first, so the numbers stay on a retry.
    """
    rows = pin(
        df.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    splits = rows.groupBy("_file", "_start").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    # one row per split of a file: a window per file stays small
    before = F.sum("_n").over(Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1))
    splits = broadcast_if_small(splits.select("_file", "_start", "_first", F.coalesce(before, F.lit(0)).alias("_offset")))
    line = F.lit(FIRST_DATA_LINE) + F.col("_offset") + F.col("_row") - F.col("_first")
    return rows.join(splits, ["_file", "_start"]).withColumn("row_number", line).drop("_start", "_row", "_first", "_offset")


def validate_partners(df: DataFrame, *, batch_id: str, pad_postcode: bool = False) -> Split:
    """Good rows, and one quarantine row per error keyed by line number.

    ``df`` needs a ``row_number`` column (see :func:`number_lines`).
    """
    checked = df.withColumn("_errors", row_errors(pad_postcode))
    good = checked.filter(F.size("_errors") == 0).drop("_errors")
    bad = checked.filter(F.size("_errors") > 0).select(
        "row_number", F.explode("_errors").alias("_error")
    )
    message = F.concat(F.lit("Ligne "), F.col("row_number"), F.lit(": "), F.col("_error"))
    return Split(
        good, quarantine_rows(bad, "import_shops", F.col("row_number"), message, batch_id)
    )


def import_stats(df: DataFrame, pad_postcode: bool = False) -> DataFrame:
    """One row: rows read, valid, invalid, personal data hashed, number of errors."""
    errors = F.size(row_errors(pad_postcode))
    contact = F.concat_ws("", *[F.col(c) for c in ("contact_nom", "contact_email", "contact_telephone")])
    return df.select(
        errors.alias("e"), (F.length(F.btrim(contact, F.lit(WHITESPACE))) > 0).alias("c")
    ).agg(
        F.count("*").alias("rows_read"),
        F.count_if(F.col("e") == 0).alias("rows_valid"),
        F.count_if(F.col("e") > 0).alias("rows_invalid"),
        F.count_if((F.col("e") == 0) & F.col("c")).alias("personal_data_hashed"),
        F.coalesce(F.sum("e"), F.lit(0)).alias("validation_errors"),
    )


def error_summary(quarantine: DataFrame, shown: int = 5) -> DataFrame:
    """The first messages by line, then one line that counts the rest."""
    line = F.col("key").cast("bigint")
    first = quarantine.orderBy(line, "reason").limit(shown).select(
        line.alias("line"), F.col("reason").alias("message")
    )
    rest = quarantine.agg((F.count("*") - shown).alias("n")).filter("n > 0")
    more = rest.select(
        F.lit(None).cast("bigint").alias("line"),
        F.concat(F.lit("... et "), F.col("n"), F.lit(" autres")).alias("message"),
    )
    return first.unionByName(more)


# ------------------------------------------------------------- contracts


@dataclass(frozen=True)
class Rule:
    """What one column must satisfy; NULL passes everything but ``required``."""

    column: str
    required: bool = False
    max_length: int | None = None
    low: float | None = None
    high: float | None = None
    decimal: tuple[int, int] | None = None
    is_type: str | None = None


def rule_violations(rule: Rule) -> list[Column]:
    col = F.col(rule.column)
    out = []
    if rule.required:
        out.append(F.when(col.isNull(), F.lit(f"{rule.column}: required")))
    if rule.max_length is not None:
        out.append(
            F.when(F.length(col) > rule.max_length, F.lit(f"{rule.column}: longer than {rule.max_length}"))
        )
    if rule.low is not None:
        out.append(F.when(col < rule.low, F.lit(f"{rule.column}: below {rule.low}")))
    if rule.high is not None:
        out.append(F.when(col > rule.high, F.lit(f"{rule.column}: above {rule.high}")))
    if rule.decimal is not None:
        precision, scale = rule.decimal
        fits = F.abs(F.round(col.cast("decimal(38,10)"), scale)) < F.lit(10 ** (precision - scale))
        out.append(F.when(~fits, F.lit(f"{rule.column}: overflows decimal({precision},{scale})")))
    if rule.is_type is not None:
        cast = col.try_cast(rule.is_type)
        out.append(
            F.when(col.isNotNull() & cast.isNull(), F.lit(f"{rule.column}: not {rule.is_type}"))
        )
    return out


def check_contract(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Add ``violations``, the list of broken rules of each row."""
    marks = [v for rule in rules for v in rule_violations(rule)]
    return df.withColumn("violations", F.array_compact(F.array(*marks)))


def enforce_contract(
    df: DataFrame, rules: Sequence[Rule], *, stage: str, key: str, batch_id: str
) -> Split:
    checked = check_contract(df, rules)
    bad = checked.filter(F.size("violations") > 0)
    return Split(
        checked.filter(F.size("violations") == 0).drop("violations"),
        quarantine_rows(bad, stage, F.col(key), F.array_join("violations", "; "), batch_id),
    )


CONTRACTS: dict[str, tuple[Rule, ...]] = {
    "raw_books": (
        Rule("title", required=True),
        Rule("_metadata", required=True),
        Rule("_metadata.source", required=True),
        Rule("_metadata.scraped_at", required=True),
    ),
    "raw_quotes": (
        Rule("text", required=True),
        Rule("author", required=True),
        Rule("_metadata", required=True),
        Rule("_metadata.source", required=True),
        Rule("_metadata.scraped_at", required=True),
    ),
    "dim_categories": (
        Rule("category_name", required=True, max_length=100),
        Rule("category_slug", required=True, max_length=100),
    ),
    "fact_books": (
        Rule("title", required=True, max_length=255),
        Rule("price_gbp", decimal=(10, 2)),
        Rule("price_eur", decimal=(10, 2)),
        Rule("rating", low=1, high=5),
        Rule("url", max_length=500),
        Rule("image_url", max_length=500),
        Rule("scraped_at", required=True),
    ),
    "dim_authors": (
        Rule("author_name", required=True, max_length=200),
        Rule("author_slug", max_length=200),
    ),
    "dim_tags": (
        Rule("tag_name", required=True, max_length=100),
        Rule("tag_slug", max_length=100),
    ),
    "fact_quotes": (
        Rule("quote_text", required=True),
        Rule("quote_hash", max_length=64),
        Rule("scraped_at", required=True),
    ),
    "dim_librairies": (
        Rule("nom", required=True, max_length=200),
        Rule("adresse", max_length=300),
        Rule("code_postal", max_length=10),
        Rule("ville", max_length=100),
        Rule("specialite", max_length=100),
        Rule("contact_hash", max_length=64),
        Rule("ca_annuel_range", max_length=50),
        Rule("imported_at", required=True),
    ),
    "authors": (Rule("author_name", required=True, max_length=255),),
    "tags": (Rule("tag_name", required=True, max_length=255),),
    "quotes": (Rule("text", required=True), Rule("id_author", required=True)),
    "ca_annuel": (
        Rule("ca_annuel", low=0, decimal=(10, 2)),
        Rule("id_librairie", required=True),
    ),
    "books": (
        Rule("title", max_length=255),
        Rule("price", decimal=(10, 2)),
        Rule("category", max_length=255),
        Rule("url_image", max_length=255),
    ),
    "librairies": tuple(
        Rule(c, max_length=255)
        for c in (
            "nom_librairie",
            "adresse",
            "code_postal",
            "ville",
            "contact_initiales",
            "contact_email",
            "contact_telephone",
            "specialite",
        )
    ),
}


def contract_report(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Rows per broken rule."""
    broken = check_contract(df, rules).select(F.explode("violations").alias("violation"))
    return broken.groupBy("violation").agg(F.count("*").alias("n_rows"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once; NULL keys never clash."""
    given = df.dropna(subset=list(keys))
    return given.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows that point at no parent; a NULL reference is allowed."""
    known = broadcast_if_small(parent.select(F.col(parent_column).alias(column)).distinct())
    return child.filter(F.col(column).isNotNull()).join(known, column, "left_anti")
