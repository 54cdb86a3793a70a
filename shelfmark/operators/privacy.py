"""Anonymisation, retention and erasure over the stored layers."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import privacy
from shelfmark.functions.text import strip
from shelfmark.operators.cleaning import iso_text, iso_date
from shelfmark.schemas import PERSONAL_COLUMNS
from shelfmark.session import broadcast_if_small
from shelfmark.sources.layers import BRONZE, layer_path, metadata, rewrite_batches

RETENTION_DAYS = 30
# fixed values: what an erasure request may name, and how the log words it
IDENTIFIER_TYPES = ("email", "nom", "telephone")
ERASURE_ACTION = "RGPD_DELETION"
ERASURE_STATUS = "completed"
ERASURE_NOT_FOUND, ERASURE_UNKNOWN_TYPE = "not_found", "unknown_type"
HASH_SHOWN = 16


class Import(NamedTuple):
    silver: DataFrame
    bronze: DataFrame


def contact_hash(salt: str) -> Column:
    return privacy.contact_pseudonym(*[F.col(c) for c in PERSONAL_COLUMNS], salt)


def bronze_partners(df: DataFrame, *, source: str, batch_id: str) -> DataFrame:
    """Trimmed raw rows with the personal-data marker; ``df`` carries ``row_number``."""
    text = [c for c in ("nom_librairie", "adresse", "code_postal", "ville")]
    return df.select(
        *[F.coalesce(strip(F.col(c)), F.lit("")).alias(c) for c in text],
        *[strip(F.col(c)).alias(c) for c in PERSONAL_COLUMNS],
        F.col("ca_annuel").try_cast("double").alias("ca_annuel"),
        iso_text(iso_date(F.col("date_partenariat"))).alias("date_partenariat"),
        strip(F.col("specialite")).alias("specialite"),
        metadata(
            source,
            batch_id,
            at="imported_at",
            row_number=F.col("row_number"),
            contains_personal_data=True,
        ).alias("_metadata"),
    )


def silver_partners(bronze: DataFrame, *, salt: str, anonymize: bool = True) -> DataFrame:
    """Silver rows under the Silver names; identifiers leave unless ``anonymize`` is off."""
    common = [
        F.col("nom_librairie").alias("nom"),
        F.col("adresse"),
        F.col("code_postal"),
        F.col("ville"),
        F.col("specialite"),
        F.col("date_partenariat"),
        privacy.revenue_band(F.col("ca_annuel")).alias("ca_annuel_range"),
        contact_hash(salt).alias("contact_hash"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.struct(
            F.col("_metadata.source"),
            F.col("_metadata.imported_at"),
            F.col("_metadata.batch_id"),
            F.lit(anonymize).alias("anonymized"),
            F.lit(anonymize).alias("rgpd_compliant"),
            F.col("_metadata.row_number"),
        ).alias("_metadata"),
    ]
    raw = [] if anonymize else [F.col(c) for c in (*PERSONAL_COLUMNS, "ca_annuel")]
    return bronze.select(*common, *raw)


def import_partners(
    valid: DataFrame, *, source: str, batch_id: str, salt: str, anonymize: bool = True
) -> Import:
    """Silver and Bronze frames of the valid partner rows."""
    bronze = bronze_partners(valid, source=source, batch_id=batch_id)
    return Import(silver_partners(bronze, salt=salt, anonymize=anonymize), bronze)


def normalised_privacy(df: DataFrame) -> DataFrame:
    """Normalised variant: initials instead of the name, MD5 of e-mail and phone."""
    return (
        df.withColumn("contact_initiales", privacy.initials(F.col("contact_nom")))
        .withColumn("contact_email", privacy.md5_hex(F.col("contact_email")))
        .withColumn("contact_telephone", privacy.md5_hex(F.col("contact_telephone")))
        .drop("contact_nom")
    )


class RevenueSplit(NamedTuple):
    shops: DataFrame
    revenue: DataFrame


def split_revenue(df: DataFrame, key: str = "id_librairie") -> RevenueSplit:
    """Confidential revenue in its own table, keyed by shop."""
    return RevenueSplit(
        df.drop("ca_annuel"), df.select(F.col("ca_annuel").cast("decimal(10,2)"), F.col(key))
    )


def minimise(df: DataFrame, allowed: Iterable[str]) -> DataFrame:
    """Only the listed columns survive."""
    return df.select(*[c for c in allowed if c in df.columns])


# ------------------------------------------------------------- retention


def _expired(now: Column, days: int, column: str) -> Column:
    return F.coalesce(F.col(column) < now - F.make_dt_interval(F.lit(days)), F.lit(False))


def purge_expired(
    df: DataFrame,
    now: Column | None = None,
    days: int = RETENTION_DAYS,
    column: str = "_metadata.imported_at",
) -> DataFrame:
    """Rows still within retention; a row without a date is kept."""
    at = now if now is not None else F.current_timestamp()
    # spelled out rather than negated: this form reaches the scan
    return df.filter(F.col(column).isNull() | (F.col(column) >= at - F.make_dt_interval(F.lit(days))))


def expired_count(
    df: DataFrame,
    now: Column | None = None,
    days: int = RETENTION_DAYS,
    column: str = "_metadata.imported_at",
) -> DataFrame:
    at = now if now is not None else F.current_timestamp()
    return df.agg(F.count_if(_expired(at, days, column)).alias("purged"))


def purge_layer(
    bronze: DataFrame, root: str, name: str, now: datetime, days: int = RETENTION_DAYS
) -> int:
    """Purge a stored Bronze collection in place; returns the number of purged rows.

    Only batches that hold an expired row are rewritten, the others stay as they are.
    """
    at = F.lit(now)
    old = bronze.filter(_expired(at, days, "_metadata.imported_at"))
    # one row per affected batch: bounded by the number of stored batches
    touched = old.groupBy("batch_id").count().collect()
    rewrite_batches(
        purge_expired(bronze, at, days),
        layer_path(root, BRONZE, name),
        [r["batch_id"] for r in touched],
    )
    return sum(r["count"] for r in touched)


# --------------------------------------------------------------- erasure


def identity_map(bronze: DataFrame, salt: str) -> DataFrame:
    """(identifier_type, identifier_hash, contact_hash): no raw identifier inside.

    Kept after Bronze is purged, so that a late request still finds the
    pseudonym, which covers name, e-mail and phone together.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(kind).alias("identifier_type"),
                privacy.pseudonym(F.col(f"contact_{kind}"), salt).alias("identifier_hash"),
            )
            for kind in IDENTIFIER_TYPES
        ]
    )
    return (
        bronze.select(contact_hash(salt).alias("contact_hash"), F.explode(entries).alias("e"))
        .select("e.identifier_type", "e.identifier_hash", "contact_hash")
        .filter("identifier_hash is not null")
        .distinct()
    )


class Erasure(NamedTuple):
    bronze: DataFrame
    silver: DataFrame
    gold: DataFrame
    counts: DataFrame
    log: DataFrame


class Doomed(NamedTuple):
    asked: Column
    marked: DataFrame
    contacts: DataFrame
    found: DataFrame


def doomed(bronze: DataFrame, requests: DataFrame, *, salt: str, known: DataFrame | None = None) -> Doomed:
    """Who is asked for: Bronze rows with the condition ``asked``, pseudonyms, requests that name somebody.

    Identifiers are compared without surrounding white space, as Bronze stores
    them; a blank one names nobody. ``found`` is (identifier_type, identifier_hash).
    """
    marked, hit = bronze, F.lit(False)
    wanted = requests.withColumn("identifier", strip(F.col("identifier"))).filter("identifier <> ''")
    for kind in IDENTIFIER_TYPES:
        column, flag = f"contact_{kind}", f"_asked_{kind}"
        keys = (
            wanted.filter(F.col("identifier_type") == kind)
            .select(F.col("identifier").alias(column))
            .distinct()
        )
        marked = marked.join(
            broadcast_if_small(keys).withColumn(flag, F.lit(True)), column, "left"
        )
        hit = hit | F.coalesce(F.col(flag), F.lit(False))
    hashes = marked.filter(hit).select(contact_hash(salt).alias("contact_hash"))
    asked = wanted.select(
        "identifier_type", privacy.pseudonym(F.col("identifier"), salt).alias("identifier_hash")
    ).distinct()
    named = identity_map(bronze, salt)
    if known is not None:
        known = known.select(*named.columns)
        hashes = hashes.unionByName(
            known.join(asked, ["identifier_type", "identifier_hash"], "left_semi").select("contact_hash")
        )
        named = named.unionByName(known)
    found = (
        named.join(asked, ["identifier_type", "identifier_hash"], "left_semi")
        .select("identifier_type", "identifier_hash")
        .distinct()
    )
    return Doomed(hit, marked, hashes.filter("contact_hash is not null").distinct(), found)


def erase(
    bronze: DataFrame,
    silver: DataFrame,
    gold: DataFrame,
    requests: DataFrame,
    *,
    salt: str,
    known: DataFrame | None = None,
) -> Erasure:
    """Erase the requested persons from all three layers.

    ``requests`` holds (identifier_type, identifier). Bronze rows match on the
    raw identifier; Silver and Gold match on the pseudonyms of those rows and of
    ``known``, a stored :func:`identity_map`. Layers only meet distinct request
    keys, which leaves them unshuffled as long as the requests are few (their
    number is checked). ``shelfmark.plans.pipeline.erase_layers`` rewrites what
    is stored.
    """
    who = doomed(bronze, requests, salt=salt, known=known)
    kept = who.marked.filter(~who.asked).select(*bronze.columns)
    erased = who.marked.filter(who.asked).select(*bronze.columns)
    contacts = broadcast_if_small(who.contacts)

    def gone(df: DataFrame) -> Column:
        return df.join(contacts, "contact_hash", "left_semi").select(F.count("*")).scalar()

    counts = bronze.sparkSession.range(1).select(
        erased.select(F.count("*")).scalar().alias("bronze_deleted"),
        gone(silver).alias("silver_deleted"),
        gone(gold).alias("gold_deleted"),
    )
    return Erasure(
        kept,
        silver.join(contacts, "contact_hash", "left_anti").select(*silver.columns),
        gold.join(contacts, "contact_hash", "left_anti").select(*gold.columns),
        counts,
        erasure_log(requests, salt, who.found),
    )


def erasure_log(requests: DataFrame, salt: str, found: DataFrame) -> DataFrame:
    """Audit rows without personal data: the pseudonym is cut to its first digits.

    ``found`` holds the (identifier_type, identifier_hash) that named somebody;
    the status of the other requests says so.
    """
    whole = privacy.pseudonym(F.col("identifier"), salt)
    hits = found.select("identifier_type", "identifier_hash", F.lit(True).alias("_found"))
    asked = requests.select("identifier_type", whole.alias("identifier_hash"))
    status = (
        F.when(F.col("_found"), F.lit(ERASURE_STATUS))
        .when(F.col("identifier_type").isin(*IDENTIFIER_TYPES), F.lit(ERASURE_NOT_FOUND))
        .otherwise(F.lit(ERASURE_UNKNOWN_TYPE))
    )
    return asked.join(hits, ["identifier_type", "identifier_hash"], "left").select(
        F.current_timestamp().alias("timestamp"),
        F.lit(ERASURE_ACTION).alias("action"),
        "identifier_type",
        F.concat(F.left("identifier_hash", F.lit(HASH_SHOWN)), F.lit("...")).alias("identifier_hash"),
        status.alias("status"),
    )
