"""Bronze to Silver: typed, trimmed, deduplicated rows with rejects kept apart."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import fields
from shelfmark.functions.text import (
    DEFAULT_CATEGORY,
    UNKNOWN_AUTHOR,
    normalise_tags,
    slug,
    strip,
    text_hash,
    title_case,
)
from shelfmark.operators.splits import Split, split_on
from shelfmark.sources.layers import metadata

# fixed values: what each cleaning step records about itself
BOOK_STEPS = ("price_gbp_to_eur", "rating_normalized", "text_cleaned")
QUOTE_STEPS = ("text_cleaned", "tags_normalized", "deduplicated")

# fixed values: fill-ins of the normalised partner table
TEXT_FILL = "Unknown"
POSTCODE_FILL = "00000"
PHONE_FILL = "0000000000"


def iso_timestamp(col: Column) -> Column:
    return F.try_to_timestamp(col)


def iso_date(col: Column) -> Column:
    return F.try_to_timestamp(col).cast("date")


def iso_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _or(col: str, default: str) -> Column:
    return F.coalesce(F.col(col), F.lit(default))


def clean_books(
    raw: DataFrame, *, batch_id: str, rate: Decimal = fields.RATE_GBP_EUR, keep: tuple = ()
) -> Split:
    """Silver books; a price that is no number sends the row to quarantine."""
    price = fields.parse_price(F.col("price"))
    rows = raw.select(
        *keep,
        strip(_or("title", "")).alias("title"),
        strip(_or("category", DEFAULT_CATEGORY)).alias("category"),
        price.alias("price_gbp"),
        fields.convert(price, rate).alias("price_eur"),
        fields.parse_rating(F.col("rating")).alias("rating"),
        fields.stock_from_digits(F.col("availability")).alias("availability"),
        _or("url", "").alias("url"),
        _or("image_url", "").alias("image_url"),
        F.col("_metadata.scraped_at").alias("scraped_at"),
        metadata(F.col("_metadata.source"), batch_id, transformations=BOOK_STEPS).alias("_metadata"),
        F.col("price").alias("_price"),
    )
    return split_on(
        rows,
        F.when(
            F.col("price_gbp").isNull(), F.concat(F.lit("price not a number: "), F.col("_price"))
        ),
        stage="transform_books",
        key=F.col("title"),
        batch_id=batch_id,
        drop=("_price",),
    )


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """First row of each ``key`` by ``order``; of rows equal in both, any one.

    The wide rows never meet in one group: the aggregate moves two narrow
    columns and combines copies map-side, and the semi join runs on ``key`` and
    ``order`` together, so a key that holds a third of all rows stays spread.
    ``order`` may repeat: positions restart with every file.
    """
    winners = df.groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_order"))
    first = F.col(key).eqNullSafe(F.col("_key")) & F.col(order).eqNullSafe(F.col("_order"))
    return df.join(winners, first, "left_semi").dropDuplicates([key, order]).select(*df.columns)


def clean_quotes(
    raw: DataFrame, *, batch_id: str, order: str = "position", keep: tuple = ()
) -> DataFrame:
    """Silver quotations, one per text hash; ``order`` must be a unique ordering column."""
    text = strip(_or("text", ""))
    tags = normalise_tags(F.col("tags"))
    rows = raw.select(
        F.col(order),
        *[c for c in keep if c != order],
        text.alias("text"),
        text_hash(text).alias("text_hash"),
        strip(_or("author", UNKNOWN_AUTHOR)).alias("author"),
        # the slug is taken from the name as it was scraped, before trimming
        slug(_or("author", "")).alias("author_slug"),
        tags.alias("tags"),
        F.size(tags).alias("tag_count"),
        F.length(text).alias("text_length"),
        F.col("_metadata.scraped_at").alias("scraped_at"),
        metadata(F.col("_metadata.source"), batch_id, transformations=QUOTE_STEPS).alias("_metadata"),
    )
    return keep_first(rows, "text_hash", order)


def clean_shops(shops: DataFrame, *, source: str, batch_id: str, keep: tuple = ()) -> DataFrame:
    """Silver shops from anonymised, geocoded partner rows."""
    return shops.select(
        *keep,
        strip(_or("nom", "")).alias("nom"),
        strip(_or("adresse", "")).alias("adresse"),
        strip(_or("code_postal", "")).alias("code_postal"),
        title_case(strip(_or("ville", ""))).alias("ville"),
        F.when(F.col("specialite") != "", strip(F.col("specialite"))).alias("specialite"),
        iso_date(F.col("date_partenariat")).alias("date_partenariat"),
        "ca_annuel_range",
        "contact_hash",
        F.col("latitude").cast("decimal(10,8)").alias("latitude"),
        F.col("longitude").cast("decimal(11,8)").alias("longitude"),
        metadata(source, batch_id, rgpd_compliant=True).alias("_metadata"),
    )


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Whole-row duplicates removed; copies are combined before the shuffle."""
    return df.dropDuplicates()


def fill_defaults(df: DataFrame, today: Column | None = None) -> DataFrame:
    """Fill-ins of the normalised partner table, applied before any cast to text."""
    text = ("nom_librairie", "adresse", "ville", "contact_nom", "contact_email", "specialite")
    fills: Mapping[str, object] = {
        **{c: TEXT_FILL for c in text},
        "code_postal": POSTCODE_FILL,
        "contact_telephone": PHONE_FILL,
    }
    out = {c: F.coalesce(F.col(c).cast("string"), F.lit(v)) for c, v in fills.items()}
    out["ca_annuel"] = F.coalesce(F.col("ca_annuel").cast(fields.MONEY), F.lit(0).cast(fields.MONEY))
    out["date_partenariat"] = F.coalesce(
        F.col("date_partenariat").cast("date"), today if today is not None else F.current_date()
    )
    for c in ("latitude", "longitude"):
        out[c] = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return df.withColumns({c: e for c, e in out.items() if c in df.columns})
