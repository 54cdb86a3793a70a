"""End-to-end runs: pages and partner files -> Bronze -> Silver -> Gold -> reports.

Every stage reads what the previous one stored, so a run can start again at any
stage. A stage works on one batch.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, replace
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.functions.fields import RATE_GBP_EUR
from shelfmark.operators import cleaning, geocode, merge, pages, privacy, validation
from shelfmark.operators.splits import QUARANTINE, failure_report
from shelfmark.plans import analytics
from shelfmark.session import broadcast_if_small, pinned
from shelfmark.sources.layers import (
    BRONZE,
    GOLD,
    SILVER,
    append_layer,
    layer_path,
    new_batch_id,
    path_exists,
    read_gold,
    read_layer,
    register_views,
    remove,
    rewrite_batches,
    write_gold,
)

# fixed values: caps of a trial run
TRIAL_CATEGORIES, TRIAL_QUOTE_PAGES = 2, 2

# stages that may reject rows
STAGES = ("extract_books", "extract_quotes", "import_shops", "transform_books", "load_books")

SUMMARY = "batch_id string, entity string, stage string, n_rows bigint"


@dataclass(frozen=True)
class Inputs:
    """What a run reads. Pages carry page_no (quotes) or category, category_no (books)."""

    book_pages: DataFrame | None = None
    quote_pages: DataFrame | None = None
    partners: DataFrame | None = None
    geo_responses: DataFrame | None = None


@dataclass(frozen=True)
class Settings:
    root: str
    salt: str
    book_source: str = "books"
    quote_source: str = "quotes"
    partner_source: str = "partners"
    geo_source: str = "geocoder"
    book_site: str = ""
    quote_site: str = ""
    rate: Decimal = RATE_GBP_EUR
    limit_categories: int | None = None
    max_quote_pages: int | None = None
    # a repeated stage replaces what its batch stored before
    replace_batch: bool = True

    def trial(self) -> Settings:
        return replace(
            self, limit_categories=TRIAL_CATEGORIES, max_quote_pages=TRIAL_QUOTE_PAGES
        )


class Run:
    """One batch moving through the layers."""

    def __init__(self, spark: SparkSession, settings: Settings, batch_id: str | None = None):
        self.spark = spark
        self.s = settings
        self.batch_id = batch_id or new_batch_id()
        self.counts: list[tuple[str, str, str, int]] = []
        self.seconds: dict[str, float] = {}

    # -- helpers

    def _count(self, entity: str, stage: str, df: DataFrame) -> None:
        self.counts.append((self.batch_id, entity, stage, df.count()))

    def _store(self, df: DataFrame, layer: str, name: str) -> None:
        append_layer(df, self.s.root, layer, name, self.batch_id, self.s.replace_batch)

    def _read(self, layer: str, name: str, schema: str) -> DataFrame:
        df = read_layer(self.spark, self.s.root, layer, name, schema, self.batch_id)
        return df.drop("batch_id")

    def _reject(self, stage: str, quarantine: DataFrame) -> None:
        """Rejected rows of one stage; a repeated stage replaces what it rejected before."""
        append_layer(
            quarantine.drop("batch_id"), self.s.root, SILVER, f"quarantine_{stage}",
            self.batch_id, replace_batch=True,
        )

    def _gold(self, table: str) -> DataFrame:
        return read_gold(self.spark, self.s.root, table, schemas.GOLD[table])

    def _count_loaded(self, entity: str, table: str) -> None:
        """Rows this batch has put in a fact table, counted in its own folder."""
        stored = read_gold(
            self.spark, self.s.root, table, schemas.GOLD[table], only_batch=self.batch_id
        )
        self._count(entity, "loaded", stored)

    def _earlier(self, table: str) -> DataFrame:
        """Facts of the other batches: a repeated batch replaces its own."""
        return read_gold(self.spark, self.s.root, table, schemas.GOLD[table], without_batch=self.batch_id)

    # -- extract

    def extract(self, inputs: Inputs) -> None:
        if inputs.book_pages is not None:
            self._extract_books(inputs.book_pages)
        if inputs.quote_pages is not None:
            self._extract_quotes(inputs.quote_pages)
        if inputs.partners is not None:
            self._extract_shops(inputs.partners, inputs.geo_responses)

    def _extract_books(self, book_pages: DataFrame) -> None:
        capped = pages.cap_categories(book_pages, self.s.limit_categories)
        split = pages.book_cards(
            capped, site_root=self.s.book_site, source=self.s.book_source, batch_id=self.batch_id
        )
        self._store(split.good.drop("page_id", "position"), BRONZE, "raw_books")
        self._reject("extract_books", split.quarantine)
        self._count("books", "extracted", self._read(BRONZE, "raw_books", schemas.RAW_BOOKS))

    def _extract_quotes(self, quote_pages: DataFrame) -> None:
        capped = quote_pages
        if self.s.max_quote_pages is not None:
            capped = quote_pages.filter(F.col("page_no") <= self.s.max_quote_pages)
        split = pages.quote_cards(
            capped, site_root=self.s.quote_site, source=self.s.quote_source, batch_id=self.batch_id
        )
        # the scan order of the crawl: page, then place on the page
        places = {c: F.col(c).cast("bigint") for c in ("page_id", "position")}
        self._store(split.good.withColumns(places), BRONZE, "raw_quotes")
        self._reject("extract_quotes", split.quarantine)
        self._count("quotes", "extracted", self._bronze_quotes())

    def _bronze_quotes(self) -> DataFrame:
        stored = self._read(BRONZE, "raw_quotes", schemas.RAW_QUOTES + ", page_id bigint, position bigint")
        return stored.withColumn("place", F.struct("page_id", "position"))

    def _extract_shops(self, partners: DataFrame, responses: DataFrame | None) -> None:
        # raw contacts wait in a folder of their own, which goes at the end, never in a checkpoint
        waiting = layer_path(self.s.root, "import", self.batch_id)

        def held(df: DataFrame) -> DataFrame:
            df.write.mode("overwrite").parquet(waiting)
            return self.spark.read.schema(df.schema).parquet(waiting)

        try:
            self._import_shops(validation.number_lines(partners, held), responses)
        finally:
            remove(self.spark, waiting)

    def _import_shops(self, lines: DataFrame, responses: DataFrame | None) -> None:
        split = validation.validate_partners(lines, batch_id=self.batch_id)
        self._reject("import_shops", split.quarantine)
        raw = privacy.bronze_partners(
            split.good, source=self.s.partner_source, batch_id=self.batch_id
        )
        self._store(raw, BRONZE, "raw_librairies")
        bronze = self._read(BRONZE, "raw_librairies", schemas.RAW_SHOPS)
        self._store(privacy.identity_map(bronze, self.s.salt), SILVER, "identity_map")
        silver = privacy.silver_partners(bronze, salt=self.s.salt)
        numbered = silver.withColumn("row_number", F.col("_metadata.row_number"))
        if responses is not None:
            answers = geocode.parse_responses(responses)
            results = geocode.geocode(geocode.requests_for(numbered), answers)
            found = geocode.found_only(
                results, source=self.s.geo_source, batch_id=self.batch_id
            )
            self._store(found, BRONZE, "raw_geocoding")
            numbered = geocode.enrich(numbered, results)
        # anonymised rows wait beside Bronze for the transform stage
        self._store(numbered.drop("_metadata"), SILVER, "anonymised_librairies")
        self._count("librairies", "extracted", bronze)

    # -- transform

    def transform(self) -> None:
        books = cleaning.clean_books(
            self._read(BRONZE, "raw_books", schemas.RAW_BOOKS),
            batch_id=self.batch_id,
            rate=self.s.rate,
        )
        self._store(books.good, SILVER, "clean_books")
        self._reject("transform_books", books.quarantine)
        self._count("books", "transformed", self._silver("clean_books", schemas.CLEAN_BOOKS))

        quotes = cleaning.clean_quotes(self._bronze_quotes(), batch_id=self.batch_id, order="place")
        self._store(quotes.drop("place"), SILVER, "clean_quotes")
        self._count("quotes", "transformed", self._silver("clean_quotes", schemas.CLEAN_QUOTES))

        shops = cleaning.clean_shops(
            self._read(SILVER, "anonymised_librairies", _ANONYMISED),
            source=self.s.partner_source,
            batch_id=self.batch_id,
        )
        self._store(shops, SILVER, "clean_librairies")
        self._count("librairies", "transformed", self._silver("clean_librairies", schemas.CLEAN_SHOPS))

    def _silver(self, name: str, schema: str) -> DataFrame:
        return self._read(SILVER, name, schema)

    # -- load

    def load(self) -> None:
        load_books(self, self._silver("clean_books", schemas.CLEAN_BOOKS))
        load_quotes(self, self._silver("clean_quotes", schemas.CLEAN_QUOTES))
        load_shops(self, self._silver("clean_librairies", schemas.CLEAN_SHOPS))

    # -- everything

    def run(self, inputs: Inputs) -> DataFrame:
        for name, stage in (
            ("extract", lambda: self.extract(inputs)),
            ("transform", self.transform),
            ("load", self.load),
        ):
            start = time.monotonic()
            stage()
            self.seconds[name] = time.monotonic() - start
        return self.summary()

    def summary(self) -> DataFrame:
        """Rows per entity and stage; loaded rows are those really inserted."""
        return self.spark.createDataFrame(self.counts, SUMMARY)

    def failures(self, shown: int = 5) -> DataFrame:
        return failure_report(self.quarantine(), shown)

    def quarantine(self) -> DataFrame:
        """All rejected rows of this batch."""
        parts = [
            read_layer(self.spark, self.s.root, SILVER, f"quarantine_{s}", _REJECTED, self.batch_id)
            for s in STAGES
        ]
        return reduce(DataFrame.unionByName, parts)


_REJECTED = QUARANTINE.replace(", batch_id string", "")
_ANONYMISED = (
    "nom string, adresse string, code_postal string, ville string, specialite string, "
    "date_partenariat string, ca_annuel_range string, contact_hash string, "
    "latitude double, longitude double, row_number bigint"
)


def _add_members(run: Run, table: str, loaded: merge.Merge) -> None:
    """Append the new members of a dimension; their numbering has pinned them already."""
    write_gold(loaded.inserted, run.s.root, table, run.batch_id, append=True)


def _add_facts(run: Run, table: str, rows: DataFrame) -> None:
    write_gold(rows, run.s.root, table, run.batch_id)


def load_books(run: Run, books: DataFrame) -> None:
    """Categories, then books; rows that break a table rule are quarantined, not fatal."""
    good, bad = validation.enforce_contract(
        books,
        validation.CONTRACTS["fact_books"],
        stage="load_books",
        key="title",
        batch_id=run.batch_id,
    )
    run._reject("load_books", bad)
    _add_members(
        run, "dim_categories", merge.upsert_categories(run._gold("dim_categories"), books)
    )
    loaded = merge.load_books(run._earlier("fact_books"), good, run._gold("dim_categories"))
    _add_facts(run, "fact_books", loaded.inserted)
    run._count_loaded("books", "fact_books")


def load_quotes(run: Run, quotes: DataFrame) -> None:
    """Authors, tags, new quotations, then the tag pairs of those quotations."""
    _add_members(run, "dim_authors", merge.upsert_authors(run._gold("dim_authors"), quotes))
    _add_members(run, "dim_tags", merge.upsert_tags(run._gold("dim_tags"), quotes))
    loaded = merge.load_quotes(run._earlier("fact_quotes"), quotes, run._gold("dim_authors"))
    pairs = merge.load_bridge(
        run._earlier("quote_tags"), loaded.inserted, quotes, run._gold("dim_tags")
    ).inserted
    _add_facts(run, "fact_quotes", loaded.inserted)
    _add_facts(run, "quote_tags", pairs)
    run._count_loaded("quotes", "fact_quotes")


def load_shops(run: Run, shops: DataFrame) -> None:
    loaded = merge.load_shops(run._earlier("dim_librairies"), shops)
    _add_facts(run, "dim_librairies", loaded.inserted)
    run._count_loaded("librairies", "dim_librairies")


def gold_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The star schema. Counters are derived from the facts, so they are never stale."""
    gold = {name: read_gold(spark, root, name, schema) for name, schema in schemas.GOLD.items()}
    gold["dim_authors"] = merge.refresh_counter(
        gold["dim_authors"], gold["fact_quotes"], "author_id", "quote_count"
    )
    gold["dim_tags"] = merge.refresh_counter(
        gold["dim_tags"], gold["quote_tags"], "tag_id", "usage_count"
    )
    return gold


IDENTITY = "identifier_type string, identifier_hash string, contact_hash string"

# stored collections that hold pseudonyms: layer, name, columns, partition
_PSEUDONYMS = (
    (GOLD, "dim_librairies", schemas.GOLD["dim_librairies"], "load_batch"),
    (SILVER, "clean_librairies", schemas.CLEAN_SHOPS, "batch_id"),
    (SILVER, "anonymised_librairies", _ANONYMISED, "batch_id"),
)


def erase_layers(spark: SparkSession, root: str, requests: DataFrame, *, salt: str) -> DataFrame:
    """Erase the requested persons from everything stored below ``root``; returns the log.

    Gold and Silver go first and Bronze and the identity map last, which tell
    whom a request means: an erasure cut half-way can simply run again. Only
    batches that hold such a person are rewritten. Pseudonyms are pinned, and the
    requested identifiers too where Catalyst cannot tell that they are few.
    """
    bronze = read_layer(spark, root, BRONZE, "raw_librairies", schemas.RAW_SHOPS)
    known = read_layer(spark, root, SILVER, "identity_map", IDENTITY)
    who = privacy.doomed(bronze, requests, salt=salt, known=known)
    contacts, log = pinned(who.contacts), pinned(privacy.erasure_log(requests, salt, who.found))
    small = broadcast_if_small(contacts)

    def rewrite(gone: DataFrame, kept: DataFrame, layer: str, name: str, partition: str) -> None:
        # one row per affected batch: bounded by the number of stored batches
        touched = [r[0] for r in gone.select(partition).distinct().collect()]
        rewrite_batches(kept, layer_path(root, layer, name), touched, partition)

    def by_contact(layer: str, name: str, columns: str, partition: str) -> None:
        path = layer_path(root, layer, name)
        if path_exists(spark, path):
            stored = spark.read.schema(f"{columns}, {partition} string").parquet(path)
            kept = stored.join(small, "contact_hash", "left_anti").select(*stored.columns)
            rewrite(stored.join(small, "contact_hash", "left_semi"), kept, layer, name, partition)

    for collection in _PSEUDONYMS:
        by_contact(*collection)
    kept = who.marked.filter(~who.asked).select(*bronze.columns)
    rewrite(who.marked.filter(who.asked), kept, BRONZE, "raw_librairies", "batch_id")
    by_contact(SILVER, "identity_map", IDENTITY, "batch_id")
    return log


def run_reports(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The validation reports that close a trial run; views are registered as well."""
    gold = gold_tables(spark, root)
    register_views(gold)
    analytics.register_views(gold, [v for v in analytics.VIEWS if v != "v_quotes_tags"])
    return {
        "category_stats": analytics.category_stats(gold),
        "top_authors": analytics.top_authors_counter(gold),
        "top_books": analytics.top_per_category(gold),
        "geocoded_shops": analytics.geocoded_shops(gold),
        "dq_report": analytics.dq_report(gold, short=True),
        "dashboard": analytics.dashboard(gold, short=True),
    }
