"""Declared schemas of the stored layers. Nothing is inferred in production paths."""

from __future__ import annotations

# Bronze ---------------------------------------------------------------

_PAGE_META = (
    "_metadata struct<source:string,scraped_at:timestamp,batch_id:string,pipeline_version:string>"
)
RAW_BOOKS = (
    "title string, price string, rating string, availability string, category string, "
    f"url string, image_url string, {_PAGE_META}"
)
RAW_QUOTES = f"text string, author string, author_url string, tags array<string>, {_PAGE_META}"
PARTNER_COLUMNS = (
    "nom_librairie",
    "adresse",
    "code_postal",
    "ville",
    "contact_nom",
    "contact_email",
    "contact_telephone",
    "ca_annuel",
    "date_partenariat",
    "specialite",
)
PERSONAL_COLUMNS = ("contact_nom", "contact_email", "contact_telephone")
CONFIDENTIAL_COLUMNS = ("ca_annuel",)
# every partner column is read as text so that leading zeros survive
PARTNER_FILE = ", ".join(f"{c} string" for c in PARTNER_COLUMNS)
RAW_SHOPS = (
    "nom_librairie string, adresse string, code_postal string, ville string, "
    "contact_nom string, contact_email string, contact_telephone string, "
    "ca_annuel double, date_partenariat string, specialite string, "
    "_metadata struct<source:string,imported_at:timestamp,batch_id:string,"
    "row_number:bigint,contains_personal_data:boolean>"
)
RAW_GEOCODING = (
    "result struct<original_id:bigint,latitude:double,longitude:double,label:string,"
    "score:double,city:string,postcode:string,context:string,type:string,raw_response:string>, "
    "_metadata struct<source:string,queried_at:timestamp,batch_id:string>"
)

# Silver ---------------------------------------------------------------

_CLEAN_META = (
    "_metadata struct<source:string,transformed_at:timestamp,batch_id:string,"
    "transformations:array<string>>"
)
CLEAN_BOOKS = (
    "title string, category string, price_gbp decimal(10,2), price_eur decimal(10,2), "
    "rating int, availability int, url string, image_url string, scraped_at timestamp, "
    + _CLEAN_META
)
CLEAN_QUOTES = (
    "text string, text_hash string, author string, author_slug string, tags array<string>, "
    f"tag_count int, text_length int, scraped_at timestamp, {_CLEAN_META}"
)
CLEAN_SHOPS = (
    "nom string, adresse string, code_postal string, ville string, specialite string, "
    "date_partenariat date, ca_annuel_range string, contact_hash string, "
    "latitude decimal(10,8), longitude decimal(11,8), "
    "_metadata struct<source:string,transformed_at:timestamp,batch_id:string,"
    "rgpd_compliant:boolean>"
)

# Gold (star) ----------------------------------------------------------

DIM_CATEGORIES = "category_id bigint, category_name string, category_slug string, created_at timestamp"
FACT_BOOKS = (
    "book_id bigint, category_id bigint, title string, price_gbp decimal(10,2), "
    "price_eur decimal(10,2), rating int, availability int, url string, image_url string, "
    "scraped_at timestamp, created_at timestamp"
)
DIM_AUTHORS = (
    "author_id bigint, author_name string, author_slug string, quote_count bigint, "
    "created_at timestamp"
)
DIM_TAGS = "tag_id bigint, tag_name string, tag_slug string, usage_count bigint, created_at timestamp"
FACT_QUOTES = (
    "quote_id bigint, author_id bigint, quote_text string, quote_hash string, "
    "scraped_at timestamp, created_at timestamp"
)
QUOTE_TAGS = "quote_id bigint, tag_id bigint"
DIM_SHOPS = (
    "librairie_id bigint, nom string, adresse string, code_postal string, ville string, "
    "latitude decimal(10,8), longitude decimal(11,8), specialite string, date_partenariat date, "
    "contact_hash string, ca_annuel_range string, imported_at timestamp, created_at timestamp"
)

GOLD = {
    "dim_categories": DIM_CATEGORIES,
    "fact_books": FACT_BOOKS,
    "dim_authors": DIM_AUTHORS,
    "dim_tags": DIM_TAGS,
    "fact_quotes": FACT_QUOTES,
    "quote_tags": QUOTE_TAGS,
    "dim_librairies": DIM_SHOPS,
}

# Normalised variant ---------------------------------------------------

NORMALISED = {
    "authors": "id_author bigint, author_name string",
    "quotes": "id_quote bigint, text string, id_author bigint",
    "tags": "id_tag bigint, tag_name string",
    "quotes_tags": "id_quote bigint, id_tag bigint",
    "librairies": (
        "id_librairie bigint, nom_librairie string, adresse string, code_postal string, "
        "ville string, contact_initiales string, contact_email string, "
        "contact_telephone string, date_partenariat date, specialite string, "
        "latitude double, longitude double"
    ),
    "ca_annuel": "id_ca_annuel bigint, ca_annuel decimal(10,2), id_librairie bigint",
    "books": (
        "id_book bigint, title string, price decimal(10,2), rating int, "
        "availability boolean, category string, url_image string"
    ),
}

# keys and references of every table: (unique keys, foreign keys)
UNIQUE_KEYS = {
    "dim_categories": (("category_id",), ("category_name",)),
    "fact_books": (("book_id",),),
    "dim_authors": (("author_id",), ("author_name",)),
    "dim_tags": (("tag_id",), ("tag_name",)),
    "fact_quotes": (("quote_id",), ("quote_hash",)),
    "quote_tags": (("quote_id", "tag_id"),),
    "dim_librairies": (("librairie_id",),),
    "authors": (("id_author",), ("author_name",)),
    "quotes": (("id_quote",),),
    "tags": (("id_tag",), ("tag_name",)),
    "quotes_tags": (("id_quote", "id_tag"),),
    "librairies": (("id_librairie",),),
    "ca_annuel": (("id_ca_annuel",),),
    "books": (("id_book",),),
}
# child table, child column, parent table, parent column, deletes cascade
FOREIGN_KEYS = (
    ("fact_books", "category_id", "dim_categories", "category_id", False),
    ("fact_quotes", "author_id", "dim_authors", "author_id", False),
    ("quote_tags", "quote_id", "fact_quotes", "quote_id", True),
    ("quote_tags", "tag_id", "dim_tags", "tag_id", True),
    ("quotes", "id_author", "authors", "id_author", True),
    ("quotes_tags", "id_quote", "quotes", "id_quote", True),
    ("quotes_tags", "id_tag", "tags", "id_tag", True),
    ("ca_annuel", "id_librairie", "librairies", "id_librairie", True),
)
