"""Records out of a table of crawled pages (page_id, url, html).

Every operator is a projection plus, at most, one ``posexplode``: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import fields
from shelfmark.functions import markup as m
from shelfmark.functions.text import UNKNOWN_AUTHOR, strip, strip_quotes
from shelfmark.operators.splits import Split, split_on

PIPELINE_VERSION = "1.0"


def page_blocks(
    pages: DataFrame,
    tag: str,
    css_class: str | None = None,
    keep: tuple[str, ...] = (),
    balanced: bool = False,
) -> DataFrame:
    """One row per matching element: page_id, url, kept columns, position, block.

    ``balanced``: an element reaches its own end tag, elements of the same name
    inside it included (:func:`markup.balanced_blocks`); otherwise it ends at
    the first end tag of its name.
    """
    read = m.balanced_blocks if balanced else m.blocks
    found = F.expr(read(m.without_scripts("html"), tag, css_class))
    return pages.select("page_id", "url", *keep, F.posexplode(found).alias("position", "block"))


def read_once(df: DataFrame, *fields: str) -> DataFrame:
    """``df.selectExpr(*fields)``, with every field computed once a row, however often later steps use it.

    Catalyst replaces a name in a filter by its whole expression to push the filter down, so each use would
    read the markup again; it pushes nothing that uses a generator's output below the generator.
    """
    return df.selectExpr(f"inline(array(struct({', '.join(fields)})))")


def page_text(pages: DataFrame, tag: str | None = None) -> DataFrame:
    """Text content of the page, or of the first ``tag`` element in it."""
    part = "html" if tag is None else m.inner("html", tag)
    return pages.select("page_id", F.expr(m.text_content(part)).alias("text"))


def block_text(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn("text", F.expr(m.strip(m.plain_text("block"))))


def menu_links(
    pages: DataFrame,
    container: tuple[str, str | None] = ("nav", None),
    nested: bool = False,
    site_root: str | None = None,
) -> DataFrame:
    """Menu entries in order: page_id, position, name, href, url, slug.

    ``nested`` keeps only the links of a list inside the outer list. Links are
    resolved against the page, or appended to ``site_root`` when it is given.
    """
    menu = m.inner(m.without_scripts("html"), *container)
    if nested:
        inner_list = r"(?is)<ul\b[^>]*>.*?<ul\b[^>]*>(.*?)</ul\s*>"
        menu = f"regexp_extract({menu}, {m.quoted(inner_list)}, 1)"
    link = r"(?is)<li\b[^>]*>\s*(<a\b[^>]*>.*?</a\s*>)"
    links = F.expr(f"regexp_extract_all({menu}, {m.quoted(link)}, 1)")
    rows = pages.select(
        "page_id", F.col("url").alias("page_url"), F.posexplode(links).alias("position", "link")
    ).select(
        "page_id",
        "page_url",
        "position",
        F.expr(m.strip(m.plain_text("link"))).alias("name"),
        F.expr(m.or_text(m.attribute("link", "a", "href"), "")).alias("href"),
    )
    url = (
        m.join_url("page_url", "href")
        if site_root is None
        else f"concat({m.quoted(site_root.rstrip('/') + '/')}, href)"
    )
    return rows.select(
        "page_id",
        "position",
        "name",
        "href",
        F.expr(url).alias("url"),
        F.expr(m.menu_slug("name", "href")).alias("slug"),
    )


def next_page(pages: DataFrame, how: str = "resolve", site_root: str = "") -> DataFrame:
    """Address of the following page, NULL at the end of the chain.

    ``resolve`` follows URL rules, ``sibling`` puts the link beside the page,
    ``root`` appends it to ``site_root``.
    """
    href = m.attribute(m.inner(m.without_scripts("html"), "li", "next"), "a", "href")
    target = {
        "resolve": m.join_url("url", "href"),
        "sibling": m.sibling_url("url", "href"),
        "root": f"concat({m.quoted(site_root.rstrip('/'))}, href)",
    }[how]
    found = pages.select("page_id", "url", F.expr(href).alias("href"))
    return found.select("page_id", "url", F.expr(target).alias("next_url"))


# ---------------------------------------------------------------- books


def _stamp(source: str, batch_id: str) -> Column:
    return F.struct(
        F.lit(source).alias("source"),
        F.current_timestamp().alias("scraped_at"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
    ).alias("_metadata")


def book_cards(pages: DataFrame, *, site_root: str, source: str, batch_id: str) -> Split:
    """Bronze books from listing pages (page_id, url, category, html)."""
    cards = page_blocks(pages, "article", "product_pod", keep=("category",))
    # raw field texts first: the second projection uses some of them more than once
    found = read_once(
        cards.withColumn("heading", F.expr(m.inner("block", "h3"))),
        "page_id",
        "position",
        "category",
        f"""coalesce({m.attribute("heading", "a", "title")},
                     {m.strip(m.plain_text(m.inner("heading", "a")))}) as title""",
        f"{m.or_text(m.attribute('heading', 'a', 'href'), '')} as href",
        f"{m.plain_text(m.inner('block', 'p', 'price_color'))} as price",
        f"{m.attribute('block', 'p', 'class', 'star-rating')} as stars",
        f"{m.plain_text(m.inner('block', 'p', 'availability'))} as stock",
        f"{m.or_text(m.attribute('block', 'img', 'src', 'thumbnail'), '')} as image",
    )
    root = site_root.rstrip("/")
    rows = found.select(
        "page_id",
        "position",
        "title",
        F.coalesce(fields.tidy_price(F.col("price")), F.lit("N/A")).alias("price"),
        fields.rating_from_class(F.col("stars")).cast("string").alias("rating"),
        fields.stock_from_text(F.col("stock")).cast("string").alias("availability"),
        "category",
        F.expr(m.rooted_url(root + "/catalogue", "href")).alias("url"),
        F.when(F.col("image") == "", F.lit(""))
        .otherwise(F.expr(m.rooted_url(root, "image")))
        .alias("image_url"),
        _stamp(source, batch_id),
    )
    return split_on(
        rows,
        F.when(F.col("title").isNull(), F.lit("title missing")),
        stage="extract_books",
        key=F.concat_ws("#", "page_id", "position"),
        batch_id=batch_id,
    )


def book_cards_normalised(pages: DataFrame, *, site_root: str, batch_id: str) -> Split:
    """Books of the normalised variant: strict rating, boolean stock, numeric price."""
    cards = page_blocks(pages, "article", "product_pod", keep=("category",))
    price_box = m.inner("block", "div", "product_price")
    found = read_once(
        cards,
        "page_id",
        "position",
        "category",
        f"{m.attribute(m.inner('block', 'h3'), 'a', 'title')} as title",
        f"{m.plain_text(m.inner(price_box, 'p'))} as price",
        f"{m.attribute('block', 'p', 'class', 'star-rating')} as stars",
        f"{m.plain_text(m.inner('block', 'p', 'availability'))} as stock",
        f"{m.attribute('block', 'img', 'src')} as src",
    )
    rows = found.select(
        "page_id",
        "position",
        "title",
        F.when(F.col("price").isNotNull(), fields.first_price(F.col("price"))).alias("price"),
        fields.rating_from_second_class(F.col("stars")).alias("rating"),
        F.when(F.col("stock").isNotNull(), fields.in_stock(F.col("stock"))).alias("availability"),
        strip(F.col("category")).alias("category"),
        F.expr(m.join_url(m.quoted(site_root), "src")).alias("url_image"),
        F.lit(None).cast("binary").alias("image"),
    )
    missing = F.lit(None).cast("string")
    for name in ("availability", "rating", "price", "title"):
        missing = F.when(F.col(name).isNull(), F.lit(f"{name} missing")).otherwise(missing)
    return split_on(
        rows,
        missing,
        stage="extract_books",
        key=F.concat_ws("#", "page_id", "position"),
        batch_id=batch_id,
    )


# --------------------------------------------------------------- quotes


def quote_cards(
    pages: DataFrame, *, site_root: str, source: str, batch_id: str, strict: bool = False
) -> Split:
    """Bronze quotations. ``strict`` rejects a card without text or author."""
    author_link = r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*/author/[^"']*)["']"""
    tag = m.strip(m.plain_text("tag"))
    # a card holds divs of its own: it reaches its own end tag
    found = read_once(
        page_blocks(pages, "div", "quote", balanced=True),
        "page_id",
        "position",
        f"{m.plain_text(m.inner('block', 'span', 'text'))} as text",
        f"{m.strip(m.plain_text(m.inner('block', 'small', 'author')))} as author",
        f"regexp_extract(block, {m.quoted(author_link)}, 1) as link",
        f"transform({m.blocks('block', 'a', 'tag')}, tag -> {tag}) as tags",
    )
    rows = found.select(
        "page_id",
        "position",
        strip_quotes(F.col("text")).alias("text"),
        "author",
        F.when(F.col("link") != "", F.concat(F.lit(site_root.rstrip("/")), F.col("link"))).alias(
            "author_url"
        ),
        "tags",
        _stamp(source, batch_id),
    )
    reason = F.lit(None).cast("string")
    if strict:
        reason = F.when(F.col("text").isNull(), F.lit("text missing")).when(
            F.col("author").isNull(), F.lit("author missing")
        )
    split = split_on(
        rows,
        reason,
        stage="extract_quotes",
        key=F.concat_ws("#", "page_id", "position"),
        batch_id=batch_id,
    )
    return Split(split.good.fillna({"text": "", "author": UNKNOWN_AUTHOR}), split.quarantine)


def with_tag(quotes: DataFrame, tag: str) -> DataFrame:
    return quotes.filter(F.array_contains("tags", tag))


def all_tags(quotes: DataFrame) -> DataFrame:
    return quotes.select(F.explode("tags").alias("tag")).distinct()


# ---------------------------------------------------- caps and statistics


def cap_categories(pages: DataFrame, limit: int | None, position: str = "category_no") -> DataFrame:
    """Pages of the first ``limit`` menu entries (menu positions count from 0)."""
    return pages if limit is None else pages.filter(F.col(position) < limit)


def cap_pages(pages: DataFrame, limit: int | None, *order: str) -> DataFrame:
    """The first ``limit`` pages of the whole crawl; the counter spans categories."""
    return pages if limit is None else pages.orderBy(*order).limit(limit)


def extract_stats(pages: DataFrame, records: DataFrame, quarantine: DataFrame) -> DataFrame:
    """One row: pages, records, errors, unique authors and tags (when present).

    Records are read once: a record counts at its first tag, or at the row that
    stands for a record without tags.
    """
    figures = {"records": F.count("*")}
    if "tags" in records.columns:
        records = records.select("*", F.posexplode_outer("tags").alias("tag_no", "tag"))
        figures["records"] = F.count_if(F.coalesce("tag_no", F.lit(0)) == 0)
        figures["unique_tags"] = F.countDistinct("tag")
    if "author" in records.columns:
        figures["unique_authors"] = F.countDistinct("author")
    counted = records.select(F.struct(*[v.alias(k) for k, v in figures.items()])).scalar()
    row = pages.sparkSession.range(0, 1, 1, 1).select(
        pages.select(F.count("*")).scalar().alias("pages"),
        counted.alias("r"),
        quarantine.select(F.count("*")).scalar().alias("errors"),
    )
    return row.select("pages", "r.records", "errors", *[f"r.{k}" for k in figures if k != "records"])
