"""Records, links and text out of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import bindings as b
from shelfmark.functions import markup as m
from shelfmark.operators import pages as pg
from shelfmark.registry.base import query, sql_strip
from shelfmark.registry.cleaning import BATCH

SITE = "https://books.example.org"
QUOTES_SITE = "https://quotes.example.org"

_CLEAN = (
    "regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>"
    "|<!--.*?-->', '', 'g')"
)


def _decoded(x: str) -> str:
    """The references that occur in the pages; the ampersand last."""
    for ref, char in (
        ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
        ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&"),
    ):
        x = f"replace({x}, '{ref}', '{char}')"
    return x


def _text(x: str) -> str:
    return _decoded(f"regexp_replace({x}, '<[^>]*>', '', 'g')")


@query(
    "menu_links",
    f"""
with menu as (
  select page_id, url as page_url,
         regexp_extract_all(regexp_extract({_CLEAN}, '(?is)<nav[^>]*>(.*?)</nav>', 1),
                            '(?is)<li[^>]*>\\s*(<a\\b[^>]*>.*?</a>)', 1) as links
  from pages),
links as (select page_id, page_url, unnest(links) as link, generate_subscripts(links, 1) - 1 as position
          from menu),
fields as (
  select page_id, page_url, position, {sql_strip(_text('link'))} as name,
         {_decoded("regexp_extract(link, 'href=\"([^\"]*)\"', 1)")} as href from links)
select page_id, position, name, href,
       regexp_extract(page_url, '^([a-z]+://[^/?#]*)', 1) || href as url,
       case when contains(href, '/') then string_split(href, '/')[-2]
            else lower(replace(name, ' ', '-')) end as slug
from fields""",
)
def menu_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.menu_links(b.table(spark, sf_dir, "pages"))


@query(
    "page_blocks",
    f"""
with found as (
  select page_id, regexp_extract_all({_CLEAN}, '(?is)<p(?:\\s[^>]*)?>(.*?)</p\\s*>', 1) as blocks from pages)
select page_id, position, {sql_strip(_text('block'))} as text
from (select page_id, unnest(blocks) as block, generate_subscripts(blocks, 1) - 1 as position from found)""",
)
def page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = pg.page_blocks(b.table(spark, sf_dir, "pages"), "p")
    return pg.block_text(blocks).select("page_id", "position", "text")


@query(
    "page_blocks_nested",
    f"""
with pg as (
  select page_id, string_split(regexp_replace({_CLEAN}, '(?i)(</?div(?:[\\s/][^>]*)?>)', chr(1) || '\\1' || chr(1), 'g'), chr(1)) as p
  from pages),
pc as (select page_id, unnest(p) as piece, generate_subscripts(p, 1) as i from pg),
k as (select *, case when piece like '</%' then -1
                     when regexp_matches(piece, '(?is)^<div(?:[\\s/][^>]*)?>$') and piece not like '%/>' then 1 else 0 end as kind
      from pc),
d as (select *, sum(kind) over (partition by page_id order by i) as depth from k),
ends as (select o.page_id, o.i, min(c.i) as j from d o join d c on c.page_id = o.page_id and c.i > o.i
         and c.kind = -1 and c.depth = o.depth - 1 where o.kind = 1 group by o.page_id, o.i),
blocks as (select e.page_id, e.i, coalesce(string_agg(x.piece, '' order by x.i), '') as block
           from ends e left join d x on x.page_id = e.page_id and x.i > e.i and x.i < e.j group by e.page_id, e.i)
select page_id, (row_number() over (partition by page_id order by i) - 1)::int as position, {sql_strip(_text('block'))} as text
from blocks""",
)
def page_blocks_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every div up to its own end tag, divs inside it included."""
    blocks = pg.page_blocks(b.table(spark, sf_dir, "pages"), "div", balanced=True)
    return pg.block_text(blocks).select("page_id", "position", "text")


@query(
    "page_headings",
    f"""
select page_id,
       {_text("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} as heading,
       {_text("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} as title,
       regexp_extract(html, '<html lang="([^"]*)"', 1) as lang
from pages""",
)
def page_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "pages").selectExpr(
        "page_id",
        f"{m.text_content(m.inner('html', 'h1'))} as heading",
        f"{m.text_content(m.inner('html', 'title'))} as title",
        f"{m.attribute('html', 'html', 'lang')} as lang",
    )


@query("page_text", f"select page_id, {_text(_CLEAN)} as text from pages")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.page_text(b.table(spark, sf_dir, "pages"))


_ROOT = "https://site.example.org"


@query(
    "resolved_urls",
    f"""
with p as (select page_id, url, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) as origin,
                  regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '[^/]*$', '') as folder
           from pages)
select page_id, origin || folder || 'a.html' as beside, origin || '/a/b.html?c' as rooted,
       origin || regexp_replace(folder, '[^/]+/$', '') || 'x' as above,
       regexp_extract(url, '^([a-z]+:)', 1) || '//cdn.example.net/i.png' as other_host,
       'https://abs.example.net/z' as absolute, '{_ROOT}/media/i.jpg' as site_root,
       regexp_replace(url, '[?#].*$', '') || '?page=3' as query_only
from p""",
)
def resolved_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(href: str) -> Column:
        return F.expr(m.join_url("url", m.quoted(href)))

    return b.table(spark, sf_dir, "pages").select(
        "page_id",
        joined("./a.html").alias("beside"),
        joined("/a/b.html?c").alias("rooted"),
        joined("../x").alias("above"),
        joined("//cdn.example.net/i.png").alias("other_host"),
        joined("https://abs.example.net/z").alias("absolute"),
        F.expr(m.rooted_url(_ROOT, m.quoted("../../media/i.jpg"))).alias("site_root"),
        joined("?page=3").alias("query_only"),
    )


# ------------------------------------------- pages made from the tables


def _escaped(col: Column) -> Column:
    for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        col = F.replace(col, F.lit(char), F.lit(ref))
    return col


def _fmt(template: str, *args: Column) -> Column:
    return F.format_string(template, *args)


def book_pages(part: DataFrame) -> DataFrame:
    """A listing page per part: its card, at times a broken card, at times a next link."""
    # a page takes far longer to read than its row is wide: a small file of few row groups would leave most cores idle
    part = part.repartition(4 * part.sparkSession.sparkContext.defaultParallelism)
    key = F.col("p_partkey")
    words = F.array(*[F.lit(w) for w in ("One", "Two", "Three", "Four", "Five", "Zero")])
    title = F.when(b.every("p_partkey", 7), F.lit("")).otherwise(
        _fmt(' title="%s &amp; Co"', F.col("p_name"))
    )
    stock = F.when(b.every("p_partkey", 9), F.lit("In stock")).otherwise(
        _fmt("In stock (%d available)", F.col("p_size"))
    )
    card = _fmt(
        '<li><article class="product_pod"><div class="image_container"><a href="x"><img src="../media/%d.jpg"'
        ' class="thumbnail"></a></div><p class="star-rating %s"></p><h3><a href="../item_%d/index.html"%s>%s'
        '</a></h3><div class="product_price"><p class="price_color">Â£%s</p><p class="instock availability">\n'
        " %s \n</p></div></article></li>",
        key,
        F.get(words, (key % 6).cast("int")),
        key,
        title,
        F.col("p_name"),
        F.col("p_retailprice").cast("decimal(10,2)").cast("string"),
        stock,
    )
    broken = F.when(
        b.every("p_partkey", 10), F.lit('<article class="product_pod"><p>sold</p></article>')
    ).otherwise(F.lit(""))
    following = F.when(
        b.every("p_partkey", 4), _fmt('<ul><li class="next"><a href="page-%d.html">n</a></li></ul>', key + 1)
    ).otherwise(F.lit(""))
    return part.select(
        key.alias("page_id"),
        _fmt(SITE + "/catalogue/category/page-%d.html", key).alias("url"),
        F.col("p_type").alias("category"),
        (F.col("p_size") % 10).alias("category_no"),
        F.concat(
            F.lit('<html><script>var x="<article class=\\"product_pod\\">";</script><ol>'),
            broken,
            card,
            F.lit("</ol>"),
            following,
            F.lit("</html>"),
        ).alias("html"),
    )


@query(
    "book_cards",
    f"""
select p_partkey as page_id, case when p_partkey % 10 = 0 then 1 else 0 end as position,
       case when p_partkey % 7 = 0 then p_name else p_name || ' & Co' end as title,
       '£' || cast(cast(p_retailprice as decimal(10,2)) as varchar) as price,
       ['1', '2', '3', '4', '5', '0'][p_partkey % 6 + 1] as rating,
       case when p_partkey % 9 = 0 then '1' else cast(p_size as varchar) end as availability,
       p_type as category, '{SITE}/catalogue/item_' || p_partkey || '/index.html' as url,
       '{SITE}/media/' || p_partkey || '.jpg' as image_url
from part""",
)
def book_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = pg.book_cards(
        book_pages(b.table(spark, sf_dir, "part")), site_root=SITE, source="books", batch_id=BATCH
    )
    return split.good.drop("_metadata")


@query(
    "book_cards_quarantine",
    f"""
select 'extract_books' as stage, p_partkey || '#0' as key, 'title missing' as reason,
       '{BATCH}' as batch_id from part where p_partkey % 10 = 0""",
)
def book_cards_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.book_cards(
        book_pages(b.table(spark, sf_dir, "part")), site_root=SITE, source="books", batch_id=BATCH
    ).quarantine


@query(
    "book_cards_normalised",
    f"""
select p_partkey as page_id, p_name || ' & Co' as title,
       cast(cast(p_retailprice as decimal(10,2)) as double) as price, p_partkey % 6 + 1 as rating,
       'true' as availability, p_type as category, '{SITE}/media/' || p_partkey || '.jpg' as url_image
from part where p_partkey % 7 <> 0 and p_partkey % 6 <> 5""",
)
def book_cards_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = pg.book_cards_normalised(
        book_pages(b.table(spark, sf_dir, "part")), site_root=SITE + "/", batch_id=BATCH
    )
    return split.good.drop("position", "image")


@query(
    "next_page",
    f"""
select p_partkey as page_id,
       case when p_partkey % 4 = 0 then '{SITE}/catalogue/category/page-' || (p_partkey + 1) || '.html' end
         as next_url
from part""",
)
def next_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = book_pages(b.table(spark, sf_dir, "part"))
    resolved = pg.next_page(pages).select("page_id", "next_url")
    beside = pg.next_page(pages, "sibling").select("page_id", F.col("next_url").alias("other"))
    return resolved.join(beside, "page_id").select(
        "page_id", F.when(F.col("next_url").eqNullSafe(F.col("other")), F.col("next_url")).alias("next_url")
    )


@query(
    "page_caps",
    """
select p_partkey as page_id, 'categories' as cap from part where p_size % 10 < 2
union all
select * from (select p_partkey, 'pages' from part order by p_size % 10, p_partkey limit 20)""",
)
def page_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = book_pages(b.table(spark, sf_dir, "part"))
    by_category = pg.cap_categories(pages, 2).select("page_id", F.lit("categories").alias("cap"))
    by_count = pg.cap_pages(pages, 20, "category_no", "page_id")
    return by_category.unionByName(by_count.select("page_id", F.lit("pages").alias("cap")))


def quote_pages(documents: DataFrame) -> DataFrame:
    """A page per document that shows its whole text as a quotation."""
    author = F.when(
        ~b.every("doc_id", 8), F.concat(F.lit('<small class="author"> '), "source", F.lit("</small>"))
    ).otherwise(F.lit(""))
    link = F.when(
        ~b.every("doc_id", 6), F.concat(F.lit('<a href="/author/'), "source", F.lit('">(about)</a>'))
    ).otherwise(F.lit(""))
    tags = F.when(b.every("doc_id", 5), F.lit("")).otherwise(
        F.concat(
            F.lit('<a class="tag" href="/tag/x">'), "lang", F.lit('</a> <a class="tag" href="/tag/y"> '),
            "source", F.lit(" </a>"),
        )
    )
    mark = F.when(b.every("doc_id", 2), F.array(F.lit("«"), F.lit("»"))).otherwise(
        F.array(F.lit("&quot;"), F.lit("&quot;"))
    )
    return documents.select(
        F.col("doc_id").alias("page_id"),
        F.concat(F.lit(QUOTES_SITE + "/page/"), "doc_id", F.lit("/")).alias("url"),
        F.concat(
            F.lit('<html><body><div class="col"><!-- <div class="quote">old</div> --></div>'),
            F.lit('<div class="quote" itemscope><span class="text" itemprop="text"> '),
            mark[0],
            _escaped(F.col("text")),
            mark[1],
            F.lit("</span><span>by "),
            author,
            link,
            F.lit('</span><div class="tags">Tags: '),
            tags,
            F.lit("</div></div></body></html>"),
        ).alias("html"),
    )


@query(
    "quote_cards",
    f"""
select doc_id as page_id, 0 as position, {sql_strip('text')} as text,
       case when doc_id % 8 <> 0 then source else 'Unknown' end as author,
       case when doc_id % 6 <> 0 then '{QUOTES_SITE}/author/' || source end as author_url,
       case when doc_id % 5 <> 0 then lang || '|' || source else '' end as tags
from documents""",
)
def quote_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = pg.quote_cards(
        quote_pages(b.table(spark, sf_dir, "documents")),
        site_root=QUOTES_SITE,
        source="quotes",
        batch_id=BATCH,
    )
    return split.good.drop("_metadata")


def _quotes(spark: SparkSession, sf_dir: str, strict: bool = False):
    pages = quote_pages(b.table(spark, sf_dir, "documents"))
    return pages, pg.quote_cards(
        pages, site_root=QUOTES_SITE, source="quotes", batch_id=BATCH, strict=strict
    )


@query(
    "quotes_with_tag",
    "select doc_id as page_id, source as author from documents "
    "where doc_id % 5 <> 0 and lang = 'fr' and doc_id % 8 <> 0 "
    "union all select doc_id, 'Unknown' from documents "
    "where doc_id % 5 <> 0 and lang = 'fr' and doc_id % 8 = 0",
)
def quotes_with_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.with_tag(_quotes(spark, sf_dir)[1].good, "fr").select("page_id", "author")


@query(
    "all_tags",
    """
select lang as tag from documents where doc_id % 5 <> 0
union select source from documents where doc_id % 5 <> 0""",
)
def all_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.all_tags(_quotes(spark, sf_dir)[1].good)


@query(
    "extract_stats",
    """
select (select count(*) from documents) as pages,
       (select count(*) from documents where doc_id % 8 <> 0) as records,
       (select count(*) from documents where doc_id % 8 = 0) as errors,
       (select count(distinct source) from documents where doc_id % 8 <> 0) as unique_authors,
       (select count(distinct t) from
          (select lang as t from documents where doc_id % 5 <> 0 and doc_id % 8 <> 0
           union all select source from documents where doc_id % 5 <> 0 and doc_id % 8 <> 0)) as unique_tags""",
)
def extract_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, split = _quotes(spark, sf_dir, strict=True)
    return pg.extract_stats(pages, split.good, split.quarantine)
