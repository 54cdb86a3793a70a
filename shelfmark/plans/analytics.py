"""Analytic queries over the star schema and the normalised tables.

Each function takes a mapping of table name to DataFrame. Aggregates run on the
fact key before any dimension is joined, so a hot key is combined map-side and
only one row per key is shuffled. Descending orders put NULL first and every
order ends in a unique column, as the relational layer this replaces does.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfmark.functions.text import excerpt
from shelfmark.session import broadcast_if_small, literal_rows, pinned

Tables = Mapping[str, DataFrame]

# fixed values: shop specialty -> prefixes of book categories
SPECIALTY_CATEGORIES: dict[str, tuple[str, ...]] = {
    "Littérature": ("Fiction", "Poetry", "Classics", "Romance"),
    "Sciences humaines": ("Philosophy", "Psychology", "History", "Politics"),
    "Jeunesse": ("Childrens", "Young Adult", "Fantasy"),
    "Sciences": ("Science", "Technology", "Mathematics"),
    "Art": ("Art", "Music", "Photography"),
    "Voyage": ("Travel", "Geography"),
    "BD et Manga": ("Sequential Art", "Graphic Novels", "Comics"),
}
DEFAULT_CATEGORIES = ("Fiction",)

# fixed values: wording of the data-quality report
OK, ATTENTION = "OK", "ATTENTION"

# fixed values: display headings of the printed reports
HEADINGS: dict[str, dict[str, str]] = {
    "category_stats": {
        "categorie": "Catégorie",
        "nb_livres": "Nombre de livres",
        "prix_moyen": "Prix moyen (€)",
        "note_moyenne": "Note moyenne",
        "prix_min": "Prix min (€)",
        "prix_max": "Prix max (€)",
        "stock_total": "Stock total",
    },
    "quote_tags_excerpt": {
        "auteur": "Auteur",
        "extrait": "Citation (extrait)",
        "longueur": "Longueur",
        "nb_tags": "Nombre de tags",
        "tags": "Tags",
    },
    "price_window": {
        "categorie": "Catégorie",
        "titre": "Titre",
        "prix": "Prix (€)",
        "note": "Note",
        "rang": "Rang prix (catégorie)",
        "ecart_moyen": "Écart prix moyen (€)",
        "percentile": "Percentile prix (%)",
        "prix_cumule": "Prix cumulé (€)",
    },
    "author_profile": {
        "auteur": "Auteur",
        "nb_citations": "Nombre de citations",
        "longueur_moyenne": "Longueur moyenne",
        "plus_courte": "Plus courte",
        "plus_longue": "Plus longue",
        "tags": "Tags principaux",
    },
    "opportunity_score": {
        "librairie": "Librairie",
        "ville": "Ville",
        "specialite": "Spécialité",
        "categorie": "Catégorie suggérée",
        "nb_livres": "Livres disponibles",
        "prix_moyen": "Prix moyen (€)",
        "stock_total": "Stock total",
        "score": "Score opportunité",
    },
    "dq_report": {"controle": "Contrôle", "nombre": "Nombre", "statut": "Statut"},
}


def with_headings(df: DataFrame, report: str) -> DataFrame:
    """Rename the columns of a report to its printed headings."""
    names = HEADINGS[report]
    return df.select(*[F.col(c).alias(names[c]) for c in names if c in df.columns])


def _mean(col: Column, scale: int = 2) -> Column:
    """Exact decimal mean, rounded half up."""
    return F.round(F.avg(col.cast("decimal(10,2)")), scale)


def _listed(tags: str) -> Column:
    return F.array_join(F.array_sort(F.col(tags)), ", ")


# -------------------------------------------------------------- categories


def _category_aggregate(books: DataFrame) -> DataFrame:
    return books.groupBy("category_id").agg(
        F.count("book_id").alias("nb"),
        _mean(F.col("price_eur")).alias("avg_price"),
        _mean(F.col("rating")).alias("avg_rating"),
        F.min("price_eur").alias("min_price"),
        F.max("price_eur").alias("max_price"),
        F.sum("availability").alias("stock"),
    )


def category_stats(t: Tables) -> DataFrame:
    """Figures of every category that has books, largest first."""
    stats = _category_aggregate(t["fact_books"])
    return (
        t["dim_categories"]
        .join(stats, "category_id")
        .filter("nb > 0")
        .select(
            F.col("category_name").alias("categorie"),
            F.col("nb").alias("nb_livres"),
            F.col("avg_price").alias("prix_moyen"),
            F.col("avg_rating").alias("note_moyenne"),
            F.col("min_price").alias("prix_min"),
            F.col("max_price").alias("prix_max"),
            F.col("stock").alias("stock_total"),
        )
        .orderBy(F.desc_nulls_first("nb_livres"), F.asc_nulls_last("categorie"))
    )


def category_stats_all(t: Tables) -> DataFrame:
    """View: figures of all categories, empty ones included."""
    stats = _category_aggregate(t["fact_books"])
    return (
        t["dim_categories"]
        .join(stats, "category_id", "left")
        .select(
            "category_name",
            F.coalesce("nb", F.lit(0)).alias("nb_books"),
            F.col("avg_price").alias("avg_price_eur"),
            "avg_rating",
            "min_price",
            "max_price",
        )
        .orderBy(F.desc_nulls_first("nb_books"), F.asc_nulls_last("category_name"))
    )


# ------------------------------------------------------------------ prices


def _price_order() -> tuple[Column, Column]:
    return F.desc_nulls_first("prix"), F.asc("book_id")


def _priced(t: Tables) -> DataFrame:
    books = t["fact_books"].select(
        "book_id", "category_id", F.col("title").alias("titre"), F.col("price_eur").alias("prix"),
        F.col("rating").alias("note"),
    )
    names = t["dim_categories"].select("category_id", F.col("category_name").alias("categorie"))
    return books.join(broadcast_if_small(names), "category_id")


def _price_columns(df: DataFrame) -> DataFrame:
    """Report columns from rang, n (books), below (cheaper books), mean and cumulated price."""
    share = F.when(F.col("n") > 1, F.col("below") / (F.col("n") - 1)).otherwise(F.lit(0.0))
    return df.select(
        "book_id",
        "categorie",
        "titre",
        "prix",
        "note",
        F.col("rang").cast("bigint").alias("rang"),
        F.round(F.col("prix") - F.col("mean"), 2).cast("decimal(12,2)").alias("ecart_moyen"),
        F.round((share * 100).cast("decimal(12,6)"), 1).cast("decimal(5,1)").alias("percentile"),
        F.col("cumul").cast("decimal(20,2)").alias("prix_cumule"),
    )


def _category_means(priced: DataFrame) -> DataFrame:
    return priced.groupBy("categorie").agg(
        F.count("*").alias("n"),
        F.count("prix").alias("n_priced"),
        F.avg("prix").alias("mean"),
    )


def price_window(t: Tables, limit: int = 20) -> DataFrame:
    """Price rank, gap to the category mean, percentile and running total; first rows.

    The report shows the head of (category, rank, id), so the head is cut first
    by a distributed top-k. It is a prefix of each category it touches, which
    makes ranks and running totals over those few rows exact; category means
    and the number of cheaper books are aggregates that combine map-side.
    """
    priced = _priced(t)
    head = pinned(
        priced.orderBy(F.asc_nulls_last("categorie"), *_price_order()).limit(limit)
    )
    shown = head.select("categorie").distinct()
    levels = head.select("categorie", "prix").distinct()
    # ``limit`` rows at most: a fixed, small side to broadcast
    members = priced.select("categorie", "prix").join(F.broadcast(shown), "categorie", "left_semi")
    means = _category_means(members)
    same = F.col("m.categorie") == F.col("l.categorie")
    cheaper = (
        members.alias("m")
        .groupBy("categorie", "prix")
        .agg(F.count("*").alias("c"))
        .alias("m")
        .join(F.broadcast(levels).alias("l"), same)
        .groupBy(F.col("l.categorie").alias("categorie"), F.col("l.prix").alias("prix"))
        .agg(
            F.sum(
                F.when(
                    F.col("l.prix").isNull(), F.when(F.col("m.prix").isNotNull(), F.col("c"))
                ).otherwise(F.when(F.col("m.prix") < F.col("l.prix"), F.col("c")))
            ).alias("below")
        )
    )
    by_price = W.partitionBy("categorie").orderBy(F.desc_nulls_first("prix"))
    running = (
        W.partitionBy("categorie")
        .orderBy(*_price_order())
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    ranked = head.select(
        "*", F.rank().over(by_price).alias("rang"), F.sum("prix").over(running).alias("cumul")
    )
    h, c = ranked.alias("h"), cheaper.alias("c")
    joined = (
        h.join(
            c,
            (F.col("h.categorie") == F.col("c.categorie"))
            & F.col("h.prix").eqNullSafe(F.col("c.prix")),
        )
        .select("h.*", F.coalesce("c.below", F.lit(0)).alias("below"))
        .join(means, "categorie")
    )
    return _price_columns(joined).orderBy(
        F.asc_nulls_last("categorie"), "rang", "book_id"
    )


def price_window_full(t: Tables) -> DataFrame:
    """The same columns for every book.

    No window spans a category. Rows are range-partitioned by (category, price,
    id), which splits a hot category, and even a hot price, over many tasks.
    Each task ranks its own slice; what lies before a slice is added from one
    row per (slice, category).
    """
    priced = _priced(t)
    means = _category_means(priced)
    order = [F.asc_nulls_last("categorie"), *_price_order()]
    rows = pinned(
        priced.repartitionByRange(*order).withColumn("slice", F.spark_partition_id())
    )
    # one row per (slice, category): what lies before each slice
    before = W.partitionBy("categorie").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    slices = rows.groupBy("categorie", "slice").agg(
        F.count("*").alias("c"), F.sum("prix").alias("s")
    )
    starts = slices.select(
        "categorie",
        "slice",
        F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c0"),
        F.sum("s").over(before).alias("s0"),
    )
    local = W.partitionBy("categorie", "slice").orderBy(*_price_order())
    running = local.rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = (
        rows.select(
            "*", F.row_number().over(local).alias("rn"), F.sum("prix").over(running).alias("s1")
        )
        .join(broadcast_if_small(starts), ["categorie", "slice"])
        .select(
            *priced.columns,
            (F.col("rn") + F.col("c0")).alias("pos"),
            F.when(
                F.col("s0").isNotNull() | F.col("s1").isNotNull(),
                F.coalesce("s0", F.lit(0)) + F.coalesce("s1", F.lit(0)),
            ).alias("cumul"),
        )
    )
    ties = placed.groupBy("categorie", "prix").agg(
        F.min("pos").alias("rang"), F.count("*").alias("same")
    )
    p, q = placed.alias("p"), ties.alias("q")
    joined = (
        p.join(
            q,
            (F.col("p.categorie") == F.col("q.categorie"))
            & F.col("p.prix").eqNullSafe(F.col("q.prix")),
        )
        .select("p.*", "q.rang", "q.same")
        .join(broadcast_if_small(means), "categorie")
        .withColumn(
            "below",
            F.when(F.col("prix").isNull(), F.col("n_priced")).otherwise(
                F.col("n") - F.col("rang") + 1 - F.col("same")
            ),
        )
    )
    return _price_columns(joined)


def price_levels(books: DataFrame, n: int) -> DataFrame:
    """The price levels of each category that hold a book of rank <= ``n``, with that rank."""
    levels = books.groupBy("category_id", "price_eur").agg(F.count("*").alias("c"))
    by_price = W.partitionBy("category_id").orderBy(F.desc_nulls_first("price_eur"))
    dearest = levels.withColumn("_level", F.dense_rank().over(by_price)).filter(F.col("_level") <= n)
    before = by_price.rowsBetween(W.unboundedPreceding, -1)
    return dearest.withColumn("rang", F.coalesce(F.sum("c").over(before), F.lit(0)) + 1).filter(
        F.col("rang") <= n
    )


def top_per_category(t: Tables, n: int = 3) -> DataFrame:
    """Dearest books of each category, rank <= ``n``, ties kept.

    At most ``n`` price levels per category can qualify, so levels are ranked
    first, on one row per (category, price); the books then join the few levels
    that made it. A level shared by very many books never sits in one window.
    """
    books = t["fact_books"].select("book_id", "category_id", "title", "price_eur")
    ranked = (
        price_levels(books, n)
        .join(t["dim_categories"].select("category_id", "category_name"), "category_id")
        .select("category_id", F.col("price_eur").alias("_price"), "rang", "category_name")
    )
    same = (F.col("b.category_id") == F.col("r.category_id")) & F.col("b.price_eur").eqNullSafe(
        F.col("r._price")
    )
    return (
        books.alias("b")
        .join(broadcast_if_small(ranked).alias("r"), same)
        .select(
            "b.book_id",
            F.col("r.category_name").alias("categorie"),
            F.col("b.title").alias("titre"),
            F.col("b.price_eur").alias("prix"),
            F.col("r.rang").cast("bigint").alias("rang"),
        )
        .orderBy(F.asc_nulls_last("categorie"), "rang", "book_id")
    )


# ------------------------------------------------------------------ quotes


def quote_tags_excerpt(t: Tables, limit: int = 15, length: int = 80) -> DataFrame:
    """Quotations with the most tags: excerpt, length, tag count and ordered tag list.

    Counting moves keys only. Text and tag names are fetched for the ``limit``
    winners alone.
    """
    counts = t["quote_tags"].groupBy("quote_id").agg(F.count("tag_id").alias("nb_tags"))
    authors = t["dim_authors"].select("author_id", "author_name")
    top = pinned(
        t["fact_quotes"]
        .select("quote_id", "author_id")
        .join(counts, "quote_id", "left")
        .join(authors, "author_id")
        .select(
            "quote_id",
            F.col("author_name").alias("auteur"),
            F.coalesce("nb_tags", F.lit(0)).alias("nb_tags"),
        )
        .orderBy(F.desc("nb_tags"), F.asc_nulls_last("auteur"), "quote_id")
        .limit(limit)
    )
    # ``limit`` rows at most: a fixed, small side to broadcast
    ids = F.broadcast(top.select("quote_id"))
    names = (
        t["quote_tags"]
        .join(ids, "quote_id", "left_semi")
        .join(t["dim_tags"].select("tag_id", "tag_name"), "tag_id")
        .groupBy("quote_id")
        .agg(F.collect_list("tag_name").alias("_tags"))
        .select("quote_id", _listed("_tags").alias("tags"))
    )
    texts = t["fact_quotes"].select("quote_id", "quote_text").join(ids, "quote_id", "left_semi")
    return (
        top.join(texts, "quote_id")
        .join(names, "quote_id", "left")
        .select(
            "quote_id",
            "auteur",
            excerpt(F.col("quote_text"), length).alias("extrait"),
            F.length("quote_text").alias("longueur"),
            "nb_tags",
            "tags",
        )
        .orderBy(F.desc("nb_tags"), F.asc_nulls_last("auteur"), "quote_id")
    )


def author_profile(t: Tables, limit: int = 10) -> DataFrame:
    """Authors with the largest stored counter: text lengths and distinct tags used."""
    lengths = t["fact_quotes"].groupBy("author_id").agg(
        _mean(F.length("quote_text"), 0).alias("longueur_moyenne"),
        F.min(F.length("quote_text")).alias("plus_courte"),
        F.max(F.length("quote_text")).alias("plus_longue"),
    )
    order = (F.desc_nulls_first("nb_citations"), F.asc("author_id"))
    top = pinned(
        t["dim_authors"]
        .select("author_id", F.col("author_name").alias("auteur"), F.col("quote_count").alias("nb_citations"))
        .join(lengths, "author_id")
        .orderBy(*order)
        .limit(limit)
    )
    # ``limit`` rows at most: a fixed, small side to broadcast
    theirs = (
        t["fact_quotes"]
        .select("quote_id", "author_id")
        .join(F.broadcast(top.select("author_id")), "author_id", "left_semi")
    )
    tags = (
        t["quote_tags"]
        .join(theirs, "quote_id")
        .select("author_id", "tag_id")
        .distinct()
        .join(t["dim_tags"].select("tag_id", "tag_name"), "tag_id")
        .groupBy("author_id")
        .agg(F.collect_set("tag_name").alias("_tags"))
        .select("author_id", _listed("_tags").alias("tags"))
    )
    return top.join(tags, "author_id", "left").orderBy(*order)


def top_authors_view(t: Tables) -> DataFrame:
    """View: per author the joined rows, the quotations and the distinct tags used.

    ``nb_quotes`` counts one row per (quotation, tag), as the view always did;
    ``nb_quotes_distinct`` counts quotations. A quotation without tags adds a
    NULL to the array. Rows are combined per (author, tag) before an author's
    tags meet.
    """
    rows = (
        t["fact_quotes"]
        .select("quote_id", "author_id")
        .join(t["quote_tags"], "quote_id", "left")
        .groupBy("author_id", "tag_id")
        .agg(F.count("*").alias("n"))
    )
    named = rows.join(t["dim_tags"].select("tag_id", "tag_name"), "tag_id", "left")
    per_author = named.groupBy("author_id").agg(
        F.sum("n").alias("nb_quotes"),
        F.array_sort(F.collect_set("tag_name")).alias("_tags"),
        F.bool_or(F.col("tag_name").isNull()).alias("_untagged"),
    )
    quotes = t["fact_quotes"].groupBy("author_id").agg(F.count("*").alias("nb_quotes_distinct"))
    with_null = F.concat(F.col("_tags"), F.array(F.lit(None).cast("string")))
    return (
        t["dim_authors"]
        .select("author_id", "author_name")
        .join(per_author, "author_id")
        .join(quotes, "author_id")
        .select(
            "author_id",
            "author_name",
            "nb_quotes",
            "nb_quotes_distinct",
            F.when(F.col("_untagged"), with_null).otherwise(F.col("_tags")).alias("tags_used"),
        )
        .orderBy(F.desc("nb_quotes"), "author_id")
    )


def top_authors_counter(t: Tables, limit: int = 5) -> DataFrame:
    return (
        t["dim_authors"]
        .select("author_id", "author_name", "quote_count")
        .orderBy(F.desc_nulls_first("quote_count"), "author_id")
        .limit(limit)
    )


# ------------------------------------------------------------------- shops


def opportunity_score(
    t: Tables,
    mapping: Mapping[str, Iterable[str]] = SPECIALTY_CATEGORIES,
    default: Iterable[str] = DEFAULT_CATEGORIES,
    limit: int | None = 20,
    link_on_name: bool = False,
) -> DataFrame:
    """Shops matched with the categories their specialty suggests, best score first.

    Statistics and category names are matched to a prefix independently, so k
    matching categories give k x k rows; ``link_on_name`` ties the two together.
    Prefixes meet categories, never shops: the mapping literal is a fixed handful
    of rows, which is the side that is broadcast.
    """
    shops = t["dim_librairies"]
    spark = shops.sparkSession
    known = dict(mapping)
    entries = [(s, p) for s, ps in known.items() for p in ps] + [(None, p) for p in default]
    prefixes = literal_rows(spark, entries, "groupe string, prefixe string")

    books = t["fact_books"].groupBy("category_id").agg(
        F.count("*").alias("nb_livres"),
        F.sum("price_eur").alias("_sum"),
        F.count("price_eur").alias("_n"),
        F.sum("availability").alias("stock_total"),
    )
    names = t["dim_categories"].select("category_id", "category_name")
    stats = (
        books.join(names, "category_id")
        .groupBy("category_name")
        .agg(
            F.sum("nb_livres").alias("nb_livres"),
            (F.sum("_sum") / F.sum("_n")).cast("decimal(20,6)").alias("_mean"),
            F.sum("stock_total").alias("stock_total"),
        )
        .select(
            F.col("category_name").alias("_stat_name"),
            "nb_livres",
            F.round("_mean", 2).alias("prix_moyen"),
            "stock_total",
        )
    )

    def matches(name: str) -> Column:
        return F.ilike(F.col(name), F.concat(F.col("prefixe"), F.lit("%")))

    suggested = F.broadcast(prefixes).join(stats, matches("_stat_name"))
    category = names.select(F.col("category_name").alias("categorie"))
    if link_on_name:
        suggested = suggested.withColumn("categorie", F.col("_stat_name"))
    else:
        # both sides are one row per category and prefix
        other = F.broadcast(prefixes).join(category, matches("categorie"))
        suggested = suggested.alias("s").join(
            other.alias("o"),
            F.col("s.groupe").eqNullSafe(F.col("o.groupe"))
            & (F.col("s.prefixe") == F.col("o.prefixe")),
        ).select("s.*", "o.categorie")
    score = F.round(
        F.col("stock_total").cast("decimal(20,0)")
        / F.nullif(F.col("prix_moyen"), F.lit(0).cast("decimal(10,2)"))
        * 10,
        2,
    )
    suggested = suggested.select(
        "groupe",
        "categorie",
        "nb_livres",
        "prix_moyen",
        "stock_total",
        score.cast("decimal(20,2)").alias("score"),
    )
    groupe = F.when(F.col("specialite").isin(list(known)), F.col("specialite"))
    wanted = shops.select("librairie_id", "nom", "ville", "specialite", groupe.alias("_groupe"))
    # few groups, many shops: shuffling on the group would leave most tasks idle
    out = wanted.join(
        broadcast_if_small(suggested), F.col("_groupe").eqNullSafe(F.col("groupe"))
    ).select(
        "librairie_id",
        F.col("nom").alias("librairie"),
        "ville",
        "specialite",
        "categorie",
        "nb_livres",
        "prix_moyen",
        "stock_total",
        "score",
    )
    if limit is None:
        return out
    return out.orderBy(
        F.desc_nulls_first("score"),
        F.asc_nulls_last("librairie"),
        "librairie_id",
        "categorie",
        "nb_livres",
    ).limit(limit)


def _distinct_specialties(shops: DataFrame) -> DataFrame:
    """Sorted distinct specialties per city, NULL last when any shop has none."""
    pairs = shops.select("ville", "specialite").distinct()
    listed = F.array_sort(F.collect_set("specialite"))
    with_null = F.concat(listed, F.array(F.lit(None).cast("string")))
    return pairs.groupBy("ville").agg(
        F.when(F.bool_or(F.col("specialite").isNull()), with_null)
        .otherwise(listed)
        .alias("specialites")
    )


def _same_city(left: DataFrame, right: DataFrame) -> DataFrame:
    r = right.withColumnRenamed("ville", "_ville")
    return left.join(r, F.col("ville").eqNullSafe(F.col("_ville"))).drop("_ville")


def shops_by_city(t: Tables) -> DataFrame:
    """View: shops, distinct specialties and first partnership of each city."""
    shops = t["dim_librairies"]
    figures = shops.groupBy("ville").agg(
        F.count("*").alias("nb_librairies"), F.min("date_partenariat").alias("premier_partenariat")
    )
    return (
        _same_city(figures, _distinct_specialties(shops))
        .select("ville", "nb_librairies", "specialites", "premier_partenariat")
        .orderBy(F.desc("nb_librairies"), F.asc_nulls_last("ville"))
    )


def city_centroids(t: Tables) -> DataFrame:
    """View: geocoded shops of each city and their mean position."""
    shops = t["dim_librairies"].filter("latitude is not null")
    figures = shops.groupBy("ville").agg(
        F.count("*").alias("nb_librairies"),
        F.round(F.avg("latitude"), 6).alias("centre_lat"),
        F.round(F.avg("longitude"), 6).alias("centre_lon"),
    )
    return (
        _same_city(figures, _distinct_specialties(shops))
        .select("ville", "nb_librairies", "specialites", "centre_lat", "centre_lon")
        .orderBy(F.desc("nb_librairies"), F.asc_nulls_last("ville"))
    )


def geocoded_shops(t: Tables) -> DataFrame:
    return (
        t["dim_librairies"]
        .filter("latitude is not null")
        .select(
            "nom",
            "ville",
            "specialite",
            F.round(F.col("latitude").cast("decimal(20,8)"), 4).alias("lat"),
            F.round(F.col("longitude").cast("decimal(20,8)"), 4).alias("lon"),
        )
    )


# ----------------------------------------------------------------- reports


def dashboard(t: Tables, short: bool = False) -> DataFrame:
    """One row of totals; each fact table is read once, ``short`` leaves the means out."""
    books = t["fact_books"].select(
        F.struct(
            F.count("*").alias("total_livres"),
            F.countDistinct("category_id").alias("nb_categories"),
            _mean(F.col("price_eur")).alias("prix_moyen_livres"),
            _mean(F.col("rating")).alias("note_moyenne_livres"),
        )
    )
    quotes = t["fact_quotes"].select(
        F.struct(
            F.count("*").alias("total_citations"), F.countDistinct("author_id").alias("nb_auteurs")
        )
    )
    shops = t["dim_librairies"].select(F.struct(F.count("*").alias("total_librairies")))
    row = t["fact_books"].sparkSession.range(1).select(
        books.scalar().alias("b"), quotes.scalar().alias("q"), shops.scalar().alias("s")
    )
    columns = [
        "b.total_livres",
        "q.total_citations",
        "s.total_librairies",
        "b.nb_categories",
        "q.nb_auteurs",
    ]
    return row.select(
        *columns, *([] if short else ["b.prix_moyen_livres", "b.note_moyenne_livres"])
    )


def dq_report(
    t: Tables, low: float = 1, high: float = 100, short: bool = False
) -> DataFrame:
    """Data-quality checks: orphans, missing positions, outlier prices, repeated hashes.

    One pass per table; the counters of a pass are then laid out as rows.
    """

    def row(label: str, value: Column, limit: int = 0) -> Column:
        status = F.when(value <= limit, F.lit(OK)).otherwise(F.lit(ATTENTION))
        return F.struct(
            F.lit(label).alias("controle"), value.cast("bigint").alias("nombre"), status.alias("statut")
        )

    books = t["fact_books"].agg(
        F.count_if(F.col("category_id").isNull()).alias("orphans"),
        F.count_if((F.col("price_eur") < low) | (F.col("price_eur") > high)).alias("outliers"),
    )
    quotes = t["fact_quotes"].agg(
        F.count_if(F.col("author_id").isNull()).alias("orphans"),
        F.count("*").alias("n"),
        F.countDistinct("quote_hash").alias("hashes"),
    )
    shops = t["dim_librairies"].agg(F.count_if(F.col("latitude").isNull()).alias("lost"))
    # fixed values: wording of the two report forms
    if short:
        labels = ("Livres sans categorie", "Citations sans auteur", "Librairies sans GPS")
    else:
        labels = ("Livres sans catégorie", "Citations sans auteur", "Librairies sans coordonnées GPS")
    book_rows = [row(labels[0], F.col("orphans"))]
    quote_rows = [row(labels[1], F.col("orphans"))]
    shop_rows = [row(labels[2], F.col("lost"), limit=2)]
    if not short:
        book_rows.append(row(f"Livres avec prix aberrant (< {low}€ ou > {high}€)", F.col("outliers")))
        quote_rows.append(row("Citations en doublon (même hash)", F.col("n") - F.col("hashes")))
    parts = [
        frame.select(F.inline(F.array(*rows)))
        for frame, rows in ((books, book_rows), (quotes, quote_rows), (shops, shop_rows))
    ]
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------ normalised variant


def _counted(facts: DataFrame, key: str, dim: DataFrame, name: str) -> DataFrame:
    counts = facts.groupBy(key).agg(F.count("id_quote").alias("n"))
    return (
        counts.join(dim.select(key, name), key)
        .groupBy(name)
        .agg(F.sum("n").alias("total_quotes"))
        .orderBy(F.desc("total_quotes"), F.asc_nulls_last(name))
    )


def quotes_per_tag(t: Tables) -> DataFrame:
    return _counted(t["quotes_tags"], "id_tag", t["tags"], "tag_name")


def quotes_per_author(t: Tables) -> DataFrame:
    return _counted(t["quotes"], "id_author", t["authors"], "author_name")


def top_authors(t: Tables, limit: int = 3) -> DataFrame:
    return quotes_per_author(t).limit(limit)


def quote_tag_view(t: Tables) -> DataFrame:
    """Denormalised view: one row per quotation and tag."""
    return (
        t["quotes_tags"]
        .join(t["tags"], "id_tag")
        .join(t["quotes"], "id_quote")
        .join(t["authors"], "id_author")
        .select("text", "author_name", "tag_name")
    )


def tags_per_author(t: Tables) -> DataFrame:
    """Rows of the view per author (repeats count); text never leaves the scan."""
    return (
        quote_tag_view(t)
        .groupBy("author_name")
        .agg(F.count("tag_name").alias("total_tag"))
        .orderBy(F.desc("total_tag"), F.asc_nulls_last("author_name"))
    )


def books_at_shop(t: Tables, shop: str, max_book_id: int = 10) -> DataFrame:
    """Books up to an id counted against every shop of the given name.

    Counts of the two sides are multiplied, so no pair is ever formed.
    """
    books = t["books"].filter(F.col("id_book") <= max_book_id).select(F.count("id_book"))
    shops = t["librairies"].filter(F.col("nom_librairie") == shop)
    return (
        shops.groupBy("nom_librairie")
        .agg(F.count("*").alias("_shops"))
        .select((F.col("_shops") * books.scalar()).alias("total_book"), "nom_librairie")
        .filter("total_book > 0")
    )


# ---------------------------------------------------------------- registry

VIEWS = {
    "v_stats_categories": category_stats_all,
    "v_top_authors": top_authors_view,
    "v_librairies_geo": shops_by_city,
    "v_dashboard_global": dashboard,
    "v_analyse_geo_librairies": city_centroids,
    "v_quotes_tags": quote_tag_view,
}


def register_views(t: Tables, names: Iterable[str] = VIEWS) -> list[str]:
    """Create the named views as temporary views."""
    done = []
    for name in names:
        VIEWS[name](t).createOrReplaceTempView(name)
        done.append(name)
    return done
