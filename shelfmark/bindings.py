"""The supplied tables seen as the domain tables of the platform."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.fields import MONEY, convert
from shelfmark.functions.text import slug, stable_key
from shelfmark.operators.merge import refresh_counter
from shelfmark.session import literal_rows

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "labels", "pages", "benchmark", "embeddings", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(col: str) -> Column:
    return F.col(col).cast(MONEY)


def every(column: str, n: int) -> Column:
    """True on each ``n``-th key: used to plant faults, never to drop rows."""
    return F.col(column) % n == 0


# -------------------------------------------------------------- star schema


def dim_categories(part: DataFrame) -> DataFrame:
    """Part types, and one category no book belongs to."""
    empty = literal_rows(part.sparkSession, [("UNUSED",)], "category_name string")
    names = part.select(F.col("p_type").alias("category_name")).distinct().unionByName(empty)
    return names.select(
        stable_key(F.col("category_name")).alias("category_id"),
        "category_name",
        slug(F.col("category_name")).alias("category_slug"),
    )


def fact_books(part: DataFrame) -> DataFrame:
    """Parts as books: some without category, some without price."""
    price = F.when(~every("p_partkey", 89), money("p_retailprice"))
    return part.select(
        F.col("p_partkey").alias("book_id"),
        F.when(~every("p_partkey", 53), stable_key(F.col("p_type"))).alias("category_id"),
        F.col("p_name").alias("title"),
        price.alias("price_gbp"),
        convert(price).alias("price_eur"),
        (F.col("p_size") % 5 + 1).cast("int").alias("rating"),
        F.col("p_size").alias("availability"),
    )


def fact_quotes(orders: DataFrame) -> DataFrame:
    """Orders as quotations: some without author; equal texts repeat a hash."""
    text = F.concat_ws(
        " ",
        F.lit("A quotation of priority"),
        F.col("o_orderpriority"),
        F.lit("in state"),
        F.col("o_orderstatus"),
        F.lit("kept since"),
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit("by customer number"),
        F.col("o_custkey").cast("string"),
    )
    return orders.select(
        F.col("o_orderkey").alias("quote_id"),
        F.when(~every("o_orderkey", 101), F.col("o_custkey")).alias("author_id"),
        text.alias("quote_text"),
        F.md5(F.lower(text).cast("binary")).alias("quote_hash"),
    )


def dim_authors(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("author_id"),
        F.col("c_name").alias("author_name"),
        slug(F.col("c_name")).alias("author_slug"),
        F.lit(0).cast("bigint").alias("quote_count"),
    )


def counted_authors(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Authors with their stored counter."""
    return refresh_counter(dim_authors(customer), fact_quotes(orders), "author_id", "quote_count")


def dim_tags(part: DataFrame) -> DataFrame:
    names = part.select(F.col("p_brand").alias("tag_name")).distinct()
    return names.select(
        stable_key(F.col("tag_name")).alias("tag_id"), "tag_name",
        slug(F.col("tag_name")).alias("tag_slug"), F.lit(0).cast("bigint").alias("usage_count"),
    )


def quote_tags(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """One pair per order and brand."""
    # the key is made on the small side, not once per line
    brands = part.select(
        F.col("p_partkey").alias("l_partkey"), stable_key(F.col("p_brand")).alias("tag_id")
    )
    return (
        lineitem.select("l_orderkey", "l_partkey")
        .join(brands, "l_partkey")
        .select(F.col("l_orderkey").alias("quote_id"), "tag_id")
        .distinct()
    )


def dim_shops(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Suppliers as shops: nation is the city, region the specialty."""
    key = F.col("s_suppkey")
    offset = (key % 500).cast("decimal(10,2)") * F.lit(Decimal("0.01"))
    placed = ~every("s_suppkey", 7)
    joined = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    return joined.select(
        key.alias("librairie_id"),
        F.col("s_name").alias("nom"),
        F.concat((key % 40 + 1).cast("string"), F.lit(" rue du Port")).alias("adresse"),
        F.lpad((key % 95 * 1000 + 1000).cast("string"), 5, "0").alias("code_postal"),
        F.col("n_name").alias("ville"),
        F.when(placed, (F.lit(Decimal("43.12")) + offset).cast("decimal(10,8)")).alias("latitude"),
        F.when(placed, (F.lit(Decimal("-1.34")) + offset).cast("decimal(11,8)")).alias("longitude"),
        F.when(~every("s_suppkey", 11), F.col("r_name")).alias("specialite"),
        F.date_add(F.lit("2015-01-01").cast("date"), (key % 900).cast("int")).alias(
            "date_partenariat"
        ),
        (money("s_acctbal") * 100).cast("decimal(12,2)").alias("ca_annuel"),
    )


class Tables(Mapping[str, DataFrame]):
    """Named frames, each planned when it is first asked for."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __contains__(self, name: object) -> bool:
        return name in self._makers

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def star(spark: SparkSession, sf_dir: str) -> Tables:
    """All star tables."""

    def raw(*names: str) -> list[DataFrame]:
        return [table(spark, sf_dir, n) for n in names]

    return Tables(
        {
            "dim_categories": lambda: dim_categories(*raw("part")),
            "fact_books": lambda: fact_books(*raw("part")),
            "dim_authors": lambda: counted_authors(*raw("customer", "orders")),
            "fact_quotes": lambda: fact_quotes(*raw("orders")),
            "dim_tags": lambda: dim_tags(*raw("part")),
            "quote_tags": lambda: quote_tags(*raw("lineitem", "part")),
            "dim_librairies": lambda: dim_shops(*raw("supplier", "nation", "region")),
        }
    )


def normalised(spark: SparkSession, sf_dir: str) -> Tables:
    """The tables of the normalised variant."""
    t = star(spark, sf_dir)

    def quotes() -> DataFrame:
        return (
            t["fact_quotes"]
            .filter("author_id is not null")
            .selectExpr("quote_id as id_quote", "quote_text as text", "author_id as id_author")
        )

    return Tables(
        {
            "authors": lambda: table(spark, sf_dir, "customer").selectExpr(
                "c_custkey as id_author", "c_name as author_name"
            ),
            "quotes": quotes,
            "tags": lambda: t["dim_tags"].selectExpr("tag_id as id_tag", "tag_name"),
            "quotes_tags": lambda: t["quote_tags"].selectExpr(
                "quote_id as id_quote", "tag_id as id_tag"
            ),
            "books": lambda: table(spark, sf_dir, "part").selectExpr(
                "p_partkey as id_book", "p_name as title"
            ),
            "librairies": lambda: table(spark, sf_dir, "supplier").selectExpr(
                "s_suppkey as id_librairie", "s_name as nom_librairie"
            ),
        }
    )


# --------------------------------------------------------------- raw layers

SCRAPED_AT = "2024-01-15 08:00:00"


def _page_meta(source: str) -> Column:
    return F.struct(
        F.lit(source).alias("source"),
        F.lit(SCRAPED_AT).cast("timestamp").alias("scraped_at"),
        F.lit("batch").alias("batch_id"),
        F.lit("1.0").alias("pipeline_version"),
    ).alias("_metadata")


def raw_books(part: DataFrame) -> DataFrame:
    """Scraped text of each part: odd prices, rating words, missing fields."""
    price = money("p_retailprice").cast("string")
    words = F.array(*[F.lit(w) for w in ("One", "two", "THREE", "Four", "five", "4", "none")])
    key = F.col("p_partkey")
    return part.select(
        "p_partkey",
        F.concat(F.lit("  "), F.col("p_name"), F.lit(" \t")).alias("title"),
        F.when(every("p_partkey", 97), F.lit("N/A"))
        .when(every("p_partkey", 83), F.concat(F.lit("£1,"), price))
        .when(every("p_partkey", 79), F.lit(None))
        .when(every("p_partkey", 5), F.replace(price, F.lit("."), F.lit(",")))
        .otherwise(F.concat(F.lit("£"), price))
        .alias("price"),
        F.when(~every("p_partkey", 71), F.get(words, (key % 7).cast("int"))).alias("rating"),
        F.when(every("p_partkey", 13), F.lit("In stock"))
        .when(~every("p_partkey", 67), F.col("p_size").cast("string"))
        .alias("availability"),
        F.when(~every("p_partkey", 31), F.col("p_type")).alias("category"),
        F.concat(F.lit("https://books.example.org/catalogue/"), key).alias("url"),
        F.lit(None).cast("string").alias("image_url"),
        _page_meta("books"),
    )


def raw_quotes(documents: DataFrame) -> DataFrame:
    """Documents as scraped quotations: the whole text, untidy tags."""
    size = F.when(F.col("n_chars") > 1000, F.lit(" Long ")).otherwise(F.lit("SHORT"))
    return documents.select(
        F.col("doc_id").alias("position"),
        "text",
        F.when(~every("doc_id", 29), F.concat(F.lit(" Author "), F.col("source"))).alias("author"),
        F.lit(None).cast("string").alias("author_url"),
        F.array(
            F.concat(F.lit(" "), F.upper(F.col("lang"))), F.col("source"), size, F.col("lang")
        ).alias("tags"),
        _page_meta("quotes"),
    )


def partner_rows(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Customers as partner rows, all text, with faults of every kind planted."""
    key = F.col("c_custkey")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    digits = F.lpad((key % 100000000).cast("string"), 8, "0")
    phone = (
        F.when(every("c_custkey", 37), F.lit(None))
        .when(every("c_custkey", 23), F.concat(F.lit("00"), digits))
        .when(every("c_custkey", 3), F.concat(F.lit("1"), digits))
        .otherwise(
            F.concat(F.lit("01."), F.left(digits, F.lit(4)), F.lit("-"), F.right(digits, F.lit(4)))
        )
    )
    email = (
        F.when(every("c_custkey", 41), F.lit(""))
        .when(every("c_custkey", 19), F.concat(F.lit("contact"), key, F.lit("@nowhere")))
        .otherwise(F.concat(F.lit(" contact"), key, F.lit("@mail.example.org ")))
    )
    return joined.select(
        (key + 2).alias("row_number"),
        F.when(~every("c_custkey", 61), F.col("c_name")).alias("nom_librairie"),
        F.when(~every("c_custkey", 59), F.concat((key % 40 + 1), F.lit(" Rue du PORT"))).alias(
            "adresse"
        ),
        F.when(every("c_custkey", 17), F.lit("1234"))
        .otherwise(F.lpad((key % 95 * 1000 + 1000).cast("string"), 5, "0"))
        .alias("code_postal"),
        F.when(~every("c_custkey", 47), F.replace(F.col("n_name"), F.lit("_"), F.lit("-"))).alias(
            "ville"
        ),
        F.when(
            ~every("c_custkey", 43), F.concat(F.lit("Ana "), F.lower("c_mktsegment"), F.lit("  B"), key)
        ).alias("contact_nom"),
        email.alias("contact_email"),
        phone.alias("contact_telephone"),
        F.when(~every("c_custkey", 53), (money("c_acctbal") * 150).cast("string")).alias("ca_annuel"),
        F.date_format(
            F.date_add(F.lit("2015-01-01").cast("date"), (key % 900).cast("int")), "yyyy-MM-dd"
        ).alias("date_partenariat"),
        F.when(~every("c_custkey", 71), F.col("r_name")).alias("specialite"),
    )


def partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partner_rows(
        table(spark, sf_dir, "customer"),
        table(spark, sf_dir, "nation"),
        table(spark, sf_dir, "region"),
    )
