"""Secrets in texts: candidates by shape, false positives removed by a random forest.

A candidate is a run of at least sixteen characters of the alphabets that keys
and tokens are written in, cut out of a word once a link's scheme and host are
taken off (a user name and password before ``@`` stay). Its features are its length, its
character classes and transitions between them, how much of it words of the
corpus' dictionary cover, whether it looks like a path, a link or an
identifier, and the words before it. The forest is trained on labelled findings:
``LABELLED`` made ones of published key formats and of what is mistaken for
them (checksums named as such, identifiers, paths, numbers, version strings),
and ``PLAIN_WORDS`` long words of the corpus, labelled as no secrets (both
bounds are the training sample's; everything else covers all rows).

All of it is DataFrame expressions and Spark ML: no Python runs on executors.
Candidates never meet by key but for the dictionary: distinct pieces of
candidates are joined with the words that occur ``MIN_COUNT`` times or more.

Cases: null or empty text has no findings; ids may repeat or be null (findings
repeat with their rows); an empty table gives an empty table. ``redact`` leaves
texts without secrets as they are, passes all columns through and replaces a
column ``n_secrets``.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import query, stored, table, words

LABELLED = 6000
PLAIN_WORDS = 2000
MIN_COUNT = 20
THRESHOLD = 0.5
TREES, DEPTH, SEED = 24, 8, 11
MARK = "<secret>"

_RUN = r"[A-Za-z0-9_+/=.~\-]{16,}"
_HOST = r"(?i)(?:\b[a-z][a-z0-9+.\-]*:)?//(?:([^/@\s]*)@)?[^/?#\s]*"
# fixed values: names that announce a secret, and names that announce what is mistaken for one
_ANNOUNCE = r"(?i)(secret|token|passw|pwd|api.?key|apikey|access.?key|private.?key|auth|bearer|credential)"
_HARMLESS = r"(?i)(sha\d*|md5|commit|checksum|digest|hash|uuid|guid|revision|version|build|isbn|card|order|phone|ref|path|file|url)"
# fixed values: common letter pairs of English text
_PAIRS = (
    "th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|of|ed|is|it|al|ar|st|to|nt|ng|se|ha|as|ou|io|le|ve|co|me|de|hi|ri|ro|ic|ne|ea|ra|ce|li|ch|ll|be|ma|si|om|ur"
)
FEATURES = (
    "length", "digits", "uppers", "symbols", "transitions", "pairs", "coverage", "distinct", "hex_only", "digits_only",
    "letters_only", "path", "link", "dashed", "quoted", "announced", "announced_before", "harmless_before", "assigned",
)


def candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, word, secret, raw, before, before2``: the runs, the words around them and their place among the words."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where(F.col("t").rlike(_RUN))
    rows = rows.select("id", words(F.col("t")).alias("w"))
    found = F.filter(F.transform("w", lambda x, i: F.struct(i.alias("i"), x.alias("raw"))), lambda x: (F.length(x["raw"]) >= 16) & x["raw"].rlike(_RUN))
    rows = rows.select("id", "w", F.explode(found).alias("f"))
    before = lambda k: F.coalesce(F.get("w", F.col("f.i") - k), F.lit(""))
    rows = rows.select("id", F.col("f.i").cast("bigint").alias("word"), F.col("f.raw").alias("raw"), before(1).alias("before"), before(2).alias("before2"))
    # a link's scheme and host are no secret; what a user wrote before "@" stays, and no run crosses the cut
    bare = F.regexp_replace("raw", _HOST, "$1 ")
    runs = rows.select("*", F.explode(F.regexp_extract_all(bare, F.lit(_RUN), F.lit(0))).alias("run"))
    # a run such as name=value is cut at the first sign that is not padding
    value = F.regexp_replace(F.regexp_replace("run", r"^[A-Za-z_.\-]{2,30}=+(?=.{12})", ""), r"[.\-~/]+$", "")
    return runs.withColumn("secret", value).where(F.length("secret") >= 12).drop("run")


def _share(pattern: str) -> Column:
    return F.length(F.regexp_replace("secret", pattern, "")).cast("double") / F.length("secret")


def _pieces(column: str = "secret") -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(column), F.lit("[a-z]{3,}"), F.lit(0)))


def features(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``found`` with the features. ``dictionary`` has one column ``w`` of lower-case words."""
    pieces = found.select(F.explode(_pieces()).alias("w")).distinct()
    known = pieces.join(dictionary, "w", "left_semi")
    keyed = found.select("secret").distinct().select("secret", F.explode(_pieces()).alias("w"))
    covered = keyed.join(known, "w").groupBy("secret").agg(F.sum(F.length("w")).alias("covered"))
    one = lambda c: c.cast("double")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace("secret", "[a-z]+", "a"), "[A-Z]+", "b"), "[0-9]+", "0"), "[^a-z0-9]+", "-")
    out = found.join(covered, "secret", "left")
    return out.withColumns(
        {
            "length": one(F.length("secret")),
            "digits": 1 - _share("[0-9]"),
            "uppers": 1 - _share("[A-Z]"),
            "symbols": 1 - _share("[^A-Za-z0-9]"),
            "transitions": one(F.length(classes) - 1) / F.length("secret"),
            "pairs": one(F.regexp_count(F.lower("secret"), F.lit(f"(?=({_PAIRS}))"))) / F.length("secret"),
            "coverage": one(F.coalesce("covered", F.lit(0))) / F.length("secret"),
            "distinct": one(F.size(F.array_distinct(F.split("secret", "")))) / F.length("secret"),
            "hex_only": one(F.col("secret").rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
            "digits_only": one(F.col("secret").rlike("^[0-9.\\-]+$")),
            "letters_only": one(F.col("secret").rlike("^[A-Za-z]+$")),
            "path": one(F.col("secret").rlike("/[^/]+/|\\.[a-z]{2,4}$")),
            "link": one(F.col("raw").rlike("(?i)(https?:|www\\.|@)")),
            "dashed": one(F.col("secret").rlike("^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-|^[a-z]+([-_][a-z]+)+$")),
            "quoted": one(F.col("raw").rlike("[\"'`]")),
            "announced": one(F.col("raw").rlike(_ANNOUNCE)),
            "announced_before": one(F.concat_ws(" ", "before2", "before").rlike(_ANNOUNCE)),
            "harmless_before": one(F.concat_ws(" ", "before2", "before", F.regexp_extract("raw", "^[^=:]{2,20}[=:]", 0)).rlike(_HARMLESS)),
            "assigned": one(F.col("before").rlike("[=:]$") | F.col("raw").rlike("^[^=:]{2,30}[=:]")),
        }
    ).drop("covered")


def dictionary(df: DataFrame, text_col: str = "text", min_count: int = MIN_COUNT) -> DataFrame:
    """Lower-case words of at least three letters that occur often in the corpus."""
    rows = df.select(F.explode(words(F.col(text_col))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    rows = rows.select(F.lower(F.regexp_replace("w", "[^A-Za-z]", "")).alias("w"), "n").where(F.length("w").between(3, 24))
    return rows.groupBy("w").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count).select("w")


def labelled(spark: SparkSession, n: int = LABELLED) -> DataFrame:
    """``n`` made findings with ``label``: keys of published formats, and what is mistaken for them."""
    i = F.col("id")
    long = F.concat(F.sha2(F.concat(F.lit("a"), i), 256), F.sha2(F.concat(F.lit("b"), i), 256))
    base = F.regexp_replace(F.base64(F.unhex(F.sha2(F.concat(F.lit("c"), i), 512))), "[\r\n]", "")
    plain = F.regexp_replace(base, "[+/=]", "")
    pick = lambda seed, *xs: F.element_at(F.array(*[F.lit(x) if isinstance(x, str) else x for x in xs]), (F.pmod(F.xxhash64(F.lit(seed), i), F.lit(len(xs))) + 1).cast("int"))
    word = lambda seed: pick(seed, "the", "value", "data", "user", "config", "service", "report", "internal", "module", "handler", "network", "request", "storage", "number", "country")
    secret = pick(
        1, F.substring(long, 1, 40), F.substring(long, 1, 32), F.substring(long, 1, 64), F.concat(F.lit("AKIA"), F.upper(F.substring(plain, 1, 16))),
        F.concat(F.lit("ghp_"), F.substring(plain, 1, 36)), F.substring(base, 1, 40), F.concat(F.lit("sk_live_"), F.substring(plain, 1, 24)),
        F.concat(F.lit("xoxb-"), F.substring(F.conv(F.substring(long, 1, 12), 16, 10), 1, 12), F.lit("-"), F.substring(plain, 1, 24)),
        F.concat(F.lit("AIza"), F.substring(plain, 1, 35)), F.concat(F.lit("eyJ"), F.substring(plain, 1, 33), F.lit(".eyJ"), F.substring(plain, 30, 30)),
        F.substring(plain, 1, 24), F.upper(F.substring(long, 1, 40)),
    )
    name = pick(2, "token", "secret", "api_key", "password", "access_key", "auth_token", "TOKEN", "private_key", "bearer")
    digits = F.lpad(F.substring(F.conv(F.substring(long, 1, 14), 16, 10), 1, 16), 16, "4")
    harmless = pick(
        3, F.concat_ws("", word(4), word(5), word(6), word(7)), F.concat_ws("_", word(4), word(5), word(6), word(7)), F.concat_ws("-", word(4), word(5), word(6)),
        F.concat_ws("/", F.lit("/usr"), word(4), word(5), F.concat(word(6), F.lit(".txt"))), digits, F.concat_ws(".", word(4), word(5), F.lit("example.com")),
        F.concat_ws("-", F.substring(long, 1, 8), F.substring(long, 9, 4), F.substring(long, 13, 4), F.substring(long, 17, 4), F.substring(long, 21, 12)),
        F.substring(long, 1, 40), F.substring(long, 1, 32), F.concat(F.initcap(word(4)), F.initcap(word(5)), F.initcap(word(6)), F.initcap(word(7))),
        F.concat_ws("", word(4), word(5), word(6), word(7)), digits, F.repeat(F.substring(long, 1, 1), 24), F.concat(F.lit("2024-01-"), F.substring(digits, 1, 2), F.lit("T10.00.00.000")),
    )
    marked = F.col("harmless").rlike("^[0-9a-f]{32,40}$") & ~F.col("harmless").rlike("^(.)\\1+$")
    label = F.pmod(F.xxhash64(F.lit(9), i), F.lit(2))
    rows = spark.range(n).select("id", label.cast("double").alias("label"), secret.alias("secret"), harmless.alias("harmless"), name.alias("name"))
    style = pick(10, "name = value", "name = value", "name: value", "name=value", "bare")
    rows = rows.select("*", style.alias("style"), word(12).alias("w1"), word(13).alias("w2"), pick(14, "commit", "sha1", "md5", "checksum", "digest", "uuid").alias("sum"))
    bad = F.col("label") == 1
    value = F.when(bad, F.col("secret")).otherwise(F.col("harmless"))
    named = bad & (F.col("style") != "bare")
    quoted = F.when(named & (F.col("style") != "name: value"), F.concat(F.lit('"'), value, F.lit('"'))).otherwise(value)
    return rows.select(
        "label", value.alias("secret"),
        F.when(named & (F.col("style") == "name=value"), F.concat("name", F.lit("="), quoted)).otherwise(quoted).alias("raw"),
        F.when(named, F.when(F.col("style") == "name = value", F.lit("=")).when(F.col("style") == "name: value", F.concat("name", F.lit(":"))).otherwise(F.col("w1")))
        .when(~bad & marked, F.col("sum")).otherwise(F.col("w1")).alias("before"),
        F.when(named & (F.col("style") == "name = value"), F.col("name")).otherwise(F.col("w2")).alias("before2"),
    )


def train(spark: SparkSession, found: DataFrame, known: DataFrame) -> RandomForestClassificationModel:
    """A forest fitted on the made findings and a bounded number of the corpus' long plain words."""
    columns = ("label", "secret", "raw", "before", "before2")
    plain = found.where(F.col("secret").rlike("^[A-Za-z.]+$")).withColumn("label", F.lit(0.0)).select(*columns)
    plain = plain.orderBy(F.xxhash64("secret", "before"), "secret", "raw", "before", "before2").limit(PLAIN_WORDS)
    sample = stored(features(labelled(spark).select(*columns).union(plain), known), "labelled")
    frame = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(sample)
    return RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(frame)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, word, secret, score, is_secret`` of every candidate."""
    found = stored(candidates(df, id_col, text_col), "candidates")
    known = stored(dictionary(df, text_col), "dictionary")
    model = train(df.sparkSession, found, known)
    frame = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(features(found, known))
    score = vector_to_array(F.col("probability"))[1]
    scored = model.transform(frame).select(F.col("id").alias(id_col), "word", "secret", F.round(score, 6).alias("score"))
    return scored.withColumn("is_secret", F.col("score") >= THRESHOLD)


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = MARK) -> DataFrame:
    """``df`` with each secret in its texts replaced by ``mark``, and ``n_secrets`` (different ones of the text)."""
    rows = df.drop("n_secrets")
    secrets = scan(rows, id_col, text_col).where("is_secret").groupBy(id_col).agg(F.collect_set("secret").alias("_secrets"))
    # longest first, so that a secret inside another doesn't break it
    listed = F.array_sort(F.transform("_secrets", lambda x: F.struct((-F.length(x)).alias("n"), x.alias("s"))))
    text = F.aggregate(listed, F.col(text_col), lambda t, x: F.replace(t, x["s"], F.lit(mark)))
    joined = rows.join(secrets.withColumnRenamed(id_col, "_id"), F.col(id_col).eqNullSafe(F.col("_id")), "left")
    n = F.coalesce(F.size("_secrets"), F.lit(0)).cast("bigint")
    return joined.withColumn("n_secrets", F.when(F.col("_secrets").isNull(), 0).otherwise(n).cast("bigint")).withColumn(
        text_col, F.when(F.col("_secrets").isNull(), F.col(text_col)).otherwise(text)
    ).drop("_id", "_secrets")


@query("op5_secret_scan")
def op5_secret_scan(spark, sf_dir) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
