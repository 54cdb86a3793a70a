"""Language-model scoring: a Katz back-off trigram model learnt from the corpus and applied to every text.

Tokens are the words of a text, A-Z lower-cased, and one end token; a history
is padded with begin markers. Training documents are those whose
``crc32(doc_id) % 10`` is not 0; null ids are held out.

Counts of trigrams, bigrams and unigrams of the training documents are plain
aggregates. Good-Turing discounts come from the counts of counts of each order
(Katz's form: counts up to ``MAX_DISCOUNTED`` are discounted, a discount outside
(0, 1] is not applied). The bottom of the recursion is the add-``ADD`` unigram
distribution over the vocabulary and one unknown token (the ``base`` of the
query), so every token has a positive probability. For a history ``h`` with
seen followers ``S``, ``P(w|h) = d c / C`` on ``S`` and
``alpha(h) P(w|h')`` elsewhere, with
``alpha(h) = (1 - sum_S d c / C) / (1 - sum_S P(w|h'))``: the weights are exact,
each distribution sums to one. A history whose followers are all undiscounted
keeps for its unseen words the probability they have one order lower
(``alpha = 1``) and shares the rest, ``sum_S P(w|h')``, among ``S`` in
proportion to the counts.

Texts are scored by :mod:`ngram_shards`: each block of texts asks for its distinct
trigrams, counts climb from shards of trigrams to shards of bigrams and of words,
and probabilities come back down the orders (log10, summed per text).
:func:`model` and :func:`evaluate` give the same model as tables keyed by n-gram,
for those who want to look at it or at single trigrams.

Cases: a null text is empty (only the end token); null or repeated ids and
repeated rows are scored each on their own; very long texts are scored whole;
an empty table gives an empty table; other input columns are kept, except
one named ``_row``, which is dropped.
"""

from __future__ import annotations

import math
import pickle
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm import ngram_shards
from shelfmark.llm.common import SPACES, query, stored, table, text_bytes

# fixed values: order of the model, largest count Katz discounts, the additive constant of the bottom distribution
ORDER = 3
MAX_DISCOUNTED = 5
ADD = 0.1
# a begin marker and the end token: neither can be a word
BEGIN, END = " ", ""
# bytes of text to a shard, and to one of the first so many shards: more of them would mean smaller rows
SHARD_BYTES = 24 << 20
FEW_BYTES, FEW = 8 << 20, 128

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def tokens(text: Column) -> Column:
    """Words of ``text`` (A-Z lower-cased), then the end token."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.concat(F.array_remove(F.split(plain, SPACES + "+"), ""), F.array(F.lit(END)))


def trigrams(df: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """A row per token: ``keep`` columns, ``u, v`` (its history) and ``w``."""
    # the tokens become a column first: inside the lambda an expression would be evaluated again for every token
    rows = df.select(*keep, F.concat(F.array(F.lit(BEGIN), F.lit(BEGIN)), tokens(F.col(text_col))).alias("_t"))
    t = F.col("_t")
    steps = F.sequence(F.lit(2), F.size(t) - 1)
    each = F.transform(steps, lambda i: F.struct(F.get(t, i - 2).alias("u"), F.get(t, i - 1).alias("v"), F.get(t, i).alias("w")))
    return rows.select(*keep, F.inline(each))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 10 == 0, F.lit(True))


def discounts(counts: DataFrame, col: str) -> list[float]:
    """Katz's Good-Turing discount of each count 1 to ``MAX_DISCOUNTED`` (index 0 unused)."""
    rows = counts.where(F.col(col) <= MAX_DISCOUNTED + 1).groupBy(col).count().collect()
    return good_turing({r[0]: r[1] for r in rows})


def good_turing(n: dict[int, int]) -> list[float]:
    """The discounts, from the n-grams seen once, twice and so on."""
    out = [1.0] * (MAX_DISCOUNTED + 1)
    n1 = n.get(1, 0)
    if n1 == 0:
        return out
    common = (MAX_DISCOUNTED + 1) * n.get(MAX_DISCOUNTED + 1, 0) / n1
    if common >= 1:
        return out
    for r in range(1, MAX_DISCOUNTED + 1):
        if n.get(r, 0) == 0:
            continue
        d = ((r + 1) * n.get(r + 1, 0) / (r * n[r]) - common) / (1 - common)
        out[r] = d if 0 < d <= 1 else 1.0
    return out


def _discounted(c: Column, d: list[float]) -> Column:
    out = F.lit(1.0)
    for r in range(MAX_DISCOUNTED, 0, -1):
        out = F.when(c == r, F.lit(d[r])).otherwise(out)
    return out


def _level(counts: DataFrame, history: list[str], lower: DataFrame, lower_keys: list[str], d: list[float], label: str):
    """Probabilities of seen n-grams (``*history, w, lp``) and weights of their histories (``*history, la``).

    ``lower`` holds ``*lower_keys, w, lower_p``: the lower order's probability of each seen n-gram's word.
    """
    c = F.col("c")
    totals = counts.groupBy(*history).agg(F.sum("c").alias("total"))
    rows = counts.join(lower, [*lower_keys, "w"]).join(totals, history).select(*history, "w", "c", "lower_p", "total", _discounted(c, d).alias("d"))
    hist = rows.groupBy(*history).agg(
        F.sum((1 - F.col("d")) * c / F.col("total")).alias("left"),
        (1 - F.sum("lower_p")).alias("rest"),
        F.sum("lower_p").alias("seen"),
    )
    hist = stored(hist, f"{label}-histories")
    probs = rows.join(hist, history).select(
        *history, "w", F.log10(F.when(F.col("left") > 0, F.col("d") * c / F.col("total")).otherwise(F.col("seen") * c / F.col("total"))).alias("lp")
    )
    weights = hist.select(*history, F.when(F.col("left") > 0, F.log10(F.col("left") / F.col("rest"))).otherwise(F.lit(0.0)).alias("la"))
    return stored(probs, f"{label}-probabilities"), weights


def model(train: DataFrame):
    """The tables of the model from trigram rows ``u, v, w`` of the training texts, and the log10 probability of an unknown token."""
    c3 = stored(train.groupBy("u", "v", "w").agg(F.count("*").alias("c")), "lm-trigrams")
    c2 = c3.groupBy("v", "w").agg(F.sum("c").alias("c"))
    c2 = stored(c2, "lm-bigrams")
    c1 = stored(c2.groupBy("w").agg(F.sum("c").alias("c")), "lm-unigrams")
    n, v = c1.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    denominator = n + ADD * (v + 1)
    p1 = c1.select("w", "c", F.log10((F.col("c") + ADD) / denominator).alias("lp"))
    unknown = math.log10(ADD / denominator)
    lower1 = p1.select("w", (10 ** F.col("lp")).alias("lower_p"))
    p2, a2 = _level(c2, ["v"], lower1, [], discounts(c2, "c"), "lm-2")
    # the bigram probability of each seen trigram's word: seen trigrams have seen bigrams
    lower2 = p2.select("v", "w", (10 ** F.col("lp")).alias("lower_p"))
    p3, a3 = _level(c3, ["u", "v"], lower2, ["v"], discounts(c3, "c"), "lm-3")
    return {"p3": p3, "a3": a3, "p2": p2, "a2": a2, "p1": p1, "unknown": unknown, "n": n, "v": v}


def evaluate(grams: DataFrame, m: dict) -> DataFrame:
    """``u, v, w, lp, base, known`` for distinct trigrams: Katz log10 probability, base log10 probability, whether ``w`` is known."""
    found = (
        grams.join(m["p3"].withColumnRenamed("lp", "lp3"), ["u", "v", "w"], "left")
        .join(m["a3"], ["u", "v"], "left")
        .join(m["p2"].withColumnRenamed("lp", "lp2"), ["v", "w"], "left")
        .join(m["a2"].withColumnRenamed("la", "la2"), ["v"], "left")
        .join(m["p1"].select("w", F.col("lp").alias("lp1")), ["w"], "left")
    )
    base = F.coalesce("lp1", F.lit(m["unknown"]))
    two = F.coalesce("lp2", F.coalesce("la2", F.lit(0.0)) + base)
    three = F.coalesce("lp3", F.coalesce("la", F.lit(0.0)) + two)
    return found.select("u", "v", "w", three.alias("lp"), base.alias("base"), F.col("lp1").isNotNull().cast("long").alias("known"))


def _repeatable(df: DataFrame) -> bool:
    """Whether a second run gives the same rows in the same order to the same tasks: files, columns and conditions only."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter") and plan.deterministic():
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation" or plan.nodeName().startswith("Relation")


def score(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", keep_text: bool = True) -> DataFrame:
    """``df`` with ``held_out``, ``n_tokens``, ``n_known``, ``base_score``, ``score``, ``train_tokens`` (columns of these names are replaced); without the text if ``keep_text`` is false."""
    spark = df.sparkSession
    names = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = df.drop(*names, "_row")
    # a block must hold the same texts whenever it is read
    rows = rows if _repeatable(rows) else stored(rows, "lm-texts")
    kept = [f for f in rows.schema.fields if keep_text or f.name != text_col]
    size = text_bytes(rows, text_col)
    shards = max(1, min(size // (FEW_BYTES // 8), spark.sparkContext.defaultParallelism), min(FEW, size // FEW_BYTES), -(-size // SHARD_BYTES))
    texts = rows.select(*(F.col("`" + f.name.replace("`", "``") + "`") for f in kept), F.col(text_col).alias("_text"), held_out(F.col(id_col)).alias("_held"))
    read = partial(ngram_shards.read_blocks, shards=shards, n_kept=len(kept))
    blocks = texts.mapInArrow(read, "key bigint, row binary").rdd.map(lambda r: (r[0], pickle.loads(r[1])))
    most = MAX_DISCOUNTED + 1
    scored, n = ngram_shards.katz(blocks, shards, most, ADD, lambda seen: good_turing(dict(enumerate(seen))))
    more = [("held_out", T.BooleanType()), ("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType())]
    schema = T.StructType([*kept, *(T.StructField(*f) for f in more)])
    streams = spark.createDataFrame(scored.map(lambda data: (data,)), "data binary", verifySchema=False)
    out = streams.mapInArrow(partial(ngram_shards.read_streams, names=schema.names), schema)
    return out.withColumn("train_tokens", F.lit(n).cast("bigint"))


@query("op12_lm_scoring")
def op12_lm_scoring(spark, sf_dir) -> DataFrame:
    scored = score(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
