"""Quality rules: per-text counts, and lines that too many documents of a host share.

A text fails outright when it is short or repeats itself. The others are judged
by their lines: a line, normalised (lower case, white space collapsed) and
hashed, is boilerplate when it occurs in at least ``MIN_DOCUMENTS`` different
documents of a host and in ``MAX_SHARE`` of them. Boilerplate is removed and a
document that keeps less than ``1 - MAX_REMOVED`` of its words is rejected.
Documents with one and the same text count as one, so copies of a text are not
taken for boilerplate: which of them stays is for deduplication to say.
:func:`judge` counts near copies as one as well. A text that frequent lines
deplete is put to those that share one of its ``BODY_KEYS`` rarest frequent
lines; the lines that half of such a group has are its body, and a text that
holds more than ``MAX_REMOVED`` of its words in a body is a copy of it. A line
then counts once per body besides the texts that copy none. The SQL of the query
``op6_quality_rules`` counts exact copies only, and the query keeps to it.

All of it is DataFrame expressions. Lines are counted per (host, line, text)
before they are counted per (host, line), so a line that a third of all
documents share arrives as one row per task. Boilerplate lines and rejected
texts are pairs of numbers; they are broadcast only after they were counted.

Cases: null text has no words and fails; a null host is a host of its own; ids
may repeat or be null (verdicts depend on host and text only); an empty table
gives an empty table. Results replace columns of the same names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import BROADCAST_ROWS, SPACES, query, small_side, stored, table, words

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
REPEAT_WINDOW = 8
MIN_DOCUMENTS = 20
MAX_SHARE = 0.05
MAX_REMOVED = 0.8
BODY_KEYS = 4
# fixed values: characters counted as symbols
SYMBOLS = "#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(all_words: Column) -> Column:
    """Words inside windows of 8 words that occur twice or more in the array."""

    def joined(step: int):
        return lambda a: F.transform(a, lambda x, i: F.xxhash64(x, F.get(a, i + step)))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, j: F.least(F.lit(REPEAT_WINDOW), F.coalesce(F.get(p, j + 1), x + REPEAT_WINDOW) - x))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda s, x: s + x.cast("bigint"))

    def places(s: Column) -> Column:
        twin = F.filter(
            F.transform(s, lambda x, j: F.struct(x["i"].alias("i"), ((x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"])).alias("t"))),
            lambda x: F.coalesce(x["t"], F.lit(False)) | x["t"],
        )
        return F.array_sort(F.transform(twin, lambda x: x["i"]))

    def search(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(
            _let(ordered, lambda s: _let(places(s), covered))
        )

    ones = F.transform(all_words, lambda x: F.xxhash64(x))
    eights = _let(ones, lambda a: _let(joined(1)(a), lambda b: _let(joined(2)(b), lambda c: joined(4)(c))))
    return F.when(F.size(all_words) < REPEAT_WINDOW, F.lit(0).cast("bigint")).otherwise(
        _let(F.slice(eights, F.lit(1), F.size(all_words) - (REPEAT_WINDOW - 1)), search)
    )


def _lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(SPACES.replace("[", "[^")))


def counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the counts and ``base_failed``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = df.drop(*COUNTS, "base_failed").withColumns({"_words": words(text), "_lines": _lines(text)})
    found = found.withColumns(
        {
            "n_words": F.size("_words").cast("bigint"),
            "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
            "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]", ""))).cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "n_repeat_words": repeated_words(F.col("_words")),
        }
    ).drop("_words", "_lines")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return found.withColumn("base_failed", failed)


def _keys(host_col: str, text_col: str) -> tuple[Column, Column]:
    """Hashes of a document's host and text."""
    return F.xxhash64(F.lit("host"), F.col(host_col)), F.xxhash64(F.lit("text"), F.coalesce(F.col(text_col), F.lit("")))


def _line_rows(df: DataFrame, host_col: str, text_col: str, *more: str) -> DataFrame:
    """A row per line: ``h, k`` (host and text), ``line``, ``size`` (its words), ``total`` (words of the text)."""
    host, key = _keys(host_col, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = F.transform(_lines(text), lambda x: F.lower(F.array_join(words(x), " ")))
    rows = df.select(host.alias("h"), key.alias("k"), F.size(words(text)).alias("total"), plain.alias("p"), *more)
    rows = rows.select("h", "k", "total", *more, F.explode("p").alias("l"))
    size = F.length("l") - F.length(F.replace("l", F.lit(" "), F.lit(""))) + 1
    return rows.select("h", "k", "total", *more, F.xxhash64("h", "l").alias("line"), size.alias("size"))


def _line_counts(df: DataFrame, host_col: str, text_col: str) -> DataFrame:
    """``line, n, documents``: hashes of (host, line) above the limits, texts with the line, texts of the host."""
    rows = _line_rows(df, host_col, text_col)
    per_line = rows.select("h", "line", "k").distinct().groupBy("h", "line").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_DOCUMENTS)
    host, key = _keys(host_col, text_col)
    hosts = df.select(host.alias("h"), key.alias("k")).distinct().groupBy("h").agg(F.count("*").alias("documents"))
    return per_line.join(hosts, "h").where(F.col("n") >= MAX_SHARE * F.col("documents")).select("line", "n", "documents")


def frequent_lines(df: DataFrame, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """``line``: hashes of (host, line) above the limits."""
    return _line_counts(df, host_col, text_col).select("line")


def _held(df: DataFrame, counted: DataFrame, host_col: str, text_col: str) -> DataFrame:
    """``h, k, total, lost, held``: texts with frequent lines, the words of these, and (line, size, n) of each."""
    rows = _line_rows(df.withColumn("_row", F.monotonically_increasing_id()), host_col, text_col, "_row")
    each = F.collect_list(F.struct("line", "size", "n"))
    found = rows.join(counted.select("line", "n"), "line").groupBy("_row", "h", "k", "total").agg(F.sum("size").alias("lost"), each.alias("held"))
    return found.groupBy("h", "k").agg(*[F.first(c).alias(c) for c in ("total", "lost", "held")])


def _copied(poor: DataFrame) -> DataFrame:
    """``h, k, body``: rows of :func:`_held` that copy a body, each with the largest group in which it does."""
    ranked = F.array_sort(F.array_distinct(F.transform("held", lambda x: F.struct(x["n"], x["line"]))))
    keys = F.transform(F.slice(ranked, 1, BODY_KEYS), lambda x: x["line"])
    members = poor.select("h", "k", "total", "held", F.explode(keys).alias("bucket"))
    shared = members.select("bucket", F.explode(F.array_distinct(F.col("held.line"))).alias("line")).groupBy("bucket", "line").agg(F.count("*").alias("n"))
    # every member has the bucket's own line
    groups = shared.where("line = bucket and n > 1").select("bucket", F.col("n").alias("members"))
    body = small_side(shared.join(groups, "bucket").where(2 * F.col("n") >= F.col("members")).select("bucket", "line", "members"), "bodies")
    rows = members.select("h", "k", "total", "bucket", F.explode("held").alias("x")).select("h", "k", "total", "bucket", "x.line", "x.size")
    own = rows.join(body, ["bucket", "line"]).groupBy("h", "k", "total", "bucket").agg(F.sum("size").alias("same"), F.max("members").alias("members"))
    own = own.where(F.col("same") > MAX_REMOVED * F.col("total"))
    return own.groupBy("h", "k").agg(F.max(F.struct("members", "bucket"))["bucket"].alias("body"))


def _boilerplate(counted: DataFrame, held: DataFrame) -> DataFrame:
    """``line``: the frequent lines that stay above the limits when copies of a body count as one."""
    poor = held.where(F.col("lost") > MAX_REMOVED * F.col("total"))
    lines = poor.join(_copied(poor), ["h", "k"]).select("body", F.explode(F.array_distinct(F.col("held.line"))).alias("line"))
    per_body = lines.groupBy("line", "body").agg(F.count("*").alias("copies"))
    fewer = per_body.groupBy("line").agg(F.sum(F.col("copies") - 1).alias("fewer"))
    n = F.col("n") - F.coalesce("fewer", F.lit(0))
    return counted.join(fewer, "line", "left").where((n >= MIN_DOCUMENTS) & (n >= MAX_SHARE * F.col("documents"))).select("line")


def line_verdicts(df: DataFrame, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """``h, k, poor, cut``: texts with boilerplate (near copies counted as one), whether it depletes them, and its lines."""
    counted = small_side(_line_counts(df, host_col, text_col), "lines")
    held = stored(_held(df, counted, host_col, text_col), "held")
    lines = small_side(_boilerplate(counted, held), "boilerplate")
    rows = held.select("h", "k", "total", F.explode("held").alias("x")).select("h", "k", "total", "x.line", "x.size")
    found = rows.join(lines, "line").groupBy("h", "k", "total").agg(F.sum("size").alias("lost"), F.collect_set("line").alias("cut"))
    return found.select("h", "k", (F.col("lost") > MAX_REMOVED * F.col("total")).alias("poor"), "cut")


def depleted(df: DataFrame, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """``h, k``: hosts and texts that lose more than ``MAX_REMOVED`` of their words with the frequent lines."""
    frequent = small_side(frequent_lines(df, host_col, text_col), "lines")
    # a number per document keeps copies of a text apart until their sums are compared
    rows = _line_rows(df.withColumn("_row", F.monotonically_increasing_id()), host_col, text_col, "_row")
    lost = rows.join(frequent, "line").groupBy("_row", "h", "k", "total").agg(F.sum("size").alias("lost"))
    return lost.where(F.col("lost") > MAX_REMOVED * F.col("total")).select("h", "k").distinct()


def depleted_but_copies(df: DataFrame, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """As :func:`depleted`, with near copies of a text counted as one."""
    return line_verdicts(df, host_col, text_col).where("poor").select("h", "k")


def cleaned(df: DataFrame, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """The documents that :func:`judge` keeps, with boilerplate cut out of their texts, and ``n_cut`` (lines cut)."""
    host, key = _keys(host_col, text_col)
    found = stored(line_verdicts(df, host_col, text_col), "verdicts")
    # rows hold lists here, so their numbers are counted
    numbers = found.agg(F.sum(F.size("cut") + 3)).first()[0] or 0
    marks = (F.broadcast(found) if numbers <= BROADCAST_ROWS else found).select(F.col("h").alias("_h"), F.col("k").alias("_k"), F.col("poor").alias("_poor"), F.col("cut").alias("_cut"))
    rows = df.drop("n_cut").join(marks, (host == F.col("_h")) & (key == F.col("_k")), "left").where(~F.coalesce("_poor", F.lit(False)))
    rows = counts(rows, text_col).where(~F.col("base_failed")).drop("base_failed", *[c for c in COUNTS if c not in df.columns])
    lines = F.split(text_col, "\n")
    stay = F.filter(lines, lambda x: ~F.array_contains("_cut", F.xxhash64("_h", F.lower(F.array_join(words(x), " ")))))
    n_cut = F.when(F.col("_cut").isNull(), 0).otherwise(F.size(lines) - F.size(stay)).cast("bigint")
    text = F.when(F.col("_cut").isNull(), F.col(text_col)).otherwise(F.array_join(stay, "\n"))
    return rows.withColumns({"n_cut": n_cut, text_col: text}).drop("_h", "_k", "_poor", "_cut")


def without_frequent_lines(df: DataFrame, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """``df`` with the frequent lines of each host cut out of its texts."""
    frequent = small_side(frequent_lines(df, host_col, text_col), "lines")
    rows = df.withColumn("_id", F.monotonically_increasing_id())
    rows = rows.withColumn("_h", F.xxhash64(F.lit("host"), F.col(host_col)))
    pieces = rows.select("_id", "_h", F.posexplode(F.split(text_col, "\n")).alias("_at", "_raw"))
    pieces = pieces.withColumn("line", F.xxhash64("_h", F.lower(F.array_join(words(F.col("_raw")), " "))))
    stay = pieces.join(frequent, "line", "left_anti").groupBy("_id").agg(F.array_sort(F.collect_list(F.struct("_at", "_raw"))).alias("_stay"))
    text = F.array_join(F.col("_stay._raw"), "\n")
    return rows.join(stay, "_id", "left").withColumn(text_col, F.when(F.col(text_col).isNotNull(), F.coalesce(text, F.lit("")))).drop("_id", "_h", "_stay")


def judge(df: DataFrame, host_col: str = "source", text_col: str = "text", near_copies: bool = True) -> DataFrame:
    """``df`` with the counts, ``base_failed`` and ``kept``; ``near_copies``: count near copies as one, as exact ones are."""
    host, key = _keys(host_col, text_col)
    found = depleted_but_copies if near_copies else depleted
    poor = small_side(found(df, host_col, text_col), "depleted").select(
        F.col("h").alias("_poor_host"), F.col("k").alias("_poor_text")
    )
    judged = counts(df.drop("kept"), text_col)
    judged = judged.join(poor, (host == F.col("_poor_host")) & (key == F.col("_poor_text")), "left")
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("_poor_text").isNull()).drop("_poor_host", "_poor_text")


def _sql() -> str:
    """The verdicts in DuckDB's SQL."""
    word = r"[^\x20\x09-\x0D]+"
    white = r"[\x20\x09-\x0D]"
    return rf"""
with d as (
  select doc_id, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{word}') as w from documents
), lines as (
  select doc_id, source, text, len(w) as total, unnest([x for x in string_split(text, chr(10)) if regexp_matches(x, '{word}')]) as raw from d
), plain as (
  select doc_id, source, text, total, raw, lower(array_to_string(regexp_extract_all(raw, '{word}'), ' ')) as line,
         len(regexp_extract_all(raw, '{word}')) as size from lines
), frequent as (
  select source, line from (select source, line, count(distinct text) as n from plain group by all)
  join (select source, count(distinct text) as documents from d group by all) using (source)
  where n >= {MIN_DOCUMENTS} and n >= {MAX_SHARE} * documents
), poor as (
  select doc_id from plain join frequent using (source, line) group by doc_id, total having sum(size) > {MAX_REMOVED} * total
), starts as (
  select doc_id, w, unnest(range(1, len(w) - {REPEAT_WINDOW - 2})) as i from d where len(w) >= {REPEAT_WINDOW}
), twins as (
  select doc_id, i, count(*) over (partition by doc_id, list_slice(w, i, i + {REPEAT_WINDOW - 1})) as n from starts
), covered as (
  select doc_id, sum(least({REPEAT_WINDOW}, coalesce(after - i, {REPEAT_WINDOW}))) as n_repeat_words
  from (select doc_id, i, lead(i) over (partition by doc_id order by i) as after from twins where n > 1) group by doc_id
), base as (
  select doc_id, len(w)::bigint as n_words, length(regexp_replace(text, '{white}', '', 'g'))::bigint as word_chars,
         (length(text) - length(regexp_replace(text, '[{SYMBOLS}]', '', 'g')))::bigint as n_symbols,
         coalesce(n_lines - n_distinct, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from d left join (select doc_id, count(*) as n_lines, count(distinct raw) as n_distinct from lines group by doc_id) using (doc_id)
  left join covered using (doc_id)
)
select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words as base_failed,
       not (n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words) and doc_id not in (select doc_id from poor) as kept
from base
"""


@query("op6_quality_rules", _sql())
def op6_quality_rules(spark, sf_dir) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), near_copies=False)
    return judged.select("doc_id", *COUNTS, "base_failed", "kept")
