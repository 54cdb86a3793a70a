"""Source divergence audit: how far each source's term profile lies from its language's and from every other source's.

Terms are runs of letters and of characters beyond ASCII (A-Z lower-cased);
a language keeps the terms found in at least ``MIN_DOCUMENTS`` of its
documents. Every (lang, source) group, and every language as a whole, gives each
kept term a smoothed integer profile value
``p = 1 + floor(SCALE * (count + 2) / (N + 2 V))``, exact in decimal arithmetic.
Two values compare by ``f = floor((p - q)^2 / (p + q))``.

Part ``pair``: for a group and each other source of its language, ``f`` summed
over all kept terms. Most terms of a group have count 0, where ``p`` is the
group's zero baseline ``z``. The sums are built by Gustavson row accumulation:
the postings of a group (its terms with count > 0) stand in the
term-major index (per term: the sources that have it and their ``p``) and each
posting scatters ``f(p, a) - f(z, a)`` into the group's dense accumulator over
all peers, ``a`` being the index row with the peers' baselines filled in. The
baselines are corrected in the same pass: each posting also adds
``f(z', p) - f(z', z)`` to the column of every peer ``z'``, and
``V f(z, z')`` completes the sum. No row per pair of postings is ever made;
accumulators are summed across tasks at the end.

Part ``term``: the terms a group uses more than its language, by ``f``, the
first ``TOP_TERMS`` of each group (a window limit that Spark applies before
the shuffle as well).

Cases: null text, lang or source count as ''; a group without kept terms
still has pairs (value from baselines, or 0 when its language keeps no term);
repeated rows count as separate documents; an empty table gives an empty
result; the input's other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import query, small_side, stored, table
from shelfmark.llm.word_ids import parts

# fixed values: what a term is, the least documents of a kept term, the scale of profile values, terms listed a group
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCUMENTS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# each byte as it stands in terms: A-Z lower-cased, a space where TERM has a gap
_TO_TERMS = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalpha() else b if b >= 128 else 32 for b in range(256))
# rows of an Arrow batch, and distinct terms that a task holds before it hands them on
_ROWS = 1 << 14
_HELD = 1 << 19


def _p(count, n, v):
    """Exact ``1 + floor(SCALE * (count + 2) / (n + 2 v))`` as a long."""
    wide = "decimal(38,0)"
    num = (count.cast(wide) + 2) * F.lit(SCALE).cast(wide)
    return 1 + F.call_function("div", num, n.cast(wide) + 2 * v.cast(wide))


def _f(p, q):
    return F.call_function("div", (p - q) * (p - q), p + q)


def _tally(batches):
    """Occurrences and documents of the terms met in a task: rows ``lang, source, term, count, documents``, at times more than one a term."""
    found: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def rows():
        for (lang, source), (count, documents) in found.items():
            n = len(count)
            for lo in range(0, n, _ROWS):
                terms = list(islice(count, lo, lo + _ROWS))
                yield pa.record_batch(
                    {
                        "lang": pa.array([lang] * len(terms), pa.string()),
                        "source": pa.array([source] * len(terms), pa.string()),
                        "term": pa.array(terms, pa.binary()).cast(pa.string()),
                        "count": pa.array(map(count.__getitem__, terms), pa.int64(), size=len(terms)),
                        "documents": pa.array(map(documents.__getitem__, terms), pa.int64(), size=len(terms)),
                    }
                )
        found.clear()

    for whole in batches:
        for batch in parts(whole, "t"):
            for lang, source, text in zip(*(batch[c].to_pylist() for c in ("lang", "source", "t")), strict=True):
                # gaps become spaces; what is left are letters and bytes beyond ASCII
                terms = text.encode().translate(_TO_TERMS).split()
                count, documents = found.setdefault((lang, source), (Counter(), Counter()))
                count.update(terms)
                documents.update(set(terms))
            if sum(len(count) for count, _ in found.values()) > _HELD:
                yield from rows()
    yield from rows()


def term_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``lang, source, term, count, documents``: occurrences and documents of each term in each group, dealt by (lang, term)."""
    rows = df.select(*(F.coalesce(c, F.lit("")).alias(a) for c, a in (("lang", "lang"), ("source", "source"), (text_col, "t"))))
    found = rows.mapInArrow(_tally, "lang string, source string, term string, count bigint, documents bigint")
    # counted in the tasks already: dealt out as they are, once for all that is done by term
    found = found.repartition("lang", "term")
    return found.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("documents").alias("documents"))


def profiles(df: DataFrame, text_col: str = "text"):
    """``groups`` (lang, source, g, n, v, z), ``langs`` (lang, n, v, zs), ``index`` (lang, term, q and ``at``: g and p of each source that has the term)."""
    # a term has a row for each source: few in one window
    df_ = F.sum("documents").over(Window.partitionBy("lang", "term"))
    kept = term_counts(df, text_col).withColumn("df", df_).where(F.col("df") >= MIN_DOCUMENTS)
    # read by several branches: counted once, from one pass over the texts
    terms = kept.groupBy("lang", "term").agg(F.sum("count").alias("c"), F.collect_list(F.struct("source", "count")).alias("at"))
    terms = stored(terms, "term-counts")
    v = terms.groupBy("lang").agg(F.count("*").alias("v"))
    n = terms.select("lang", F.inline("at")).groupBy("lang", "source").agg(F.sum("count").alias("n"))
    names = df.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    # a language's sources are few: numbered in one window per language
    g = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = names.join(n, ["lang", "source"], "left").join(v, "lang", "left").select(
        "lang", "source", g.alias("g"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v")
    )
    groups = small_side(groups.withColumn("z", F.when(F.col("v") > 0, _p(F.lit(0), F.col("n"), F.col("v")))), "groups")
    langs = groups.groupBy("lang").agg(F.sum("n").alias("n"), F.max("v").alias("v"), F.array_sort(F.collect_list(F.struct("g", "source", "n", "z"))).alias("zs"))
    langs = small_side(langs.select("lang", "n", "v", F.col("zs.z").alias("zs"), F.col("zs.source").alias("sources"), F.col("zs.n").alias("ns")), "langs")

    def place(x):
        g = (F.array_position("sources", x["source"]) - 1).cast("int")
        return F.struct(g.alias("g"), _p(x["count"], F.get("ns", g), F.col("v")).alias("p"))

    index = terms.join(langs, "lang").select("lang", "term", _p(F.col("c"), F.col("n"), F.col("v")).alias("q"), F.transform("at", place).alias("at"))
    return groups, langs, stored(index, "term-index")


def _fn(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return (d * d) // (p + q)


def _accumulate(batches):
    """Dense per-peer accumulators of the groups met in a task: rows ``lang, g, acc``."""
    acc: dict[str, np.ndarray] = {}
    for b in batches:
        if b.num_rows == 0:
            continue
        cols = {name: b.column(name) for name in b.schema.names}
        langs = cols["lang"].to_numpy(zero_copy_only=False)
        for lang in np.unique(langs):
            take = np.flatnonzero(langs == lang)
            zs = np.asarray(cols["zs"][int(take[0])].as_py(), np.int64)
            mat = acc.setdefault(lang, np.zeros((len(zs), len(zs)), np.int64))
            at = pa.array(cols["at"].take(pa.array(take)))
            g, p = (np.asarray(at.values.field(c), np.int64) for c in ("g", "p"))
            rows = np.repeat(np.arange(len(take)), np.diff(np.asarray(at.offsets)))
            # the index rows with the peers' baselines filled in
            dense = np.broadcast_to(zs, (len(take), len(zs))).copy()
            dense[rows, g] = p
            for lo in range(0, len(g), _ROWS):
                gs, ps, peers = g[lo : lo + _ROWS], p[lo : lo + _ROWS, None], dense[rows[lo : lo + _ROWS]]
                z = zs[gs][:, None]
                # row scatter: the group's own terms against every peer
                np.add.at(mat, gs, _fn(ps, peers) - _fn(z, peers))
                # baseline correction: this posting seen by every peer with count 0 there
                np.add.at(mat.T, gs, _fn(zs[None, :], ps) - _fn(zs[None, :], z))
    names, gs, rows_out = [], [], []
    for lang, mat in acc.items():
        for g in range(mat.shape[0]):
            names.append(lang)
            gs.append(g)
            rows_out.append(mat[g])
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array(gs, pa.int64()), pa.array(rows_out, pa.list_(pa.int64()))], ["lang", "g", "acc"]
    )


def pair_sums(groups: DataFrame, langs: DataFrame, index: DataFrame) -> DataFrame:
    """``lang, g, s, value``: f summed over all kept terms for every ordered pair of groups of a language."""
    rows = index.join(langs.select("lang", "zs"), "lang").select("lang", "at", "zs")
    parts = rows.mapInArrow(_accumulate, "lang string, g long, acc array<long>")
    spread = parts.select("lang", "g", F.posexplode("acc").alias("s", "value"))
    sums = spread.groupBy("lang", "g", "s").agg(F.sum("value").alias("value"))
    # every pair, from the baselines of the language, whether or not it has postings
    pairs = groups.select("lang", "g", "z", "v").join(langs.select("lang", "zs"), "lang").select(
        "lang", "g", "z", "v", F.posexplode("zs").alias("s", "zs_s")
    )
    pairs = pairs.where(F.col("g") != F.col("s")).join(sums, ["lang", "g", "s"], "left")
    base = F.col("v") * _f(F.col("z"), F.col("zs_s"))
    value = F.when(F.col("v") == 0, F.lit(0)).otherwise(base + F.coalesce("value", F.lit(0)))
    return pairs.select("lang", "g", "s", value.cast("bigint").alias("value"))


def audit(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``lang, source, part, item, value, rank``: both parts for every group."""
    groups, langs, index = profiles(df, text_col)
    sums = pair_sums(groups, langs, index)
    named = groups.select("lang", "g", "source")
    other = groups.select("lang", F.col("g").alias("s"), F.col("source").alias("item"))
    pair = sums.join(named, ["lang", "g"]).join(other, ["lang", "s"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    used = index.select("lang", "term", "q", F.inline("at")).where(F.col("p") > F.col("q")).join(named, ["lang", "g"])
    term = used.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _f(F.col("p"), F.col("q")).cast("bigint").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item"))
    pair = pair.withColumn("rank", F.row_number().over(order))
    term = term.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP_TERMS)
    return pair.unionByName(term).select("lang", "source", "part", "item", "value", "rank")


def _sql() -> str:
    lower = _UPPER.lower()
    return rf"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{lower}'), '{TERM}') as w
  from documents
), occ as (
  select r, lang, source, unnest(w) as term from d
), kept as (
  select lang, term from occ group by lang, term having count(distinct r) >= {MIN_DOCUMENTS}
), v as (
  select lang, count(*) as v from kept group by lang
), groups as (
  select distinct lang, source from d
), cnt as (
  select lang, source, term, count(*) as c from occ join kept using (lang, term) group by all
), n as (
  select g.lang, g.source, coalesce(sum(c.c), 0) as n, coalesce(any_value(v.v), 0) as v
  from groups g left join cnt c using (lang, source) left join v using (lang) group by g.lang, g.source
), gp as (
  select g.lang, g.source, k.term, coalesce(c.c, 0) as c,
         1 + ({SCALE}::hugeint * (coalesce(c.c, 0) + 2)) // (g.n + 2 * g.v) as p
  from n g join kept k using (lang) left join cnt c using (lang, source, term)
), lq as (
  select l.lang, l.term, 1 + ({SCALE}::hugeint * (l.c + 2)) // (t.n + 2 * t.v) as q
  from (select lang, term, sum(c) as c from gp group by all) l
  join (select lang, sum(n) as n, any_value(v) as v from n group by lang) t using (lang)
), pv as (
  select a.lang, a.source as s, b.source as o, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from gp a join gp b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), allp as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(pv.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join pv on pv.lang = a.lang and pv.s = a.source and pv.o = b.source
  union all
  select g.lang, g.source, 'term', g.term, ((g.p - l.q) * (g.p - l.q) // (g.p + l.q))::bigint
  from gp g join lq l using (lang, term) where g.c > 0 and g.p > l.q
)
select lang, source, part, item, value, rank::int as rank from (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from allp
) where part = 'pair' or rank <= {TOP_TERMS}
"""


@query("op13_divergence_audit", _sql())
def op13_divergence_audit(spark, sf_dir) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))
