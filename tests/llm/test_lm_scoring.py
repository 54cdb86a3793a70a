"""Katz back-off scores against a plain Python model built from the same definition."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from shelfmark.llm import lm_scoring as L


def toks(text):
    plain = (text or "").translate(str.maketrans(L._UPPER, L._UPPER.lower()))
    return [w for w in re.split(r"[ \t\n\x0b\f\r]+", plain) if w] + [L.END]


def brute(rows):
    held = {i: doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 == 0 for i, (doc_id, _) in enumerate(rows)}
    c3 = Counter()
    for i, (_, text) in enumerate(rows):
        if not held[i]:
            t = [L.BEGIN, L.BEGIN] + toks(text)
            c3.update((t[j - 2], t[j - 1], t[j]) for j in range(2, len(t)))
    c2, c1 = Counter(), Counter()
    for (u, v, w), c in c3.items():
        c2[v, w] += c
    for (v, w), c in c2.items():
        c1[w] += c
    n, vocab = sum(c1.values()), len(c1)

    def p1(w):
        return (c1.get(w, 0) + L.ADD) / (n + L.ADD * (vocab + 1))

    def disc(counts):
        nr = Counter(counts.values())
        out = [1.0] * (L.MAX_DISCOUNTED + 1)
        if nr[1] == 0:
            return out
        common = (L.MAX_DISCOUNTED + 1) * nr[L.MAX_DISCOUNTED + 1] / nr[1]
        if common >= 1:
            return out
        for r in range(1, L.MAX_DISCOUNTED + 1):
            if nr[r]:
                d = ((r + 1) * nr[r + 1] / (r * nr[r]) - common) / (1 - common)
                out[r] = d if 0 < d <= 1 else 1.0
        return out

    def level(counts, hist_of, lower):
        d = disc(counts)
        by = defaultdict(dict)
        for g, c in counts.items():
            by[hist_of(g)][g[-1]] = c

        def prob(h, w):
            foll = by.get(h)
            if not foll:
                return lower(h[1:], w)
            total = sum(foll.values())
            left = sum((1 - (d[c] if c <= L.MAX_DISCOUNTED else 1)) * c / total for c in foll.values())
            seen = sum(lower(h[1:], x) for x in foll)
            if w in foll:
                c = foll[w]
                return (d[c] if c <= L.MAX_DISCOUNTED else 1) * c / total if left > 0 else seen * c / total
            return (left / (1 - seen) if left > 0 else 1.0) * lower(h[1:], w)

        return prob

    p2 = level(c2, lambda g: (g[0],), lambda h, w: p1(w))
    p3 = level(c3, lambda g: (g[0], g[1]), p2)
    out = []
    for i, (doc_id, text) in enumerate(rows):
        t = [L.BEGIN, L.BEGIN] + toks(text)
        grams = [(t[j - 2], t[j - 1], t[j]) for j in range(2, len(t))]
        out.append((doc_id, held[i], len(grams), sum(c1.get(w, 0) > 0 for _, _, w in grams), n,
                    sum(math.log10(p1(w)) for _, _, w in grams), sum(math.log10(p3((u, v), w)) for u, v, w in grams)))
    return out


def corpus():
    words = "the cat sat on a mat and The dog ran to the park while a bird sang".split()
    rows = []
    for i in range(300):
        k = 3 + (i * 7) % 23
        rows.append((i, " ".join(words[(i * j + j * j) % len(words)] for j in range(k))))
    rows += [(None, "the cat sat"), (5, rows[5][1]), (5, rows[5][1]), (1000, None), (1001, ""), (1002, "unseen zebra words " * 200)]
    return rows


def close(a, b):
    return all((x == y) if not isinstance(x, float) else math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(a, b))


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", L.F.lit("clash")).withColumn("_row", L.F.lit(1)).repartition(4)
    got = sorted((tuple(r) for r in L.score(df).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), key=repr)
    want = sorted(brute(rows), key=repr)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert close(a, b), (a, b)
    # the model prefers held-out texts like the training ones to word salad
    assert any(r[1] for r in got) and any(not r[1] for r in got)


def test_normalised(spark):
    """Every history's distribution over the vocabulary and the unknown token sums to one."""
    rows = corpus()[:120]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    grams = L.trigrams(df.withColumn("held_out", L.held_out(L.F.col("doc_id"))), "text", "held_out")
    m = L.model(grams.where(~L.F.col("held_out")).select("u", "v", "w"))
    vocab = [r.w for r in m["p1"].collect()]
    hists = [(r.u, r.v) for r in m["a3"].limit(5).collect()] + [(L.BEGIN, "zzz")]
    cand = spark.createDataFrame([(u, v, w) for u, v in hists for w in vocab + ["<never>"]], "u string, v string, w string")
    vals = L.evaluate(cand, m).collect()
    unknown_mass = 10 ** m["unknown"]
    for u, v in hists:
        known = sum(10 ** r.lp for r in vals if (r.u, r.v) == (u, v) and r.w != "<never>")
        never = [10 ** r.lp for r in vals if (r.u, r.v) == (u, v) and r.w == "<never>"][0]
        # the unknown token's probability at the bottom is that of one unknown word
        assert known + never * (unknown_mass / 10 ** m["unknown"]) == pytest.approx(1.0, abs=1e-9)


def test_empty(spark):
    assert L.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_as_tables(spark):
    """Scores are those of the model's tables, and only packed rows are shuffled: no exchange has a row per token."""
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("held_out", L.held_out(L.F.col("doc_id")))
    grams = L.trigrams(df, "text", "held_out").select("u", "v", "w", "held_out")
    m = L.model(grams.where(~L.F.col("held_out")).select("u", "v", "w"))
    values = L.evaluate(grams.select("u", "v", "w").distinct(), m)
    want = grams.join(values, ["u", "v", "w"]).agg(L.F.count("*"), L.F.sum("known"), L.F.sum("base"), L.F.sum("lp")).first()
    scored = L.score(df)
    got = scored.agg(L.F.sum("n_tokens"), L.F.sum("n_known"), L.F.sum("base_score"), L.F.sum("score")).first()
    assert close(tuple(got), tuple(want))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan
