"""Source divergence audit against a brute force over all pairs and terms, in plain Python."""

import re
from collections import Counter, defaultdict

from shelfmark.llm import divergence_audit as A

TERM = re.compile(A.TERM)


def brute(rows):
    docs = [((lang or ""), (source or ""), TERM.findall((text or "").translate(str.maketrans(A._UPPER, A._UPPER.lower())))) for text, lang, source in rows]
    groups = sorted({(lang, source) for lang, source, _ in docs})
    df, cnt = Counter(), Counter()
    for lang, source, w in docs:
        df.update((lang, t) for t in set(w))
        cnt.update((lang, source, t) for t in w)
    kept = defaultdict(set)
    for (lang, t), k in df.items():
        if k >= A.MIN_DOCUMENTS:
            kept[lang].add(t)

    def p(c, n, v):
        return 1 + (A.SCALE * (c + 2)) // (n + 2 * v)

    def f(a, b):
        return (a - b) ** 2 // (a + b)

    prof, lang_c = {}, defaultdict(Counter)
    for lang, source in groups:
        terms = kept[lang]
        n = sum(cnt[lang, source, t] for t in terms)
        prof[lang, source] = {t: (cnt[lang, source, t], p(cnt[lang, source, t], n, len(terms))) for t in terms}
        for t in terms:
            lang_c[lang][t] += cnt[lang, source, t]
    out = []
    for lang, source in groups:
        terms = kept[lang]
        total = sum(lang_c[lang].values())
        q = {t: p(lang_c[lang][t], total, len(terms)) for t in terms}
        pairs = [(sum(f(prof[lang, source][t][1], prof[lang, o][t][1]) for t in terms), o) for (l2, o) in groups if l2 == lang and o != source]
        for i, (v, o) in enumerate(sorted(pairs, key=lambda x: (-x[0], x[1].encode()))):
            out.append((lang, source, "pair", o, v, i + 1))
        used = [(f(pp, q[t]), t) for t, (c, pp) in prof[lang, source].items() if c > 0 and pp > q[t]]
        for i, (v, t) in enumerate(sorted(used, key=lambda x: (-x[0], x[1].encode()))[: A.TOP_TERMS]):
            out.append((lang, source, "term", t, v, i + 1))
    return sorted(out)


def corpus():
    words = ["alpha", "Beta", "gamma", "délta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu"]
    rows = []
    for i in range(160):
        text = " ".join(words[(i * k + k) % len(words)] for k in range(1, 3 + i % 9)) + ("  x1y2 Z" if i % 3 else "")
        rows.append((None if i % 41 == 0 else text, ["en", "fr", None][i % 3], [f"s{i % 5}", None, "big"][i % 3 if i % 7 else 2]))
    rows += [("only here", "solo", "one")] * 3 + [("", "en", "quiet")] + [rows[5]] * 4
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("g", A.F.lit(1)).withColumn("zs", A.F.lit("x")).repartition(5)
    got = sorted(tuple(r) for r in A.audit(df).collect())
    assert got == brute(rows)
    assert any(r[2] == "term" for r in got) and any(r[1] == "quiet" and r[2] == "pair" for r in got)


def test_language_without_kept_terms(spark):
    rows = [("one two", "xx", "a"), ("three", "xx", "b"), (None, "xx", None)]
    got = sorted(tuple(r) for r in A.audit(spark.createDataFrame(rows, "text string, lang string, source string")).collect())
    assert got == brute(rows)
    assert {r[4] for r in got} == {0} and len(got) == 6


def test_empty(spark):
    assert A.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_terms_are_counted_before_they_are_dealt_out(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(A, "_HELD", 5)
    rows = [(t or "", lang or "", source or "") for t, lang, source in corpus()]
    texts, langs, sources = zip(*rows, strict=True)
    table = pa.table({"lang": langs, "source": sources, "t": texts})
    made = [r for b in A._tally(table.to_batches(max_chunksize=40)) for r in b.to_pylist()]
    occurrences, documents = Counter(), Counter()
    for r in made:
        occurrences[r["lang"], r["source"], r["term"]] += r["count"]
        documents[r["lang"], r["source"], r["term"]] += r["documents"]
    want, want_documents = Counter(), Counter()
    for t, lang, source in rows:
        w = [(lang, source, x) for x in TERM.findall(t.translate(str.maketrans(A._UPPER, A._UPPER.lower())))]
        want.update(w)
        want_documents.update(set(w))
    assert occurrences == want and documents == want_documents
    assert len(want) < len(made) < sum(want.values()) / 2
    # one exchange serves the counts and all that is done by term
    df = spark.createDataFrame(corpus(), "text string, lang string, source string")
    plan = A.term_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Generate" not in plan, plan
