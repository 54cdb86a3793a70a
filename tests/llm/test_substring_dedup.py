"""Substring removal against a count of all windows."""

import hashlib
import random
import re

import pytest

from shelfmark.llm.substring_dedup import cut_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, window):
    docs = [WORD.findall(t or "") for t in texts]
    seen = {}
    for d in docs:
        for i in range(len(d) - window + 1):
            w = tuple(d[i : i + window])
            seen[w] = seen.get(w, 0) + 1
    out = []
    for d in docs:
        gone = [False] * len(d)
        for i in range(len(d) - window + 1):
            if seen[tuple(d[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(d), sum(gone), " ".join(w for w, g in zip(d, gone) if not g)))
    return out


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(r.choice([2, 5, 400]))] + ["ñandú", "漢字"]
    word = lambda: r.choice(vocabulary)
    passage = [[word() for _ in range(r.randint(20, 90))] for _ in range(6)]
    texts = [None, "", "   \n", "w1", "x " * 300, "x " * 120 + "y", "z " + "x " * 40]
    for _ in range(60):
        d = [word() for _ in range(r.randint(0, 120))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passage)
            lo = r.randint(0, 10)
            at = r.randint(0, len(d))
            d[at:at] = p[lo : len(p) - r.randint(0, 10)]
        texts.append(r.choice([" ", "\n", " \t"]).join(d))
    texts += texts[-5:] + [" ".join(["aa", "bb"] * 60), " ".join(["bb", "aa"] * 30)]
    return texts


@pytest.mark.parametrize("seed,window", [(1, 35), (2, 35), (3, 35), (4, 20)])
def test_against_all_windows(spark, seed, window):
    texts = corpus(seed)
    df = spark.createDataFrame([(i, t, i % 3) for i, t in enumerate(texts)], "doc_id long, text string, kept int")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in cut_repeats(df, window=window).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, window)


def test_across_many_batches_and_buckets(spark, monkeypatch):
    from shelfmark.llm import substring_dedup as S

    monkeypatch.setattr(S, "BATCH_BYTES", 2000)
    monkeypatch.setattr(S, "BUCKET_BYTES", 4000)
    texts = corpus(9)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in S.cut_repeats(df).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 35)


def test_empty_null_ids_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert cut_repeats(empty).collect() == []
    t = " ".join(f"w{i}" for i in range(40))
    rows = [(None, t), (None, t), (7, "a b"), (7, "a b")]
    got = cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.n_words, r.n_removed) for r in got) == [(2, 0), (2, 0), (40, 40), (40, 40)]


def test_query_digest(spark, tmp_path):
    from shelfmark.llm.common import QUERIES

    texts = corpus(5)
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.kept_sha256 for r in QUERIES["op1_substring_dedup"](spark, str(tmp_path)).collect()}
    for i, (_, _, kept) in enumerate(brute(texts, 35)):
        assert got[i] == hashlib.sha256(kept.encode()).hexdigest()
