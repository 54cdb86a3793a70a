"""Quality rules against the same rules written out in Python."""

import random
import re

import pytest

from shelfmark.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, h int, kept string"


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    marked = {j for p in seen.values() if len(p) > 1 for i in p for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    out = (len(w), sum(map(len, w)), sum(c in Q.SYMBOLS for c in text), len(lines) - len(set(lines)), len(marked))
    return (*out, len(w) < 20 or 100 * len(marked) > 30 * len(w))


def corpus(seed):
    r = random.Random(seed)
    line = lambda: " ".join(r.choice(["a", "b", "cé", "#x", "d\te", "漢"]) for _ in range(r.randint(0, 12)))
    pool = [line() for _ in range(6)]
    texts = [None, "", "\n\n", "a " * 7, "a " * 8, "a " * 9, "b\x0bc\rd\x1ce\xa0f", " ".join(f"w{i}" for i in range(5000))]
    for _ in range(40):
        texts.append("\n".join(r.choice(pool) if r.random() < 0.3 else line() for _ in range(r.randint(0, 12))))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_counts(spark, seed):
    texts = corpus(seed)
    df = spark.createDataFrame([(i, t, "s", 1, "x") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: tuple(r[c] for c in (*Q.COUNTS, "base_failed")) for r in Q.counts(df).collect()}
    assert [got[i] for i in range(len(texts))] == [plain(t) for t in texts]


def test_documents_of_boilerplate_are_rejected(spark):
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(30))
    line = "Accept  all our Cookies " + " ".join(f"Now{j}" for j in range(30))
    rows = [(i, f"{line}\n{own(i)}", "s") for i in range(30)]
    rows += [(100, f"{line.lower()}\nwords here", "s"), (101, f"{line}\nwords here", "other")]
    rows += [(200 + i, own(999), "s") for i in range(300)] + [(None, None, None)] * 2
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    judged = Q.judge(df)
    assert judged.columns == ["doc_id", "text", "source", "h", *Q.COUNTS, "base_failed", "kept"]
    got = {r.doc_id: r.kept for r in judged.collect()}
    assert judged.count() == len(rows)
    assert not got[100] and not got[None]
    assert all(kept for i, kept in got.items() if i not in (100, None))
    cut = {r.doc_id: r.text for r in Q.without_frequent_lines(df).collect()}
    assert cut[3] == own(3) and cut[100] == "words here" and cut[101] == rows[31][1] and cut[None] is None
    assert Q.judge(df.limit(0)).collect() == []


def near_copies(r, start, n, n_lines, source):
    """Rows of ``n`` texts of one body: in each a line is replaced or has a word changed."""
    body = [" ".join(f"b{start}l{j}w{i}" for i in range(10)) for j in range(n_lines)]
    rows = []
    for i in range(n):
        lines = list(body)
        at = r.randrange(n_lines)
        lines[at] = f"changed{i} {lines[at]}" if i % 2 else " ".join(f"new{i}x{j}" for j in range(10))
        rows.append((start + i, "\n".join(lines) if i else "\n".join(body), source))
    return rows


def test_near_copies_count_as_one(spark):
    r = random.Random(3)
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    menu = [" ".join(f"m{j}w{k}" for k in range(9)) for j in range(3)]
    pool = [" ".join(f"p{j}w{k}" for k in range(9)) for j in range(12)]
    rows = [(i, "\n".join([*menu, own(i)]), "hot") for i in range(100)]
    rows += near_copies(r, 1000, 300, 8, "hot") + near_copies(r, 2000, 60, 30, "hot")
    rows += [(3000 + i, own(3000 + i), "small") for i in range(380)] + near_copies(r, 4000, 20, 12, "small")
    # nothing but boilerplate: the menu of full pages, and lines of a pool in any order
    rows += [(5000 + i, "\n".join([*menu, f"only this {i}"]), "hot") for i in range(40)]
    rows += [(6000 + i, "\n".join(r.sample(pool, 4)), "mixed") for i in range(200)]
    df = spark.createDataFrame([(*x, 1, "x") for x in rows], SCHEMA)
    kept = {x.doc_id for x in Q.judge(df).where("kept").collect()}
    assert kept == {x[0] for x in rows if x[0] < 5000}
