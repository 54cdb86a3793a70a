"""Fill-in-the-middle: cuts by code points agree with plain Python slicing, and the output restores exactly."""

import hashlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.llm import fill_in_middle as M


def plain(doc_id, text):
    """Brute force: Python strings are sequences of code points."""
    t = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(t)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if n == 0 or any(s in t for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    p, m, s = t[:a], t[a:b], t[b:]
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return n, ("spm" if h4 % 100 < 20 else "psm"), a, b - a, out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.characters(codec="utf-8"), max_size=40)), max_size=12), st.data())
def test_byte_cuts_match_code_points(texts, data):
    cuts = [data.draw(st.integers(0, len(t or ""))) for t in texts]
    n, (got,) = M.byte_cuts(pa.array(texts, pa.string()), [np.array(cuts, np.int64)])
    assert list(n) == [len(t or "") for t in texts]
    assert list(got) == [len((t or "")[:c].encode()) for t, c in zip(texts, cuts)]


TEXTS = [None, "", "a", "é", "日本語のテキスト", "emoji 😀 and 𝔘𝔫𝔦 text", "has <P> inside", "x <M> y", "<S>", "word " * 3000, "mixed é 😀 " * 200]


def test_against_python(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)] + [(None, "no id here"), (7, "repeated row"), (7, "repeated row")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fim", M.F.lit("clash")).repartition(3)
    got = M.fim(df).select("doc_id", "text", "fim.*").collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r[6]) == plain(r.doc_id, r[1])
        back = spark.createDataFrame([(r[6], r.form)], "o string, f string").select(M.restore(M.F.col("o"), M.F.col("f"))).first()[0]
        assert back == (r[1] or "")
    forms = {r.form for r in got}
    assert forms <= {"plain", "psm", "spm"} and "plain" in forms


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert M.fim(df).count() == 0


def test_query(spark, tmp_path):
    from shelfmark.llm.common import QUERIES

    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in QUERIES["op11_fill_in_middle"](spark, str(tmp_path)).collect():
        t = TEXTS[r.doc_id] or ""
        n, form, a, m, out = plain(r.doc_id, t)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, a, m)
        assert r.output_sha256 == hashlib.sha256(out.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(t.encode()).hexdigest()
