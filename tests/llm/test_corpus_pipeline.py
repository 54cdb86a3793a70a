"""The pipeline on documents with planted cases."""

import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P

SECRET = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"


def documents():
    r = random.Random(8)
    fresh = lambda n: " ".join(f"w{r.randint(0, 50_000)}" for _ in range(n))
    passage = fresh(55)
    clean = {i: fresh(r.randint(25, 400)) for i in range(40)}
    rows = dict(clean)
    rows |= {100: "too short", 101: "same words again and again " * 30, 102: None, 103: ""}
    rows |= {200 + i: clean[i] for i in range(5)}
    rows[300] = clean[7] + " one more word"
    rows |= {400: f"{fresh(30)} {passage} {fresh(30)}", 401: f"{fresh(200)} {passage}", 402: passage}
    rows[500] = f'{fresh(30)} token = "{SECRET}" {fresh(5)}'
    return clean, rows


def test_stages(spark):
    clean, rows = documents()
    df = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows.items()], "doc_id long, text string, lang string, source string, n_chars long")
    kept, docs = {}, df
    for name, stage in P.STAGES[:-1]:
        docs = P.stored(stage(spark, docs, ""), name)
        assert docs.columns == P.COLUMNS
        kept[name] = {x.doc_id: x.text for x in docs.collect()}
        assert all(x.n_chars == len(x.text) for x in docs.collect())
        assert all(kept[name].get(i) == t for i, t in clean.items())
    assert kept["quality_rules"].keys() == rows.keys() - {100, 101, 102, 103}
    assert kept["near_dedup"].keys() == kept["quality_rules"].keys() - {200, 201, 202, 203, 204, 300}
    last = kept["substring_dedup"]
    assert 402 not in last and len(last[400].split()) == 60 and len(last[401].split()) == 200
    assert SECRET not in kept["secret_scan"][500] and P.secret_scan.MARK in kept["secret_scan"][500]
    pieces = P.packed(spark, docs, "").collect()
    tokens = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: len(tokens.encode(t, add_special_tokens=False).ids) + 1 for i, t in kept["secret_scan"].items()}
    got = {}
    for x in pieces:
        got[x.doc_id] = got.get(x.doc_id, 0) + x.length
    assert got == want


def test_run_on_supplied_documents(spark):
    out = P.run(spark, "/root/testdata/sf0.001")
    ids = {x.doc_id for x in out.select("doc_id").collect()}
    assert 0 < len(ids) < 200
    assert P.run.__name__ == "run" and out.agg({"length": "max"}).first()[0] <= 2048


def test_a_large_group_of_near_copies_leaves_one(spark):
    r = random.Random(6)
    fresh = lambda n: " ".join(f"w{r.randint(0, 50_000)}" for _ in range(n))
    body = [fresh(12) for _ in range(9)]
    rows = [(i, fresh(80)) for i in range(100)]
    for i in range(60):
        lines = list(body)
        lines[i % 9] = f"{lines[i % 9]} also{i}"
        rows.append((1000 + i, "\n".join(lines)))
    docs = spark.createDataFrame([(i, t, "en", "hot", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in P.STAGES[:-1]:
        docs = P.stored(stage(spark, docs, ""), name)
    assert {x.doc_id for x in docs.collect()} == {*range(100), 1000}


def test_boilerplate_is_cut_from_kept_documents(spark):
    r = random.Random(7)
    fresh = lambda n: " ".join(f"w{r.randint(0, 50_000)}" for _ in range(n))
    line, own = "Read more about our nine offers in this shop", [fresh(40) for _ in range(60)]
    rows = [(i, f"{t}\n\n{line if i % 2 else line.upper()}" if i < 30 else t, "a") for i, t in enumerate(own)]
    rows += [(100, f"{line}\nlittle else", "a"), (101, f"{line}\n{own[0]}", "b")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = P.quality(spark, docs, "")
    assert out.columns == P.COLUMNS
    got = {x.doc_id: (x.text, x.n_chars) for x in out.collect()}
    want = {i: f"{t}\n" if i < 30 else t for i, t in enumerate(own)} | {101: rows[-1][1]}
    assert got == {i: (t, len(t)) for i, t in want.items()}
