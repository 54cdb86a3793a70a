"""Secret scan: planted secrets, harmless look-alikes, held-out accuracy, redaction."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from shelfmark.llm import secret_scan as S

HEX = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
GH = "ghp_x8Kd92LmQ7rT5vWz1YbN4cFgHjPsA6eUoI3k"
TEXTS = {
    1: f'some words token = "{HEX}" more words here',
    2: f"export API_KEY={GH} and go on",
    3: "a thoroughlyunremarkablelongword here and there",
    4: "pay with 4980791576280449 please",
    5: "see /usr/share/documents/report.txt or http://www.example.com/some/page for more",
    6: f"commit {HEX[::-1]} fixed it",
    7: None, 8: "",
    9: f'TOKEN = "{HEX}" again token = "{HEX}".',
}


@pytest.fixture(scope="module")
def docs(spark):
    filler = [(100 + i, "plain words and documents report share example page some country number", None) for i in range(40)]
    return spark.createDataFrame([(i, t, "x") for i, t in TEXTS.items()] + filler, "doc_id long, text string, n_secrets string").cache()


def test_planted(spark, docs):
    got = {}
    for r in S.scan(docs).collect():
        if r.is_secret:
            got.setdefault(r.doc_id, set()).add(r.secret)
    assert got == {1: {HEX}, 2: {GH}, 9: {HEX}}
    red = {r.doc_id: r for r in S.redact(docs).collect()}
    assert red[1].text == 'some words token = "<secret>" more words here' and red[1].n_secrets == 1
    assert HEX not in red[9].text and red[9].text.count(S.MARK) == 2
    assert all(red[i].text == TEXTS[i] and red[i].n_secrets == 0 for i in (3, 4, 5, 6, 7, 8))
    assert len(red) == docs.count()


def test_held_out_accuracy(spark, docs):
    known = S.dictionary(docs, min_count=5)
    model = S.train(spark, S.candidates(docs), known)
    other = S.labelled(spark, 2 * S.LABELLED).exceptAll(S.labelled(spark))
    frame = VectorAssembler(inputCols=list(S.FEATURES), outputCol="x").transform(S.features(other, known))
    right = model.transform(frame).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert right > 0.95


def test_empty_and_repeated_rows(spark, docs):
    assert S.scan(docs.limit(0)).collect() == []
    twice = docs.where("doc_id = 1").union(docs.where("doc_id = 1")).withColumn("doc_id", F.lit(None).cast("long"))
    assert [r.text for r in S.redact(twice).collect()] == ['some words token = "<secret>" more words here'] * 2
