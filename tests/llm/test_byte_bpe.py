"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib

import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.llm.byte_bpe import ByteBPE, decode, encode, round_trip

PATH = P.path("byte_bpe_50k.tiktoken")
ODD = [
    None, "", " ", "\n", "  a", "a  ", " \n x", "\n\n'x", "it's we'll they've I'm o'clock 'rest ''s 's's's!", " 's", "!'s", "\n's", "'re'd'", "'s's' 's",
    "naïve 漢字テスト １２３ ½", "a 　b\x1c\x85c", "😀😀 👩‍👩‍👧 é", "x" * 3000, "ab" * 2000 + "1" * 500, "'", "don'", "l'l 'l 'll",
]


@pytest.fixture(scope="module")
def models():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return ByteBPE(PATH), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check(models, texts):
    own, want = models
    ids, cut = own.encode(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        part = ids[cut[i] : cut[i + 1]]
        assert part.tolist() == want.encode_ordinary(t or "")
        assert own.decode(part, own.offsets(part)).tobytes() == (t or "").encode()


def test_odd_texts(models):
    check(models, ODD)


PIECES = ["'s", "'ll", "'", "s", "re", " ", "  ", "\n", "\t", "a", "Z", "é", "1", "٣", "!", "-", " ", "漢", "́", "x'd"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=120).map("".join), min_size=1, max_size=6))
def test_mixed_pieces(models, texts):
    check(models, texts)


def test_frames(spark, models):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, "a b", "y")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    want = {t: models[1].encode_ordinary(t or "") for _, t, _ in rows}
    coded = encode(df, PATH)
    got = {r.doc_id: r for r in coded.collect()}
    for i, t in enumerate(ODD):
        assert got[i].ids == want[t]
        raw = (t or "").encode()
        ends = [*got[i].offsets[1:], len(raw)] if want[t] else []
        assert b"".join(raw[a:b] for a, b in zip(got[i].offsets, ends, strict=True)) == raw
    back = {r.doc_id: bytes(r.decoded) for r in decode(coded, PATH).collect()}
    assert all(back[i] == (t or "").encode() for i, t in enumerate(ODD))
    digest = round_trip(df, PATH).collect()
    assert len(digest) == len(rows)
    for r in digest:
        t = "a b" if r.doc_id is None else ODD[r.doc_id]
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want[t])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest() and r.n_tokens == len(want[t])
    assert round_trip(df.limit(0), PATH).collect() == []
