"""Packing: every id once, windows gapless, little padding."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from shelfmark.llm.packing import pack

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, ids int"


def plain_ids(texts):
    t = Tokenizer.from_file(PATH)
    return [[*e.ids, 1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def texts(n=200):
    r = random.Random(3)
    odd = [None, "", " \n ", "It's 2024: naïve CAFÉ don't!", "<|endoftext|> a<|startoftext|>b", "x y ́z  w", "é 漢字 😀", "word " * 9000]
    return odd + [" ".join(r.choice(["alpha", "beta,", "Gamma", "x1y2", "été."]) for _ in range(r.randint(0, 1500))) for _ in range(n)]


def test_every_id_in_one_piece(spark):
    corpus = texts()
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(corpus)], SCHEMA).repartition(6)
    got = pack(df, PATH, most_open=8).toPandas()
    for i, want in enumerate(plain_ids(corpus)):
        own = got[got.doc_id == i].sort_values("start")
        assert own.start.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
        assert np.frombuffer(b"".join(own.ids), "<u4").tolist() == want
        assert set(own.doc_tokens) == {len(want)}
    for _, s in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 2048
    assert got.length.sum() / (2048 * got.sequence_id.nunique()) > 0.93


def test_empty_table_and_repeated_rows(spark):
    assert pack(spark.createDataFrame([], SCHEMA), PATH).collect() == []
    got = pack(spark.createDataFrame([(None, "a b", 1)] * 3, SCHEMA), PATH).collect()
    assert len(got) == 3 and len({(r.sequence_id, r.offset) for r in got}) == 3


def test_digest(spark, tmp_path):
    from shelfmark.llm.common import QUERIES

    corpus = texts(20)
    spark.createDataFrame([(i, t, 0) for i, t in enumerate(corpus)], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    want = plain_ids(corpus)
    for r in QUERIES["op2_packing"](spark, str(tmp_path)).collect():
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_new_words_with_known_letters_are_not_encoded_again():
    from shelfmark.llm.word_ids import WordIds

    words = WordIds(PATH)
    seen, whole = [], words.known.tokenizer

    class Counted:
        def encode_batch_fast(self, batch, **more):
            seen.extend(batch)
            return whole.encode_batch_fast(batch, **more)

    words.known.tokenizer = Counted()
    text = "Alpha, alpha. alpha&&& (alpha ALPHA!! crème Crème; x1y2. it's IT'S, T̈ rest"
    assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == plain_ids([text])[0]
    assert not any("alpha" in w.lower() and w.lower() != "(alpha" or "crème" in w.lower() for w in seen), seen


def test_words_of_odd_characters():
    from shelfmark.llm.word_ids import WordIds

    r = random.Random(6)
    pool = "aZTẗ́éÀßÿµªº÷×'’.,&$<|>09²½İſΣσςǅ 漢あ가ᄀ\xad\x7f\x00\x1c\x85‍٠😀-_sSeErRlLdDmM"
    corpus = ["".join(r.choice(pool) for _ in range(r.randint(0, 14))) for _ in range(20000)]
    corpus += ["<|endoftext|>.", "A.<|startoftext|>b", "<|STARTOFTEXT|>", "Ends,<|endoftext|>"]
    got = [np.frombuffer(x, "<u4").tolist() for x in WordIds(PATH).encode(corpus)]
    assert got == plain_ids(corpus)
