"""The packed steps of the trigram scores, run without a cluster."""

import pickle
from collections import defaultdict
from functools import partial

import numpy as np
import pyarrow as pa
import pytest

from shelfmark.llm import ngram_shards as N
from shelfmark.llm.lm_scoring import ADD, MAX_DISCOUNTED, good_turing


class _Task:
    @staticmethod
    def get():
        return _Task

    @staticmethod
    def partitionId():
        return 3


def _texts(n, seed=1):
    rng = np.random.default_rng(seed)
    return [" ".join(f"W{x}" for x in rng.zipf(1.3, rng.integers(0, 40)) if x < 60) for _ in range(n)]


def _scores(texts, held, shards, monkeypatch):
    """``text number: (held_out, n_tokens, n_known, base, score)`` of texts."""
    monkeypatch.setattr("pyspark.TaskContext", _Task)
    batch = pa.record_batch({"id": pa.array(range(len(texts))), "t": pa.array(texts, pa.string()), "h": pa.array(held)})
    rows = [(b["key"][0].as_py(), pickle.loads(b["row"][0].as_py())) for b in N.read_blocks(iter([batch]), shards, 1)]
    most = MAX_DISCOUNTED + 1

    def run(step, *inputs, **fixed):
        dealt = defaultdict(list)
        for rows in inputs:
            for key, row in rows:
                dealt[key % shards].append((key, row))
        # a step must not rely on the order in which rows arrive
        return [x for part in dealt.values() for x in partial(step, **fixed)(iter(part[::-1]))]

    def seen(rows):
        return [sum(x) for x in zip(*(row[1] for _, row in rows if row[0] == "seen"))]

    names = run(N.name_words, rows, shards=N.word_shards(shards))
    n, v = seen(names)
    denominator = n + ADD * (v + 1)
    trigrams = run(N.ask_trigrams, rows, names, shards=shards)
    bigrams = run(N.climb, trigrams, kind="trigrams", order=3, lower="bigrams", shards=shards, most=most)
    words = run(N.climb, bigrams, kind="bigrams", order=2, lower="unigrams", shards=N.word_shards(shards), most=most)
    d3, d2 = (good_turing(dict(enumerate(seen(x)))) for x in (bigrams, words))
    counts = run(N.count_words, words)
    lower = partial(N.log_unigram, add=ADD, denominator=denominator)
    two = run(N.descend, bigrams, counts, kind="bigrams", order=2, answers="unigram counts", reply="bigram scores", d=d2, lower=lower)
    three = run(N.descend, trigrams, two, kind="trigrams", order=3, answers="bigram scores", reply="scores", d=d3, lower=N.as_they_are)
    found = {}
    dealt = defaultdict(list)
    for key, row in [*rows, *names, *three]:
        dealt[key % shards].append((key, row))
    for part in dealt.values():
        for data in N.score_blocks(iter(part), ADD, denominator):
            found |= {x[0]: x[1:] for x in zip(*pa.ipc.open_stream(data).read_all().to_pydict().values())}
    return found, bigrams


@pytest.mark.parametrize("piece", [1 << 20, 300, 5])
def test_pieces_blocks_and_shards_change_nothing(monkeypatch, piece):
    """Scores don't depend on how the work is cut, even where a history's n-grams are in several pieces."""
    texts = [*_texts(400), None, "", "  ", "\t\x0b\x0c\r\n", "the End " * 300, *["of the"] * 300]
    held = [i % 10 == 0 for i in range(len(texts))]
    want, _ = _scores(texts, held, 1, monkeypatch)
    monkeypatch.setattr(N, "PIECE", piece)
    monkeypatch.setattr(N, "BLOCK_BYTES", 2000)
    got, bigrams = _scores(texts, held, 40, monkeypatch)
    if piece == 5:
        assert max(row[2][1] for _, row in bigrams if row[0] == "bigrams") > 1
        w = np.arange(100, dtype=np.uint64)
        (cut,) = (x for x in N._pieces([np.ones_like(w), np.ones_like(w), w]) if x)
        assert len(cut) > 1 and sorted(np.concatenate(cut)) == list(range(100))
    assert sorted(got) == sorted(want) == list(range(len(texts)))
    for i, row in want.items():
        assert got[i][:3] == row[:3] and got[i][3:] == pytest.approx(row[3:], abs=1e-9), i
    for i, text in enumerate(texts):
        assert want[i][:2] == (held[i], len((text or "").encode().split()) + 1)


def test_packed_grams():
    rng = np.random.default_rng(2)
    for width in (20, 36):
        cols = [rng.integers(0, 1 << width, 5000).astype(np.uint64) for _ in range(3)]
        cols[0] = np.sort(cols[0] % np.uint64(50)) + np.uint64(1 << width - 1)
        counts = rng.integers(0, 2, 5000) * rng.integers(0, 1000, 5000)
        edges = np.array([0, 0, 17, 3000, 3000, 5000])
        packed = list(N.pack_grams(cols, counts, edges))
        assert [bool(x) for x in packed] == [False, True, True, False, True]
        got, n = N.unpack_grams([x for x in packed if x], 3)
        assert all((a == b).all() for a, b in zip(got, cols)) and (n == counts).all()
        few = np.repeat(rng.normal(size=30), 40)
        for values in (few, rng.normal(size=9), few[:0]):
            assert (N.unpack_values(N.pack_values(values), "<f8") == values).all()


def test_order_of_keys_that_differ_in_low_bits():
    rng = np.random.default_rng(3)
    keys = (rng.integers(0, 5, 4000) << 40 | rng.integers(0, 9, 4000)).astype(np.uint64)
    assert (N.order_of(keys) == np.argsort(keys, kind="stable")).all()
    assert len(N.order_of(keys[:0])) == 0
