"""Token files: round trips of blocks, payloads and whole tables."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.llm.token_files import decode_block, decode_payload, encode_block, encode_payload, read_tokens, write_tokens
from test_packing import PATH, plain_ids, texts


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 2**32 - 1)), min_size=1, max_size=500), st.sampled_from([0, 50, 90, 98, 100]))
def test_block_round_trip(values, percentile):
    ids = np.array(values, "<u4")
    assert decode_block(encode_block(ids, percentile)).tolist() == values


@pytest.mark.parametrize("n", [1, 4095, 4096, 4097, 20_000])
def test_payload_round_trip(n):
    ids = np.random.default_rng(n).zipf(1.3, n).clip(0, 49_407).astype("<u4")
    keys, starts = np.array([5, 9]), np.array([0, n // 2])
    k, at, got = decode_payload(encode_payload(keys, starts, ids))
    assert k.tolist() == [5, 9] and at.tolist() == [0, n // 2, n] and (got == ids).all()


def test_files_smaller_than_plain_ids():
    ids = np.random.default_rng(1).integers(0, 900, 100_000).astype("<u4")
    assert len(encode_payload(np.array([1]), np.array([0]), ids)) < 0.4 * ids.nbytes


def test_table(spark):
    corpus = texts(60)
    keys = [3 * i - 50 for i in range(len(corpus))]
    keys[-1] = 10**12
    df = spark.createDataFrame([(k, t, 1) for k, t in zip(keys, corpus)], "doc_id long, text string, range int").repartition(5)
    got = sorted(read_tokens(write_tokens(df, PATH)).collect(), key=lambda r: r.doc_id)
    at = 0
    for r, key, ids in zip(got, keys, plain_ids(corpus), strict=True):
        assert (r.doc_id, r.start, r.n_tokens) == (key, at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_empty_null_and_repeated_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert read_tokens(write_tokens(empty, PATH)).collect() == []
    rows = [(None, "a"), (4, "a"), (4, "a"), (2, None)]
    got = read_tokens(write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), PATH)).collect()
    assert sorted((r.start, r.doc_id, r.n_tokens) for r in got) == [(0, None, 2), (2, 2, 1), (3, 4, 2), (5, 4, 2)]
