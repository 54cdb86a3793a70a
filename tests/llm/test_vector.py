"""Hashes of slices, and the tables they need."""

import numpy as np

from shelfmark.llm import vector as V


def test_a_worker_keeps_no_long_tables():
    short = np.frombuffer(b"some words of one text", np.uint8)
    long = np.tile(short, 100_000)
    ends = np.array([22, 22 * 70_000 + 22, 22 * 99_999 + 22])
    want = V.word_hashes(short, np.array([0]), np.array([22]))[0]
    assert (V.word_hashes(long, ends - 22, ends) == want).all()
    assert V._POWERS.up.nbytes + V._POWERS.down.nbytes <= 20 << 20
