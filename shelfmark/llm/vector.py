"""Numpy helpers for text columns that arrive as Arrow arrays inside a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit bijection that spreads every input bit over the result (splitmix64 finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mixed(np.arange(1, 257, dtype=_U))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[:1] = 1
    return np.cumprod(out, out=out)


class _Powers:
    """Powers of the odd base and of its inverse modulo 2**64, extended on demand.

    A worker outlives its tasks, so it keeps at most ``KEPT`` of each; longer tables last for one call.
    """

    KEPT = (1 << 20) + (1 << 16)

    def __init__(self) -> None:
        self.up = self.down = _powers(1, 1)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = n if n > self.KEPT else min(self.KEPT, 1 << max(16, n.bit_length()))
            made = _powers(int(_BASE), size), _powers(pow(int(_BASE), -1, 1 << 64), size)
            if size > self.KEPT:
                return made
            self.up, self.down = made
        return self.up, self.down


_POWERS = _Powers()


def slice_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``values[s:e]`` for each pair; equal slices have equal hashes."""
    up, down = _POWERS.upto(len(values) + 1)
    total = np.zeros(len(values) + 1, _U)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U))


def string_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.array([], pa.string())
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def word_bounds(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of all texts, and the first word of each text (n + 1 entries)."""
    inside = ~_SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = at[(at > 0) & (at < len(raw))]
    first[cut] |= inside[cut]
    last[cut - 1] |= inside[cut - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, at)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return slice_hashes(_BYTE[raw], starts, ends)


def joined_words(raw, starts, ends, text_of_word, n_texts: int) -> pa.Array:
    """Texts made of the given words, each text's words joined by one space."""
    per = np.bincount(text_of_word, minlength=n_texts) if len(starts) else np.zeros(n_texts, np.int64)
    size = ends - starts + 1
    final = np.cumsum(per)[per > 0] - 1
    size[final] -= 1
    out = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(size, out=out[1:])
    source = np.arange(out[-1]) + np.repeat(starts - out[:-1], size)
    data = raw[np.minimum(source, max(len(raw) - 1, 0))] if len(raw) else raw
    gaps = np.ones(len(starts), bool)
    gaps[final] = False
    data[out[1:][gaps] - 1] = 32
    offsets = out[np.concatenate([[0], np.cumsum(per)])].astype(np.int64)
    return pa.LargeStringArray.from_buffers(n_texts, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes()))


def pack_blob(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()
