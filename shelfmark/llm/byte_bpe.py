"""Byte-level BPE: pre-tokens by a scan of transition functions, cached merges, decoding by offsets.

Code points become classes (letter, number, other, white space ...), looked up
in an array; a class acts on the state of a small automaton as a function from
states to states. Composing functions is associative, so the states of a whole
batch come from a blocked prefix scan over numpy arrays: blocks are composed
side by side, the blocks' functions are scanned, and the states are filled in.
A token starts where the transition says so. No regular expression is run.

The pre-tokens are those of the pattern that ships with the rank files:
contractions, letters, numbers or others with at most one blank before them,
and white space, whose last character is left to what follows.

Slices of the text's bytes between boundaries are merged by rank once per
distinct slice and worker. Each text keeps the byte offset at which each of
its tokens starts, and decoding places the tokens' bytes by these offsets.

Cases: null text counts as empty (no ids); ids may repeat or be null; an empty
table gives an empty table. The result has its own columns.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import vector as V
from shelfmark.llm.common import query, table
from shelfmark.llm.word_ids import parts

# classes of characters
_L, _N, _O, _BLANK_LAST, _W_LAST, _W, _SHORT, _LONG = range(8)
# states: what the token of the last character still takes
_CLOSED, _IN_L, _IN_N, _IN_O, _AFTER_BLANK, _IN_W, _TAKES_1, _TAKES_2 = range(8)
# fixed values: white space as the pattern sees it
_WHITE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
# fixed values: what may follow the apostrophe of a contraction
_ONE_LETTER = "stmd"
_TWO_LETTERS = ("re", "ve", "ll")

_SCAN_BLOCK = 64
# pre-tokens remembered by a worker before it starts afresh
CACHE_SLICES = 1 << 19


@functools.cache
def _classes() -> np.ndarray:
    out = np.full(sys.maxunicode + 1, _O, np.uint8)
    for c in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LN":
            out[c] = _L if kind == "L" else _N
    out[list(_WHITE)] = _W
    return out


@functools.cache
def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a token starts here", by class (plus 8 for the first of a text) and state."""
    step, opens = np.zeros((16, 8), np.uint8), np.ones((16, 8), bool)
    for cls, run in ((_L, _IN_L), (_N, _IN_N), (_O, _IN_O)):
        step[cls] = run
        opens[cls, [run, _AFTER_BLANK]] = False
    step[_BLANK_LAST], step[_W_LAST], step[_W] = _AFTER_BLANK, _CLOSED, _IN_W
    opens[_W, _IN_W] = False
    for cls, takes in ((_SHORT, _TAKES_1), (_LONG, _TAKES_2)):
        step[cls] = takes
        step[cls, [_IN_O, _AFTER_BLANK]] = _IN_O
        opens[cls, [_IN_O, _AFTER_BLANK]] = False
    step[_L, _TAKES_1], step[_L, _TAKES_2] = _CLOSED, _TAKES_1
    opens[_L, [_TAKES_1, _TAKES_2]] = False
    step[8:] = step[:8, [_CLOSED]]
    return step, opens


def _symbols(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Class of each code point, looking at most two ahead in its text; ``first`` marks the texts' first."""
    cls = _classes()[points]
    n = len(points)
    same = np.zeros(n, bool)
    same[:-1] = ~first[1:]
    white = cls == _W
    before_solid = np.zeros(n, bool)
    before_solid[:-1] = same[:-1] & ~white[1:]
    last = white & before_solid
    cls[last] = _W_LAST
    cls[last & (points == 32)] = _BLANK_LAST
    quotes = np.flatnonzero((points == 39) & same)
    if len(quotes):
        after = points[quotes + 1]
        short = np.isin(after, [ord(c) for c in _ONE_LETTER])
        two = quotes + 2 < n
        two[two] &= same[quotes[two] + 1]
        second = points[np.where(two, quotes + 2, quotes)]
        long = np.zeros(len(quotes), bool)
        for a, b in _TWO_LETTERS:
            long |= two & (after == ord(a)) & (second == ord(b))
        cls[quotes[short]] = _SHORT
        cls[quotes[long]] = _LONG
    cls[first] += 8
    return cls


def token_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pre-tokens start, among the code points of all texts."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    step, opens = _automaton()
    rows = -(-n // _SCAN_BLOCK)
    grid = np.full(rows * _SCAN_BLOCK, 8 + _O, np.uint8)
    grid[:n] = _symbols(points, first)
    grid = np.ascontiguousarray(grid.reshape(rows, _SCAN_BLOCK).T)
    flat = step.ravel()
    whole = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for line in grid:
        whole = flat[(line.astype(np.int16) << 3)[:, None] + whole]
    d = 1
    while d < rows:  # inclusive scan: each function follows all before it
        whole[d:] = np.take_along_axis(whole[d:], whole[:-d].astype(np.intp), axis=1)
        d *= 2
    state = np.zeros(rows, np.uint8)
    state[1:] = whole[:-1, _CLOSED]
    marks = np.empty(grid.shape, bool)
    starts = opens.ravel()
    for i, line in enumerate(grid):
        place = (line.astype(np.int16) << 3) + state
        marks[i] = starts[place]
        state = flat[place]
    return np.flatnonzero(marks.T.ravel()[:n])


class ByteBPE:
    """Encoder and decoder over a file of ranks."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = max(self.ranks.values()) + 1
        token = [b""] * size
        for raw, rank in self.ranks.items():
            token[rank] = raw
        self.length = np.array([len(t) for t in token], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(token), np.uint8)
        self.known: dict[bytes, bytes] = {}

    def _merge(self, piece: bytes) -> bytes:
        """Ids of one pre-token: the pair of lowest rank is merged first, the leftmost of equals."""
        ranks = self.ranks
        if piece in ranks:
            return np.array([ranks[piece]], "<u4").tobytes()
        n = len(piece)
        end, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = bytearray(b"\x01") * n
        heap = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n and (r := ranks.get(piece[i : end[j]])) is not None:
                heapq.heappush(heap, (r, i, end[j]))

        for i in range(n):
            offer(i)
        while heap:
            r, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue
            alive[end[i]] = 0
            end[i] = stop
            if stop < n:
                prev[stop] = i
            offer(i)
            if prev[i] >= 0:
                offer(prev[i])
        return np.array([ranks[piece[i : end[i]]] for i in range(n) if alive[i]], "<u4").tobytes()

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of an Arrow column, and the first id of each text (n + 1 entries)."""
        raw, at = V.string_buffers(texts)
        if not len(raw):
            return np.zeros(0, "<u4"), np.zeros(len(at), np.int64)
        data = raw.tobytes()
        points = np.frombuffer(data.decode().encode("utf-32-le"), "<u4")
        byte_of = np.flatnonzero((raw & 0xC0) != 0x80)
        first = np.zeros(len(points), bool)
        begins = at[:-1][np.diff(at) > 0]
        first[np.searchsorted(byte_of, begins)] = True
        cuts = byte_of[token_starts(points, first)]
        if len(self.known) > CACHE_SLICES:
            self.known.clear()
        known, merge = self.known, self._merge
        out = []
        lo = 0
        for hi in [*cuts[1:].tolist(), len(data)]:
            piece = data[lo:hi]
            got = known.get(piece)
            if got is None:
                got = known[piece] = merge(piece)
            out.append(got)
            lo = hi
        per = np.cumsum([0, *map(len, out)]) // 4
        return np.frombuffer(b"".join(out), "<u4"), per[np.searchsorted(cuts, at)]

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset of each token in what the ids decode to (n + 1 entries)."""
        return np.append(0, np.cumsum(self.length[ids]))

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        size = np.diff(offsets)
        return self.bytes[np.arange(offsets[-1]) + np.repeat(self.begin[ids] - offsets[:-1], size)]


_MODELS: dict[str, ByteBPE] = {}


def _model(path: str) -> ByteBPE:
    if path not in _MODELS:
        _MODELS[path] = ByteBPE(path)
    return _MODELS[path]


def encode(df: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids, offsets``: token ids and the byte offset at which each token starts (array<int>, array<bigint>)."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        model = _model(ranks)
        for whole in batches:
            for batch in parts(whole, "t"):
                ids, cut = model.encode(batch["t"])
                at = model.offsets(ids)
                within = at[:-1] - np.repeat(at[cut[:-1]], np.diff(cut))
                lists = pa.array(cut, pa.int32())
                yield pa.record_batch(
                    {
                        "id": batch["id"],
                        "ids": pa.ListArray.from_arrays(lists, pa.array(ids.astype(np.int32))),
                        "offsets": pa.ListArray.from_arrays(lists, pa.array(within, pa.int64())),
                    }
                )

    return rows.mapInArrow(run, f"id {kind}, ids array<int>, offsets array<bigint>").withColumnRenamed("id", id_col)


def decode(df: DataFrame, ranks: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col, decoded``: the bytes of ``encode``'s result."""
    rows = df.select(F.col(id_col).alias("id"), "ids")
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        model = _model(ranks)
        for batch in batches:
            decoded = []
            for x in batch["ids"]:
                ids = np.asarray(x.values.to_numpy(zero_copy_only=False) if x.is_valid else [], np.int64)
                decoded.append(model.decode(ids, model.offsets(ids)).tobytes())
            yield pa.record_batch({"id": batch["id"], "decoded": pa.array(decoded, pa.binary())})

    return rows.mapInArrow(run, f"id {kind}, decoded binary").withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256``: both directions in one pass, digests only."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        model = _model(ranks)
        decimal = [b"%d" % i for i in range(len(model.length))]
        for whole in batches:
            for batch in parts(whole, "t"):
                ids, cut = model.encode(batch["t"])
                at = model.offsets(ids)
                back = memoryview(model.decode(ids, at).tobytes())
                byte = at[cut].tolist()
                listed, cut = ids.tolist(), cut.tolist()
                n = len(batch)
                digest = lambda x: hashlib.sha256(x).hexdigest()
                yield pa.record_batch(
                    {
                        "id": batch["id"],
                        "n_tokens": pa.array(np.diff(cut), pa.int64()),
                        "ids_sha256": [digest(b" ".join([decimal[i] for i in listed[cut[k] : cut[k + 1]]])) for k in range(n)],
                        "decoded_sha256": [digest(back[byte[k] : byte[k + 1]]) for k in range(n)],
                    }
                )

    out = rows.mapInArrow(run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)


@query("op4_byte_bpe")
def op4_byte_bpe(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
