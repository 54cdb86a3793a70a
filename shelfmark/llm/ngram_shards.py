"""Katz back-off over shards: the counting and the evaluation of :mod:`lm_scoring` without a row per token.

Texts are taken in blocks. A block numbers its words, keeps its texts as those
numbers, and sends each of its words once, with its count in the block's
training texts, to shards of words. These reply with the count in all texts and
a number that stands for the word from then on, the smaller the commoner.

With these a block asks for each of its distinct trigrams once, again with the
count in its training texts. Requests are dealt by history to shards, which add
the counts up and ask for the bigrams of their trigrams in the same way, and
those shards for their words: counts climb from order to order. Values go back
down the same way. A reply lists them in the order of its request, without keys.
Every shard of an order knows all followers of its histories, so totals,
discounts and back-off weights are computed where they are used. Discounts need
counts of counts over all shards, a few numbers that the driver adds up.

Words and n-grams are told apart by 64-bit fingerprints.

Each shuffle is made once and read by all later steps. A shard works through
pieces of its n-grams, so that what it holds besides its requests stays bounded;
a history found all over is cut into several.
"""

from __future__ import annotations

import contextlib
import ctypes
import pickle
import struct
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array

from shelfmark.llm.word_ids import parts

# the number of the begin marker, and the code of values that have none
BEGIN, RARE = 0, 0xFFFF
# bytes of text of a block, and about how many requested n-grams a shard works on at once
BLOCK_BYTES = 8 << 20
PIECE = 3 << 19
# bytes of a word's number
_WIDTH = 5

_CODEC = "zstd"
# the trigrams of one middle word go to 16 shards at most
_SPREAD = np.uint64(60)


# -- packed arrays


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of bytes, compressed together."""
    raw = b"".join(a.tobytes() for a in arrays)
    sizes = struct.pack(f"<{len(arrays) + 1}q", len(arrays), *(a.nbytes for a in arrays))
    return sizes + (pa.compress(raw, _CODEC, asbytes=True) if raw else b"")


def _unpack(data: bytes) -> list[np.ndarray]:
    (k,) = struct.unpack_from("<q", data)
    sizes = struct.unpack_from(f"<{k}q", data, 8)
    raw = pa.decompress(memoryview(data)[8 * (k + 1) :], sum(sizes), _CODEC) if sum(sizes) else b""
    ends = np.cumsum(sizes)
    return [np.frombuffer(raw, np.uint8, size, end - size) for size, end in zip(sizes, ends, strict=True)]


def _planes(a: np.ndarray) -> np.ndarray:
    """The bytes of equal significance side by side."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)


def _from_planes(raw: np.ndarray, kind: str) -> np.ndarray:
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _id_parts(ids: np.ndarray) -> np.ndarray:
    """The bytes of equal significance of the numbers, side by side; upper ones are mostly zero."""
    return np.ascontiguousarray(ids.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_WIDTH].T)


def _ids(planes: list[np.ndarray]) -> np.ndarray:
    """In four bytes each, if these hold them."""
    ids = planes[0].astype(np.uint64 if any(p.any() for p in planes[4:]) else np.uint32)
    for i, p in enumerate(planes[1:], 1):
        if p.any():
            ids |= p.astype(ids.dtype) << ids.dtype.type(8 * i)
    return ids


def _count_parts(counts: np.ndarray) -> list[np.ndarray]:
    return [np.minimum(counts, 255).astype(np.uint8), counts[counts >= 255].astype(np.int64)]


def _counts(low: np.ndarray, large: np.ndarray) -> np.ndarray:
    counts = low.astype(np.int64)
    counts[low == 255] = large.view(np.int64)
    return counts


def pack_grams(cols: list[np.ndarray], counts: np.ndarray, edges: np.ndarray) -> Iterator[bytes]:
    """N-grams and their counts, packed from each edge to the next; equal beginnings that stand together are written once."""
    new = np.zeros(len(counts), bool)
    new[edges[:-1][edges[:-1] < edges[1:]]] = True
    levels = []
    for i, c in enumerate(cols):
        if i < len(cols) - 1:
            new[1:] |= c[1:] != c[:-1]
            at = np.flatnonzero(new)
            c, n, ends = c[at], np.diff(at, append=len(counts)), np.searchsorted(at, edges)
        else:
            n, ends = counts, edges
        low, large = _count_parts(n)
        levels.append((_id_parts(c), low, large, ends.tolist(), np.searchsorted(np.flatnonzero(n >= 255), ends).tolist()))
    for i in range(len(edges) - 1):
        sizes, raw = [], []
        for planes, low, large, ends, large_ends in levels:
            own, far = slice(ends[i], ends[i + 1]), slice(large_ends[i], large_ends[i + 1])
            sizes += [own.stop - own.start, far.stop - far.start]
            raw += [*(p[own].tobytes() for p in planes), low[own].tobytes(), large[far].tobytes()]
        raw = b"".join(raw)
        yield struct.pack(f"<{len(sizes)}I", *sizes) + pa.compress(raw, _CODEC, asbytes=True) if raw else b""


def unpack_grams(packed: list[bytes], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """All n-grams and counts of some packed ones, one after the other."""
    found = [[[] for _ in range(_WIDTH + 2)] for _ in range(order)]
    for data in packed:
        sizes = struct.unpack_from(f"<{2 * order}I", data)
        pairs = list(zip(sizes[::2], sizes[1::2], strict=True))
        raw = pa.decompress(memoryview(data)[8 * order :], sum((_WIDTH + 1) * n + 8 * far for n, far in pairs), _CODEC)
        lo = 0
        for level, (n, far) in zip(found, pairs, strict=True):
            for i in range(_WIDTH + 2):
                size = n if i <= _WIDTH else 8 * far
                level[i].append(np.frombuffer(raw, np.uint8, size, lo))
                lo += size
    cols = []
    for level in found:
        *planes, low, large = (np.concatenate(x) for x in level)
        cols.append(_ids(planes))
        counts = _counts(low, large)
        if len(cols) < order:
            cols[-1] = np.repeat(cols[-1], counts)
    return cols, counts


def pack_values(values: np.ndarray) -> bytes:
    """Values of eight bytes; where there are many, those that repeat get codes."""
    if len(values) < 256:
        return _pack(_planes(values))
    raw = values.view(np.uint64)
    order = order_of(raw)
    first = _runs(raw[order])
    found, sizes = raw[order[first]], np.diff(np.append(first, len(raw)))
    by_count = np.argsort(-sizes, kind="stable")[:RARE]
    by_count = by_count[sizes[by_count] > 1]
    code = np.full(len(found), RARE, "<u2")
    code[by_count] = np.arange(len(by_count))
    codes = np.empty(len(raw), "<u2")
    codes[order] = np.repeat(code, sizes)
    return _pack(found[by_count], _planes(codes), raw[codes == RARE])


def unpack_values(data: bytes, kind: str) -> np.ndarray:
    first, *others = _unpack(data)
    if not others:
        return _from_planes(first, kind)
    found, (codes, others) = first, others
    codes, found = _from_planes(codes, "<u2"), found.view(kind)
    coded = codes != RARE
    values = np.empty(len(codes), kind)
    values[coded], values[~coded] = found[codes[coded]], others.view(kind)
    return values


def pack_numbers(numbers: np.ndarray) -> bytes:
    return _pack(_id_parts(numbers))


def unpack_numbers(data: bytes) -> np.ndarray:
    return _ids(list(_unpack(data)[0].reshape(_WIDTH, -1)))


def pack_words(prints: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending fingerprints and their counts."""
    return _pack(_planes(np.diff(prints, prepend=np.uint64(0))), *_count_parts(counts))


def unpack_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    prints, *counts = _unpack(data)
    return np.cumsum(_from_planes(prints, "<u8"), dtype=np.uint64), _counts(*counts)


def _release() -> None:
    """Memory that is free goes back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # where there is no such call
        ctypes.CDLL(None).malloc_trim(0)


# -- fingerprints


def _scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers."""
    x = x.astype(np.uint64, copy=False)
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def keys(cols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By what the n-grams are dealt, and fingerprints of their histories and of themselves.

    Columns are the history, the nearest word first, then the word. N-grams of one nearest word, where there
    is another one, go to a few shards at most; those of one history to one.
    """
    *before, w = cols
    if not before:
        key = _scramble(w)
        return key, key, key
    near = history = route = _scramble(before[0])
    for u in before[1:]:
        history = _scramble(history ^ u)
        route = _scramble(near ^ (_scramble(u) >> _SPREAD))
    return route, history, _scramble(history ^ w)


def part_of(key: np.ndarray, n: int) -> np.ndarray:
    """The part, of ``n``, that a key falls in; it grows with the key."""
    return ((key >> np.uint64(40)) * np.uint64(n) >> np.uint64(24)).astype(np.int64)


def order_of(key: np.ndarray, exact: bool = True) -> np.ndarray:
    """Positions by key, equal keys by position; a sort of numbers is several times faster than ``argsort``. If not ``exact``, the lowest bits don't count."""
    bits = np.uint64(max(1, (len(key) - 1).bit_length()))
    packed = key >> bits << bits | np.arange(len(key), dtype=np.uint64)
    packed.sort()
    order = (packed & (np.uint64(1) << bits) - np.uint64(1)).astype(np.int64)
    if exact:
        # keys that differ only in the bits which the position has taken
        k = key[order]
        mixed = np.flatnonzero((k[1:] >> bits == k[:-1] >> bits) & (k[1:] != k[:-1]))
        if len(mixed):
            among = np.flatnonzero(np.isin(k >> bits, k[mixed] >> bits))
            order[among] = order[among][np.argsort(k[among], kind="stable")]
    return order


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


class Grams:
    """Distinct n-grams, taken from ``cols`` when asked for; ``at``: where each of the given ones stands among them."""

    def __init__(self, cols: list[np.ndarray], by: str = "route") -> None:
        """In the order of their routes or histories (equal ones by their fingerprints), or just of their fingerprints (``gram``)."""
        self._cols, self._keys = cols, keys(cols)
        route, history, gram = self._keys
        order = order_of(gram)
        runs = _runs(gram.take(order))
        self.at = np.empty(len(order), np.int64)
        self.at[order] = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, len(order))))
        self._first = order.take(runs)
        self.size = len(runs)
        if by != "gram" and len(cols) > 1:
            key, loose = history.take(self._first), by == "route" and len(cols) > 2
            if loose:
                # enough of the route to deal by, then histories: these stand together but for rare chances
                key = route.take(self._first) >> np.uint64(37) << np.uint64(37) | key >> np.uint64(27)
            ordered = order_of(key, not loose)
            place = np.empty(self.size, np.int64)
            place[ordered] = np.arange(self.size)
            self._first, self.at = self._first.take(ordered), place.take(self.at)

    @property
    def cols(self) -> list[np.ndarray]:
        return [c.take(self._first) for c in self._cols]

    @property
    def history(self) -> np.ndarray:
        return self._keys[1].take(self._first)

    @property
    def gram(self) -> np.ndarray:
        return self._keys[2].take(self._first)

    def edges(self, shards: int) -> np.ndarray:
        """Where each shard's n-grams begin, and the end."""
        return np.searchsorted(part_of(self._keys[0].take(self._first), shards), np.arange(shards + 1))


def lower_order(grams: Grams) -> Grams:
    """The n-grams without their farthest word."""
    *before, w = grams.cols
    return Grams([*before[:-1], w])


def summed(at: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, weights=counts, minlength=n).astype(np.int64)


# -- requests: rows ``key, (kind, shard, requester, how many, packed)``; replies: ``key, (kind, key, requester, shard, packed)``


def dealt(kind: str, requester, grams: Grams, counts: np.ndarray, shards: int) -> Iterator[tuple]:
    """A request to each shard."""
    edges = grams.edges(shards)
    sizes = np.diff(edges).tolist()
    for shard, (n, data) in enumerate(zip(sizes, pack_grams(grams.cols, counts, edges), strict=True)):
        if n:
            yield shard, (kind, shard, requester, n, data)


def replied(replies: list[tuple], unpack: Callable) -> np.ndarray:
    """The values of all that was asked for; the shards have it one after the other."""
    return np.concatenate([unpack(data) for _, data in sorted(replies, key=lambda x: x[0])])


def _replies(to: list[tuple], shard: int, values: np.ndarray, sizes: list[int], pack: Callable) -> Iterator[tuple]:
    for (kind, requester), part in zip(to, np.split(values, np.cumsum(sizes)[:-1]), strict=True):
        key = requester[0] if isinstance(requester, tuple) else requester
        yield key, (kind, key, requester, shard, pack(part))


def _rows(rows: Iterator[tuple], *kinds: str) -> dict:
    """``(shard, kind): [(requester, ..., packed)]`` of the rows of a partition."""
    found = defaultdict(list)
    for _, (kind, shard, *row) in rows:
        if kind in kinds:
            found[shard, kind].append(tuple(row))
    return found


def _pieces(cols: list[np.ndarray]) -> list[list]:
    """Positions of the n-grams of each piece, in lists: all n-grams of a history are in the pieces of one list."""
    n = -(-len(cols[0]) // PIECE)
    if n <= 1:
        return [[slice(None)]]
    pieces = []
    for at in _cut(np.arange(len(cols[0])), _scramble(keys(cols)[0]), n):
        few = -(-len(at) // (4 * PIECE))
        # n-grams that ask for the same one of the lower order stay together
        pieces.append(_cut(at, keys([cols[0][at], cols[-1][at]])[2], few) if few > 1 else [at])
    return pieces


def _cut(at: np.ndarray, key: np.ndarray, n: int) -> list[np.ndarray]:
    part = part_of(key, n).astype(np.uint16)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(1, n))
    return [x for x in np.split(at[order], cuts) if len(x)]


def climb(rows: Iterator[tuple], kind: str, order: int, lower: str, shards: int, most: int) -> Iterator[tuple]:
    """Add up the counts of the requested n-grams, and ask for those of the next lower order; at key 0 the counts of counts up to ``most``."""
    for (shard, _), requests in _rows(rows, kind).items():
        cols, asked = unpack_grams([data for *_, data in requests], order)
        for i, at in enumerate(at for pieces in _pieces(cols) for at in pieces):
            grams = Grams([c[at] for c in cols], "gram")
            counts = summed(grams.at, asked[at], grams.size)
            yield 0, ("seen", np.bincount(counts[counts <= most], minlength=most + 1).tolist())
            low = lower_order(grams)
            yield from dealt(lower, (shard, i), low, summed(low.at, counts, low.size), shards)
        _release()


def name_words(rows: Iterator[tuple], shards: int) -> Iterator[tuple]:
    """Number the words by their counts in all training texts and reply with counts and numbers; at key 0 the tokens and the words."""
    for (shard, _), requests in _rows(rows, "words").items():
        prints, counts = ([np.concatenate(x) for x in zip(*(unpack_words(data) for *_, data in requests), strict=True)])
        sizes = [n for _, n, _ in requests]
        words, at = np.unique(prints, return_inverse=True)
        counts = summed(at, counts, len(words))
        yield 0, ("seen", [int(counts.sum()), int(np.count_nonzero(counts))])
        numbers = np.empty(len(words), np.int64)
        numbers[np.argsort(-counts, kind="stable")] = np.arange(len(words)) * shards + shard + 1
        to = [("word counts", r[0]) for r in requests]
        yield from _replies(to, shard, counts[at], sizes, pack_values)
        to = [("word numbers", r[0]) for r in requests]
        yield from _replies(to, shard, numbers[at], sizes, pack_numbers)


def count_words(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Add up the counts of the requested words and reply with them."""
    for (shard, _), requests in _rows(rows, "unigrams").items():
        cols, asked = unpack_grams([data for *_, data in requests], 1)
        grams = Grams(cols, "gram")
        counts = summed(grams.at, asked, grams.size)
        yield from _replies([("unigram counts", r[0]) for r in requests], shard, counts[grams.at], [n for _, n, _ in requests], pack_values)


def descend(rows: Iterator[tuple], kind: str, order: int, answers: str, reply: str, d: list[float], lower: Callable) -> Iterator[tuple]:
    """Reply to the requests with Katz's log10 probabilities; ``answers`` are the values of the next lower order, ``lower`` makes log10 probabilities of them."""
    found = _rows(rows, kind, answers)
    discount = np.array(d[1:])
    unpack = partial(unpack_values, kind="<i8" if order == 2 else "<f8")
    for shard in {s for s, k in found if k == kind}:
        requests = found[shard, kind]
        cols, asked = unpack_grams([data for *_, data in requests], order)
        below = defaultdict(list)
        for (_, i), *answer in found[shard, answers]:
            below[i].append(answer)

        def piece(i: int, at, cols=cols, asked=asked, below=below):
            grams = Grams([c[at] for c in cols], "history")
            counts = summed(grams.at, asked[at], grams.size)
            log_low = lower(replied(below[i], unpack))[lower_order(grams).at]
            few = (counts > 0) & (counts <= len(discount))
            times = np.ones(len(counts))
            times[few] = discount[counts[few] - 1]
            history = grams.history
            runs = _runs(history)
            return grams.at, counts, log_low, times, history[runs], runs

        values, i = np.empty(len(asked)), 0
        for pieces in _pieces(cols):
            sums, last = [], None
            for k, at in enumerate(pieces):
                _, counts, log_low, times, histories, runs = last = piece(i + k, at)
                each = (counts, (1 - times) * counts, np.where(counts > 0, 10.0**log_low, 0.0))
                sums.append((histories, *(np.add.reduceat(x, runs) for x in each)))
            histories, total, left, seen = (np.concatenate(x) for x in zip(*sums, strict=True))
            if len(pieces) > 1:
                histories, same = np.unique(histories, return_inverse=True)
                total, left, seen = (np.bincount(same, weights=x, minlength=len(histories)) for x in (total, left, seen))
            with np.errstate(divide="ignore", invalid="ignore"):
                left = left / total
                weight = np.log10(left / (1 - seen))
            weight[~((total > 0) & (left > 0) & (seen < 1))] = 0.0
            for k, at in enumerate(pieces):
                to, counts, log_low, times, own, runs = last if len(pieces) == 1 else piece(i + k, at)
                h = np.repeat(np.searchsorted(histories, own), np.diff(runs, append=len(counts)))
                with np.errstate(divide="ignore", invalid="ignore"):
                    of_seen = np.log10(np.where(left[h] > 0, times, seen[h]) * counts / total[h])
                values[at] = np.where(counts > 0, of_seen, weight[h] + log_low)[to]
            i += len(pieces)
        yield from _replies([(reply, r[0]) for r in requests], shard, values, [n for _, n, _ in requests], pack_values)
        _release()


def log_unigram(counts: np.ndarray, add: float, denominator: float) -> np.ndarray:
    return np.log10((counts + add) / denominator)


def as_they_are(values: np.ndarray) -> np.ndarray:
    return values


# -- blocks of texts


def numbered(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of texts (A-Z lower-cased, the end token the last), each text as their numbers, all in a row, and the sizes of the texts."""
    # cuts at the white space of lm_scoring.tokens, and leaves empty words beside it
    cut = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = cut.flatten().dictionary_encode()
    end = len(words.dictionary)
    found = words.indices.to_numpy()
    left = found != pc.index(words.dictionary, "").as_py()
    upto = np.concatenate([[0], np.cumsum(left)])
    offsets = cut.offsets.to_numpy() - cut.offsets[0].as_py()
    sizes = upto[offsets[1:]] - upto[offsets[:-1]] + 1
    ends = np.cumsum(sizes) - 1
    numbers = np.full(int(sizes.sum()), end, np.int64)
    others = np.ones(len(numbers), bool)
    others[ends] = False
    numbers[others] = found[left]
    return words.dictionary, numbers, sizes


def fingerprints(words: pa.Array) -> np.ndarray:
    return hash_array(words.to_numpy(zero_copy_only=False), categorize=False)


class Block(NamedTuple):
    """Texts as numbers of words, the end token included. Words stand by their fingerprints; numbers go by how often the words are found."""

    found: np.ndarray
    sizes: np.ndarray
    numbers: np.ndarray
    held_out: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array, held_out: np.ndarray) -> tuple[Block, np.ndarray]:
        """The block, and the fingerprints of its words."""
        words, numbers, sizes = numbered(texts)
        prints = fingerprints(pa.concat_arrays([words, pa.array([""], words.type)]))
        order = order_of(prints)
        found = np.bincount(numbers, minlength=len(prints))[order]
        # an empty word beside white space is none
        order, found = order[found > 0], found[found > 0]
        place = np.zeros(len(prints), np.int64)
        place[order[_by_count(found)]] = np.arange(len(order))
        return cls(found, sizes, place[numbers], held_out), prints[order]

    def pack(self) -> bytes:
        return _pack(*_count_parts(self.found), *_count_parts(self.sizes), _id_parts(self.numbers), self.held_out.astype(np.uint8))

    @classmethod
    def unpack(cls, data: bytes) -> Block:
        a = _unpack(data)
        return cls(_counts(*a[:2]), _counts(*a[2:4]), _ids(list(a[4].reshape(_WIDTH, -1))), a[5].astype(bool))

    def trained(self) -> np.ndarray:
        return np.repeat(~self.held_out, self.sizes)

    def word_counts(self) -> np.ndarray:
        """Of the words, in the training texts."""
        counts = np.empty(len(self.found), np.int64)
        counts[_by_count(self.found)] = np.bincount(self.numbers[self.trained()], minlength=len(self.found))
        return counts

    def of_tokens(self, of_words: np.ndarray) -> np.ndarray:
        return of_words[_by_count(self.found)][self.numbers]

    def trigrams(self, names: np.ndarray) -> Grams:
        w = self.of_tokens(names)
        starts = np.cumsum(self.sizes) - self.sizes
        u, v = np.empty_like(w), np.empty_like(w)
        v[1:], u[2:] = w[:-1], w[:-2]
        u[starts] = v[starts] = BEGIN
        u[starts[self.sizes > 1] + 1] = BEGIN
        return Grams([v, u, w])

    def per_text(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, np.cumsum(self.sizes) - self.sizes)


def _by_count(found: np.ndarray) -> np.ndarray:
    return np.argsort(-found, kind="stable")


def read_blocks(batches: Iterator[pa.RecordBatch], shards: int, n_kept: int) -> Iterator[pa.RecordBatch]:
    """Rows ``key, row`` (pickled) from batches whose last columns are the text and whether it is held out: the blocks, kept columns included, and their words."""
    from pyspark import TaskContext

    task, count, kept, size = TaskContext.get().partitionId(), 0, [], 0

    def block() -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(kept)
        texts = pa.concat_arrays([x.cast(pa.large_string()) for x in whole.column(n_kept).chunks])
        own, prints = Block.of(texts, whole.column(n_kept + 1).to_numpy().astype(bool))
        name = task + (count << 24)
        columns = whole.select(range(n_kept))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, columns.schema, options=pa.ipc.IpcWriteOptions(compression=_CODEC)) as out:
            out.write_table(columns)
        rows = [(name, ("block", name, own.pack(), sink.getvalue().to_pybytes()))]
        counts = own.word_counts()
        few = word_shards(shards)
        edges = np.searchsorted(part_of(prints, few), np.arange(few + 1))
        for shard, (lo, hi) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
            if lo < hi:
                rows.append((shard, ("words", shard, name, hi - lo, pack_words(prints[lo:hi], counts[lo:hi]))))
        for key, row in rows:
            yield pa.record_batch({"key": pa.array([key], pa.int64()), "row": pa.array([pickle.dumps(row)], pa.binary())})

    for whole in batches:
        whole = whole.rename_columns([str(i) for i in range(n_kept + 2)])
        for batch in parts(whole, str(n_kept), BLOCK_BYTES // 4):
            kept.append(batch)
            size += pc.sum(pc.binary_length(batch.column(n_kept))).as_py() or 0
            if size >= BLOCK_BYTES:
                yield from block()
                kept, size, count = [], 0, count + 1
                _release()
    if sum(len(x) for x in kept):
        yield from block()
    _release()


def ask_trigrams(rows: Iterator[tuple], shards: int) -> Iterator[tuple]:
    """Each block asks for its trigrams."""
    found = _rows(rows, "block", "word numbers")
    for name in {s for s, _ in found}:
        ((data, _),) = found[name, "block"]
        own = Block.unpack(data)
        grams = own.trigrams(replied([x[1:] for x in found[name, "word numbers"]], unpack_numbers))
        counts = summed(grams.at, own.trained(), grams.size)
        yield from dealt("trigrams", name, grams, counts, shards)
        del own, grams, counts
        _release()


def score_blocks(rows: Iterator[tuple], add: float, denominator: float) -> Iterator[bytes]:
    """For each block its kept columns and the sums of its texts, as an Arrow stream."""
    found = _rows(rows, "block", "word counts", "word numbers", "scores")
    for name in {s for s, _ in found}:
        _release()
        ((data, columns),) = found[name, "block"]
        own = Block.unpack(data)
        counts = replied([x[1:] for x in found[name, "word counts"]], partial(unpack_values, kind="<i8"))
        known = own.per_text(own.of_tokens((counts > 0).astype(np.int64)))
        base = own.per_text(own.of_tokens(log_unigram(counts, add, denominator)))
        grams = own.trigrams(replied([x[1:] for x in found[name, "word numbers"]], unpack_numbers))
        score = own.per_text(replied([x[1:] for x in found[name, "scores"]], partial(unpack_values, kind="<f8"))[grams.at])
        table = pa.ipc.open_stream(columns).read_all()
        arrays = [*table.columns, pa.array(own.held_out), pa.array(own.sizes), pa.array(known), pa.array(base), pa.array(score)]
        table = pa.table(arrays, [str(i) for i in range(len(arrays))])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        yield sink.getvalue().to_pybytes()


def read_streams(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0):
            for x in pa.ipc.open_stream(data.as_buffer()):
                yield pa.RecordBatch.from_arrays(x.columns, names)


# -- the steps on the cluster


def _same(key: int) -> int:
    return key


def _shuffled(rdd, step: Callable, n: int, **fixed):
    """The rows of a step, by key; all shuffles deal keys alike, so that a union of them moves nothing."""
    return rdd.mapPartitions(partial(step, **fixed)).partitionBy(n, _same)


def _added_up(rdd) -> list[int]:
    """The sums of the rows ``seen``, which have key 0."""
    return rdd.context.runJob(rdd, _seen, [0])


def _seen(rows: Iterator[tuple]) -> list:
    total: list[int] = []
    for _, row in rows:
        if row[0] == "seen":
            total = [a + b for a, b in zip(total or [0] * len(row[1]), row[1], strict=True)]
    return total


def word_shards(shards: int) -> int:
    """Words are fewer than n-grams: many shards of them would mean small rows."""
    return shards if shards <= 32 else max(32, shards // 4)


def katz(blocks, shards: int, most: int, add: float, discounts: Callable[[list[int]], list[float]]):
    """The streams of :func:`score_blocks` from the rows of :func:`read_blocks`, and the training tokens."""
    texts = blocks.partitionBy(shards, _same)
    few = word_shards(shards)
    named = _shuffled(texts, name_words, shards, shards=few)
    n, v = _added_up(named) or (0, 0)
    denominator = n + add * (v + 1)
    texts = texts.union(named)
    trigrams = _shuffled(texts, ask_trigrams, shards, shards=shards)
    bigrams = _shuffled(trigrams, climb, shards, kind="trigrams", order=3, lower="bigrams", shards=shards, most=most)
    d3 = discounts(_added_up(bigrams))
    words = _shuffled(bigrams, climb, shards, kind="bigrams", order=2, lower="unigrams", shards=few, most=most)
    d2 = discounts(_added_up(words))
    counts = _shuffled(words, count_words, shards)
    unigram = partial(log_unigram, add=add, denominator=denominator)
    two = _shuffled(bigrams.union(counts), descend, shards, kind="bigrams", order=2, answers="unigram counts", reply="bigram scores", d=d2, lower=unigram)
    three = _shuffled(trigrams.union(two), descend, shards, kind="trigrams", order=3, answers="bigram scores", reply="scores", d=d3, lower=as_they_are)
    return texts.union(three).mapPartitions(partial(score_blocks, add=add, denominator=denominator)), n
