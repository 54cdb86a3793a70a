"""Removal of long passages that occur more than once, by recompression.

Every text is a sequence of words. A round gives a new symbol to each run of
one repeated symbol and to each pair of neighbours whose first member falls
into the left and whose second into the right half of the alphabet; which half
is decided by the name and the round, so every task names alike and a round
moves no data. A name is a 64-bit fingerprint of what it stands for. Symbols
stop growing at a cap per round, so that a passage of ``window`` words keeps
whole symbols inside.

Merging looks at two neighbours only. For a window one can therefore tell from
its own words which boundaries survive whatever stands around it. The first
symbol of that core at the highest level with a core is the window's anchor:
equal windows have equal anchors. Anchors that occur once in the corpus rule
their windows out; the windows of shared anchors are verified by a second
fingerprint over all their words.

Which names of a batch of texts are shared is answered by buckets of names: a
batch sends each name once with a mark if it holds it twice, and gets back one
bit per name. A name held by a third of all rows costs a row per batch.

Cases: null text counts as empty (no words, nothing removed); ids may repeat or
be null (rows are kept apart); identical rows give identical results; an empty
table gives an empty table; other columns are passed through, and ``n_words``,
``n_removed`` and ``kept`` replace columns of these names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import vector as V
from shelfmark.llm.common import query, table, text_bytes

WINDOW = 35
# longest symbol, in words, that each round may make
CAPS = (2, 3, 4, 6, 8, 10, 12, 14, 16)
# rounds that first name runs
RUN_ROUNDS = (0, 4)
# rounds after which anchors are taken; a later one with a core wins
ANCHOR_ROUNDS = (2, 5, 8)
BATCH_BYTES = 1 << 20
BUCKET_BYTES = 2 << 20

_U = np.uint64


def _rounds(names: np.ndarray, opens: np.ndarray, p: np.ndarray, window: int, caps=CAPS) -> tuple[np.ndarray, np.ndarray]:
    """Anchor name and anchor position of each window start ``p``.

    ``names`` are word fingerprints, ``opens`` marks the first word of a text.
    """
    n = len(names)
    start = np.arange(n + 1)
    f, g, live = p.copy(), p + window, np.ones(len(p), bool)
    anchor, where = V.mixed(names[p]), p.copy()
    at = np.empty(n + 1, np.int64)
    for r, cap in enumerate(caps):
        if r in RUN_ROUNDS:
            names, opens, start, f, g, live = _name_runs(names, opens, start, f, g, live, cap if r else max(caps), at)
        names, opens, start, f, g, live = _name_pairs(names, opens, start, f, g, live, cap, r, at)
        if r in ANCHOR_ROUNDS:
            at[start] = np.arange(len(start))
            i = np.flatnonzero(live)
            anchor[i] = names[at[f[i]]] + _U(r + 1)
            where[i] = f[i]
    return anchor, where


def _name_runs(names, opens, start, f, g, live, cap, at):
    m = len(names)
    size = np.diff(start)
    fresh = np.ones(m + 1, bool)
    fresh[1:m] = (names[1:] != names[:-1]) | opens[1:]
    heads = np.flatnonzero(fresh)
    run = np.cumsum(fresh[:m]) - 1
    head, tail = heads[run], heads[run + 1]
    at[start] = np.arange(m + 1)
    i = np.flatnonzero(live)
    s, t = at[f[i]], at[g[i]] - 1
    one = start[tail[s]] >= g[i]  # the core is one run: its ends can't be told
    right, left = tail[s] - s, t - head[t] + 1
    lose = np.maximum(right, 2) * size[s] <= cap
    f[i] = np.where(lose, start[tail[s]], f[i])
    lose = np.maximum(left, 2) * size[t] <= cap
    g[i] = np.where(lose, start[head[t]], g[i])
    live[i] = ~one & (f[i] < g[i])
    k = np.diff(heads)
    joined = (k > 1) & (k * size[heads[:-1]] <= cap)
    keep = np.flatnonzero(fresh[:m] | ~joined[run])
    new = names[keep].copy()
    which = run[keep]
    now = joined[which]
    new[now] = V.mixed(new[now] * _U(0xD6E8FEB86659FD93) + k[which[now]].astype(_U))
    return new, opens[keep], np.append(start[keep], start[-1]), f, g, live


def _name_pairs(names, opens, start, f, g, live, cap, r, at):
    m = len(names)
    size = np.diff(start)
    left = (V.mixed(names ^ V.mixed(np.array([r + 1], _U))) & _U(1)).astype(bool)
    at[start] = np.arange(m + 1)
    i = np.flatnonzero(live)
    s, t = at[f[i]], at[g[i]] - 1
    short = size < cap
    f[i] = np.where(~left[s] & short[s], start[s + 1], f[i])
    g[i] = np.where(left[t] & short[t], start[t], g[i])
    live[i] = f[i] < g[i]
    joined = np.zeros(m, bool)
    joined[:-1] = left[:-1] & ~left[1:] & ~opens[1:] & (size[:-1] + size[1:] <= cap)
    new = names.copy()
    j = np.flatnonzero(joined)
    new[j] = V.mixed(V.mixed(names[j] + _U(0xA0761D6478BD642F)) * _U(0xE7037ED1A0B428DB) + names[j + 1])
    keep = np.ones(m, bool)
    keep[j + 1] = False
    keep = np.flatnonzero(keep)
    return new[keep], opens[keep], np.append(start[keep], start[-1]), f, g, live


class _Batch:
    """Words and window starts of a batch of texts."""

    def __init__(self, texts, window: int) -> None:
        self.raw, at = V.string_buffers(texts)
        self.starts, self.ends, first = V.word_bounds(self.raw, at)
        self.n_words = np.diff(first)
        self.window = window
        self.text_of_word = np.repeat(np.arange(len(self.n_words)), self.n_words)
        self.names = V.word_hashes(self.raw, self.starts, self.ends)
        n = len(self.names)
        self.opens = np.zeros(n, bool)
        self.opens[first[:-1][self.n_words > 0]] = True
        end = np.repeat(first[1:], self.n_words)
        self.p = np.flatnonzero(np.arange(n) + window <= end)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Anchor of each window, and whether its window opens a new occurrence of it."""
        if not len(self.p):
            return np.zeros(0, _U), np.zeros(0, bool)
        name, where = _rounds(self.names, self.opens, self.p, self.window)
        fresh = np.ones(len(name), bool)
        fresh[1:] = (name[1:] != name[:-1]) | (where[1:] != where[:-1])
        return name, fresh

    def windows(self, chosen: np.ndarray) -> np.ndarray:
        p = self.p[chosen]
        return V.slice_hashes(V.mixed(self.names ^ _U(0x2545F4914F6CDD1D)), p, p + self.window)


def _buckets(names: np.ndarray, n: int) -> np.ndarray:
    return (V.mixed(names ^ _U(0x8EBC6AF09C88C6E3)) % _U(n)).astype(np.int64)


def _sent(batch: int, names: np.ndarray, twice: np.ndarray, n_buckets: int) -> dict:
    """Rows for the buckets: sorted distinct names with a mark, per bucket."""
    bucket = _buckets(names, n_buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=n_buckets))
    rows = {"b": [], "bucket": [], "names": [], "marks": []}
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        part = order[lo:hi]
        rows["b"].append(batch)
        rows["bucket"].append(int(bucket[part[0]]))
        rows["names"].append(V.pack_blob(names[part]))
        rows["marks"].append(V.pack_blob(np.packbits(twice[part])))
    return rows


def _distinct(names: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct names, whether one occurs twice, and the place of each name."""
    if not len(names):
        return names, np.zeros(0, bool), np.zeros(0, np.int64)
    distinct, place = np.unique(names, return_inverse=True)
    return distinct, np.bincount(place[fresh], minlength=len(distinct)) > 1, place


def _marks(table_: pa.Table, names: np.ndarray, n_buckets: int) -> np.ndarray:
    """The returned bits, in the order of ``names`` (sorted distinct)."""
    bits = {b: m for b, m in zip(table_["bucket"].to_pylist(), table_["marks"].to_pylist(), strict=True)}
    bucket = _buckets(names, n_buckets)
    out = np.zeros(len(names), bool)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=n_buckets))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        part = order[lo:hi]
        raw = np.frombuffer(bits[int(bucket[part[0]])], np.uint8)
        out[part] = np.unpackbits(raw, count=len(part)).astype(bool)
    return out


_SENT = "b bigint, bucket bigint, names binary, marks binary"
_SENT_ARROW = pa.schema([("b", pa.int64()), ("bucket", pa.int64()), ("names", pa.binary()), ("marks", pa.binary())])
# bucket of rows that only pass through to the next step of their own batch
_OWN = -1


def _shared(rows):
    """One bucket: mark the names that two batches sent or that one marked."""
    if len(rows) and rows["bucket"][0].as_py() <= _OWN:
        return rows
    blobs = [np.frombuffer(x, _U) for x in rows["names"].to_pylist()]
    marks = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(x)) for m, x in zip(rows["marks"].to_pylist(), blobs, strict=True)]
    names, twice = np.concatenate(blobs), np.concatenate(marks)
    order = np.argsort(names, kind="stable")
    sorted_, mark = names[order], twice[order].astype(np.int64)
    head = np.flatnonzero(np.diff(sorted_, prepend=sorted_[0] ^ _U(1)) != 0)
    size = np.diff(np.append(head, len(sorted_)))
    yes = (size > 1) | (np.add.reduceat(mark, head) > 0)
    found = np.empty(len(names), bool)
    found[order] = np.repeat(yes, size)
    cut = np.cumsum([len(x) for x in blobs])[:-1]
    out = [V.pack_blob(np.packbits(x)) for x in np.split(found, cut)]
    return pa.table({"b": rows["b"], "bucket": rows["bucket"], "names": pa.array([b""] * len(out), pa.binary()), "marks": pa.array(out, pa.binary())}).cast(_SENT_ARROW)


def cut_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``df`` with ``n_words``, ``n_removed`` and ``kept``.

    A word is removed if it lies in a window of ``window`` words whose words
    also start elsewhere in the table, same text included. ``kept`` are the
    other words joined by one space.
    """
    rest = [c for c in df.columns if c not in ("n_words", "n_removed", "kept")]
    size = text_bytes(df, text_col)
    n_batches = max(1, -(-size // BATCH_BYTES))
    n_buckets = max(1, -(-size // BUCKET_BYTES))
    key = F.xxhash64(F.lit(17), F.col(id_col), F.col(text_col))
    rows = df.select(
        F.pmod(key, F.lit(n_batches)).alias("b"),
        key.alias("k"),
        F.col(text_col).alias("t"),
        F.struct(*[F.col(f"`{c}`") for c in rest if c != text_col]).alias("rest"),
    )

    def texts(t):
        t = t.sort_by("k")
        return t, _Batch(t["t"], window)

    def send_anchors(key, t):
        _, batch = texts(t)
        names, twice, _ = _distinct(*batch.anchors())
        return pa.table(_sent(key[0].as_py(), names, twice, n_buckets), _SENT_ARROW)

    def send_windows(key, t, answers):
        _, batch = texts(t)
        b = key[0].as_py()
        names, _, place = _distinct(*batch.anchors())
        chosen = _marks(answers, names, n_buckets)[place] if len(names) else np.zeros(0, bool)
        windows = batch.windows(chosen)
        found, twice, _ = _distinct(windows, np.ones(len(windows), bool))
        sent = _sent(b, found, twice, n_buckets)
        for name, x in zip(sent, (b, _OWN - b, b"", V.pack_blob(np.packbits(chosen))), strict=True):
            sent[name].append(x)
        return pa.table(sent, _SENT_ARROW)

    def cut(key, t, answers):
        t, batch = texts(t)
        covered = np.zeros(len(batch.names) + 1, np.int64)
        if len(batch.p):
            own = answers.filter(pa.compute.less_equal(answers["bucket"], _OWN))["marks"][0].as_py()
            chosen = np.flatnonzero(np.unpackbits(np.frombuffer(own, np.uint8), count=len(batch.p)))
            windows = batch.windows(chosen)
            names, _, place = _distinct(windows, np.ones(len(windows), bool))
            if len(names):
                hit = batch.p[chosen[_marks(answers, names, n_buckets)[place]]]
                np.add.at(covered, hit, 1)
                np.add.at(covered, hit + window, -1)
        gone = np.cumsum(covered[:-1]) > 0
        n = len(batch.n_words)
        stay = ~gone
        kept = V.joined_words(batch.raw, batch.starts[stay], batch.ends[stay], batch.text_of_word[stay], n)
        removed = np.bincount(batch.text_of_word[gone], minlength=n)
        return pa.table(
            {"t": t["t"], "rest": t["rest"], "n_words": pa.array(batch.n_words.astype(np.int64)), "n_removed": pa.array(removed.astype(np.int64)), "kept": kept.cast(pa.string())}
        )

    grouped = rows.groupBy("b")
    anchors = grouped.applyInArrow(send_anchors, _SENT).groupBy("bucket").applyInArrow(_shared, _SENT)
    windows = grouped.cogroup(anchors.groupBy("b")).applyInArrow(send_windows, _SENT)
    verified = windows.groupBy("bucket").applyInArrow(_shared, _SENT)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    out = grouped.cogroup(verified.groupBy("b")).applyInArrow(
        cut, f"t string, rest {kinds['rest']}, n_words bigint, n_removed bigint, kept string"
    )
    columns = [F.col("t").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in rest]
    return out.select(*columns, "n_words", "n_removed", "kept")


@query("op1_substring_dedup")
def op1_substring_dedup(spark, sf_dir) -> DataFrame:
    cut = cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))
