"""Packing of tokenised texts into fixed windows, online and in bounded space.

Each input partition keeps at most ``OPEN`` windows open. A piece goes into the
open window that it fills best; when it fits into none and all windows are in
use, the fullest is emitted. Texts longer than a window fill windows of their
own and only their rest is placed. What stays open at the end of a partition is
merged: the open windows of every ``MERGED`` partitions meet in one task (a
bounded number) and their pieces are placed again, largest first.

The pieces are written to the shared folder with their ids before the merge,
so a lost executor never makes a second, different packing.

Cases: null text counts as empty and yields the end id alone; ids may repeat or
be null; an empty table gives an empty table. The result has its own columns,
named after the arguments, whatever else the input holds.
"""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import query, stored, table
from shelfmark.llm.word_ids import END_ID, encoder, parts

SIZE = 2048
OPEN = 64
MERGED = 4
# numbers below these bits are counted inside a partition or a merge group
_LOCAL_BITS = 40

_COLUMNS = ("id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")


class _Windows:
    """Open windows of one partition."""

    def __init__(self, size: int, most: int, first: int) -> None:
        self.size, self.most, self.next = size, most, first
        self.free: list[tuple[int, int]] = []  # room and number, sorted
        self.held: dict[int, list[tuple]] = {}
        self.out: list[tuple] = []

    def _close(self, number: int) -> None:
        at = 0
        for piece in self.held.pop(number):
            self.out.append((*piece[:4], number, at, piece[4]))
            at += piece[2]

    def place(self, piece: tuple) -> None:
        """``piece``: id, start, length, tokens of the text, ids."""
        n = piece[2]
        i = bisect.bisect_left(self.free, (n, -1))
        if i < len(self.free):
            room, number = self.free.pop(i)
        else:
            if len(self.free) >= self.most:
                self._close(self.free.pop(0)[1])
            room, number = self.size, self.next
            self.next += 1
            self.held[number] = []
        self.held[number].append(piece)
        if room == n:
            self._close(number)
        else:
            bisect.insort(self.free, (room - n, number))

    def finish(self) -> None:
        for _, number in self.free:
            self._close(number)
        self.free = []


def _table(rows: list[tuple], id_type: pa.DataType, group) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(_COLUMNS)
    kinds = [id_type, *[pa.int64()] * 5, pa.binary()]
    made = {c: pa.array(x, k) for c, x, k in zip(_COLUMNS, columns, kinds, strict=True)}
    return pa.table(made | {"open_group": pa.array([group] * len(rows), pa.int64())})


def pack(
    df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
    size: int = SIZE, most_open: int = OPEN, merged: int = MERGED, end_id: int = END_ID,
) -> DataFrame:
    """Pieces: ``id_col, start, length, doc_tokens, sequence_id, offset, ids``.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers.
    Sequence numbers are unique; offsets inside a sequence have no gap.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    kind = rows.schema["id"].dataType.simpleString()

    def place(batches):
        encode = encoder(vocabulary, end_id).encode
        pid = TaskContext.get().partitionId()
        windows, id_type = _Windows(size, most_open, pid << _LOCAL_BITS), None
        for whole in batches:
            id_type = whole.schema.field("id").type
            for batch in parts(whole, "t"):
                for key, ids in zip(batch["id"].to_pylist(), encode(batch["t"].to_pylist()), strict=True):
                    n, at = len(ids) // 4, 0
                    while n - at >= size:
                        windows.out.append((key, at, size, n, windows.next, 0, ids[4 * at : 4 * (at + size)]))
                        windows.next += 1
                        at += size
                    if at < n:
                        windows.place((key, at, n - at, n, ids[4 * at :]))
                yield from _table(windows.out, id_type, None).to_batches()
                windows.out = []
        if id_type is not None:
            windows.finish()
            yield from _table(windows.out, id_type, pid // merged).to_batches()

    def merge(key, t):
        group = key[0].as_py()
        windows = _Windows(size, t.num_rows, (1 << 62) + (group << _LOCAL_BITS))
        t = t.sort_by([("length", "descending"), ("sequence_id", "ascending"), ("offset", "ascending")])
        for r in t.to_pylist():
            windows.place((r["id"], r["start"], r["length"], r["doc_tokens"], r["ids"]))
        windows.finish()
        return _table(windows.out, t.schema.field("id").type, None)

    schema = f"id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary, open_group bigint"
    pieces = stored(rows.mapInArrow(place, schema), "packed")
    closed = pieces.where("open_group is null")
    rest = pieces.where("open_group is not null").groupBy("open_group").applyInArrow(merge, schema)
    return closed.unionAll(rest).select(F.col("id").alias(id_col), *_COLUMNS[1:])


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op2_packing")
def op2_packing(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    return digest(pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))
