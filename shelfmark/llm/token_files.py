"""Token ids in files of patched frame-of-reference blocks.

Format. A table of Parquet files, uncompressed, in ascending id order; each row
holds the texts of one range of 512 ids, its ``payload`` being (little-endian)

    u32 number of texts, u64 number of ids, u32 number of blocks
    i64 id of each text; u64 first id of each text, counted in the payload
    u64 byte position of each block, counted from the end of this index
    blocks

and a block of at most 4096 ids being

    u32 minimum, u8 width, u16 ids, u16 exceptions
    ids minus the minimum, their low ``width`` bits packed into 64-bit words
    u16 place and u32 value (minus the minimum) of each exception

``width`` is what the given percentile of the block's values needs; larger
values are exceptions. A block can be read alone through the index.

Texts are dealt out by ranges of ids, so files follow each other in id order
and no task gets more than its ranges. Positions over the whole corpus come
from one total per range, added up along a tree.

Cases: null text counts as empty (the end id alone); a null id sorts first;
repeated ids stay apart in the order of their texts; an empty table gives
empty files. Other columns are ignored.
"""

from __future__ import annotations

import functools
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import query, running_totals, stored, table
from shelfmark.llm.word_ids import END_ID, encoder

BLOCK = 4096
PERCENTILE = 98
RANGE_BITS = 9
# range of rows without an id: below all others
_NO_ID = -(1 << 55)

_HEAD = struct.Struct("<IQI")
_BLOCK_HEAD = struct.Struct("<IBHH")


@functools.lru_cache(64)
def _places(width: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bit = np.arange(n, dtype=np.int64) * width
    word, shift = bit >> 6, (bit & 63).astype(np.uint64)
    heads = np.flatnonzero(np.diff(word, prepend=-1))
    return word, shift, heads


def _packed(values: np.ndarray, width: int) -> bytes:
    if not width or not len(values):
        return b""
    word, shift, heads = _places(width, len(values))
    out = np.zeros(int(word[-1]) + 2, np.uint64)
    out[: len(heads)] = np.bitwise_or.reduceat(values << shift, heads)
    over = np.flatnonzero(shift.astype(np.int64) + width > 64)
    out[word[over] + 1] |= values[over] >> (np.uint64(64) - shift[over])
    return out[: -(-len(values) * width // 64)].tobytes()


def _unpacked(raw: bytes, width: int, n: int) -> tuple[np.ndarray, int]:
    if not width:
        return np.zeros(n, np.uint64), 0
    size = -(-n * width // 64)
    words = np.append(np.frombuffer(raw, "<u8", size), np.uint64(0))
    word, shift, _ = _places(width, n)
    low = words[word] >> shift
    high = np.where(shift > 0, words[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
    return (low | high) & np.uint64((1 << width) - 1), size * 8


def encode_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One block of at most 65535 ids (unsigned 32-bit)."""
    low = int(ids.min())
    values = ids.astype(np.uint64) - np.uint64(low)
    cut = np.partition(values, k := min(len(values) - 1, int(len(values) * percentile / 100)))[k]
    width = int(cut).bit_length()
    odd = np.flatnonzero(values >> np.uint64(width))
    body = _packed(values & np.uint64((1 << width) - 1), width)
    return (
        _BLOCK_HEAD.pack(low, width, len(ids), len(odd)) + body
        + odd.astype("<u2").tobytes() + values[odd].astype("<u4").tobytes()
    )


def decode_block(raw: memoryview | bytes) -> np.ndarray:
    low, width, n, odd = _BLOCK_HEAD.unpack_from(raw)
    at = _BLOCK_HEAD.size
    values, used = _unpacked(raw[at:], width, n)
    at += used
    places = np.frombuffer(raw, "<u2", odd, at)
    values[places] = np.frombuffer(raw, "<u4", odd, at + 2 * odd)
    return (values + np.uint64(low)).astype("<u4")


def encode_payload(keys: np.ndarray, starts: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> bytes:
    blocks = [encode_block(ids[i : i + block]) for i in range(0, len(ids), block)]
    at = np.cumsum([0, *map(len, blocks)])[:-1].astype("<u8")
    return b"".join(
        [_HEAD.pack(len(keys), len(ids), len(blocks)), keys.astype("<i8").tobytes(), starts.astype("<u8").tobytes(), at.tobytes(), *blocks]
    )


def decode_payload(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the texts, first token of each (n + 1 entries), and all tokens."""
    n, total, n_blocks = _HEAD.unpack_from(raw)
    at = _HEAD.size
    keys = np.frombuffer(raw, "<i8", n, at)
    starts = np.frombuffer(raw, "<u8", n, at + 8 * n).astype(np.int64)
    index = np.frombuffer(raw, "<u8", n_blocks, at + 16 * n).astype(np.int64)
    body = memoryview(raw)[at + 16 * n + 8 * n_blocks :]
    ends = np.append(index[1:], len(body))
    ids = [decode_block(body[lo:hi]) for lo, hi in zip(index, ends, strict=True)]
    return keys, np.append(starts, total), np.concatenate(ids) if ids else np.zeros(0, "<u4")


def write_tokens(
    df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID, folder: str | None = None,
) -> DataFrame:
    """Write the files and return their table: ``range, n_texts, n_ids, no_id, payload``."""
    rows = df.select(
        F.coalesce(F.shiftright(F.col(id_col).cast("bigint"), RANGE_BITS), F.lit(_NO_ID)).alias("range"),
        F.col(id_col).cast("bigint").alias("id"),
        F.col(text_col).alias("t"),
    )

    def encode(key, t):
        t = t.sort_by([("id", "ascending"), ("t", "ascending")])
        coded = encoder(vocabulary, end_id).encode(t["t"].to_pylist())
        size = np.array([len(x) // 4 for x in coded], np.int64)
        ids = np.frombuffer(b"".join(coded), "<u4")
        no_id = key[0].as_py() == _NO_ID
        keys = np.zeros(len(size), np.int64) if no_id else t["id"].to_numpy()
        payload = encode_payload(keys, np.cumsum(size) - size, ids)
        return pa.table({"range": [key[0].as_py()], "n_texts": [len(size)], "n_ids": [len(ids)], "no_id": [no_id], "payload": [payload]})

    coded = rows.repartitionByRange("range").groupBy("range").applyInArrow(
        encode, "range bigint, n_texts bigint, n_ids bigint, no_id boolean, payload binary"
    )
    return stored(coded, "tokens", codec="none", folder=folder)


def read_tokens(files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id_col, start, n_tokens, ids_crc32`` of every text, from the files."""
    offsets = running_totals(files.select("range", "n_ids"), "range", "n_ids", "before")

    def decode(batches):
        for batch in batches:
            for key, no_id, raw in zip(*(batch[c].to_pylist() for c in ("range", "no_id", "payload")), strict=True):
                keys, at, ids = decode_payload(raw)
                data, n = memoryview(ids.tobytes()), len(keys)
                crc = [zlib.crc32(data[4 * lo : 4 * hi]) for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.record_batch(
                    {
                        "range": pa.array([key] * n, pa.int64()),
                        "id": pa.array(keys, pa.int64(), mask=np.full(n, no_id)),
                        "start": pa.array(at[:-1], pa.int64()),
                        "n_tokens": pa.array(np.diff(at), pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                )

    texts = files.select("range", "no_id", "payload").mapInArrow(
        decode, "range bigint, id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return texts.join(offsets, "range").select(
        F.col("id").alias(id_col), (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


@query("op3_token_files")
def op3_token_files(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    return read_tokens(write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))
