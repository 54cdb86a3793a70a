"""Fill-in-the-middle: each text cut at two code points, its parts reordered around sentinels.

Cuts are counted in code points but the text is sliced as UTF-8 bytes. A batch
of texts reaches Python as one Arrow buffer of bytes and is never decoded: only
its multibyte characters are indexed, each by its code-point position in the
batch and the excess bytes (beyond one a character) of all multibyte characters
up to and including it. A code-point cut ``c`` lies at byte ``c + excess``, the
excess of the multibyte characters before ``c``, which ``searchsorted`` finds in
that sparse index; ASCII spans need no entry and stay plain arithmetic. Spark
then slices the bytes, assembles the output and hashes it, all in native
expressions; the texts never come back from Python.

Cut points and form come from the sha256 of ``1:`` and the decimal id: its
first four groups of 8 hex digits, read as unsigned integers, are h1 to h4. The
prefix ends after ``min(h1, h2) % (n + 1)`` code points (each taken modulo
first), the middle after the larger. A text is left ``plain`` when it is empty,
holds a sentinel already or ``h3 % 100 >= PLAIN_PERCENT``; otherwise it is
``spm`` when ``h4 % 100 < SPM_PERCENT``, else ``psm``.

Cases: a null text is empty (plain); a null id is hashed as ``1:`` alone;
repeated rows give equal results; very long texts are cut whole; an empty
table gives an empty table. :func:`fim` adds one struct column ``out`` and
replaces a column of that name; all other columns of the input stay as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import query, table

# fixed values: the sentinels, and the shares of plain and suffix-first texts
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT = 90
SPM_PERCENT = 20


def _offsets(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (n + 1) and bytes of a string array, nulls as empty strings."""
    arr = arr.fill_null("").cast(pa.large_string())
    _, offsets, data = arr.buffers()
    offs = np.frombuffer(offsets, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offs, raw


def byte_cuts(arr: pa.Array, cuts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Code points of each text, and each array of code-point cuts (one per text) as byte offsets in it.

    The index holds one entry per multibyte character of the batch: its
    code-point position and the excess bytes up to it. Everything else is
    arithmetic on positions.
    """
    offs, raw = _offsets(arr)
    lead = np.flatnonzero(raw >= 0xC0)
    extra = 1 + (raw[lead] >= 0xE0) + (raw[lead] >= 0xF0)
    excess = np.concatenate(([0], np.cumsum(extra, dtype=np.int64)))
    # code-point position of each multibyte character in the batch
    lead_cp = lead - excess[:-1]
    at = excess[np.searchsorted(lead, offs, "left")]
    starts = offs - at
    n = np.diff(starts)
    out = []
    for c in cuts:
        g = starts[:-1] + np.asarray(c, np.int64)
        out.append(g + excess[np.searchsorted(lead_cp, g, "left")] - offs[:-1])
    return n, out


_CUTS = T.StructType([T.StructField(name, T.LongType()) for name in ("n", "lo", "hi", "lo_b", "hi_b")])


@F.arrow_udf(_CUTS)
def _cuts(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    n, _ = byte_cuts(text, [])
    a = h1.to_numpy(zero_copy_only=False).astype(np.int64) % (n + 1)
    b = h2.to_numpy(zero_copy_only=False).astype(np.int64) % (n + 1)
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    _, (lo_b, hi_b) = byte_cuts(text, [lo, hi])
    return pa.StructArray.from_arrays([pa.array(x) for x in (n, lo, hi, lo_b, hi_b)], ["n", "lo", "hi", "lo_b", "hi_b"])


def draws(doc_id: Column) -> list[Column]:
    """h1 to h4 of an id: the first four 8-digit groups of the hex sha256 of ``1:`` and the id."""
    h = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def restore(output: Column, form: Column) -> Column:
    """The text rebuilt from a transformed ``output`` and its ``form``.

    The original holds no sentinel, so the first sentinel after the leading
    one ends its part.
    """

    def locate(sentinel: str, start: Column) -> Column:
        return F.call_function("locate", F.lit(sentinel), output, start)

    second = F.when(form == "spm", locate(PREFIX, F.lit(4))).otherwise(locate(SUFFIX, F.lit(4)))
    middle = locate(MIDDLE, second + 3)
    first_part = F.substring(output, F.lit(4), second - 4)
    second_part = F.substring(output, second + 3, middle - second - 3)
    rest = F.substring(output, middle + 3, F.lit(1 << 30))
    return (
        F.when(form == "psm", F.concat(first_part, rest, second_part))
        .when(form == "spm", F.concat(second_part, rest, first_part))
        .otherwise(output)
    )


def fim(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", out: str = "fim") -> DataFrame:
    """``df`` with a struct ``out``: ``n`` (code points), ``form``, ``prefix_chars``, ``middle_chars`` (null if plain), ``text`` (the output)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    h1, h2, h3, h4 = draws(F.col(id_col))
    rows = df.withColumn(out, F.struct(text.alias("t"), h3.alias("h3"), h4.alias("h4"), _cuts(text, h1, h2).alias("c")))
    t, c = F.col(f"{out}.t"), F.col(f"{out}.c")
    sentinel = t.contains(PREFIX) | t.contains(SUFFIX) | t.contains(MIDDLE)
    plain = (c["n"] == 0) | sentinel | (F.col(f"{out}.h3") % 100 >= PLAIN_PERCENT)
    form = F.when(plain, "plain").when(F.col(f"{out}.h4") % 100 < SPM_PERCENT, "spm").otherwise("psm")
    raw = F.encode(t, "UTF-8")

    def part(start: Column, end: Column) -> Column:
        return F.decode(F.substring(raw, start + 1, end - start), "UTF-8")

    prefix, middle = part(F.lit(0), c["lo_b"]), part(c["lo_b"], c["hi_b"])
    suffix = part(c["hi_b"], F.octet_length(t))
    output = (
        F.when(form == "plain", t)
        .when(form == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    return rows.withColumn(
        out,
        F.struct(
            c["n"].alias("n"),
            form.alias("form"),
            F.when(~plain, c["lo"]).alias("prefix_chars"),
            F.when(~plain, c["hi"] - c["lo"]).alias("middle_chars"),
            output.alias("text"),
        ),
    )


def _sql() -> str:
    """The digest in DuckDB's SQL: cuts by code points with substring, no byte index."""
    h = [f"('0x' || substr(h, {1 + 8 * i}, 8))::ubigint as h{i + 1}" for i in range(4)]
    return f"""
with d as (
  select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents
), c as (
  select doc_id, t, length(t)::bigint as n, {", ".join(h)} from d
), k as (
  select doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1))::bigint as a, greatest(h1 % (n + 1), h2 % (n + 1))::bigint as b,
         case when n = 0 or contains(t, '{PREFIX}') or contains(t, '{SUFFIX}') or contains(t, '{MIDDLE}') or h3 % 100 >= {PLAIN_PERCENT} then 'plain'
              when h4 % 100 < {SPM_PERCENT} then 'spm' else 'psm' end as form
  from c
)
select doc_id, n, form,
       case when form <> 'plain' then a end as prefix_chars,
       case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then t
                        when 'psm' then '{PREFIX}' || substring(t, 1, a) || '{SUFFIX}' || substring(t, b + 1) || '{MIDDLE}' || substring(t, a + 1, b - a)
                        else '{SUFFIX}' || substring(t, b + 1) || '{PREFIX}' || substring(t, 1, a) || '{MIDDLE}' || substring(t, a + 1, b - a) end) as output_sha256,
       sha256(t) as restored_sha256
from k
"""


@query("op11_fill_in_middle", _sql())
def op11_fill_in_middle(spark, sf_dir) -> DataFrame:
    done = fim(table(spark, sf_dir, "documents").select("doc_id", "text"))
    f = F.col("fim")
    return done.select(
        "doc_id",
        f["n"].alias("n"),
        f["form"].alias("form"),
        f["prefix_chars"].alias("prefix_chars"),
        f["middle_chars"].alias("middle_chars"),
        F.sha2(f["text"], 256).alias("output_sha256"),
        F.sha2(restore(f["text"], f["form"]), 256).alias("restored_sha256"),
    )
