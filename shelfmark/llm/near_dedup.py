"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Documents with one text are one node (its smallest id). A node's shingles are
its windows of three words, each labelled with its number among equal ones. A
sketch keeps the two labelled shingles of smallest hash in the order in which
they stand in the text; two texts agree on a sketch if they share those
shingles in that order, so agreement follows edit similarity. Nodes that agree
on one of ``SKETCHES`` sketches share a bucket. A changed word spoils three
windows, too many for a short text: texts of up to ``SHORT`` words are sketched
by single words, and those that may be near both kinds of texts in both ways.

No bucket of near texts is paired out. Its leader, drawn by a hash of bucket and
node, is compared with the others; leaders differ from bucket to bucket, so
members of a large group meet many of them. Components of the verified links
follow. While a bucket still holds several components, more and more of the
members outside its largest one, drawn likewise, are compared with every member
of another component, until all of them have been: then each pair of a bucket
is compared, joined or ruled out. Lengths rule a link out, and so do the rarest
words: of two linked texts of ``n`` words at most, ``0.8 n`` are common, so among
each one's ``floor(0.2 n) + 1`` rarest words (in one order for all) stands a common
one. Members meet on the bucket and such a word, so unlike texts that share a
bucket for a common passage do not meet at all.

A pair is linked when the word-level edit distance, computed inside a band just
wide enough for the threshold, is at most ``1 - SIMILARITY`` of the longer text.

Cases: texts without words are near only to equal ones; null counts as a text of its own kind (all
null texts are copies). A row without an id takes the class of an equal text
with one, else it has none. If an id repeats, its texts share a node. An empty
table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm import vector as V
from shelfmark.llm.common import query, small_side, stored, table
from shelfmark.llm.word_ids import parts

SHINGLE = 3
# texts of up to so many words are sketched by single words
SHORT = 15
SIMILARITY = 0.8
SKETCHES = 24
# leaders of a bucket in the round after the first, and how many times as many in each further one
LEADERS, MORE = 16, 8
# rare words before a word that are looked at to see whether a pair has met there
BEFORE = 4
_PLACE_BITS = 28

_U = np.uint64


def _numbered(names: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """``names``, each with its number among equal ones of its owner mixed in (``owner`` ascends)."""
    order = np.lexsort((names, owner))
    same = np.zeros(len(names), bool)
    same[1:] = (names[order][1:] == names[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    run = np.arange(len(names))
    run -= np.maximum.accumulate(np.where(same, 0, run))
    label = names.copy()
    label[order] += run.astype(_U) * _U(0x9E3779B97F4A7C15)
    return label


def sketches(texts, n_sketches: int = SKETCHES, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and its sketches (a row a text; zeros for a text without words)."""
    raw, at = V.string_buffers(texts)
    starts, ends, first = V.word_bounds(raw, at)
    words = V.word_hashes(raw, starts, ends)
    n_words = np.diff(first)
    out = np.zeros((len(n_words), n_sketches), np.int64)
    busy = np.flatnonzero(n_words)
    if not len(busy):
        return n_words, out
    count = np.maximum(n_words[busy] - shingle + 1, 1)
    head = np.cumsum(count) - count
    owner = np.repeat(np.arange(len(busy)), count)
    place = np.arange(count.sum()) - head[owner]
    lo = first[:-1][busy][owner] + place
    names = V.slice_hashes(words, lo, lo + np.minimum(n_words[busy], shingle)[owner])
    label = _numbered(names, owner)
    low = _U((1 << _PLACE_BITS) - 1)
    single = count == 1
    for k in range(n_sketches):
        salt = V.mixed(np.array([k + 1], _U))
        rank = (V.mixed(label ^ salt) & ~low) | place.astype(_U)
        one = (np.minimum.reduceat(rank, head) & low).astype(np.int64)
        rank[head + one] = ~_U(0)
        two = (np.minimum.reduceat(rank, head) & low).astype(np.int64)
        two[single] = 0
        a, b = names[head + np.minimum(one, two)], names[head + np.maximum(one, two)]
        out[busy, k] = V.mixed(V.mixed(a ^ salt) * _U(0xE7037ED1A0B428DB) + b).view(np.int64)
    return n_words, out


def banded_distance(a: list, b: list, most: int) -> int:
    """Edit distance of two sequences if it is at most ``most``, else ``most + 1``.

    One column of the band per element of ``b``, kept as bit vectors of
    vertical differences whose window moves down by one each time. ``most`` is
    below the length of both.
    """
    m, n = len(a), len(b)
    if abs(m - n) > most:
        return most + 1
    if a == b:
        return 0
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    width = 2 * most + 2
    full = (1 << width) - 1
    top = 1 << (width - 1)
    plus, minus = full & ~((1 << (width - most - 1)) - 1), 0
    score, limit, row = most, 2 * most + n - m, 1 << (width - 2)
    shift = most + 1 - width
    for j, x in enumerate(b):
        hit = where.get(x, 0)
        hit = (hit >> shift if shift >= 0 else hit << -shift) & full
        diagonal = ((((hit & plus) + plus) ^ plus) | hit | minus) & full
        right_plus = (minus | ~(diagonal | plus)) & full
        right_minus = diagonal & plus
        if j < m - most:
            score += not diagonal & top
            if score > limit:
                return most + 1
        else:
            score += bool(right_plus & row) - bool(right_minus & row)
            row >>= 1
        down = diagonal >> 1
        plus, minus = (right_minus | ~(down | right_plus)) & full, down & right_plus
        shift += 1
    return min(score, most + 1)


def _alike(one: pa.Array, two: pa.Array, similarity: float) -> list[bool]:
    def split(column):
        raw, at = V.string_buffers(column)
        starts, ends, first = V.word_bounds(raw, at)
        return V.word_hashes(raw, starts, ends), first

    (x, cut_x), (y, cut_y) = split(one), split(two)
    found = []
    for i in range(len(one)):
        a, b = x[cut_x[i] : cut_x[i + 1]], y[cut_y[i] : cut_y[i + 1]]
        most = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
        found.append(bool(len(a) and len(b)) and banded_distance(a.tolist(), b.tolist(), most) <= most)
    return found


def linked(pairs: DataFrame, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs ``a, b`` of nodes whose texts are near; ``docs`` is ``id, t``. Only texts of pairs are moved."""
    docs = docs.join(small_side(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids"), "id", "left_semi")
    left = docs.select(F.col("id").alias("a"), F.col("t").alias("ta"))
    right = docs.select(F.col("id").alias("b"), F.col("t").alias("tb"))
    both = pairs.join(right, "b").join(left, "a")

    def verify(batches):
        for whole in batches:
            for batch in parts(whole, "ta", 1 << 20):
                yield batch.select(["a", "b"]).filter(pa.array(_alike(batch["ta"], batch["tb"], similarity), pa.bool_()))

    return both.select("a", "b", "ta", "tb").mapInArrow(verify, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """``id, label`` of every node of ``edges`` (``a, b``): the smallest id of its component.

    Each round sends every node to the smallest of itself and its neighbours
    and joins what was sent together into one node. The larger end of each edge
    goes, so the edges shrink fast; a round moves what is left of them.
    """
    left = stored(edges.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).where("low <> high").distinct(), "edges")
    labels = left.select(F.col("low").alias("id")).union(left.select("high")).distinct().withColumn("label", F.col("id"))
    labels = stored(labels, "labels")
    while left.limit(1).count():
        near = left.select(F.col("high").alias("node"), F.col("low").alias("other")).union(left.select("low", "high"))
        sent = near.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("to"))
        further = sent.select(F.col("node").alias("to"), F.col("to").alias("then"))
        sent = stored(sent.join(further, "to").select("node", F.col("then").alias("to")), "sent")
        low, high = (sent.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")) for c in ("low", "high"))
        moved = left.join(low, "low").join(high, "high")
        ends = F.least("to_low", "to_high").alias("low"), F.greatest("to_low", "to_high").alias("high")
        left = stored(moved.select(*ends).where("low <> high").distinct(), "edges")
        moves = sent.select(F.col("node").alias("label"), "to")
        labels = stored(labels.join(moves, "label", "left").select("id", F.coalesce("to", "label").alias("label")), "labels")
    return labels


def _pairs(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets with several components; ``out``: outside the largest one, ``n_out``: how many of the bucket are."""
    named = members.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    sizes = named.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("n"), F.count("*").alias("parts")).where("parts > 1")
    kept = mixed.select("bucket", F.col("main.label").alias("main"), (F.col("n") - F.col("main.n")).alias("n_out"))
    return named.join(kept, "bucket").withColumn("out", F.col("label") != F.col("main")).drop("main")


def _rare_words(docs: DataFrame, similarity: float) -> DataFrame:
    """``id, size, rare``: (place, word) of the rarest words of each text; two linked texts share one of them.

    A word (with its number among equal ones of the text) is the rarer the fewer
    of these texts have it; ``place`` counts in that order from 0. Words of one
    text alone stand first and are left out.
    """

    def split(batches):
        for whole in batches:
            for batch in parts(whole, "t", 1 << 20):
                raw, at = V.string_buffers(batch["t"])
                starts, ends, first = V.word_bounds(raw, at)
                size = np.diff(first)
                named = _numbered(V.word_hashes(raw, starts, ends), np.repeat(np.arange(len(size)), size))
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(named.view(np.int64), pa.int64()))
                yield pa.record_batch({"node": batch["node"], "id": batch["id"], "size": pa.array(size, pa.int64()), "words": lists})

    # numbers written once; small ones are cheap to move
    texts = docs.select(F.monotonically_increasing_id().alias("node"), "id", "t")
    texts = stored(texts.mapInArrow(split, "node bigint, id bigint, size bigint, words array<bigint>"), "words")
    each = texts.select("node", "size", F.explode("words").alias("word"))
    common = each.groupBy("word").agg(F.count("*").alias("n")).where("n > 1")
    text = Window.partitionBy("node", "size")
    ranked = each.join(common, "word").withColumn("rank", F.dense_rank().over(text.orderBy("n", "word")))
    ranked = ranked.withColumn("place", F.col("size") - F.max("rank").over(text) + F.col("rank") - 1)
    ranked = ranked.where(F.col("place") <= F.floor(F.lit(1 - similarity) * F.col("size") + 1e-9))
    lists = ranked.groupBy("node", "size").agg(F.array_sort(F.collect_set(F.struct("place", "word"))).alias("rare"))
    return stored(lists.join(texts.select("node", "id"), "node").select("id", "size", "rare"), "rare")


def _spots(members: DataFrame, rare: DataFrame) -> DataFrame:
    """A row for each bucket and rare word of a node: ``bucket, word, id, label, size, place``, and what stands before them.

    ``buckets``: smaller ones of the node among ``members``; ``words``: the ``BEFORE`` rare ones before the word.
    """
    nodes = members.groupBy("id", "size").agg(F.min("label").alias("label"), F.array_sort(F.collect_set("bucket")).alias("all"))
    rows = nodes.join(rare, ["id", "size"]).select("id", "size", "label", "all", "rare", F.posexplode("all").alias("k", "bucket"))
    rows = rows.select("id", "size", "label", "bucket", F.slice("all", F.lit(1), F.col("k")).alias("buckets"), "rare", F.posexplode("rare").alias("i", "x"))
    start = F.greatest(F.col("i") - BEFORE, F.lit(0))
    return rows.select("bucket", "x.word", "id", "label", "size", "x.place", "buckets", F.slice(F.col("rare.word"), start + 1, F.col("i") - start).alias("words"))


def _fits(similarity: float):
    """Most edits of a pair, and whether its lengths allow a link."""
    most = F.floor(F.lit(1 - similarity) * F.greatest("size", "size2") + 1e-9)
    return most, F.abs(F.col("size") - F.col("size2")) <= most


def _met(members: DataFrame, leaders: DataFrame, rare: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: members and leaders of other components that may be linked, met on a bucket and a rare word.

    A pair that shares what stands before has met there, so it comes once, or again only
    after ``BEFORE`` words that it does not share.
    """
    most, fits = _fits(similarity)
    # words before the first common one are in no other text of the pair
    common = F.least(F.col("size") - F.col("place"), F.col("size2") - F.col("place2")) >= F.greatest("size", "size2") - most
    new = ~F.arrays_overlap("buckets", "buckets2") & ~F.arrays_overlap("words", "words2")
    two = _spots(leaders, rare)
    two = two.select("bucket", "word", *[F.col(c).alias(c + "2") for c in ("id", "label", "size", "place", "buckets", "words")])
    met = _spots(members, rare).join(two, ["bucket", "word"])
    return met.where((F.col("label") != F.col("label2")) & fits & common & new).select(*_pairs("id", "id2"))


def near_classes(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    similarity: float = SIMILARITY, n_sketches: int = SKETCHES, shingle: int = SHINGLE,
) -> DataFrame:
    """``id_col, text_id, class_id`` for every row.

    ``text_id`` is the smallest id with the same text, ``class_id`` the smallest
    id of all near texts.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t"))
    keys = rows.select("id", F.coalesce(F.md5("t"), F.lit("")).alias("key"))
    first = keys.groupBy("key").agg(F.min("id").alias("text_id"))
    copies = stored(keys.join(first, "key").select("id", "text_id"), "copies")

    def sketch(batches):
        for whole in batches:
            for batch in parts(whole, "t", 1 << 20):
                n_words = None
                # the shortest text that a text of SHORT + 1 words can be near has windows as well
                for length, low, high in ((shingle, int((SHORT + 1) * similarity), None), (1, 1, SHORT)):
                    if high is not None:
                        batch = batch.filter(pa.array(n_words <= high))
                    n_words, found = sketches(batch["t"], n_sketches, length)
                    offsets = pa.array(np.arange(len(found) + 1) * n_sketches, pa.int32())
                    lists = pa.ListArray.from_arrays(offsets, pa.array(found.ravel(), pa.int64()))
                    yield pa.record_batch({"id": batch["id"], "size": pa.array(n_words, pa.int64()), "found": lists}).filter(pa.array(n_words >= low))

    nodes = copies.where("id = text_id").select("id").distinct()
    found = rows.where("id is not null").mapInArrow(sketch, "id bigint, size bigint, found array<bigint>").join(nodes, "id", "left_semi")
    members = stored(found.select("id", "size", F.explode("found").alias("bucket")).distinct(), "buckets")
    several = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    # most buckets hold one node
    members = stored(members.join(small_side(several, "several"), "bucket", "left_semi"), "shared")
    _, fits = _fits(similarity)
    lead = members.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("bucket", "id").alias("draw"), "id", "size")).alias("lead"))
    lead = lead.select("bucket", F.col("lead.id").alias("id2"), F.col("lead.size").alias("size2"))
    pairs = members.join(lead, "bucket").where((F.col("id") != F.col("id2")) & fits).select(*_pairs("id", "id2")).distinct()
    docs = rows.where("id is not null and t is not null")
    tried = stored(pairs, "pairs")
    links = stored(linked(tried, docs, similarity), "links")
    labels = components(links)
    share = F.shiftrightunsigned(F.xxhash64(F.lit("lead"), "bucket", "id"), 11) / F.lit(float(1 << 53))
    drawn = LEADERS
    open_ = stored(_open(members, labels), "open")
    # all that follows stays among the nodes that are open now
    docs = stored(docs.join(small_side(open_.select("id").distinct(), "ids"), "id", "left_semi"), "open-texts")
    rare = _rare_words(docs, similarity)
    while open_.limit(1).count():
        leaders = open_.where(F.col("out") & (share * F.col("n_out") < drawn))
        pairs = _met(open_, leaders, rare, similarity).distinct()
        pairs = stored(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = tried.union(pairs)
        more = stored(linked(pairs, docs, similarity), "links")
        # a bucket all of whose members outside the largest component have led is done
        members = open_.where(F.col("n_out") > drawn).select("id", "size", "bucket")
        if more.limit(1).count():
            links = links.union(more)
            labels = components(links)
        open_ = stored(_open(members, labels), "open")
        drawn *= MORE
    named = copies.join(labels.withColumnRenamed("id", "text_id"), "text_id", "left")
    return named.select(F.col("id").alias(id_col), "text_id", F.coalesce("label", "text_id").alias("class_id"))


@query("op9_near_dedup")
def op9_near_dedup(spark, sf_dir) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))
