"""Main text of web pages, with the templates of their sites removed.

A page is read once into blocks of text, each with the fingerprints of the
element subtrees around it. Spark counts per host in how many different pages a
subtree occurs; blocks inside subtrees that recur across many pages of their
host are dropped. Pages whose own article is the same count once, so copies of
a page are not taken for a template; and inside an article only containers, not
paragraphs, headings or list items, can be template parts, so a sentence that
many articles share stays.

Elements that are no main text by their tag, role or class (navigation, asides,
forms, notices, adverts, comments ...) go whatever their count. The article is
the largest ``article`` element, else ``main``, else a container named like
one, else the body.

Cases: null or empty html gives an empty text; ids, urls and rows may repeat or
be null (a null url is a host of its own); an empty table gives an empty table.
The result has its own columns.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import query, stored, table

# a subtree is template once it occurs in so many different pages of its host, and in this share of them
MIN_PAGES = 10
MIN_SHARE = 0.02

# fixed values: elements of the HTML standard by role
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes".split())
_NO_TEXT = frozenset(
    "script style textarea title xmp noscript iframe noembed noframes head template svg math canvas object audio video map "
    "nav footer aside form button select option optgroup datalist input label fieldset dialog menu".split()
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
# elements that don't end the block of text they stand in
_UNBROKEN = _INLINE | {"script", "style", "noscript", "template"}
_FLOW = _INLINE | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th tr tbody thead tfoot figcaption caption hr html body main article".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
# an opening tag ends an open element of these, up to a barrier
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
_P_BARRIER = frozenset("table td th caption button html object template".split())
# fixed values: names of classes, ids and roles that mark what is no main text, and what is
_ASIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|side-?bar\w*|comments?|commentlist|replies|respond|disqus\w*|"
    r"notices?|cookies?|consent|gdpr|newsletter|subscri\w+|share|sharing|social|related|recommended|breadcrumbs?|menus?|"
    r"nav|navbar|navigation|footer|header|masthead|popup|modal|overlay|pagination|pager|toolbar|widgets?|"
    r"search|complementary|contentinfo|alert|skip-?link|login|signup|hidden|copyright)(?:$|[\s_-])",
    re.I,
)
_COMMENT_NAMES = re.compile(r"(?:^|[\s_-])comments?(?:$|[\s_-])", re.I)
_MAIN_MARKS = re.compile(r"(?:^|\s)(?:main|articleBody)(?:$|\s)")
_MAIN_NAMES = re.compile(r"(?:^|[\s_-])(?:article(?:-?body)?|main(?:-?content)?|content|post(?:-?(?:body|content))?|entry(?:-?content)?|story(?:-?body)?)(?:$|[\s_-])", re.I)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_MARK = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_SPACE = re.compile(r"\s+")


class _Node:
    __slots__ = ("tag", "names", "gone", "parent", "chars", "hash", "inside", "own", "header")

    def __init__(self, tag, names, gone, parent):
        self.tag, self.names, self.gone, self.parent = tag, names, gone, parent
        self.chars, self.hash, self.inside, self.own = 0, [tag, names], False, False
        self.header = tag == "header" or parent is not None and parent.header


def _fingerprint(parts: list) -> int:
    # the same in every process, unlike hash() of strings
    return xxhash.xxh64_intdigest("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass")) - (1 << 63)


class _Page:
    """Elements of a page, parents first, and its blocks of text with the element around each."""

    def __init__(self, source: str) -> None:
        self.source = source
        self.root = self.node = _Node("", "", False, None)
        self.nodes, self.blocks = [self.root], []
        self.current: list[str] = []
        self.holder = None
        self.open: dict[str, int] = {}
        self._read()
        for x in reversed(self.nodes[1:]):
            x.parent.chars += x.chars
        self.main = self._main()
        around, up = set(), self.main
        while up is not None:
            around.add(id(up))
            up = up.parent
        for x in self.nodes:
            x.inside = x is self.main or x.parent is not None and x.parent.inside
            x.own = x.tag not in _FLOW if x.inside and x is not self.main else id(x) not in around

    def _flush(self) -> None:
        if self.current:
            text = _SPACE.sub(" ", entities.unescape("".join(self.current))).strip()
            if text:
                self.blocks.append((text, self.holder))
                self.holder.chars += len(text)
            self.current = []
        self.holder = None

    def _close(self, to) -> None:
        while self.node is not to:
            done = self.node
            self.node = done.parent
            self.open[done.tag] -= 1
            if done.tag not in _UNBROKEN:
                self._flush()
            done.hash = _fingerprint(done.hash)
            self.node.hash.append(done.hash)

    def _text(self, piece: str) -> None:
        if not piece:
            return
        if piece.strip():
            self.node.hash.append(_SPACE.sub(" ", piece).strip())
        if not self.node.gone:
            if self.holder is None:
                self.holder = self.node
                while self.holder.tag in _INLINE:
                    self.holder = self.holder.parent
            self.current.append(piece)

    def _open_one(self, tags, barrier):
        """The innermost open element of ``tags`` inside the barrier."""
        if not any(self.open.get(t) for t in tags):
            return None
        up = self.node
        while up is not None and up.tag not in barrier:
            if up.tag in tags:
                return up
            up = up.parent
        return None

    def _read(self) -> None:
        raw, at, n = self.source, 0, len(self.source)
        while at < n:
            m = _TOKEN.search(raw, at)
            if m is None:
                self._text(raw[at:])
                break
            self._text(raw[at : m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag not in _UNBROKEN:
                    self._flush()
                if self.open.get(tag):
                    up = self.node
                    while up.tag != tag:
                        up = up.parent
                    self._close(up.parent)
                continue
            if tag in _CLOSES_P and (up := self._open_one(("p",), _P_BARRIER)) is not None:
                self._close(up.parent)
            if tag in _SIBLINGS:
                while (up := self._open_one(*_SIBLINGS[tag])) is not None:
                    self._close(up.parent)
            if tag == "br":
                if self.current:
                    self.current.append(" ")
            elif tag not in _UNBROKEN:
                self._flush()
            if tag not in _VOID:
                at = self._enter(tag, m[3], at)
        self._close(self.root)
        self._flush()

    def _enter(self, tag: str, attributes: str, at: int) -> int:
        marks = " ".join(a or b or c for a, b, c in _MARK.findall(attributes)) if attributes else ""
        gone = self.node.gone or tag in _NO_TEXT
        if not gone and attributes:
            if tag == "article":
                gone = bool(_COMMENT_NAMES.search(marks))
            elif tag not in _INLINE and tag not in ("html", "body", "main"):
                gone = bool(_ASIDE_NAMES.search(marks) or _HIDDEN.search(attributes))
        self.node = _Node(tag, marks, gone, self.node)
        self.nodes.append(self.node)
        self.open[tag] = self.open.get(tag, 0) + 1
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(self.source, at)
            self.node.hash.append(self.source[at : end.start() if end else len(self.source)])
            at = end.end() if end else len(self.source)
            self._close(self.node.parent)
        return at

    def _main(self):
        live = [x for x in self.nodes[1:] if not x.gone and x.chars]
        for fits in (
            lambda x: x.tag == "article",
            lambda x: x.tag == "main" or _MAIN_MARKS.search(x.names),
            lambda x: x.tag in ("div", "section", "td") and _MAIN_NAMES.search(x.names),
        ):
            found = max((x for x in live if fits(x)), key=lambda x: x.chars, default=None)
            if found is not None:
                return found
        return self.root

    def _kept(self) -> list:
        return [(words, owner) for words, owner in self.blocks if owner.inside and (owner.tag in _HEADINGS or not owner.header)]

    def parts(self) -> tuple[list[int], list[int], list[str], list[int]]:
        """Parent and fingerprint of each subtree around main text that may be a template part (parents first), and
        its blocks with the innermost such subtree around each (-1: none)."""
        kept, around = self._kept(), {id(self.root): None}
        for x in self.nodes[1:]:
            around[id(x)] = x if x.own else around[id(x.parent)]
        used = set()
        for _, owner in kept:
            up = around[id(owner)]
            while up is not None and id(up) not in used:
                used.add(id(up))
                up = around[id(up.parent)]
        number, parents, marks = {id(None): -1}, [], []
        for x in self.nodes[1:]:
            if id(x) in used:
                number[id(x)] = len(marks)
                parents.append(number[id(around[id(x.parent)])])
                marks.append(x.hash)
        return parents, marks, [words for words, _ in kept], [number[id(around[id(owner)])] for _, owner in kept]

    def text(self, templates=frozenset()) -> list[str]:
        """Blocks of main text outside the given subtrees."""
        return _outside(self.parts(), templates) if templates else [words for words, _ in self._kept()]


def _outside(parts, templates) -> list[str]:
    """Blocks of :meth:`_Page.parts` outside the given subtrees."""
    parents, marks, blocks, places = parts
    gone: list[bool] = []
    for up, mark in zip(parents, marks, strict=True):
        gone.append(up >= 0 and gone[up] or mark in templates)
    return [words for words, place in zip(blocks, places, strict=True) if place < 0 or not gone[place]]


def page_text(source: str | None, templates=frozenset()) -> str:
    return "\n".join(_Page(source or "").text(templates))


def page_subtrees(source: str | None) -> tuple[list[int], int]:
    """Fingerprints of the subtrees that may be template parts, and one of the page's main text."""
    page = _Page(source or "")
    return list({x.hash for x in page.nodes[1:] if x.own}), _fingerprint(page.text())


_PAGE = "key bigint, host string, subtrees array<bigint>, body bigint"


def extract(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE,
) -> DataFrame:
    """``id_col, url_col, text, n_chars``."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = df.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
        host.alias("host"), F.xxhash64(host, F.col(html_col)).alias("key"),
    )

    def subtrees(batches):
        for batch in batches:
            read = [page_subtrees(x) for x in batch["html"].to_pylist()]
            yield pa.record_batch(
                {"key": batch["key"], "host": batch["host"], "subtrees": pa.array([r[0] for r in read], pa.list_(pa.int64())), "body": pa.array([r[1] for r in read], pa.int64())}
            )

    pages = stored(rows.select("key", "host", "html").mapInArrow(subtrees, _PAGE), "subtrees")
    # one row for each different page and subtree; equal articles of a host are one page
    seen = pages.select("key", "host", "body", F.explode("subtrees").alias("subtree")).distinct()
    counts = seen.select("host", "subtree", "body").distinct().groupBy("host", "subtree").agg(F.count("*").alias("n"))
    sizes = pages.select("host", "body").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    many = (
        counts.where(F.col("n") >= min_pages).join(sizes, "host")
        .where(F.col("n") >= F.col("pages") * min_share).select("host", "subtree")
    )
    found = seen.select("key", "host", "subtree").distinct().join(many, ["host", "subtree"])
    templates = found.groupBy("key").agg(F.collect_set("subtree").alias("templates"))

    # only the main text and the subtrees around it cross the network, to meet their templates: compressed
    def squeeze(batches):
        for batch in batches:
            packed = [zlib.compress(json.dumps(_Page(x or "").parts(), separators=(",", ":")).encode()) for x in batch["html"].to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("html"), "html", pa.array(packed, pa.binary())).rename_columns(["key", "id", "url", "parts"])

    def cut(batches):
        for batch in batches:
            pairs = zip(batch["parts"].to_pylist(), batch["templates"].to_pylist(), strict=True)
            texts = ["\n".join(_outside(json.loads(zlib.decompress(x)), frozenset(gone or ()))) for x, gone in pairs]
            yield pa.record_batch({"id": batch["id"], "url": batch["url"], "text": pa.array(texts, pa.string())})

    kind = rows.schema["id"].dataType.simpleString()
    packed = rows.select("key", "id", "url", "html").mapInArrow(squeeze, f"key bigint, id {kind}, url string, parts binary")
    joined = packed.join(templates, "key", "left")
    text = joined.select("id", "url", "parts", "templates").mapInArrow(cut, f"id {kind}, url string, text string")
    return text.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("bigint").alias("n_chars")
    )


@query("op10_html_text")
def op10_html_text(spark, sf_dir) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
