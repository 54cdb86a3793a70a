"""Records, text and links out of HTML strings, as native expressions.

The functions take and return SQL text (a column name is the simplest one), to
be wrapped in ``F.expr`` at the end: nested extractions then cost one call to
the JVM instead of hundreds. Elements are matched up to their first closing tag,
so a selected element must not contain another of the same name before the
fields that are read from it. Remove scripts first (:func:`without_scripts`).
"""

from __future__ import annotations

import itertools
from html.entities import html5, name2codepoint

from shelfmark.functions.text import WHITESPACE

_ENTITY_RE = "&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
_SCHEME_RE = "^[A-Za-z][A-Za-z0-9+.-]*:"
_ORIGIN_RE = "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
_fresh = itertools.count()


def quoted(text: str) -> str:
    """A text as an SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(value: str, body) -> str:
    """``body(name)`` with ``value`` computed once, however often ``body`` uses the name."""
    name = f"v{next(_fresh)}"
    return f"transform(array({value}), {name} -> {body(name)})[0]"


def strip(x: str) -> str:
    return f"btrim({x}, {quoted(WHITESPACE)})"


def or_text(x: str, default: str) -> str:
    return f"coalesce({x}, {quoted(default)})"


def open_tag(tag: str, css_class: str | None = None) -> str:
    """Regular expression of a start tag, optionally carrying ``css_class``."""
    if css_class is None:
        return rf"<{tag}(?=[\s/>])[^>]*>"
    attr = rf"""\bclass\s*=\s*["'](?:[^"']*\s)?{css_class}(?:\s[^"']*)?["']"""
    return rf"<{tag}\s[^>]*?{attr}[^>]*>"


def element(tag: str, css_class: str | None = None) -> str:
    """Regular expression of an element; group 1 is its inner markup."""
    body = rf"(?:[^<]++|<(?!/{tag}\s*>))*+"
    return rf"(?is){open_tag(tag, css_class)}({body})</{tag}\s*>"


def without_scripts(html: str) -> str:
    # one leading "<" for all alternatives: most positions fail on the first character
    pattern = r"(?is)<(?:(script|style)\b[^>]*>.*?</\1\s*>|!--.*?-->)"
    return f"regexp_replace({html}, {quoted(pattern)}, '')"


def blocks(html: str, tag: str, css_class: str | None = None) -> str:
    """Inner markup of every matching element, in document order."""
    return f"regexp_extract_all({html}, {quoted(element(tag, css_class))}, 1)"


def _fresh_name(stem: str) -> str:
    return f"{stem}{next(_fresh)}"


def balanced_blocks(html: str, tag: str, css_class: str | None = None) -> str:
    """Inner markup of every matching element up to its own end tag, in document order.

    Start and end tags named ``tag`` are marked and the markup is split at
    them. Each piece adds +1 (a start tag), -1 (an end tag) or 0 (anything
    else, a self-closing tag included) to a running depth; an element ends at
    the first end tag after it where the depth comes back to what it was
    before the element. Elements of the same name inside are therefore kept
    whole, and each of them is a block of its own when it matches. An element
    whose end tag is missing gives no block.
    """
    mark = quoted(rf"(?i)(</?{tag}(?:[\s/][^>]*)?>)")
    pieces = f"split(regexp_replace({html}, {mark}, concat(chr(1), '$1', chr(1))), chr(1))"
    start = quoted(rf"(?is)^{open_tag(tag, css_class)}$")

    def kind(x: str) -> str:
        return f"case when {x} like '</%' then -1 when {x} rlike {quoted(rf'(?is)^<{tag}(?:[\s/][^>]*)?>$')} and {x} not like '%/>' then 1 else 0 end"

    def body(p: str) -> str:
        x, k, i, j, a, y, e = (_fresh_name(n) for n in "xkijaye")

        def with_kinds(ks: str) -> str:
            def with_depths(ds: str) -> str:
                end = f"get(filter(sequence({i} + 1, size({p})), {j} -> {j} > {i} and {j} < size({p}) and get({ks}, {j}) = -1 and get({ds}, {j}) = get({ds}, {i}) - 1), 0)"
                opens = f"filter(sequence(0, size({p}) - 1), {i} -> get({ks}, {i}) = 1 and get({p}, {i}) rlike {start})"
                found = f"transform({opens}, {i} -> {let(end, lambda en: f'if({en} is null, null, array_join(slice({p}, {i} + 2, {en} - {i} - 1), {quoted("")}))')})"
                return f"filter({found}, {e} -> {e} is not null)"

            depths = f"transform({ks}, ({k}, {i}) -> aggregate(slice({ks}, 1, {i} + 1), 0, ({a}, {y}) -> {a} + {y}))"
            return let(depths, with_depths)

        return let(f"transform({p}, {x} -> {kind(x)})", with_kinds)

    return let(pieces, body)


def inner(html: str, tag: str, css_class: str | None = None) -> str:
    """Inner markup of the first matching element; NULL when there is none."""
    return f"get({blocks(html, tag, css_class)}, 0)"


def attribute(html: str, tag: str, name: str, css_class: str | None = None) -> str:
    """Attribute of the first matching start tag; NULL when absent or empty."""
    start = f"regexp_extract({html}, {quoted('(?is)' + open_tag(tag, css_class))}, 0)"
    pattern = quoted(rf"""(?is)\s{name}\s*=\s*(["'])(.*?)\1""")
    return f"nullif({decode_entities(f'regexp_extract({start}, {pattern}, 2)')}, '')"


_HTML4 = {n: chr(code) for n, code in name2codepoint.items() if html5.get(f"{n};") == chr(code)}


def _entity_map() -> str:
    """Character names of HTML 4 by first letter: a literal map is searched entry by entry."""
    shelves: dict[str, list[str]] = {}
    for name, text in sorted(_HTML4.items()):
        shelves.setdefault(name[0], []).append(f"{quoted(name)}, {quoted(text)}")
    return "map(" + ", ".join(f"'{k}', map({', '.join(v)})" for k, v in shelves.items()) + ")"


# The other named references, rare in pages, as one text "\x01name\x02text" after
# another: slower to search than a map, but a long text costs nothing to plan.
_RARE = (
    "".join(
        f"\x01{name[:-1]}\x02{text}"
        for name, text in html5.items()
        if name.endswith(";") and name[:-1] not in _HTML4
    )
    + "\x01"
)


def _rare_reference(ref: str) -> str:
    after = f"substring_index({quoted(_RARE)}, concat('\x01', {ref}, '\x02'), -1)"
    # the text itself starts with a separator, so an unknown name leaves nothing
    return f"nullif(substring_index({after}, '\x01', 1), '')"


# fixed values: the references nearly every page is made of
_COMMON_ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "nbsp": "\xa0"}


def _reference(ref: str) -> str:
    """The text a character reference stands for; an unknown one stays as written."""
    common = " ".join(f"when '{n}' then {quoted(t)}" for n, t in _COMMON_ENTITIES.items())
    digits = f"try_cast(regexp_extract({ref}, '^#([0-9]{{1,7}})$', 1) as bigint)"
    hexa = f"conv(regexp_extract({ref}, '^#[xX]([0-9a-fA-F]{{1,6}})$', 1), 16, 10)"
    numeric = let(
        f"coalesce({digits}, try_cast({hexa} as bigint))",
        lambda n: f"case when {n} > 0 and {n} <= 1114111 and not {n} between 55296 and 57343 "
        f"then decode(unhex(lpad(hex({n}), 8, '0')), 'UTF-32') end",
    )
    named = (
        f"coalesce(try_element_at(try_element_at({_ENTITIES}, left({ref}, 1)), {ref}), "
        f"{_rare_reference(ref)})"
    )
    return (
        f"case {ref} {common} else coalesce(case when startswith({ref}, '#') then {numeric} "
        f"else {named} end, concat('&', {ref}, ';')) end"
    )


_ENTITIES = _entity_map()
_REFERENCE = _reference("ref")


def decode_entities(text: str) -> str:
    """Replace named and numeric character references in one pass."""

    def decoded(t: str) -> str:
        pattern = quoted(_ENTITY_RE)
        refs = f"transform(regexp_extract_all({t}, {pattern}, 1), ref -> {_REFERENCE})"
        joined = f"zip_with(split({t}, {pattern}, -1), {refs}, (p, r) -> concat(p, coalesce(r, '')))"
        return f"case when contains({t}, '&') then array_join({joined}, '') else {t} end"

    return let(text, decoded)


def plain_text(part: str) -> str:
    """Text nodes of script-free markup: tags removed, entities decoded."""
    return decode_entities(f"regexp_replace({part}, '<[^>]*>', '')")


def text_content(html: str) -> str:
    """Text nodes of a whole page; scripts, styles and comments do not count as text."""
    return plain_text(without_scripts(html))


# ---------------------------------------------------------------- links


def _resolve_dots(path: str) -> str:
    """``.`` and ``..`` steps worked off, never above the root."""
    # a path ends in a slash when its last segment is a dot segment
    ending = f"case when {path} rlike {quoted(r'(^|/)[.]{1,2}$')} then concat({path}, '/') else {path} end"
    step = (
        "(acc, seg) -> case when seg = '..' then slice(acc, 1, greatest(size(acc) - 1, 1)) "
        "when seg = '.' then acc else concat(acc, array(seg)) end"
    )
    # the first segment is the empty string before the leading slash and stays
    kept = let(
        f"split({ending}, '/', -1)",
        lambda segs: f"aggregate(slice({segs}, 2, size({segs})), array(''), {step})",
    )
    return f"array_join({kept}, '/')"


def join_url(base: str, href: str) -> str:
    """Resolve ``href`` against the page address ``base``."""
    return let(base, lambda b: let(href, lambda h: _joined(b, h)))


def _joined(base: str, href: str) -> str:
    path_re = quoted("^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)")
    folder = f"regexp_replace(regexp_extract({base}, {path_re}, 1), '[^/]*$', '')"
    path = f"regexp_extract({href}, '^[^?#]*', 0)"
    full = let(
        path,
        lambda p: f"case when startswith({p}, '/') then {p} "
        f"else concat(coalesce(nullif({folder}, ''), '/'), {p}) end",
    )
    tail = f"substr({href}, length({path}) + 1)"
    return (
        f"case when {href} is null then null when {href} rlike {quoted(_SCHEME_RE)} then {href} "
        f"when startswith({href}, '//') then concat(regexp_extract({base}, '^([^:]+:)', 1), {href}) "
        f"when {href} = '' then {base} "
        f"when startswith({href}, '#') then concat(regexp_replace({base}, '#.*$', ''), {href}) "
        f"when startswith({href}, '?') then concat(regexp_replace({base}, '[?#].*$', ''), {href}) "
        f"else concat(regexp_extract({base}, {quoted(_ORIGIN_RE)}, 1), "
        f"{let(full, _resolve_dots)}, {tail}) end"
    )


def rooted_url(root: str, href: str) -> str:
    """Drop ``../`` steps and prefix the site root; an absolute address is kept."""
    prefix = quoted(root.rstrip("/") + "/")
    return let(
        href,
        lambda h: f"case when startswith({h}, 'http') then {h} "
        f"else concat({prefix}, replace({h}, '../', '')) end",
    )


def sibling_url(page_url: str, href: str) -> str:
    """``href`` put beside the current page, without resolving dot segments."""
    return f"concat(regexp_replace({page_url}, '/[^/]*$', ''), '/', {href})"


def menu_slug(name: str, href: str) -> str:
    """Second last path segment, else the slug of the link text."""
    return (
        f"case when contains({href}, '/') then try_element_at(split({href}, '/', -1), -2) "
        f"else replace(lower({strip(name)}), ' ', '-') end"
    )
