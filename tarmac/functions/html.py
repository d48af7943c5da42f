"""HTML anchor extraction and URL resolution as column expressions.

Pages are processed whole. One pattern cuts a page into its anchors, each from
its ``<a`` start tag to where its text ends; they become rows, and all that
follows works on one anchor at a time. An anchor's text is the tag-separated
pieces, entity-decoded, stripped and joined by one space; relative links are resolved against the
page URL with RFC 3986 dot-segment removal done by ``aggregate``. No Python
runs per row.
"""

from __future__ import annotations

import json
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.functions.text import WHITESPACE

# Blocks whose content is not markup (comments, scripts and
# style sheets). One that never ends takes the rest of the page.
NON_MARKUP = (r"(?is)<!--.*?(?:-->|$(?!\n))|<script\b.*?(?:</script\s*>|$(?!\n))"
              r"|<style\b.*?(?:</style\s*>|$(?!\n))")
# The attributes of a start tag: anything but ``>``, which may
# stand inside quotes. Possessive, so no text makes it slow or deep.
_INSIDE = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_START = rf"<a(?=[\s/>]){_INSIDE}>"
TAG = rf"(?s)</?[a-zA-Z!?]{_INSIDE}>|<!?>"
# Where an anchor's text ends: its end tag, or else the end of
# an element around it.
_END = (r"</(?:a|p|li|ul|ol|dl|dd|dt|td|th|tr|table|div|section|article|nav|header|footer|main"
        r"|aside|h[1-6]|form|body|html)\s*>")
# An anchor: its start tag and what follows up to its end or the next anchor.
ANCHOR = rf"(?is){_START}(?:[^<]++|<(?!{_START[1:]}|{_END[1:]}))*+"
# One attribute, its name and its value in any of three forms.
ATTRIBUTE = r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?"""

# A character reference, with or without its semicolon.
REFERENCE = r"&(#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[a-zA-Z][a-zA-Z0-9]*+;?)"
REPLACEMENT = "�"

# Marker that stands for a tag boundary inside anchor text.
_BOUNDARY = "\u0001"


def _sql(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


# The references most pages have, ``&amp;`` last.
COMMON = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\xa0"), ("&amp;", "&"))
# Any reference that is none of these.
_UNCOMMON = r"&(?!(?:lt|gt|quot|#39|nbsp|amp);)[#a-zA-Z]"

# The expressions below are written as SQL text over a column or lambda variable:
# one call to the engine builds what would take hundreds, column by column.


@cache
def _named_sql() -> str:
    """The characters of every reference's name (with its semicolon where it
    needs one), as the HTML standard has them: a constant of the plan, in short
    lists by the first two letters, since lists are searched in order."""
    lists: dict[str, dict[str, str]] = {}
    for key, text in html5.items():
        lists.setdefault(key[:2], {})[key] = text
    return f"from_json({_sql(json.dumps(lists))}, 'map<string,map<string,string>>')"


@cache
def _windows_sql() -> str:
    """Map for the numbers 128 to 159, which mean Windows-1252 characters."""
    found = {str(n): bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)}
    return f"from_json({_sql(json.dumps(found))}, 'map<string,string>')"


@cache
def _decode_reference_sql(ref: str) -> str:
    """Text of one reference (without ``&``); an unknown one stays as it is. A
    number out of range, or of no character, gives the replacement character."""
    bare = f"rtrim(';', {ref})"
    digits = f"ltrim('0', regexp_replace({bare}, '^#[xX]?', ''))"
    # More digits than any character's number has: out of range.
    code = (f"CASE WHEN length({digits}) > 9 THEN '9999999999' "
            f"WHEN lower({ref}) LIKE '#x%' THEN conv(concat('0', {digits}), 16, 10) ELSE {digits} END")
    character = (
        f"element_at(transform(array({code}), code -> CASE "
        f"WHEN NOT coalesce(try_cast(code AS bigint) BETWEEN 1 AND {0x10FFFF} "
        f"AND NOT try_cast(code AS bigint) BETWEEN {0xD800} AND {0xDFFF}, false) THEN {_sql(REPLACEMENT)} "
        f"WHEN try_cast(code AS bigint) BETWEEN 128 AND 159 THEN {_windows_sql()}[code] "
        f"ELSE decode(unhex(lpad(hex(try_cast(code AS bigint)), 8, '0')), 'UTF-32') END), 1)")

    def named(name: str) -> str:
        return f"element_at(element_at({_named_sql()}, left({name}, 2)), {name})"

    # without its semicolon only some names are known
    return (f"CASE WHEN {ref} LIKE '#%' THEN {character} ELSE coalesce({named(ref)}, "
            f"concat({named(bare)}, CASE WHEN {ref} != {bare} THEN ';' END), concat('&', {ref})) END")


def _decode_sql(s: str) -> str:
    """``s`` (a name) with its character references decoded."""
    plain = s
    for reference, text in COMMON:
        plain = f"replace({plain}, {_sql(reference)}, {_sql(text)})"
    found = f"transform(regexp_extract_all({s}, {_sql(REFERENCE)}, 1), ref -> {_decode_reference_sql('ref')})"
    rebuilt = (f"array_join(zip_with(split({s}, {_sql(REFERENCE)}, -1), concat({found}, array('')), "
               f"(p, x) -> concat(coalesce(p, ''), coalesce(x, ''))), '')")
    return (f"CASE WHEN NOT contains({s}, '&') THEN {s} WHEN NOT {s} RLIKE {_sql(_UNCOMMON)} THEN {plain} "
            f"ELSE {rebuilt} END")


def decode_entities(c: str) -> Column:
    """Decode the character references of column ``c``: ``&#233;``, ``&#xE9;``
    and every named one of the standard, with or without a semicolon. No
    reference is an error: a number out of range gives U+FFFD, an unknown name
    stays. Text without ``&`` passes untouched."""
    return F.expr(_decode_sql(_name(c)))


def _without_blocks_sql(html: str) -> str:
    """Comments, scripts and styles become a tag boundary. A page without any
    is not searched by the pattern."""
    some = f"(contains({html}, '<!--') OR {html} RLIKE {_sql('(?i)<s(?:cript|tyle)')})"
    return f"CASE WHEN {some} THEN regexp_replace({html}, {_sql(NON_MARKUP)}, '<!>') ELSE {html} END"


def _text_sql(raw: str, tag: str) -> str:
    """Visible text of an anchor: the text pieces between tags, entity-decoded,
    each stripped of white space, empty ones dropped, joined by one space."""
    def stripped(piece: str) -> str:
        return f"btrim({_decode_sql(piece)}, {_sql(WHITESPACE)})"

    pieces = f"split(regexp_replace(inner, {_sql(TAG)}, {_sql(_BOUNDARY)}), {_sql(_BOUNDARY)}, -1)"
    joined = f"array_join(filter(transform({pieces}, piece -> {stripped('piece')}), p -> p != ''), ' ')"
    return (f"element_at(transform(array(substring({raw}, length({tag}) + 1)), inner -> "
            f"CASE WHEN contains(inner, '<') THEN {joined} ELSE {stripped('inner')} END), 1)")


def _href_sql(tag: str) -> str:
    """The first ``href`` value (entity-decoded), empty text for ``href=""`` or
    a bare ``href``, null when there is none. Attributes are read from the
    start one by one, so text inside another one's quotes is none."""
    attributes = f"substring({tag}, 3, length({tag}) - 3)"
    names = f"regexp_extract_all({attributes}, {_sql(ATTRIBUTE)}, 1)"
    values = f"regexp_extract_all({attributes}, {_sql(ATTRIBUTE)}, 2)"
    at = f"nullif(array_position(transform({names}, n -> lower(n)), 'href'), 0)"
    quotes = "^[\"']|[\"']$"
    value = f"regexp_replace(element_at({values}, cast({at} AS int)), {_sql(quotes)}, '')"
    return f"element_at(transform(array({value}), value -> {_decode_sql('value')}), 1)"


def raw_anchors(html: str) -> Column:
    """Array of the anchors' source text, one for every ``<a`` start tag of
    column ``html`` in document order, closed or not. A start tag ends an anchor
    that is still open, as anchors do not nest."""
    return F.expr(f"regexp_extract_all({_without_blocks_sql(_name(html))}, {_sql(ANCHOR)}, 0)")


def start_tag(raw: str) -> Column:
    """The start tag of an anchor's source."""
    return F.expr(f"regexp_extract({_name(raw)}, {_sql(f'(?is)^{_START}')}, 0)")


def anchor_text(raw: str, tag: str) -> Column:
    """Visible text of an anchor's source and its start tag (columns)."""
    return F.expr(_text_sql(_name(raw), _name(tag)))


def anchor_href(tag: str) -> Column:
    """The ``href`` of a start tag (a column)."""
    return F.expr(_href_sql(_name(tag)))


def anchors(html: str) -> Column:
    """Array of (title, href) of :func:`raw_anchors`."""
    tag = f"regexp_extract(raw, {_sql(f'(?is)^{_START}')}, 0)"
    return F.expr(
        f"transform(regexp_extract_all({_without_blocks_sql(_name(html))}, {_sql(ANCHOR)}, 0), raw -> "
        f"element_at(transform(array({tag}), tag -> named_struct("
        f"'title', {_text_sql('raw', 'tag')}, 'href', {_href_sql('tag')})), 1))")


# ------------------------------------------------------------ URL resolution

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_NETLOC = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
_HAS_NETLOC = r"^[A-Za-z][A-Za-z0-9+.\-]*://"
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.\-]*:(?://[^/?#]*)?)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
_QUERY = r"^[^?#]*(\?[^#]*)?"
_HREF_PATH = r"^([^?#]*)"
_HREF_REST = r"^[^?#]*(.*)$"


def _without_dots_sql(segments: str) -> str:
    """Resolve ``.`` and ``..`` over an array of path segments; ``..`` at
    the top is dropped. A trailing ``.`` or ``..`` keeps a trailing slash."""
    resolved = (
        f"aggregate({segments}, cast(array() AS array<string>), (acc, seg) -> CASE "
        f"WHEN seg = '..' THEN CASE WHEN size(acc) > 0 THEN slice(acc, 1, size(acc) - 1) ELSE acc END "
        f"WHEN seg = '.' THEN acc ELSE concat(acc, array(seg)) END)")
    return (f"CASE WHEN element_at({segments}, -1) IN ('.', '..') THEN concat({resolved}, array('')) "
            f"ELSE {resolved} END")


def resolve_url(base: str, href: str) -> Column:
    """Resolve column ``href`` against the page URL in column ``base``: absolute
    links are kept, ``//host`` takes the base scheme, ``/path``, ``?query``,
    ``#fragment`` and relative paths are joined to the base."""
    base, href = _name(base), _name(href)

    def part(text: str, pattern: str) -> str:
        return f"regexp_extract({text}, {_sql(pattern)}, 1)"

    scheme, bpath = part(base, _SCHEME), part(base, _PATH)
    hpath, hrest = part(href, _HREF_PATH), part(href, _HREF_REST)
    has_netloc = f"{base} RLIKE {_sql(_HAS_NETLOC)}"
    origin = f"concat({scheme}, ':', CASE WHEN {has_netloc} THEN concat('//', {part(base, _NETLOC)}) ELSE '' END)"
    base_dir = "CASE WHEN element_at(b, -1) != '' THEN slice(b, 1, size(b) - 1) ELSE b END"
    joined = (f"concat(element_at(transform(array(split({bpath}, '/', -1)), b -> {base_dir}), 1), "
              f"split({hpath}, '/', -1))")
    squeezed = (
        f"element_at(transform(array({joined}), j -> CASE WHEN size(j) >= 2 THEN concat(slice(j, 1, 1), "
        f"filter(slice(j, 2, size(j) - 2), x -> x != ''), slice(j, size(j), 1)) ELSE j END), 1)")
    segments = f"CASE WHEN startswith({hpath}, '/') THEN split({hpath}, '/', -1) ELSE {squeezed} END"
    path = (f"element_at(transform(transform(array({segments}), s -> array_join({_without_dots_sql('s')}, '/')), "
            f"p -> CASE WHEN p = '' THEN '/' WHEN {has_netloc} AND NOT startswith(p, '/') THEN concat('/', p) "
            f"ELSE p END), 1)")
    # A root-relative link without dot segments resolves to the base's origin
    # followed by the link: one pattern in place of the general resolution.
    root_plain = (f"startswith({href}, '/') AND NOT startswith({href}, '//') AND NOT contains({href}, '/.') "
                  f"AND {has_netloc}")
    return F.expr(
        f"CASE WHEN {root_plain} THEN concat({part(base, _ORIGIN)}, {href}) "
        f"WHEN {href} RLIKE {_sql(_SCHEME)} THEN {href} WHEN {href} = '' THEN {base} "
        f"WHEN startswith({href}, '//') THEN concat({scheme}, ':', {href}) "
        f"WHEN startswith({href}, '#') THEN concat({part(base, r'^([^#]*)')}, {href}) "
        f"WHEN {hpath} = '' THEN concat({origin}, {bpath}, CASE WHEN startswith({hrest}, '#') "
        f"THEN concat({part(base, _QUERY)}, {hrest}) ELSE {hrest} END) "
        f"ELSE concat({origin}, {path}, {hrest}) END")
