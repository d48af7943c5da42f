"""Main text of web pages by equivalence-class template deduction.

A page is read into tokens: an element by its path of tags, a block of text by
its path and words. The pages of one host come from one template, so:

1. *Occurrence vectors.* A token's vector has its number of occurrences on each
   page of the host. It is never built: each page adds a hash of (page, number)
   to a sum, so equal sums (with equal numbers of pages) are equal vectors, and
   a host of any size is one aggregate.
2. *Equivalence classes.* Tokens of one host with one vector form a class. The
   root class has the root's vector: its tokens occur once on every page. A
   class is valid if it covers at least ``SUPPORT`` of the host's pages, has
   several tokens (or elements that every page has equally often), and nests:
   the parent of each of its tokens is in a valid class. A text whose vector no
   other token shares is a passage that pages repeat, not template.
3. *Template.* Valid classes nest into the root class by their paths; their
   text tokens are constants. Like containers side by side are told apart by
   their order, so a host needs neither names nor classes on its elements.
4. *Slots.* What is left of a page are the slots between template tokens. The
   main slot is the article (or main) element of a valid class, if it has most
   of the host's own running text; else the smallest element around all of its
   slots and the headings and paragraphs beside them. Its blocks, without the
   template's constants and without elements that are never an article, are the
   page's text. Where no article or main element marks it, running text outside
   the slot that is no constant stays as well.

Names decide only what the template leaves open. Elements that are never an
article (menus, buttons, scripts and the like) are left out; so are forms and
elements named as menu, notice, comments and so on, unless one wraps the page's
article or most of its text. Inside an article only a class that is such a name
itself counts, an article's own header is part of it, and hidden elements are
text like any other.

A lone page of a host, or a page without its host's main element, has no
template to speak of: there the page's own article or main element counts, else
its body without links other than linked headings and paragraphs.

Defined results: null or empty html, and a page without text, give the empty
string; a null url is a host of its own; repeated rows get equal texts, and
page_id need not be distinct; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import text_of, written

#: Share of a host's pages that a template token is on, and of a host's text in its main slot.
SUPPORT = 0.9
MAIN_SHARE = 0.5
MIN_PAGES = 2

#: Containers of one label side by side that are told apart; later ones are alike.
TWINS = 8

#: Places that the pages of one host are dealt over.
SALTS = 32

# Element names of the HTML standard, by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q "
                   "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
NEVER = frozenset("script style noscript template head title nav header footer aside button select "
                  "option textarea input label fieldset iframe object svg canvas dialog menu".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 "
                     "header hr main nav ol pre section table ul".split())
TEXTUAL = frozenset("h1 h2 h3 h4 h5 h6 p ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th "
                    "caption figure figcaption details summary".split())
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p blockquote".split())
SCOPE = frozenset("table ul ol dl div section article aside nav header footer form main body html".split())

# Names in class, id and role attributes of what is not an article. A
# name counts as a whole, or by its first or last part.
_WHOLE = re.compile(
    r"(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|sidebar|side-?bar|menu|nav|navbar|navigation|"
    r"breadcrumbs?|header|masthead|footer|cookies?|consent|notices?|alert|popup|modal|overlay|newsletter|"
    r"subscribe|subscription|share|sharing|social|related|recommended|comments?|replies|reply|disqus|"
    r"widget|pagination|pager|search|login|signup|toolbar|skip)")
_FIRST = re.compile(
    r"(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|sidebar|menu|nav|navbar|navigation|breadcrumbs?|footer|"
    r"cookies?|consent|popup|modal|newsletter|subscribe|subscription|share|sharing|social|related|recommended|"
    r"comments?|disqus|pagination|pager|toolbar)")
_LAST = re.compile(_FIRST.pattern[:-1] + r"|masthead|notices?|alert|overlay|replies)")
_PAIR = re.compile(r"(?:site|top|global|main)[_-]header|widget[_-]area|skip[_-](?:link|links|to[_-]\w+)|reply[_-]\w+|"
                   r"(?:search|login|signup)[_-](?:form|box|bar|field|panel|widget)|"
                   r"comments?[_-](?:list|area|section|form|thread|wrapper|box|body|reply)")
#: Words that say how a page is laid out, not what an element is.
_LAYOUT = frozenset("has with no without not".split())
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_MARKUP = re.compile(r"<!--|<!|<\?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                     r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>")

_ROOT = 0x9E3779B9

#: Roles of elements: what a slot is made of, and what marks one.
CONTAINER, TEXT, SECTION, ARTICLE, MAIN = range(5)


def _role(name: str) -> int:
    return {"section": SECTION, "article": ARTICLE, "main": MAIN}.get(name, TEXT if name in TEXTUAL else CONTAINER)


@lru_cache(4096)
def _names_no_article(names: str) -> bool:
    """Whether a class, id or role names an element that is not an article."""
    for name in names.lower().split():
        parts = [x for x in re.split(r"[_-]+", name) if x]
        if not parts or _LAYOUT.intersection(parts):
            continue
        if (_WHOLE.fullmatch(name) or _PAIR.fullmatch(name)
                or len(parts) > 1 and (_FIRST.fullmatch(parts[0]) or _LAST.fullmatch(parts[-1]))):
            return True
    return False


@lru_cache(4096)
def _class_in_article(name: str) -> bool:
    parts = [x for x in re.split(r"[_-]+", name) if x]
    return bool(parts) and not _LAYOUT.intersection(parts) and bool(
        _WHOLE.fullmatch(name) or _PAIR.fullmatch(name) or len(parts) > 1 and _LAST.fullmatch(parts[-1]))


def _named_inside(name: str, found: list[tuple[str, str]]) -> bool:
    """Whether an element inside an article is named as none of its text. There
    a class or role must be such a name itself or end in one; an id, a section's
    name or a first part (related-work, ad-hoc) says what the text is about."""
    return name != "section" and any(
        kind != "id" and any(_class_in_article(x) for x in value.lower().split()) for kind, value in found)


def _digest(text: str, seed: int) -> int:
    """A signed 64-bit hash."""
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed & (2**64 - 1))
    return value - (1 << 64) if value >> 63 else value


class _Node:
    """A block element of a page. Nodes know their parent, not their whole path,
    so a page takes memory in proportion to its tags however deep they nest."""

    __slots__ = ("name", "path", "parent", "soft", "own", "article", "heading", "size", "marks", "headings", "flag")

    def __init__(self, name: str, path: int, parent: "_Node | None", soft: bool = False, own: bool = False):
        self.name, self.path, self.parent = name, path, parent
        self.soft = soft  # named as no article, or a form: left out unless it wraps the article
        self.own = own or (parent is not None and parent.own)  # in an article that is itself named so
        self.article = name in ("article", "main") or (parent is not None and parent.article)
        self.heading = name == "h1" or (parent is not None and parent.heading)
        self.size = self.marks = self.headings = 0
        self.flag = False


class _Open:
    """An open element: its node (that around it, for an inline one)."""

    __slots__ = ("name", "node", "never", "link")

    def __init__(self, name: str, node: _Node, never: bool, link: bool):
        self.name, self.node, self.never, self.link = name, node, never, link


class BlockOfText:
    """One block: its text, its place, its own token, and whether it lies in an
    element that is never an article, or mostly in links."""

    __slots__ = ("text", "node", "token", "never", "linked")

    def __init__(self, text: str, node: _Node, never: bool, linked: bool):
        self.text, self.node, self.never, self.linked = text, node, never, linked
        self.token = _digest(text, node.path)

    @property
    def chain(self) -> tuple:
        """Tokens of the elements around the block, outermost first."""
        out, node = [], self.node
        while node.parent is not None:
            out.append(node.path)
            node = node.parent
        return tuple(reversed(out))


class Page:
    """Blocks and elements of one page, read in a single pass. Broken markup is
    read as browsers do: unknown end tags are ignored, open ones end late."""

    def __init__(self, source: str):
        self.blocks: list[BlockOfText] = []
        self.elements: list[tuple[int, int, int]] = []  # (token, token of the parent, role)
        self.nodes = [_Node("", _ROOT, None)]  # parents come before their children
        self._paths: dict[tuple[int, str], int] = {}
        self._stack = [_Open("", self.nodes[0], False, False)]
        self._names: Counter = Counter()  # open elements by name
        self._twins: Counter = Counter()  # containers of one label by the node around them
        self._text: list[str] = []
        self._letters = self._linked = 0
        self._read(source)
        self._flush()
        self._exclude_named()

    def _read(self, source: str) -> None:
        at, n = 0, len(source)
        last = source.rfind(">")  # behind it no tag ends
        while at < n:
            found = _MARKUP.search(source, at, last + 1) if at <= last else None
            if not found:
                # what opens a comment there has no end either
                stop = source.find("<!--", max(at, last + 1))
                self._add(source[at:stop] if stop >= 0 else source[at:])
                return
            if found.start() > at:
                self._add(source[at:found.start()])
            mark = found.group()
            if mark in ("<!--", "<!", "<?"):
                stop = source.find("-->" if mark == "<!--" else ">", found.end())
                at = n if stop < 0 else stop + (3 if mark == "<!--" else 1)
                continue
            at = found.end()
            slash, name, rest = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
            name = name.lower()
            if slash:
                self._close(name)
                continue
            self._open(name, rest)
            if name in RAW and not rest.endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                at = stop.end() if stop else n
                self._close(name)

    def _add(self, text: str) -> None:
        self._text.append(text)
        size = len(text)
        self._letters += size
        if self._stack[-1].link:
            self._linked += size

    def _flush(self) -> None:
        if not self._text:
            return
        text = " ".join(entities.unescape("".join(self._text)).split())
        letters, linked = self._letters, self._linked
        self._text, self._letters, self._linked = [], 0, 0
        if text:
            top = self._stack[-1]
            self.blocks.append(BlockOfText(text, top.node, top.never, 2 * linked > letters))

    def _open(self, name: str, rest: str) -> None:
        inline = name in INLINE
        if not inline:
            self._flush()
            ends = CLOSES.get(name, ()) or ({"p"} if name in CLOSES_P else ())
            if ends:
                self._end_implied(ends)
        elif name == "br":
            self._text.append(" ")
        if name in VOID:
            return
        parent = self._stack[-1]
        outer = parent.node
        # An article's own header holds its title; only those of pages are left out.
        never = parent.never or (name in NEVER and not (name == "header" and outer.article))
        node = outer
        if not inline:
            label, soft = name, name == "form"
            if rest.strip():
                found = [(kind.lower(), a or b or c) for kind, a, b, c in _NAMED.findall(rest)]
                names = " ".join(value for _, value in found)
                if names:
                    label = f"{name} {re.sub(r'[0-9]+', '0', names)}"
                    if not never and name not in ("html", "body", "main"):
                        soft = soft or (_named_inside(name, found) if outer.article else _names_no_article(names))
            if _role(name) != TEXT:
                # Like containers side by side play different parts in a template.
                self._twins[id(outer), label] += 1
                label = f"{label} {min(self._twins[id(outer), label], TWINS)}"
            path = self._paths.get((outer.path, label))
            if path is None:
                path = self._paths[outer.path, label] = _digest(label, outer.path)
            self.elements.append((path, outer.path, _role(name)))
            node = _Node(name, path, outer, soft and name != "article", soft and name == "article")
            self.nodes.append(node)
        self._stack.append(_Open(name, node, never, parent.link or name == "a"))
        self._names[name] += 1

    def _cut(self, i: int) -> None:
        for e in self._stack[i:]:
            self._names[e.name] -= 1
        del self._stack[i:]

    def _end_implied(self, ends) -> None:
        if not any(self._names[x] for x in ends):
            return
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i].name in ends:
                self._cut(i)
                return
            if self._stack[i].name in SCOPE:
                return

    def _close(self, name: str) -> None:
        if self._names[name]:
            for i in range(len(self._stack) - 1, 0, -1):
                if self._stack[i].name == name:
                    if name not in INLINE:
                        self._flush()
                    self._cut(i)
                    return
                if name in INLINE and self._stack[i].name not in INLINE:
                    return  # an inline end tag does not end a block
        if name == "p":
            self._flush()

    def _exclude_named(self) -> None:
        """Blocks in forms and in elements named as no article are left out, unless
        the element wraps the page's article or most of its running text."""
        if not any(node.soft for node in self.nodes):
            return
        blocks = [b for b in self.blocks if not b.never]
        for b in blocks:
            if not b.linked:
                b.node.size += len(b.text)
                # an article that is itself named, such as a comment, is not the page's
                b.node.marks += b.node.article and not b.node.own
                b.node.headings += b.node.heading
        for node in self.nodes[1:]:
            node.flag = node.parent.flag or node.soft
        rest = sum(node.size for node in self.nodes if not node.flag)
        for node in reversed(self.nodes[1:]):
            node.parent.size += node.size
            node.parent.marks += node.marks
            node.parent.headings += node.headings
        total, articles, headings = self.nodes[0].size, self.nodes[0].marks, self.nodes[0].headings
        for node in self.nodes[1:]:
            wrapper = node.marks == articles and (
                articles and node.size > rest or 2 * node.size > total and node.headings == headings)
            node.flag = node.parent.flag or (node.soft and not wrapper)
        for b in blocks:
            b.never = b.node.flag

    def tokens(self) -> list[tuple[int, int, bool, int, int, int]]:
        """(token, parent, is_text, number, characters of running text below it,
        or of the text itself if it is no link, role)."""
        texts: Counter = Counter()
        size: Counter = Counter()
        for node in self.nodes:
            node.size = 0
        for b in self.blocks:
            if not b.never:
                texts[b.token, b.node.path] += 1
                if not b.linked:
                    size[b.token] += len(b.text)
                    b.node.size += len(b.text)
        chars: Counter = Counter()
        for node in reversed(self.nodes[1:]):
            chars[node.path] += node.size
            node.parent.size += node.size
        out = [(t, p, False, n, chars[t], role) for (t, p, role), n in Counter(self.elements).items()]
        out += [(t, p, True, n, size[t], CONTAINER) for (t, p), n in texts.items()]
        return out

    def main_text(self, main: int | None, constants: frozenset) -> list[str]:
        """Blocks of the main slot in page order."""
        blocks = [b for b in self.blocks if not b.never]
        place = None
        self.nodes[0].flag = False
        for node in self.nodes[1:]:
            node.flag = node.parent.flag or node.path == main  # in the main slot
            if place is None and node.path == main:
                place = node.name
        if place in ("article", "main"):
            return [b.text for b in blocks if b.node.flag and b.token not in constants]
        # An article whose class differs from page to page is in no class of the host.
        running = sum(len(b.text) for b in blocks if not b.linked and b.token not in constants)
        for name in ("article", "main"):
            self.nodes[0].own = False
            for node in self.nodes[1:]:
                node.own = node.parent.own or node.name == name
            inside = [b for b in blocks if b.node.own]
            own = sum(len(b.text) for b in inside if not b.linked and b.token not in constants)
            if inside and (place is None or running and own >= MAIN_SHARE * running):
                return [b.text for b in inside if place is None or b.token not in constants]
        if place is None:
            # linked titles and paragraphs are running text, other links are menus
            return [b.text for b in blocks if b.token not in constants
                    and (not b.linked or b.node.name in PROSE)]
        # links outside the slot, or in the whole page, are no article
        links = place not in ("html", "body")
        return [b.text for b in blocks if b.token not in constants
                and (not b.linked or links and b.node.flag or b.node.name in PROSE and b.node.flag)]


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/?#]*)", 1)),
                      F.lit(""))


def templates(pages: DataFrame) -> DataFrame:
    """(host, main, constants): the token of each host's main slot and the text
    tokens that are constant. ``pages``: host, key (names a page), html."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(lo, 256) for b in batches for lo in range(0, b.num_rows, 256)):
            rows: list[tuple] = []
            for host, key, source in zip(*(c.to_pylist() for c in batch.columns)):
                page = Page(source)
                rows.append((host, key, _ROOT, 0, False, 1, sum(
                    len(b.text) for b in page.blocks if not b.never and not b.linked), CONTAINER))
                rows.extend((host, key, *t) for t in page.tokens())
            cols = list(zip(*rows))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["host", "key", "token", "parent", "is_text", "n", "chars", "role"])

    tokens = pages.select("host", "key", "html").mapInArrow(
        read, "host string, key bigint, token bigint, parent bigint, is_text boolean, n int, chars bigint, role int")
    # The vector of a token, as a sum over pages; a token in one place has one parent.
    vectors = written(tokens.groupBy("host", "token").agg(
        F.min("parent").alias("parent"), F.max("is_text").alias("is_text"),
        F.count(F.lit(1)).alias("support"), F.max("n").alias("most"),
        F.min("n").alias("least"),
        F.sum(F.xxhash64("key", "n").cast("decimal(38,0)")).alias("vector"),
        F.sum("chars").alias("chars"), F.max("role").alias("role")), "template-vectors")
    hosts = vectors.filter(F.col("token") == _ROOT).select(
        "host", F.col("support").alias("pages"), F.col("chars").alias("all_chars")).filter(
        F.col("pages") >= MIN_PAGES)
    # Most tokens are a page's own text; they go before the join.
    common = vectors.filter(F.col("support") >= MIN_PAGES * SUPPORT)
    frequent = common.join(hosts, "host").filter(F.col("support") >= F.col("pages") * SUPPORT)
    # Classes: tokens of a host with one vector, a bounded number (a page's tokens).
    even = (F.col("least") == F.col("most")) & (F.col("support") == F.col("pages")) & ~F.col("is_text")
    classes = frequent.groupBy("host", "vector", "support", "most", "pages", "all_chars").agg(
        F.bool_or(even).alias("even"),
        F.collect_list(F.struct("token", "parent", "is_text", "chars", "role")).alias("tokens"))
    found = classes.groupBy("host").agg(
        F.first("all_chars").alias("all_chars"),
        F.collect_list(F.struct("support", "most", "even", "tokens")).alias("classes"))

    def deduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(host, *_template(total, found_))
                   for host, total, found_ in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int64()),
                 pa.array([o[2] for o in out], pa.list_(pa.int64()))], names=["host", "main", "constants"])

    return found.mapInArrow(deduce, "host string, main bigint, constants array<bigint>")


def _template(total: int, classes: list[dict]) -> tuple[int | None, list[int]]:
    """The main slot's token and the text tokens of one host that are cut."""
    every = {t["token"]: t for c in classes for t in c["tokens"]}
    class_of = {t["token"]: i for i, c in enumerate(classes) for t in c["tokens"]}
    most = {t["token"]: c["most"] for c in classes for t in c["tokens"]}
    root = class_of.get(_ROOT)
    # The root class: what is on every page as often as the page itself, once. It
    # and other classes of several tokens are valid if they nest: the parent of
    # each token is in a valid class. A token whose vector no other one has is no
    # evidence of a template: a passage that most pages repeat is one.
    # Elements that every page has equally often are on every page as well.
    valid = {i for i, c in enumerate(classes) if i == root or len(c["tokens"]) > 1 or c["even"]}
    changed = True
    while changed:
        broken = {i for i in valid if i != root and any(
            class_of.get(t["parent"]) not in valid for t in classes[i]["tokens"])}
        valid -= broken
        changed = bool(broken)

    places: dict[int, list[int]] = {}

    def above(token: int) -> list[int] | None:
        """Elements around a token, innermost first; None if one is in no valid class."""
        out: list[int] = []
        while token != _ROOT:
            if class_of.get(token) not in valid or len(out) > 1000:
                return None
            token = every[token]["parent"]
            out.append(token)
        return out

    for t in every:
        if t != _ROOT and (p := above(t)) is not None:
            places[t] = p
    fixed = [t for t in places if every[t]["is_text"] and most[t] == 1]
    own = {t: every[t]["chars"] for t in places if not every[t]["is_text"]}
    own[_ROOT] = total
    for t in fixed:
        for place in places[t]:
            own[place] -= every[t]["chars"]
    if own[_ROOT] <= 0:  # copies of one page: their text is the article
        own = {t: total if t == _ROOT else every[t]["chars"] for t in own}
    if own[_ROOT] <= 0:
        return None, sorted(fixed)

    def role(token: int) -> int:
        return CONTAINER if token == _ROOT else every[token]["role"]

    marked = [(role(t), len(places[t]), t) for t in own if t != _ROOT and most[t] == 1
              and role(t) in (ARTICLE, MAIN) and own[t] >= MAIN_SHARE * own[_ROOT]]
    if marked:
        main = min(marked)[2]
    else:
        below: dict[int, list[int]] = {}
        for t in own:
            if t != _ROOT and every[t]["chars"] > 0 and (own[t] > 0 or role(t) in (TEXT, SECTION)):
                below.setdefault(every[t]["parent"], []).append(t)
        main, slot = None, _ROOT
        while len(below.get(slot, ())) == 1:
            slot = below[slot][0]
            if (most[slot] > 1 or role(slot) == TEXT or own[slot] < SUPPORT * own[_ROOT]
                    or every[slot]["chars"] < MAIN_SHARE * total):
                break
            main = slot

    def of_template(token: int) -> bool:
        """Whether a constant of the main slot is no running text: a link, or at
        a place of its own that never has a page's own text."""
        if not every[token]["chars"]:
            return True
        around = iter(places[token])
        place = next(around)
        while not marked and role(place) in (TEXT, SECTION):
            place = next(around)
        return role(place) == CONTAINER and own[place] <= 0

    outside = [t for t in fixed if main not in places[t]]
    inside = [t for t in fixed if main in places[t] and of_template(t)]
    # Pages that are copies of one article have no text but constants: those
    # are the article, not the template.
    if main is not None and sum(every[t]["chars"] for t in inside) >= MAIN_SHARE * every[main]["chars"]:
        inside = []
    return main, sorted(outside + inside)


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html") -> DataFrame:
    """page_id, url and text of each page."""
    source = text_of(html_col)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        host_of(F.col(url_col)).alias("host"), source.alias("html"),
                        F.xxhash64(F.col(id_col), F.col(url_col), source).alias("key"))
    # A host may have a third of all pages: its template, one row, is sent to
    # ``SALTS`` places, and its pages are dealt over them.
    known = templates(rows).select(F.col("host").alias("h"), "main", "constants",
                                   F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    joined = rows.join(known, (F.col("host") == F.col("h")) & (F.pmod("key", F.lit(SALTS)) == F.col("s")), "left")

    @F.arrow_udf("string")
    def extracted(html: pa.Array, main: pa.Array, constants: pa.Array) -> pa.Array:
        out, sets = [], {}
        for source_, slot, fixed in zip(html.to_pylist(), main.to_pylist(), constants):
            key = tuple(fixed.as_py()) if fixed.is_valid else ()
            if key not in sets:
                sets[key] = frozenset(key)
            out.append("\n".join(Page(source_).main_text(slot, sets[key])))
        return pa.array(out, pa.string())

    return joined.select("page_id", "url",
                         extracted(F.col("html"), F.col("main"), F.col("constants")).alias("text"))
