"""Markup as data: a page becomes one array of nodes, and everything else is column expressions.

A node is an element or a text run, in document order. `size` counts the nodes below
it, so a subtree is the index range `idx .. idx + size`. Only splitting the text of a
page into nodes needs Python (one Arrow function over the body column); choosing nodes
and reading values from them stays in the JVM and never shuffles.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import suppress
from html import unescape
from itertools import islice
from typing import NamedTuple
from urllib.parse import quote, urljoin

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.session import ship_code

NODES = (
    "array<struct<idx:int,parent:int,size:int,tag:string,class:string,"
    "text:string,attrs:map<string,string>,link:string>>"
)
# Nodes of which a site has named what it looks for: `marks` says what of it they are, and tags and classes stay behind.
MARKED_NODES = "array<struct<idx:int,parent:int,size:int,marks:int,text:string,attrs:map<string,string>>>"
TEXT = "#text"
# What is kept of the reason why a page could not be split.
ERROR_CHARS = 500
# Pages are split in slices of so many bytes or pages, whatever the Arrow batches hold.
SLICE_BYTES, SLICE_PAGES = 1 << 20, 1000

# HTML elements without an end tag.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Block elements whose start ends an open paragraph.
_BLOCK = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
# Start tag -> (open elements it ends, elements the search for them stops at).
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "body": ({"head"}, set()),
} | {tag: ({"p"}, {"td", "th", "table", "body", "button"} | (_BLOCK - {"p"})) for tag in _BLOCK}
# An inline end tag does not reach past one of these.
_WALLS = _BLOCK - {"p"} | {"td", "th", "tr", "li", "body"}

_ATTR = r"""([^\s=<>"'/][^\s=<>/]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>][^\s<>]*)))?"""
_REST = r"((?:[\s/\"'=]++|%s)*+)" % re.sub(r"(?<!\\)\((?!\?)", "(?:", _ATTR)
# A comment or declaration, a script or style with its text, or any other tag.
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<((?i:script|style))(?=[\s/>]){_REST}>(.*?)(?:</(?i:\1)\s*>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/<>]*){_REST}>",
    re.DOTALL,
)
_ATTRS = re.compile(_ATTR)
# In place of a number: an end tag, and a comment or declaration.
_END, _SKIP = 0, -1
# What stands between "<" and the next ">" of a tag that surely ends there: every value is closed and parted from the next name.
_PLAIN = re.compile(
    r"""(/?)(?!(?i:script|style)(?![^\s/]))([a-zA-Z][^\s/"'=]*)"""
    r"""((?:\s+[^\s="'/]+(?:="[^"]*"|='[^']*'|=[^\s"']+)?(?=[\s/]|\Z))*+\s*/?)"""
)
_PATH_SAFE = "!#$%&'()*+,/:;=?@[]~"


# Addresses that stay as they are, wholly or behind the base's scheme and host.
_WHOLE_LINK = re.compile(r"https?://[A-Za-z0-9.-]+(?:/[A-Za-z0-9_.-]+)*/?")
_ROOTED_LINK = re.compile(r"(?:/[A-Za-z0-9_-][A-Za-z0-9_.-]*)+/?")
_ORIGIN = re.compile(r"https?://[A-Za-z0-9.-]+(?=[/?#]|\Z)")


def absolute_link(base: str, href: str) -> str | None:
    """`href` as an absolute URL with non-ASCII percent-encoded; null for schemes that are not pages."""
    if origin := _ORIGIN.match(base):
        if _WHOLE_LINK.fullmatch(href):
            return href
        if _ROOTED_LINK.fullmatch(href):
            return origin[0] + href
    try:
        link = urljoin(base, quote(href.strip(" \t\n\r\x0c"), safe=_PATH_SAFE))
    except ValueError:
        return None
    return link if link.startswith(("http://", "https://", "file://", "ftp://")) else None


class Mark(NamedTuple):
    """Elements that a site looks for: of a tag (any if None), with all the classes, and an attribute of a value (any if None)."""

    tag: str | None = None
    classes: tuple[str, ...] = ()
    attr: str | None = None
    value: str | None = None


class PageNodes:
    """The nodes of a batch of pages, gathered in order.

    A node is kept as the number of its tag as written, its parent and its size. What a tag
    says is read once and stands in tables by that number, which Arrow takes columns from.
    """

    def __init__(self, keep: frozenset[str], links: bool, marks: Sequence[Mark] = ()) -> None:
        self.keep, self.links, self.marks = keep, links, marks
        self.read = keep | {"class"} | ({"href"} if links else set()) | {mark.attr for mark in marks if mark.attr}
        # Marks with an attribute and their bits, by its name and value; what elements say to the others, by tag and class as written.
        self.by_attr: dict[str, dict[str | None, list[tuple[Mark, int]]]] = {}
        for place, mark in enumerate(marks):
            if mark.attr:
                self.by_attr.setdefault(mark.attr, {}).setdefault(mark.value, []).append((mark, 1 << place))
        self.kinds: dict[tuple[str, str | None], tuple[str | None, int]] = {}
        # Per node: its number, parent (within its page) and, once it closes, size. Number 0 is a text run.
        self.numbers: list[int] = []
        self.parents: list[int] = []
        self.sizes: list[int] = []
        self.texts: list[str] = []
        # Places and addresses of the links.
        self.link_at: list[int] = []
        self.link_to: list[str] = []
        self.pages = [0]
        # Per number: tag, class list, names and values of the attributes.
        self.tags: list[str] = [TEXT]
        self.classes: list[str | None] = [None]
        self.attrs: list[tuple[list[str], list[str]]] = [([], [])]
        self.bits: list[int] = [0]
        self.known: dict[str, tuple] = {}
        self.seen: dict[tuple[str, str], tuple] = {}

    def kind(self, tag: str, written: str | None) -> tuple[str | None, int]:
        """The class list of an element, and the bits of the marks it meets that ask for no attribute."""
        classes = (written or "").split()
        bits = sum(
            1 << place
            for place, mark in enumerate(self.marks)
            if not mark.attr and mark.tag in (None, tag) and all(c in classes for c in mark.classes)
        )
        known = self.kinds[tag, written] = (None if written is None else f" {' '.join(classes)} ", bits)
        return known

    def start(self, tag: str, attrs: str) -> tuple:
        """What a start tag does: (tag, number, what it ends, void, href that counts)."""
        known = self.seen.get((tag, attrs))
        if known is None:
            known = self.seen[tag, attrs] = self.first_start(tag, attrs)
        return known

    def first_start(self, tag: str, attrs: str) -> tuple:
        """`start` for a tag that was not written so before: it gets a number, and what it says is read."""
        found: dict[str, str] = {}  # of a repeated attribute the first counts
        if "=" in attrs:
            read = self.read
            for name, double, single, bare in _ATTRS.findall(attrs):
                if name not in read:
                    name = name.lower()
                    if name not in read:
                        continue
                if name not in found:
                    value = double or single or bare
                    found[name] = unescape(value) if "&" in value else value
        written = found.get("class")
        classes, bits = self.kinds.get((tag, written)) or self.kind(tag, written)
        names, values = [], []
        for name, value in found.items():
            if name in self.keep:
                names.append(name)
                values.append(value)
            if name in self.by_attr:
                asked = self.by_attr[name]
                for mark, bit in (*asked.get(value, ()), *asked.get(None, ())):
                    if mark.tag in (None, tag) and all(f" {c} " in (classes or "") for c in mark.classes):
                        bits |= bit
        number = len(self.tags)
        self.tags.append(tag)
        self.classes.append(classes)
        self.attrs.append((names, values))
        self.bits.append(bits)
        href = found.get("href") if self.links and tag in ("a", "area", "base") else None
        return (tag, number, _ENDS.get(tag), tag in _VOID, href)

    def page(self, body: str, base: str) -> None:
        """Split one page; elements close as browsers close them, whatever end tags are missing."""
        numbers, parents, sizes, texts = self.numbers, self.parents, self.sizes, self.texts
        does_known = self.known.get
        first = len(numbers)
        # Place (within the page) and tag of the open elements from the root down, under them the page itself.
        open_at, open_tag = [-1], [""]
        depths: dict[str, list[int]] = {}  # depths of the open elements of each tag, ascending
        based = False

        def close(depth: int) -> None:
            below = len(numbers) - first - 1
            while len(open_at) > depth:
                start = open_at.pop()
                depths[open_tag.pop()].pop()
                sizes[first + start] = below - start

        def close_up_to(tags: Iterable[str], walls: Iterable[str]) -> None:
            """Close the innermost open element of the tags, unless a wall is open inside it."""
            depth = max((found[-1] for tag in tags if (found := depths.get(tag))), default=0)
            if depth and depth >= max((found[-1] for tag in walls if (found := depths.get(tag))), default=0):
                close(depth)

        def add_text(text: str) -> None:
            numbers.append(0)
            parents.append(open_at[-1])
            sizes.append(0)
            texts.append(text)

        # Nothing after the last ">" is a tag; looking there would cost a scan for every "<".
        end = body.rfind(">") + 1
        pieces = iter(body[:end].split("<"))
        text = next(pieces)
        # Where the text before a tag began, if a "<" belongs to it; else -1, and it is `text`.
        text_from, after = -1, len(text)
        for piece in pieces:
            at = after
            after += len(piece) + 1
            written, closed, rest = piece.partition(">")
            does = does_known(written) if closed else None
            raw_text = None
            if does is None:
                does = self.plain(written) if closed else None
                if does is None:
                    found = _TOKEN.match(body, at, end)
                    if found is None:  # the "<" is text
                        if text_from < 0:
                            text_from = at - len(text)
                        continue
                    does, raw_text, token_end = self.token(found, body)
                    while after < token_end:  # in a comment, a script or a quoted value
                        piece = next(pieces, None)
                        after = len(body) if piece is None else after + len(piece) + 1
                    rest = body[token_end : min(after, end)]
            if text_from >= 0:
                text, text_from = body[text_from:at], -1
            if text:
                numbers.append(0)
                parents.append(open_at[-1])
                sizes.append(0)
                texts.append(unescape(text) if "&" in text else text)
            text = rest
            tag, number, ends, void, href = does
            if number == _END:
                if open_tag[-1] == tag:
                    del open_tag[-1]
                    depths[tag].pop()
                    start = open_at.pop()
                    sizes[first + start] = len(numbers) - first - start - 1
                else:
                    close_up_to((tag,), () if tag in _WALLS or tag == "html" else _WALLS)
                continue
            if number == _SKIP:
                continue
            if ends is not None:
                for other in ends[0]:
                    if depths.get(other):
                        close_up_to(*ends)
                        break
            if href is not None:
                if tag != "base":
                    link = absolute_link(base, href)
                    if link is not None:
                        self.link_at.append(len(numbers))
                        self.link_to.append(link)
                elif not based:
                    # The first one counts; one that is no address changes nothing.
                    based = True
                    with suppress(ValueError):
                        base = urljoin(base, href)
            place = len(numbers) - first
            numbers.append(number)
            parents.append(open_at[-1])
            sizes.append(0)
            if void:
                continue
            mine = depths.get(tag)
            if mine is None:
                depths[tag] = [len(open_at)]
            else:
                mine.append(len(open_at))
            open_at.append(place)
            open_tag.append(tag)
            if raw_text is not None:  # taken as it stands
                if raw_text:
                    add_text(raw_text)
                close(len(open_at) - 1)
                if token_end > end:
                    break
        else:
            token_end = end
        if token_end <= end:
            # What is left after the last tag, comments that are not closed aside.
            text = (body[text_from:] if text_from >= 0 else text + body[end:]).split("<!--", 1)[0]
            if text:
                add_text(unescape(text) if "&" in text else text)
        close(1)
        self.pages.append(len(numbers))

    def plain(self, written: str) -> tuple | None:
        """What a tag does that surely ends at the next ">", noted for the next one written so; null for others."""
        plain = _PLAIN.fullmatch(written)
        if plain is None:
            return None
        slash, tag, attrs = plain.groups()
        does = self.known[written] = (tag.lower(), _END, None, False, None) if slash else self.first_start(tag.lower(), attrs)
        return does

    def token(self, found: re.Match, body: str) -> tuple[tuple, str | None, int]:
        """What any token does, the text of a script or style, and where it ends."""
        raw, raw_attrs, raw_text, slash, tag, attrs = found.groups()
        if raw is not None:
            if found.end(3) == found.end():  # never closed: the rest of the page is its text
                return self.start(raw.lower(), raw_attrs), body[found.start(3) :], len(body)
            return self.start(raw.lower(), raw_attrs), raw_text, found.end()
        if tag is None:
            return ("", _SKIP, None, False, None), None, found.end()
        does = (tag.lower(), _END, None, False, None) if slash else self.start(tag.lower(), attrs)
        return does, None, found.end()

    def page_or_error(self, body: str, base: str) -> str | None:
        """Split one page; one that cannot be split has no nodes, and the reason is returned."""
        parts = (self.numbers, self.parents, self.sizes, self.texts, self.link_at, self.link_to)
        before = [len(part) for part in parts]
        try:
            self.page(body, base)
        except Exception as error:  # whatever a page does to the splitter, the others go on
            for part, length in zip(parts, before):
                del part[length:]
            self.pages.append(before[0])
            return f"{type(error).__name__}: {error}"[:ERROR_CHARS]
        return None

    def elements(self, tag: str | None, cls: str | None, first: int) -> list[tuple[int, int]]:
        """Place and size, itself included, of the elements of a tag and class (None for any) from a place on."""
        fits = [
            (name == tag if tag else name != TEXT) and (cls is None or f" {cls} " in (classes or ""))
            for name, classes in zip(self.tags, self.classes)
        ]
        return [(at, self.sizes[at] + 1) for at, number in enumerate(self.numbers[first:], first) if fits[number]]

    def array(self, only: Sequence[tuple[str, str]] | None = None) -> pa.Array:
        """The pages' nodes. With `only`, tags and classes ('' for any), such elements and links alone, numbered among themselves.

        A node whose parent is not among them has parent -1; sizes count what is left below.
        """
        ints, strings = pa.int32(), pa.string()
        numbers, starts = np.array(self.numbers, np.int32), np.array(self.pages, np.int64)
        lengths = np.diff(starts)
        count = len(numbers)
        parents, sizes = np.array(self.parents, np.int64), np.array(self.sizes, np.int64)
        # Places of text runs and links in their lists, -1 for none.
        text_of = np.where(numbers == 0, np.cumsum(numbers == 0) - 1, -1)
        link_of = np.full(count, -1)
        link_of[self.link_at] = np.arange(len(self.link_at))
        if only is not None:
            fits = [
                any(name == tag and (not cls or f" {cls} " in (classes or "")) for tag, cls in only)
                for name, classes in zip(self.tags, self.classes)
            ]
            kept = np.array(fits, bool)[numbers] | (link_of >= 0)
            before = np.concatenate(([0], np.cumsum(kept)))  # nodes kept before each place
            page = np.repeat(starts[:-1], lengths)
            above = page + np.maximum(parents, 0)
            parents = np.where((parents >= 0) & kept[above], before[above] - before[page], -1)[kept]
            sizes = (before[np.arange(count) + sizes + 1] - before[1:])[kept]
            numbers, text_of, link_of = numbers[kept], text_of[kept], link_of[kept]
            starts = before[starts]
            lengths = np.diff(starts)
            count = len(numbers)

        def at(values: list, places: np.ndarray) -> pa.Array:
            return pa.array(values, strings).take(pa.array(places, ints, mask=places < 0))

        kinds = pa.array(numbers, ints)
        attr_ends = np.cumsum([0, *(len(names) for names, _ in self.attrs)])
        attrs = pa.MapArray.from_arrays(
            pa.array(attr_ends, ints),
            pa.array([name for names, _ in self.attrs for name in names], strings),
            pa.array([value for _, values in self.attrs for value in values], strings),
        )
        fields = {
            "idx": pa.array(np.arange(count) - np.repeat(starts[:-1], lengths), ints),
            "parent": pa.array(parents, ints),
            "size": pa.array(sizes, ints),
        }
        if self.marks:
            fields["marks"] = pa.array(np.array(self.bits, np.int32)[numbers], ints)
        else:
            fields["tag"] = pa.array(self.tags, strings).take(kinds)
            fields["class"] = pa.array(self.classes, strings).take(kinds)
        fields["text"] = at(self.texts, text_of)
        fields["attrs"] = attrs.take(kinds)
        if not self.marks:
            fields["link"] = at(self.link_to, link_of)
        structs = pa.StructArray.from_arrays(list(fields.values()), list(fields))
        return pa.ListArray.from_arrays(pa.array(starts, ints), structs)


def slices(batches: Iterable[tuple[pa.Array, ...]]) -> Iterator[tuple[pa.Array, ...]]:
    """Arrow batches, bodies first, cut to SLICE_BYTES of bodies (a page at least) and SLICE_PAGES pages.

    A batch's rows are the session's setting, and a page's nodes take many times its bytes:
    whole batches would be held as Python objects, which cost memory and, since the garbage
    collector walks them again and again, more time than splitting.
    """
    for columns in batches:
        sizes = [size or 0 for size in pc.binary_length(columns[0]).to_pylist()]
        start = held = 0
        for at, size in enumerate(sizes):
            if at > start and (held + size > SLICE_BYTES or at - start == SLICE_PAGES):
                yield tuple(column.slice(start, at - start) for column in columns)
                start, held = at, 0
            held += size
        yield tuple(column.slice(start) for column in columns)


def page_nodes(
    body: Column,
    url: Column,
    attributes: Sequence[str] = (),
    links: bool = False,
    only: Sequence[tuple[str, str]] | None = None,
    marks: Sequence[Mark] = (),
) -> Column:
    """The nodes of a page, with only the named attributes; `links` adds absolute hrefs of a and area.

    With `only`, pairs of a tag and a class ('' for any), just these elements and the links leave the Python worker.
    With `marks`, at most 31, elements carry a bit for each that they meet in place of tag, class and link.
    """
    keep = frozenset(attributes)
    ship_code()

    @F.arrow_udf(MARKED_NODES if marks else NODES)
    def split(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for bodies, urls in slices(batches):
            nodes = PageNodes(keep, links, marks)
            for page, base in zip(bodies.to_pylist(), urls.to_pylist()):
                nodes.page(page or "", base or "")
            yield nodes.array(only)

    return split(body, url)


def page_nodes_or_error(body: Column, url: Column, attributes: Sequence[str] = (), marks: Sequence[Mark] = ()) -> Column:
    """`page_nodes` as a struct (nodes, error): a page that cannot be split has no nodes and says why, others have no error."""
    keep = frozenset(attributes)
    ship_code()

    @F.arrow_udf(f"struct<nodes:{MARKED_NODES if marks else NODES},error:string>")
    def split(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for bodies, urls in slices(batches):
            nodes = PageNodes(keep, False, marks)
            errors = [nodes.page_or_error(page or "", base or "") for page, base in zip(bodies.to_pylist(), urls.to_pylist())]
            yield pa.StructArray.from_arrays([nodes.array(), pa.array(errors, pa.string())], ["nodes", "error"])

    return split(body, url)


# Column expressions over nodes. `nodes` is an array of nodes, `n` one of them.


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then(value)` with `value` worked out once, however often `then` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def element(tag: str | None = None, classes: Sequence[str] = (), attrs: dict[str, Column | str] | None = None):
    """Predicate on a node: its tag, classes and attribute values."""

    def test(n: Column) -> Column:
        checks = [n["tag"] == tag] if tag else [n["tag"] != TEXT]
        checks += [n["class"].contains(f" {c} ") for c in classes]
        checks += [n["attrs"][k] == v for k, v in (attrs or {}).items()]
        whole = checks[0]
        for check in checks[1:]:
            whole = whole & check
        return whole

    return test


def marked(mask: int):
    """Predicate on a node with marks: it has one of the mask's."""
    return lambda n: n["marks"].bitwiseAND(F.lit(mask)) != 0


def _outermost(picked: Column) -> Column:
    """The picked nodes that lie in no other of them, as (idx, size): disjoint ranges in order."""
    none = F.array().cast("array<struct<idx:int,size:int>>")

    def step(done: Column, n: Column) -> Column:
        wider = F.struct(
            F.concat(done["out"], F.array(F.struct(n["idx"].alias("idx"), n["size"].alias("size")))).alias("out"),
            (n["idx"] + n["size"]).alias("end"),
        )
        return F.when(n["idx"] <= done["end"], done).otherwise(wider)

    return F.aggregate(picked, F.struct(none.alias("out"), F.lit(-1).alias("end")), step, lambda done: done["out"])


def pick(nodes: Column, *path, among: Column | None = None) -> Column:
    """Nodes meeting the last predicate that lie below nodes meeting the ones before it, in order.

    The ancestors' ranges are worked out once and merged, so each node is looked at once
    per step of the path. `among` are the nodes that the first step is known to pick from, where they were picked before.
    """
    *above, last = path
    if not above:
        return F.filter(nodes if among is None else among, last)

    def below(whole: Column) -> Column:
        start = F.get(whole, F.lit(0))["idx"]
        inner = F.transform(
            _outermost(pick(whole, *above, among=among)), lambda a: F.filter(F.slice(whole, a["idx"] - start + 2, a["size"]), last)
        )
        return F.flatten(inner)

    return let(nodes, below)


def subtree(nodes: Column, root: Column) -> Column:
    """A node with everything below it, out of a whole page or a subtree it lies in."""
    return F.slice(nodes, root["idx"] - F.get(nodes, F.lit(0))["idx"] + 1, root["size"] + 1)


def texts(nodes: Column) -> Column:
    """Every text run."""
    # Elements have no text. The field of all nodes is taken at once, which costs less than asking each node for its tag.
    return F.filter(nodes["text"], lambda t: t.isNotNull())


def own_texts(nodes: Column, picked: Column) -> Column:
    """Text runs directly in the picked nodes."""
    runs = F.transform(
        picked, lambda p: F.filter(subtree(nodes, p), lambda t: (t["parent"] == p["idx"]) & t["text"].isNotNull())
    )
    return F.flatten(runs)["text"]


def deep_texts(nodes: Column, picked: Column) -> Column:
    """Text runs anywhere below the picked nodes."""
    return F.flatten(F.transform(picked, lambda p: texts(subtree(nodes, p))))


def attr_values(picked: Column, name: str) -> Column:
    """The named attribute of the picked nodes that have it."""
    return F.filter(F.transform(picked, lambda n: n["attrs"][name]), lambda v: v.isNotNull())


def first(values: Column) -> Column:
    return F.get(values, F.lit(0))


def joined(values: Column) -> Column:
    return F.array_join(values, " ")
