"""Main text of web pages through wrappers inferred per host.

A wrapper is a union-free regular expression over a page's tokens: tags, text,
repeated groups (...)+ and optional groups (...)?. It starts as the first
page structure of a host, with its own repetitions folded, and is aligned with
one more structure at a time: where texts differ a text becomes a slot; where
tags differ, a part that repeats a known group joins it and anything else
becomes optional. Slots are where the host's pages differ, so they show which element
holds the article: the region. Fixed text, navigation, adverts and the like
never count towards it.

Each page is then read with its host's region: the text of all blocks below
it, boilerplate elements left out. A page that does not have the region is
read with a wrapper of its own.

A wrapper is fitted on every distinct page of its host. Pages of one structure
(the same tags once repetitions are folded) are one structure, whose texts are
fixed where all these pages agree; a host has few structures, whatever its
pages. More than ``FAN_IN`` of them are aligned in bunches, and the bunches'
wrappers again, until one is left. All pages are read whole. Null html counts
as empty and gives an empty text; null or malformed urls share one empty host.
Rows may repeat; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from difflib import SequenceMatcher
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from claimloom.operators.skew import salted_left_join
from claimloom.staging import stage

FAN_IN = 64  # structures that one task aligns, about
HELD_ITEMS = 200_000  # tags and texts of structures that a task holds at most
LONGEST_REPEAT = 12  # tokens of one repeated unit
MAIN_SHARE = 0.6  # of the slot text an element must hold to be entered on the way to an article or main element
_ROWS = 128
# Two sequences are compared by SequenceMatcher up to this product of their lengths, longer ones by common_subsequence.
FULL_COMPARISON = 1_000_000
HELD_BITS = 1 << 26  # of the table of lengths that common_subsequence holds at once

# How HTML elements behave and what never belongs to an article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th figcaption caption".split())
BOILERPLATE_TAGS = frozenset(
    "head nav footer aside form button select option menu dialog script style textarea title noscript iframe "
    "template svg object".split()
)
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement banner sponsor sponsored promo sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer cookie cookies consent notice notices alert newsletter subscribe signup login "
    "comment comments reply replies disqus social share sharing related popup modal overlay widget toolbar "
    "copyright disclaimer masthead pagination pager".split()
)

# Words that make a name a statement about an element, as in has-sidebar, no-comments, nav-open.
STATE_WORDS = frozenset(
    "has have is no not with without open opened closed on off enabled disabled active visible hidden show shown fixed sticky".split()
)
# Words of elements that may as well hold the article, as in social-post, page-sidebar-content.
CONTENT_WORDS = frozenset("content post article entry story main page body text wrapper container layout".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)", re.S
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """("open", tag, element name), ("close", tag, ""), ("text", text, "") of a page.

    An element's name is its tag with its class, id and role, numbers made equal.
    """
    at = 0
    while m := _TOKEN.match(html, at):
        at = m.end()
        tag = (m[2] or "").lower()
        if m[4] is not None:
            yield "text", m[4], ""
        elif not tag:
            continue
        elif m[1]:
            yield "close", tag, ""
        else:
            marks = [re.sub(r"\d+", "0", (a[2] or a[3] or a[4] or "").strip().lower()) for a in _ATTRIBUTE.finditer(m[3])]
            yield "open", tag, ".".join([tag, *sorted(x for x in marks if x)])
            if tag in _RAW_END:
                end = _RAW_END[tag].search(html, at)
                at = end.end() if end else len(html)
                yield "close", tag, ""


# How sure a name is: not boilerplate, boilerplate unless the element holds most of the text, boilerplate unless
# it holds the article element, boilerplate in any case.
CLEAR, UNSURE, LIKELY, CERTAIN = range(4)


def boilerplate_kind(name: str, inside_article: bool) -> int:
    """What the tag and each whole class, id or role name say. A name of several words counts by its last
    word or, if no word of it may hold an article, by its first; statements about the page do not count."""
    tag, _, marks = name.partition(".")
    if tag in BOILERPLATE_TAGS or (tag == "header" and not inside_article):
        return CERTAIN
    if tag in ("html", "body", "article", "main"):
        return CLEAR
    kind = CLEAR
    for mark in re.split(r"[.\s]+", marks):
        words = [w for w in re.split(r"[^a-z]+", mark) if w]
        if BOILERPLATE_WORDS.isdisjoint(words) or not STATE_WORDS.isdisjoint(words):
            continue
        sure = words[-1] in BOILERPLATE_WORDS or (words[0] in BOILERPLATE_WORDS and CONTENT_WORDS.isdisjoint(words))
        kind = max(kind, LIKELY if sure else UNSURE)
    return kind


@dataclass(frozen=True)
class Holders:
    """Elements, by their number on the page, that hold more than half of its text; and those around an article element that does."""

    most: frozenset[int] = frozenset()
    around_article: frozenset[int] = frozenset()


class Stack:
    """Open elements of a page; end tags may be missing. Elements are numbered as they open."""

    def __init__(self, holders: Holders = Holders()):
        self.names: list[str] = []
        self.tags: list[str] = []
        self.numbers: list[int] = []
        self.boilerplate = 0  # open elements that are boilerplate
        self.links = 0
        self.lowest = 0  # the stack was cut down to this since a caller last set it
        self.opened = 0
        self._articles = 0
        self._counts: dict[str, int] = {}
        self._flags: list[tuple[bool, bool, bool]] = []
        self._holders = holders

    def open(self, tag: str, name: str) -> None:
        if tag in VOID:
            return
        if tag not in INLINE:
            # a block ends an open paragraph, with whatever inline element is open in it
            for i in range(len(self.tags) - 1, -1, -1):
                inner = self.tags[i]
                if inner == "p" or (inner == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option")):
                    self._cut(i)
                    break
                if inner not in INLINE:
                    break
        kind, number = boilerplate_kind(name, self._articles > 0), self.opened
        bad = (
            kind == CERTAIN
            or (kind == LIKELY and number not in self._holders.around_article)
            or (kind == UNSURE and number not in self._holders.most)
        )
        flags = (bad, tag == "a", tag in ("article", "main"))
        self.names.append(name)
        self.tags.append(tag)
        self.numbers.append(number)
        self._flags.append(flags)
        self._counts[tag] = self._counts.get(tag, 0) + 1
        self.opened += 1
        self.boilerplate += flags[0]
        self.links += flags[1]
        self._articles += flags[2]

    def close(self, tag: str) -> None:
        if self._counts.get(tag):
            i = len(self.tags) - 1
            while self.tags[i] != tag:
                i -= 1
            self._cut(i)

    def _cut(self, i: int) -> None:
        for (bad, link, article), tag in zip(self._flags[i:], self.tags[i:]):
            self.boilerplate -= bad
            self.links -= link
            self._articles -= article
            self._counts[tag] -= 1
        del self.names[i:], self.tags[i:], self.numbers[i:], self._flags[i:]
        self.lowest = min(self.lowest, i)


def holders_of(events: Iterable[tuple[str, str, object]]) -> Holders:
    """``events`` are ("open", tag, name), ("close", tag, _) and ("text", _, characters)."""
    stack, above, chars, tags = Stack(), [], [], []
    loose = 0  # text outside all elements
    outer: list[int] = []  # numbers of open elements whose tag alone makes them boilerplate
    for kind, tag, what in events:
        if kind == "text":
            while outer and not _is_open(stack, outer[-1]):
                outer.pop()
            if not outer and stack.numbers:
                chars[stack.numbers[-1]] += what
            elif not outer:
                loose += what
        elif kind == "close":
            stack.close(tag)
        elif tag not in VOID:
            stack.open(tag, what)
            above.append(stack.numbers[-2] if len(stack.numbers) > 1 else -1)
            chars.append(0)
            tags.append(tag)
            if tag in BOILERPLATE_TAGS:
                outer.append(stack.numbers[-1])
    for number in range(len(chars) - 1, -1, -1):
        if above[number] >= 0:
            chars[above[number]] += chars[number]
    total = loose + sum(c for c, up in zip(chars, above) if up < 0)
    most = [number for number, c in enumerate(chars) if 2 * c > total]  # one inside the other
    articles = [i for i, number in enumerate(most) if tags[number] in ("article", "main")]
    return Holders(frozenset(most), frozenset(most[: articles[-1]] if articles else ()))


def _is_open(stack: Stack, number: int) -> bool:
    at = bisect_left(stack.numbers, number)
    return at < len(stack.numbers) and stack.numbers[at] == number


# --- wrappers ---------------------------------------------------------------------


@dataclass
class Item:
    """A tag (``token``), a text, or a group (``items``) of the expression."""

    token: str = ""
    value: str | None = None  # of a text: its fixed value, None once it is a slot
    chars: int = 0
    items: list[Item] = field(default_factory=list)
    mark: str = ""  # "+" or "?" of a group
    key: object = None

    def __post_init__(self):
        if self.key is None:
            self.key = (self.mark, *(i.key for i in self.items)) if self.items else self.token

    def merged(self, other: Item) -> Item:
        items = [a.merged(b) for a, b in zip(self.items, other.items)]
        value = self.value if self.value == other.value else None
        return Item(self.token, value, self.chars + other.chars, items, self.mark, self.key)

    def __str__(self):
        if self.items:
            return f"({' '.join(map(str, self.items))}){self.mark}"
        return self.token if self.token != "#" else "#slot" if self.value is None else "#text"


def page_items(html: str) -> list[Item]:
    out = []
    for kind, value, name in tokens(html):
        if kind == "text":
            text = " ".join(unescape(value).split())
            if text:
                out.append(Item("#", text, len(text)))
        elif kind == "open" and name.partition(".")[0] != "br":
            out.append(Item(f"<{name}>"))
        elif kind == "close":
            out.append(Item(f"</{value}>"))
    return out


def fold(items: list[Item], longest: int = LONGEST_REPEAT) -> list[Item]:
    """Immediate repetitions become (...)+ groups, the shortest units first."""
    changed = True
    while changed:
        changed = False
        for width in range(1, longest + 1):
            keys, out, i = [x.key for x in items], [], 0
            while i < len(items):
                if i + width >= len(keys) or keys[i] != keys[i + width]:  # nothing repeats here
                    out.append(items[i])
                    i += 1
                    continue
                unit, end = keys[i : i + width], i + width
                while len(unit) == width and keys[end : end + width] == unit:
                    end += width
                if len(unit) == width and end > i + width and not (width == 1 and items[i].mark == "+"):
                    body = items[i : i + width]
                    for j in range(i + width, end, width):
                        body = [a.merged(b) for a, b in zip(body, items[j : j + width])]
                    out.append(Item(items=body, mark="+"))
                    i, changed = end, True
                elif width == 1 and end > i + 1:  # groups of one kind in a row are one group
                    group = items[i]
                    for other in items[i + 1 : end]:
                        group = group.merged(other)
                    out.append(group)
                    i, changed = end, True
                else:
                    out.append(items[i])
                    i += 1
            items = out
    return items


def absorb(items: list[Item], other: list[Item]) -> list[Item]:
    """Single occurrences of a group that ``other`` repeats become that group, the longest that fits."""
    units: dict[object, list[list[object]]] = {}  # by their first key, each kind of group once
    for key in sorted(dict.fromkeys(x.key for x in other if x.mark == "+"), key=len, reverse=True):
        units.setdefault(key[1], []).append(list(key[1:]))
    keys, out, i = [x.key for x in items], [], 0
    while i < len(items):
        unit = next((u for u in units.get(keys[i], ()) if keys[i : i + len(u)] == u), None)
        out.append(items[i] if unit is None else Item(items=items[i : i + len(unit)], mark="+"))
        i += 1 if unit is None else len(unit)
    return fold(out) if units else items


def matching(a: list[object], b: list[object]) -> list[tuple[int, int, int]]:
    """(start in a, start in b, length) of equal stretches, in order.

    Sequences of any length are compared whole: what lies between equal ends
    by ``SequenceMatcher`` or, beyond ``FULL_COMPARISON``, which would take
    minutes there, by a longest common subsequence.
    """
    if len(a) * len(b) <= FULL_COMPARISON:
        return [m for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if m[2]]
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    inner_a, inner_b = a[head : len(a) - tail], b[head : len(b) - tail]
    if len(inner_a) * len(inner_b) <= FULL_COMPARISON:
        inner = matching(inner_a, inner_b)
    else:
        inner = _stretches(common_subsequence(inner_a, inner_b))
    out = [(0, 0, head)] if head else []
    out += [(i + head, j + head, n) for i, j, n in inner]
    return out + ([(len(a) - tail, len(b) - tail, tail)] if tail else [])


def _stretches(pairs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    out: list[tuple[int, int, int]] = []
    for i, j in pairs:
        if out and (out[-1][0] + out[-1][2], out[-1][1] + out[-1][2]) == (i, j):
            out[-1] = (*out[-1][:2], out[-1][2] + 1)
        else:
            out.append((i, j, 1))
    return out


def common_subsequence(a: list[object], b: list[object]) -> list[tuple[int, int]]:
    """Places (in a, in b) of a longest common subsequence.

    A row of the table of lengths is a whole number with a bit per item, so 64
    items or so are compared at once; the table is cut in halves (Hirschberg)
    until a part can be held, so memory is linear.
    """
    shared = {k: n for n, k in enumerate(set(a) & set(b))}
    at_a, at_b = ([i for i, k in enumerate(s) if k in shared] for s in (a, b))
    x, y = [shared[a[i]] for i in at_a], [shared[b[j]] for j in at_b]
    if len(x) < len(y):
        return [(at_a[i], at_b[j]) for j, i in _subsequence(y, x)]
    return [(at_a[i], at_b[j]) for i, j in _subsequence(x, y)]


def _subsequence(x: list[int], y: list[int]) -> list[tuple[int, int]]:
    if not x or not y:
        return []
    if len(y) == 1:
        return [(x.index(y[0]), 0)] if y[0] in x else []
    if len(x) * len(y) <= HELD_BITS:
        width = len(x) // 8 + 1
        rows = [row.to_bytes(width, "little") for row in ((1 << len(x)) - 1, *_length_rows(x, y))]
        out, i, j = [], len(x), len(y)
        while i and j:
            byte, bit = (i - 1) >> 3, (i - 1) & 7
            if rows[j][byte] >> bit & 1:
                i -= 1
            elif rows[j - 1][byte] >> bit & 1:
                i, j = i - 1, j - 1
                out.append((i, j))
            else:
                j -= 1
        return out[::-1]
    half = len(y) // 2
    before = _prefix_lengths(x, y[:half])
    after = _prefix_lengths(x[::-1], y[half:][::-1])[::-1]
    cut = int((before + after).argmax())
    return _subsequence(x[:cut], y[:half]) + [(i + cut, j + half) for i, j in _subsequence(x[cut:], y[half:])]


def _length_rows(x: list[int], y: list[int]) -> Iterator[int]:
    """After each item of ``y``: bit i is 0 if x[: i + 1] has one item more in common with it and those before than x[:i]."""
    places: dict[int, list[int]] = {k: [] for k in y}
    for i, k in enumerate(x):
        if k in places:
            places[k].append(i)

    def bits(at: list[int]) -> int:
        out = bytearray(len(x) // 8 + 1)
        for i in at:
            out[i >> 3] |= 1 << (i & 7)
        return int.from_bytes(out, "little")

    # those of frequent keys are kept, some 512 at most
    kept = {k: bits(at) for k, at in places.items() if len(at) > len(x) // 512 + 32}
    row = every = (1 << len(x)) - 1
    for k in y:
        if places[k]:
            equal = row & (kept[k] if k in kept else bits(places[k]))
            row = ((row + equal) | (row - equal)) & every
        yield row


def _prefix_lengths(x: list[int], y: list[int]) -> np.ndarray:
    """Items that each of x[:0], x[:1], ... has in common with ``y``."""
    row = deque(_length_rows(x, y), maxlen=1).pop()
    held = np.frombuffer(row.to_bytes(len(x) // 8 + 1, "little"), np.uint8)
    return np.concatenate([[0], np.cumsum(np.unpackbits(held, count=len(x), bitorder="little") == 0)])


def align(wrapper: list[Item], page: list[Item]) -> list[Item]:
    """The wrapper generalised so that it also describes ``page``, which may be a wrapper itself."""
    page = absorb(page, wrapper)
    wrapper = absorb(wrapper, page)

    def opened(items: list[Item]) -> tuple[list[Item], list[bool]]:
        """Optional parts take part with their content, so that a page that has them matches."""
        parts = [(y, x.mark == "?") for x in items for y in (x.items if x.mark == "?" else [x])]
        return [y for y, _ in parts], [inside for _, inside in parts]

    def bare(items: list[Item]) -> list[object]:
        return [x.key if x.mark != "?" else ("?",) + tuple(x.key[1:]) for x in items]

    def optional(items: list[Item]) -> list[Item]:
        if not items:
            return []
        if len(items) == 1 and items[0].mark == "?":
            return items
        plain = [y for x in items for y in (x.items if x.mark == "?" else [x])]
        return [Item(items=plain, mark="?")]

    (flat, inside), (other, within) = opened(wrapper), opened(page)
    out: list[Item] = []
    at_a = at_b = 0
    for a, b, n in [*matching(bare(flat), bare(other)), (len(flat), len(other), 0)]:
        out += optional(flat[at_a:a]) + optional(other[at_b:b])
        for i in range(n):
            both = [flat[a + i].merged(other[b + i])]
            out += optional(both) if inside[a + i] or within[b + i] else both
        at_a, at_b = a + n, b + n
    return out


def aligned(structures: Iterable[list[Item]]) -> list[Item]:
    wrapper: list[Item] | None = None
    for items in structures:
        wrapper = items if wrapper is None else align(wrapper, items)
    return wrapper or []


def infer_wrapper(pages: list[str]) -> list[Item]:
    return aligned(fold(page_items(html)) for html in pages)


def joined(items: list[Item], other: list[Item]) -> list[Item]:
    """Two pages of one structure as one: texts that differ become slots."""
    return [a.merged(b) for a, b in zip(items, other)]


def dump(items: list[Item]) -> str:
    def plain(x: Item) -> object:
        return [x.mark, *map(plain, x.items)] if x.items else ["#", x.value, x.chars] if x.token == "#" else x.token

    return json.dumps([plain(x) for x in items])


def load(text: str) -> list[Item]:
    def item(x) -> Item:
        if isinstance(x, str):
            return Item(x)
        return Item("#", x[1], x[2]) if x[0] == "#" else Item(items=[item(y) for y in x[1:]], mark=x[0])

    return [item(x) for x in json.loads(text)]


def region_of(wrapper: list[Item]) -> tuple[str, ...]:
    """Path of the element that holds the wrapper's slot text.

    The innermost article or main element on the way to most of the text, whole
    with its heading and all its blocks; without any, the deepest element that
    holds all of the text.
    """
    def events(items: list[Item]) -> Iterator[tuple[str, str, object]]:
        for x in items:
            if x.items:
                yield from events(x.items)
            elif x.token == "#":
                yield "text", "slot" if x.value is None else "fixed", x.chars
            elif x.token.startswith("</"):
                yield "close", x.token[2:-1], ""
            else:
                name = x.token[1:-1]
                yield "open", name.partition(".")[0], name

    listed = list(events(wrapper))
    holders = holders_of(listed)
    for slots_only in (True, False):  # pages that agree in everything have no slots
        tree = _Weights()
        stack = Stack(holders)
        for kind, tag, what in listed:
            if kind == "open":
                stack.open(tag, what)
            elif kind == "close":
                stack.close(tag)
            elif not stack.boilerplate and not stack.links and (tag == "slot" or not slots_only):
                tree.add(stack, what)
        tree.sum_up()
        if tree.seen:
            break
    node, main, whole = 0, None, 0  # whole: the deepest element so far that holds all of the text
    while True:
        inner = [c for c in tree.below(node) if tree.tag(c) not in LEAVES and tree.tag(c) not in INLINE]
        # an article or main element goes first, but one inside another only if it is the larger part
        rank = lambda c: (main is None and tree.tag(c) in ("article", "main"), tree.weights[c])
        best = max(inner, key=rank, default=None)
        if best is None or (
            (main is not None or tree.tag(best) not in ("article", "main"))
            and tree.weights[best] < MAIN_SHARE * tree.weights[node]
        ):
            return tree.path(whole if main is None else main)
        node = best
        if tree.tag(node) in ("article", "main"):
            main = node
        elif tree.weights[node] == tree.weights[0]:
            whole = node


class _Weights:
    """Characters of text by element path, as a tree of names; node 0 stands above all."""

    def __init__(self):
        self.names, self.up, self.weights = [""], [-1], [0]
        self._children: list[dict[str, int]] = [{}]
        self._way: list[int] = []  # nodes of the stack's names
        self.seen = False

    def add(self, stack: Stack, chars: int) -> None:
        del self._way[stack.lowest :]
        for name in stack.names[len(self._way) :]:
            above = self._way[-1] if self._way else 0
            node = self._children[above].get(name)
            if node is None:
                node = self._children[above][name] = len(self.names)
                self.names.append(name)
                self.up.append(above)
                self.weights.append(0)
                self._children.append({})
            self._way.append(node)
        stack.lowest = len(self._way)
        self.weights[self._way[-1] if self._way else 0] += chars
        self.seen = True

    def sum_up(self) -> None:
        for node in range(len(self.names) - 1, 0, -1):
            self.weights[self.up[node]] += self.weights[node]

    def below(self, node: int) -> list[int]:
        return list(self._children[node].values())

    def tag(self, node: int) -> str:
        return self.names[node].partition(".")[0]

    def path(self, node: int) -> tuple[str, ...]:
        names = []
        while node:
            names.append(self.names[node])
            node = self.up[node]
        return tuple(reversed(names))


# --- reading pages ----------------------------------------------------------------


def read_region(html: str, region: tuple[str, ...]) -> str | None:
    """Text blocks below ``region``, one line each; None if the page has no such element."""
    listed = list(tokens(html))
    stack = Stack(holders_of((k, v, len(" ".join(v.split())) if k == "text" else name) for k, v, name in listed))
    blocks, block, seen = [], [], not region
    depth, matched = len(region), 0  # how many names from the top agree with the region

    def end_block() -> None:
        text = " ".join(unescape("".join(block)).split())
        block.clear()
        if text:
            blocks.append(text)

    for kind, value, name in listed:
        if kind == "text":
            if not stack.boilerplate and matched == depth:
                block.append(value)
            continue
        if value in INLINE:
            if value == "br":
                block.append(" ")
        else:
            end_block()
        if kind == "open":
            stack.open(value, name)
        else:
            stack.close(value)
        matched, stack.lowest = min(matched, stack.lowest), len(stack.names)
        while matched < min(depth, len(stack.names)) and stack.names[matched] == region[matched]:
            matched += 1
        seen = seen or matched == depth
    end_block()
    return "\n".join(blocks) if seen else None


def main_text(html: str | None, region: tuple[str, ...] | None) -> str:
    """A page's main text; a page without its host's region is a host of its own."""
    if not html:
        return ""
    text = None if region is None else read_region(html, region)
    if text is None:
        text = read_region(html, region_of(infer_wrapper([html])))
    return text or ""


def page_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


_STRUCTURE = "host string, place string, items string"


def page_structures(pages: DataFrame) -> DataFrame:
    """(host, place, items) per structure of each host of ``pages(host, html)``; ``place`` names the structure."""

    def read(batches):
        for batch in batches:
            known: dict[tuple[str, tuple], list[Item]] = {}
            held = 0
            for start in range(0, batch.num_rows, _ROWS):
                piece = batch.slice(start, _ROWS)
                for host, html in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    items = page_items(html)
                    for x in items:
                        if x.value is not None:  # only equal or not matters
                            x.value = hashlib.blake2b(x.value.encode("utf-8", "replace"), digest_size=16).hexdigest()
                    items = fold(items)
                    key = host, tuple(x.key for x in items)
                    if key in known:
                        known[key] = joined(known[key], items)
                        continue
                    known[key] = items
                    held += len(items)
                    if held > HELD_ITEMS:
                        yield told(known)
                        known, held = {}, 0
            yield told(known)

    def told(known) -> pa.RecordBatch:
        rows = [(host, hashlib.sha256(repr(key).encode()).hexdigest(), dump(items)) for (host, key), items in known.items()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], pa.string()) for i in range(3)], names=["host", "place", "items"]
        )

    def combine(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        whole: list[Item] | None = None
        for text in table.column("items"):
            items = load(text.as_py())
            whole = items if whole is None else joined(whole, items)
        return pa.table({"host": [key[0].as_py()], "place": [key[1].as_py()], "items": [dump(whole)]})

    return pages.mapInArrow(read, _STRUCTURE).groupBy("host", "place").applyInArrow(combine, _STRUCTURE)


def _in_order(table: pa.Table) -> list[Item]:
    return aligned(load(text) for text in table.sort_by([("place", "ascending"), ("items", "ascending")]).column("items").to_pylist())


def infer_wrappers(pages: DataFrame, url: str, html: str, fan_in: int = FAN_IN) -> DataFrame:
    """(host, region, wrapper) for every host with a non-empty page, from all its distinct pages."""
    rows = pages.where(F.length(html) > 0).select(page_host(F.col(url)).alias("host"), F.col(html).alias("html"))
    distinct = rows.groupBy("host", F.sha2("html", 256).alias("place")).agg(F.min("html").alias("html"))
    structures = stage(page_structures(distinct.select("host", "html")), "structures")

    def bunch(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        least = min(table.column("place").to_pylist())
        return pa.table({"host": [key[0].as_py()], "place": [least], "items": [dump(_in_order(table))]})

    def infer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        wrapper = _in_order(table)
        region = list(region_of(wrapper))
        text = " ".join(map(str, wrapper))
        return pa.table({"host": [key[0].as_py()], "region": pa.array([region], pa.list_(pa.string())), "wrapper": [text]})

    while True:
        counts = structures.groupBy("host").agg(F.count("*").alias("n"))
        largest = counts.agg(F.max("n")).first()[0] or 0
        if largest <= fan_in:
            break
        # half as many to a bunch as fit, as bunches differ; each round leaves that many times fewer
        wide = counts.where(F.col("n") > fan_in).select("host", F.ceil(F.col("n") / F.lit(max(2, fan_in // 2))).alias("bunches"))
        dealt = structures.join(wide, "host", "left").withColumn(
            "bunch", F.when(F.col("bunches").isNotNull(), F.pmod(F.xxhash64("place"), F.col("bunches")).cast("string")).otherwise(F.col("place"))
        )
        structures = stage(dealt.groupBy("host", "bunch").applyInArrow(bunch, _STRUCTURE), "structures")
    return structures.groupBy("host").applyInArrow(infer, "host string, region array<string>, wrapper string")


def extract_main_text(
    pages: DataFrame,
    id: str,
    url: str,
    html: str,
    keep: Mapping[str, Column],
    fan_in: int = FAN_IN,
) -> DataFrame:
    """(columns of ``keep``, text, n_chars) per row of ``pages``."""
    wrappers = stage(infer_wrappers(pages, url, html, fan_in).select("host", "region"), "wrappers")
    rows = pages.select(
        page_host(F.col(url)).alias("host"), F.col(html).alias("_html"), F.col(id).alias("_row"),
        *[c.alias(name) for name, c in keep.items()],
    )
    joined = salted_left_join(rows, wrappers, "host", "_row").select("_html", "region", *keep)

    def read(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                piece = batch.slice(start, _ROWS)
                regions = [None if r is None else tuple(r) for r in piece.column(1).to_pylist()]
                texts = [main_text(h, r) for h, r in zip(piece.column(0).to_pylist(), regions)]
                arrays = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                names = [*piece.schema.names[2:], "text", "n_chars"]
                yield pa.RecordBatch.from_arrays([*piece.columns[2:], *arrays], names=names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[2:])
    return joined.mapInArrow(read, f"{fields}, text string, n_chars bigint")
