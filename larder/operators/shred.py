"""Page shredding: HTML text -> one array of nodes per page.

The only Python worker code of the extraction. One Arrow pass cuts plain pages into tokens, many at once
(``PlainPages``), and all others with a regular expression, and writes the node columns directly as Arrow arrays; for sites with rules
it also marks the elements that the rules' paths reach (``operators.paths``). Everything
after it is Column work in the JVM. Broken markup is read leniently: void elements never nest,
``p``/``li``/``td``/``tr``/``dt``/``dd``/``option`` end where the next block or sibling
begins, unclosed elements end with their parent, unknown end tags are ignored. A start tag that
ends in ``/>`` is an empty element, and pages without ``html`` or ``body`` tags get these elements.
The time per page grows with its length, whatever the markup: the open elements are also
kept by name, so no end is looked for by walking up the tree.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from larder.operators import paths
from larder.operators.paths import TEXT, Page, SitePaths
from larder.schema import NODE_ATTRS, NODE_TYPE

TOKEN = re.compile(
    r"<(?:!--.*?(?:-->|\Z)"
    r"|[!?][^>]*>"
    r"|/([a-zA-Z][^\s/>]*)[^>]*>"
    r"|([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|([a-zA-Z][^\s/>]*)([^>]*)>)",
    re.S,
)
# A slash at the end of a start tag that belongs to a value without quotes.
BARE_SLASH = re.compile(r"=\s*[^\s\"']*/$")
ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

# Element classes of HTML.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW_TEXT = {t: re.compile(rf"</{t}[\s/>]", re.I) for t in ("script", "style")}
CLOSES_P = frozenset(
    "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
# start tag -> (open elements it ends, elements that stop the search)
IMPLIED_END = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "body": (frozenset(["head"]), frozenset()),
}
# Elements that come before the body, and tags that make a page of frames, which has none.
HEAD = frozenset("title meta link script style base noscript template".split())
FRAMES = frozenset("frameset frame noframes".split())
HAS_HTML, HAS_BODY = (re.compile(rf"<{t}[\s/>]", re.I) for t in ("html", "body"))
# The usual spelling is found much faster.
LOW_HTML, LOW_BODY = (re.compile(rf"<{t}[\s/>]") for t in ("html", "body"))
P_END = (frozenset(["p"]), frozenset(["table", "td", "th", "button", "object", "body"]))
# An end tag does not reach beyond these, unless it names one of them.
END_BARRIER = frozenset(["table", "td", "th"])

# Output batches are cut at these sizes, so that one input batch of large pages cannot
# exceed Arrow's 32-bit offsets or the worker's memory.
MAX_NODES = 50_000
MAX_CHARS = 4_000_000

# Tags of a batch that are remembered as read, and the longest of them.
KNOWN_TAGS = 20_000
KNOWN_CHARS = 200
UNKNOWN = object()

ATTR_SLOT = {a.replace("_", "-"): i for i, a in enumerate(NODE_ATTRS)}
ITEMSCOPE = ATTR_SLOT["itemscope"]

# The element lists of a page, for the paths of its site: by tag ("li"), by the whole value of these
# attributes ("id=x"), and by the presence of those that rules also test in part ("@class").
INDEXED_VALUES = frozenset(
    ["class", "id", "itemprop", "itemtype", "property", "name", "rel", "style"]
)
INDEXED_PRESENCE = frozenset(["class", "title"])
VALUE_SLOTS = {NODE_ATTRS.index(a): a + "=" for a in INDEXED_VALUES}
PRESENCE_SLOTS = {NODE_ATTRS.index(a): "@" + a for a in INDEXED_PRESENCE}


class Tag(NamedTuple):
    """What the text of one tag says, whatever page it stands in."""

    end: bool
    name: str
    attrs: tuple[tuple[int, str], ...] = ()  # the known attributes, the first of each name
    opens: bool = False  # an item
    empty: bool = False
    closes_p: bool = False
    implied: tuple[frozenset, frozenset] | None = None


def read_attrs(raw: str) -> tuple[tuple[int, str], ...]:
    found: dict[int, str] = {}
    for name, double, single, bare in ATTR.findall(raw):
        slot = ATTR_SLOT.get(name) if name.islower() else ATTR_SLOT.get(name.lower())
        if slot is None or slot in found:
            continue
        value = double or single or bare
        found[slot] = unescape(value) if "&" in value else value
    return tuple(found.items())


def read_tag(m: re.Match) -> Tag | None:
    """The tag that a token is, None for comments and declarations."""
    kind = m.lastindex
    if kind is None:
        return None
    if kind == 1:
        return Tag(True, m[1].lower())
    name, raw = m[kind - 1].lower(), m[kind]
    attrs = read_attrs(raw) if "=" in raw or "item" in raw else ()
    return Tag(
        False,
        name,
        attrs,
        any(slot == ITEMSCOPE for slot, _ in attrs),
        name in VOID or raw.endswith("/") and not BARE_SLASH.search(raw),
        name in CLOSES_P,
        IMPLIED_END.get(name),
    )


class NodeColumns:
    """Flat node columns of a batch of pages."""

    def __init__(self, sites: dict[str, SitePaths] | None = None) -> None:
        self.sites = sites or {}
        self.scopes: list[int] = []
        self.scope_offsets: list[int] = [0]
        self.hits: list[tuple[int, int]] = []  # rule, position
        self.hit_offsets: list[int] = [0]
        self.origins: list[int] = []
        self.origin_offsets: list[int] = [0]
        self.parent, self.item, self.end = array("i"), array("i"), array("i")
        self.tag: list[str] = []
        self.text: list[str | None] = []
        self.attr_rows = [array("i") for _ in NODE_ATTRS]
        self.attr_values: list[list[str]] = [[] for _ in NODE_ATTRS]
        self.offsets: list[int] = [0]
        self.known: dict[str, Tag | None] = {}  # short tags met before: most repeat

    def __len__(self) -> int:
        return len(self.tag)

    def add_page(self, html: str, source: str | None = None) -> None:
        site = self.sites.get(source)
        index: dict[str, list[int]] | None = {} if site else None  # of a page whose site has paths
        page_attrs: dict[int, dict[int, str]] = {}
        tags, texts, parents, items, end = self.tag, self.text, self.parent, self.item, self.end
        attr_rows, attr_values, known = self.attr_rows, self.attr_values, self.known
        base = len(tags)
        stack: list[tuple[str, int, int]] = [("", -1, -1)]  # tag, position, nearest item
        open_at: dict[str, list[int]] = {}  # tag -> its places in the stack

        def pop_to(size: int) -> None:
            last = len(tags) - base - 1
            for tag, p, _ in reversed(stack[size:]):
                end[base + p] = last
                open_at[tag].pop()
            del stack[size:]

        def nearest(names) -> int:
            """Place in the stack of the innermost open element of these; 0 if there is none."""
            best = 0
            for t in names:
                places = open_at.get(t)
                if places and places[-1] > best:
                    best = places[-1]
            return best

        def close_implied(ends: frozenset, stops: frozenset) -> None:
            at = nearest(ends)
            if at and at > nearest(stops):
                pop_to(at)

        def add_node(name: str, text: str | None = None) -> int:
            here = len(tags) - base
            _, parent, item = stack[-1]
            parents.append(parent)
            items.append(item)
            end.append(here)
            tags.append(name)
            texts.append(text)
            return here

        def push(name: str, here: int, item: int) -> None:
            if name in open_at:
                open_at[name].append(len(stack))
            else:
                open_at[name] = [len(stack)]
            stack.append((name, here, item))

        def add_missing(name: str) -> None:
            item = stack[-1][2]
            here = add_node(name)
            if index is not None:
                index.setdefault(name, []).append(here)
            push(name, here, item)

        def need_body() -> bool:
            """Close an open head and open the body that the page leaves out."""
            if open_at.get("head"):
                pop_to(nearest(["head"]))
            add_missing("body")
            return False

        def add_text(raw: str) -> None:
            add_node(TEXT, unescape(raw) if "&" in raw else raw)

        no_body = not (LOW_BODY.search(html) or HAS_BODY.search(html))
        if not (LOW_HTML.search(html) or HAS_HTML.search(html)):
            add_missing("html")
        at, size = 0, len(html)
        top, parent, item = stack[-1]  # looked up again wherever the stack changes
        last_tag = html.rfind(">")
        # behind the last ">" only a comment can be a token
        going = at <= last_tag or html.find("<!--", at) >= 0
        while going:
            going = False
            for m in TOKEN.finditer(html, at):
                start = m.start()
                if start > at:
                    raw = html[at:start]
                    if no_body and top in ("", "html", "head") and not raw.isspace():
                        no_body = need_body()
                        top, parent, item = stack[-1]
                    # as add_node, without the call
                    end.append(len(tags) - base)
                    parents.append(parent)
                    items.append(item)
                    tags.append(TEXT)
                    texts.append(unescape(raw) if "&" in raw else raw)
                token = m[0]
                at = start + len(token)
                tag = known.get(token, UNKNOWN)
                if tag is UNKNOWN:
                    tag = read_tag(m)
                    if len(token) <= KNOWN_CHARS and len(known) < KNOWN_TAGS:
                        known[token] = tag
                if tag is None:
                    pass
                elif tag[0]:
                    name = tag[1]
                    if top == name:
                        end[base + parent] = len(tags) - base - 1
                        open_at[name].pop()
                        stack.pop()
                        top, parent, item = stack[-1]
                    else:
                        place = nearest((name,))
                        if place and place >= nearest(END_BARRIER):
                            pop_to(place)
                            top, parent, item = stack[-1]
                else:
                    _, name, attrs, opens, empty, closes_p, implied = tag
                    if no_body and name not in ("html", "head"):
                        if name in FRAMES:
                            no_body = False
                        elif name not in HEAD:
                            no_body = need_body()
                            top, parent, item = stack[-1]
                    if closes_p and open_at.get("p"):
                        close_implied(*P_END)
                        top, parent, item = stack[-1]
                    if implied:
                        if top in implied[0]:  # the usual case: it is the innermost element
                            end[base + parent] = len(tags) - base - 1
                            open_at[top].pop()
                            stack.pop()
                        else:
                            close_implied(*implied)
                        top, parent, item = stack[-1]
                    here = len(tags) - base
                    end.append(here)
                    parents.append(parent)
                    items.append(item)
                    tags.append(name)
                    texts.append(None)
                    if index is not None:
                        index.setdefault(name, []).append(here)
                    for slot, value in attrs:
                        attr_rows[slot].append(base + here)
                        attr_values[slot].append(value)
                    if attrs and index is not None:
                        page_attrs[here] = dict(attrs)
                        for slot, value in attrs:
                            if slot in VALUE_SLOTS:
                                index.setdefault(VALUE_SLOTS[slot] + value, []).append(here)
                            if slot in PRESENCE_SLOTS:
                                index.setdefault(PRESENCE_SLOTS[slot], []).append(here)
                    if not empty:
                        # as push, without the call
                        places = open_at.get(name)
                        if places is None:
                            open_at[name] = [len(stack)]
                        else:
                            places.append(len(stack))
                        top, parent = name, here
                        if opens:
                            item = here
                        stack.append((name, here, item))
                        if name in RAW_TEXT:
                            close = RAW_TEXT[name].search(html, at)
                            stop = close.start() if close else size
                            if stop > at:
                                add_node(TEXT, html[at:stop])
                            at = stop
                            going = at <= last_tag or html.find("<!--", at) >= 0
                            break
                if at > last_tag and html.find("<!--", at) < 0:
                    break
        if at < size:
            if no_body and not html[at:].isspace() and stack[-1][0] in ("", "html", "head"):
                need_body()
            add_text(html[at:])
        pop_to(1)
        if site:
            self.add_hits(site, base, page_attrs, index)

    def add_hits(self, site: SitePaths, base: int, attrs: dict[int, dict[int, str]], index: dict[str, list[int]]) -> None:
        """Note the elements that the paths of the page's site reach."""
        page = Page(self.tag[base:], self.parent[base:], self.text[base:], self.end[base:], attrs, index)
        scopes, hits = paths.match(page, site)
        self.scopes.extend(scopes)
        for rule, pos, origins in hits:
            self.hits.append((rule, pos))
            self.origins.extend(origins)
            self.origin_offsets.append(len(self.origins))

    def close_row(self) -> None:
        self.offsets.append(len(self))
        self.scope_offsets.append(len(self.scopes))
        self.hit_offsets.append(len(self.hits))

    def matches_to_arrow(self) -> dict[str, pa.Array]:
        ints = lambda values: pa.array(np.asarray(values, dtype=np.int32))
        rule, pos = zip(*self.hits) if self.hits else ((), ())
        origins = pa.ListArray.from_arrays(ints(self.origin_offsets), ints(self.origins))
        hits = pa.StructArray.from_arrays([ints(rule), ints(pos), origins], names=["rule", "pos", "from"])
        return {
            "scopes": pa.ListArray.from_arrays(ints(self.scope_offsets), ints(self.scopes)),
            "hits": pa.ListArray.from_arrays(ints(self.hit_offsets), hits),
        }

    def to_arrow(self) -> pa.Array:
        n = len(self)
        offsets = np.asarray(self.offsets, dtype=np.int32)
        place = np.arange(n, dtype=np.int32)
        parent, item, end = (np.frombuffer(c, dtype=np.int32) for c in (self.parent, self.item, self.end))
        first = np.repeat(offsets[:-1], np.diff(offsets))  # of the node's page
        # a node adds one level from the next node to its end
        levels = np.ones(n + 1, dtype=np.int32)
        levels -= np.bincount(first + end + 1, minlength=n + 2)[1:].astype(np.int32)
        depth = np.zeros(n, dtype=np.int32)
        np.cumsum(levels[: n - 1], out=depth[1:]) if n > 1 else None
        attrs = pa.StructArray.from_arrays(
            [sparse_strings(n, rows, values) for rows, values in zip(self.attr_rows, self.attr_values)],
            names=NODE_ATTRS,
        )
        nodes = pa.StructArray.from_arrays(
            [*map(pa.array, (place - first, end, parent, depth, item)), pa.array(self.tag, pa.string()), pa.array(self.text, pa.string()), attrs],
            names=["pos", "end", "parent", "depth", "item", "tag", "text", "attrs"],
        )
        return pa.ListArray.from_arrays(pa.array(offsets), nodes)


def sparse_strings(n: int, rows: array, values: list[str]) -> pa.Array:
    """``n`` texts, NULL but for the ascending ``rows``."""
    if not values:
        return pa.nulls(n, pa.string())
    there = np.zeros(n, dtype=bool)
    there[np.frombuffer(rows, dtype=np.int32)] = True
    dense = pa.array(values, pa.string())
    _, ends, data = dense.buffers()
    before = np.zeros(n + 1, dtype=np.int32)
    np.cumsum(there, out=before[1:])
    starts = np.frombuffer(ends, dtype=np.int32)[before]
    bits = np.packbits(there, bitorder="little")
    return pa.StringArray.from_buffers(n, pa.py_buffer(starts), data, pa.py_buffer(bits))


# Pages are cut into tokens together up to this size, and in those that ``PlainPages`` reads no more elements are open.
CUT_BYTES = 200_000
DEEPEST = 64
BROKEN = object()


def plain_tag(token: str, known: dict[str, Tag | None]) -> Tag | None | object:
    """As ``read_tag``, for the text from a "<" to the next ">"; ``BROKEN`` where a token may not end there."""
    m = TOKEN.fullmatch(token)
    if m is None or m.lastindex == 5:
        return BROKEN  # not a tag, or quotes that go on behind the ">"
    if m.lastindex is None:
        if token.startswith("<!--") and not (len(token) > 6 and token.endswith("-->")):
            return BROKEN
    elif m.lastindex == 3 and not (token[m.end(2)] in "/>" or token[m.end(2)].isspace()):
        return BROKEN  # a quote in the name
    tag = known.get(token, UNKNOWN)
    if tag is UNKNOWN:
        tag = read_tag(m)
        if len(token) <= KNOWN_CHARS and len(known) < KNOWN_TAGS:
            known[token] = tag
    return tag


class Open(dict):
    """The elements that are open at some place of a page, and by kind of tag the step that it makes from there."""

    def __init__(self, names: tuple[str, ...], items: tuple[int, ...], steps: Steps) -> None:
        self.names, self.items, self.steps = names, items, steps  # items: the places of items among the names, from 1

    def __missing__(self, kind: int) -> tuple[int, Open]:
        self[kind] = step = self.steps.learn(self, kind)
        return step


class Steps:
    """What tags do to the open elements: each kind of tag is worked out once for the same open elements.

    ``levels``, by number of the step: how many elements are open before it, after what it closes, and with its
    own; the place of the innermost item among them after what it closes, and with its own.
    """

    def __init__(self, kinds: list[Tag | None]) -> None:
        self.kinds = kinds  # None: the end of a page
        self.known: dict[tuple, Open] = {}
        self.levels: list[tuple[int, int, int, int, int]] = []
        self.start = self.state((), ())

    def state(self, names: tuple[str, ...], items: tuple[int, ...]) -> Open:
        key = (names, items)
        if key not in self.known:
            self.known[key] = Open(names, items, self)
        return self.known[key]

    def learn(self, state: Open, kind: int) -> tuple[int, Open]:
        names, items = state.names, state.items
        tag = self.kinds[kind]

        def close(ends, stops) -> None:
            nonlocal names, items
            for k in range(len(names) - 1, -1, -1):
                if names[k] in ends:
                    names, items = names[:k], tuple(i for i in items if i <= k)
                    return
                if names[k] in stops:
                    return

        if tag is None:
            names = items = ()
        elif tag.end:
            close((tag.name,), END_BARRIER)
        else:
            if tag.closes_p:
                close(*P_END)
            if tag.implied:
                close(*tag.implied)
        left, item = len(names), max(items, default=0)
        if tag is not None and not tag.end and not tag.empty:
            names += (tag.name,)
            if tag.opens:
                items += (len(names),)
        if len(names) > DEEPEST:
            names = items = ()
        after = self.state(names, items)
        self.levels.append((len(state.names), left, len(names), item, max(items, default=0)))
        return len(self.levels) - 1, after


class PlainPages:
    """The nodes of those of several pages in which every "<" begins a token that ends with the next ">".

    Such pages, with ``html`` and ``body`` tags, are cut into tokens together, and only tags that open or close
    elements are looked at one by one. Their nodes are the same as by ``NodeColumns.add_page``, which reads
    all other pages.
    """

    def __init__(self, html: pa.Array, known: dict[str, Tag | None]) -> None:
        self.rank = [-1] * len(html)
        html = html.cast(pa.string())
        _, ends, held = html.buffers()
        if held is None:
            return
        bounds = np.frombuffer(ends, np.int32)[html.offset : html.offset + len(html) + 1].astype(np.int64)
        data = np.frombuffer(held, np.uint8)[bounds[0] : bounds[-1]]
        bounds -= bounds[0]
        lt, gt = np.flatnonzero(data == 60), np.flatnonzero(data == 62)
        page, page_gt = (np.searchsorted(bounds, x, side="right") - 1 for x in (lt, gt))
        counts = np.bincount(page, minlength=len(html))
        good = (counts > 0) & (counts == np.bincount(page_gt, minlength=len(html)))
        lt, gt, page = lt[good[page]], gt[good[page_gt]], page[good[page]]
        good[page[lt > gt]] = False
        good[page[1:][(lt[1:] < gt[:-1]) & (page[1:] == page[:-1])]] = False
        keep = good[page]
        lt, gt, page = lt[keep], gt[keep], page[keep]
        if not len(lt):
            return
        cuts = np.empty(2 * len(lt), np.int32)
        cuts[::2], cuts[1::2] = lt, gt + 1
        pieces = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data.tobytes()))
        tokens = pieces.take(pa.array(np.arange(0, len(cuts), 2))).dictionary_encode()
        code = tokens.indices.to_numpy()
        tags = [plain_tag(t, known) for t in tokens.dictionary.to_pylist()]

        def of_tags(test) -> np.ndarray:
            return np.array([t is not BROKEN and t is not None and test(t) for t in tags], bool)[code]

        good[page[np.array([t is BROKEN for t in tags], bool)[code]]] = False
        for name in ("html", "body"):
            has = np.zeros(len(html), bool)
            has[page[of_tags(lambda t: not t.end and t.name == name)]] = True
            good &= has
        raw = np.zeros(len(lt), bool)  # the text before this tag is that of a script or style
        for name in RAW_TEXT:
            opened = np.flatnonzero(of_tags(lambda t: not t.end and not t.empty and t.name == name))
            closes = of_tags(lambda t: t.end and t.name == name)
            behind = np.minimum(opened + 1, len(lt) - 1)
            closed = (behind > opened) & closes[behind] & (page[behind] == page[opened])
            good[page[opened[~closed]]] = False
            raw[behind[closed]] = True
        started = of_tags(lambda t: not t.end)
        moves = of_tags(lambda t: t.end or not t.empty or t.closes_p or t.implied is not None)
        attributed = of_tags(lambda t: bool(t.attrs))
        keep = good[page]
        lt, gt, page, code, raw, started, moves, attributed = (
            x[keep] for x in (lt, gt, page, code, raw, started, moves, attributed)
        )
        if not len(lt):
            return
        rows, first, counts = np.unique(page, return_index=True, return_counts=True)
        number = np.repeat(np.arange(len(rows)), counts)  # of the token's page
        behind = first + counts - 1

        # texts before the tokens, and behind the last token of each page
        begin = np.empty(len(lt), np.int64)
        begin[1:] = gt[:-1] + 1
        begin[first] = bounds[rows]
        text = begin < lt
        tail_begin, tail_end = gt[behind] + 1, bounds[rows + 1]
        tail = tail_begin < tail_end
        made = text.astype(np.int64) + started
        sizes = np.add.reduceat(made, first) + tail
        base = np.concatenate([[0], np.cumsum(sizes)])
        before = np.cumsum(made) - made + np.repeat(np.concatenate([[0], np.cumsum(tail)[:-1]]), counts)
        place = before + text  # of the token's node among all nodes
        tail_place = base[1:] - 1

        total = int(base[-1])
        # the tags that open or close elements, and the end of each page
        kinds: dict[tuple, int] = {}
        kind = [kinds.setdefault((t.end, t.name, t.opens, t.empty), len(kinds)) if isinstance(t, Tag) else -1 for t in tags]
        of_kind = {k: t for k, t in zip(kind, tags) if k >= 0}
        steps = Steps([*(of_kind[k] for k in range(len(kinds))), None])
        move = np.flatnonzero(moves)
        upto = np.cumsum(moves)
        closing = upto[behind] + np.arange(len(rows))  # the ends of pages among the steps
        moving = upto[move] - 1 + number[move]
        what, where = (np.empty(len(move) + len(rows), np.int64) for _ in range(2))
        what[moving], where[moving] = np.array(kind)[code[move]], place[move]
        what[closing], where[closing] = len(kinds), base[1:]
        state, taken = steps.start, []
        add = taken.append
        for k in what.tolist():
            step, state = state[k]
            add(step)
        was, left, now, item_left, item_now = np.array(steps.levels, np.int64)[np.array(taken)].T
        # the element that is the n-th of the open ones at a step: the last that became the n-th before it
        count = len(what) + 1
        pushed = np.flatnonzero(now > left)
        order = np.argsort(now[pushed], kind="stable")
        became = (now[pushed] * count + pushed)[order]

        def nth_open(n: np.ndarray, step: np.ndarray) -> np.ndarray:
            """Which of ``pushed`` is the n-th open element just before a step."""
            return order[np.maximum(np.searchsorted(became, n * count + step) - 1, 0)]

        home = np.concatenate([np.repeat(base[:-1], counts)[move], base[:-1]])[np.argsort(np.concatenate([moving, closing]))]
        pushed_place = (where - home)[pushed].astype(np.int32)

        def position(n: np.ndarray, step: np.ndarray) -> np.ndarray:
            return np.where(n > 0, pushed_place[nth_open(n, step)], -1) if len(pushed) else np.full(len(n), -1)

        gone = was - left  # elements that a step closes
        closer = np.repeat(np.arange(len(what)), gone)
        nth = np.arange(len(closer)) - np.repeat(np.cumsum(gone) - gone, gone) + 1 + left[closer]
        self.end = (np.arange(total) - np.repeat(base[:-1], sizes)).astype(np.int32)
        if len(closer):
            self.end[where[pushed[nth_open(nth, closer)]]] = (where - home)[closer] - 1
        tops, inside = (position(n, np.arange(1, count)) for n in (now, item_now))
        own = moving[started[move]]  # steps of tags with nodes of their own
        self.parent, self.item = np.empty(total, np.int32), np.empty(total, np.int32)
        self.parent[where[own]], self.item[where[own]] = position(left[own], own), position(item_left[own], own)
        # what is open before a token, and at the end of a page: -1 before the first step
        since = upto - moves + number - 1
        last = closing - 1
        start = np.zeros(len(lt), bool)
        start[first] = True
        fresh = np.maximum.accumulate(np.where(start, np.arange(len(lt)), 0))  # first token of the page
        none = upto - moves == (upto - moves)[fresh]
        still = started & ~moves
        for nodes, before_step, bare in ((before[text], since[text], none[text]), (place[still], since[still], none[still]), (tail_place[tail], last[tail], np.zeros(int(tail.sum()), bool))):
            self.parent[nodes] = np.where(bare, -1, tops[before_step])
            self.item[nodes] = np.where(bare, -1, inside[before_step])
        deep = set(np.searchsorted(closing, np.flatnonzero((left == DEEPEST) & (now == 0))).tolist())

        names = np.empty(len(tags), object)
        names[:] = [getattr(t, "name", None) for t in tags]
        tag = np.full(total, TEXT, object)
        tag[place[started]] = names[code[started]]
        self.tag = tag.tolist()
        cut = np.concatenate([begin[text], tail_begin[tail]]).tolist()
        stop = np.concatenate([lt[text], tail_end[tail]]).tolist()
        whole = data.tobytes()
        if whole.isascii():
            page_text = whole.decode()
            found = [page_text[a:b] for a, b in zip(cut, stop)]
        else:
            found = [whole[a:b].decode() for a, b in zip(cut, stop)]
        as_is = np.concatenate([raw[text], np.zeros(int(tail.sum()), bool)]).tolist()
        values = np.empty(len(found), object)
        values[:] = [unescape(t) if "&" in t and not r else t for t, r in zip(found, as_is)]
        texts = np.full(total, None, object)
        texts[np.concatenate([before[text], tail_place[tail]])] = values
        self.text = texts.tolist()
        with_attrs = np.flatnonzero(attributed)
        self.attrs = [(g, tags[c].attrs) for g, c in zip(place[with_attrs].tolist(), code[with_attrs].tolist())]
        self.attr_bounds = np.searchsorted(with_attrs, np.append(first, len(lt))).tolist()
        self.base = base.tolist()
        for i, row in enumerate(rows.tolist()):
            if i not in deep:
                self.rank[row] = i

    def add_to(self, columns: NodeColumns, row: int) -> bool:
        """Add the nodes of a page, if it is one of the plain ones."""
        i = self.rank[row]
        if i < 0:
            return False
        a, b = self.base[i], self.base[i + 1]
        shift = len(columns.tag) - a
        columns.tag += self.tag[a:b]
        columns.text += self.text[a:b]
        for column, values in ((columns.parent, self.parent), (columns.item, self.item), (columns.end, self.end)):
            column.frombytes(values[a:b].tobytes())
        attr_rows, attr_values = columns.attr_rows, columns.attr_values
        for g, attrs in self.attrs[self.attr_bounds[i] : self.attr_bounds[i + 1]]:
            for slot, value in attrs:
                attr_rows[slot].append(g + shift)
                attr_values[slot].append(value)
        return True


def shred_batches(
    batches: Iterator[pa.RecordBatch], sites: dict[str, SitePaths] | None = None
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [i for i, name in enumerate(batch.schema.names) if name != "html"]
        html = batch.column(batch.schema.get_field_index("html"))
        source = batch.column(batch.schema.get_field_index("source")) if sites else None
        start, chars, cols = 0, 0, NodeColumns(sites)

        def flush(stop: int) -> pa.RecordBatch:
            part = batch.slice(start, stop - start)
            arrays = [part.column(i) for i in keep]
            names = [batch.schema.names[i] for i in keep]
            made = {"nodes": cols.to_arrow()}
            if sites:
                made |= cols.matches_to_arrow()
            return pa.RecordBatch.from_arrays([*arrays, *made.values()], names=[*names, *made])

        sizes = pc.fill_null(pc.binary_length(html), 0).to_pylist()
        cut, cut_end = 0, 0  # rows that are cut into tokens together
        for row in range(batch.num_rows):
            if row >= cut_end:
                cut, cut_end, held = row, row + 1, sizes[row]
                while cut_end < batch.num_rows and held + sizes[cut_end] <= CUT_BYTES:
                    held += sizes[cut_end]
                    cut_end += 1
                plain = PlainPages(html.slice(cut, cut_end - cut), cols.known)
            if sizes[row]:
                name = source[row].as_py() if sites else None
                if sites and name in sites or not plain.add_to(cols, row - cut):
                    cols.add_page(html[row].as_py(), name)
                chars += sizes[row]
            cols.close_row()
            if len(cols) >= MAX_NODES or chars >= MAX_CHARS:
                yield flush(row + 1)
                start, chars, cols = row + 1, 0, NodeColumns(sites)
        if start < batch.num_rows:
            yield flush(batch.num_rows)


INTS = T.ArrayType(T.IntegerType())
HIT_TYPE = T.StructType(
    [T.StructField("rule", T.IntegerType()), T.StructField("pos", T.IntegerType()), T.StructField("from", INTS)]
)
MATCH_FIELDS = [T.StructField("scopes", INTS), T.StructField("hits", T.ArrayType(HIT_TYPE))]


def shred_pages(pages: DataFrame, sites: dict[str, SitePaths] | None = None) -> DataFrame:
    """Replace the ``html`` column of a page table by ``nodes ARRAY<STRUCT<...>>``.

    ``sites`` are the paths of sites by ``source``; their pages get ``scopes`` (the scope elements)
    and ``hits`` (what each rule's path reaches, and from which scopes). Pages of other sites
    have none.

    All other columns pass through, so select only what later steps need: neither a
    filter nor a column list moves below the Python node by itself.
    """
    schema = T.StructType(
        [f for f in pages.schema.fields if f.name != "html"]
        + [T.StructField("nodes", T.ArrayType(NODE_TYPE))]
        + (MATCH_FIELDS if sites else [])
    )
    # Ship these modules by value: executors need not have the package installed.
    for module in (sys.modules[__name__], paths):
        cloudpickle.register_pickle_by_value(module)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return shred_batches(batches, sites)

    return pages.mapInArrow(run, schema)
