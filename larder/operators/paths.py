"""Matching of site rules while a page is shredded: which elements the paths of its site reach.

A site's paths are compiled to segments: a run of child steps is looked up by its last step and checked from
parent to parent; segments are linked by the positions of their elements. All look-ups go through the page's
element lists by tag and attribute, so a path costs the elements that it may match, not the page. Ranks among
siblings and the tags of children are computed once per parent.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass

TEXT = "#text"
EVERY = "*"
BLANK = re.compile(r"[ \t\n\x0b\f\r]")


@dataclass(frozen=True)
class Test:
    """What an element must be; ``slot`` is the place of the attribute among those that are kept."""

    tag: str | None
    slot: int | None
    op: str
    value: str | None
    nth: int | None
    has: tuple[str, ...]
    lacks: tuple[str, ...]
    text_of: str | None
    text_op: str
    text_value: str | None


@dataclass(frozen=True)
class Segment:
    """A run of child steps: how its head is reached, where its last element is listed, tests from there up."""

    axis: str
    key: str
    test: Test
    ups: tuple[Test, ...]


@dataclass(frozen=True)
class Rule:
    """One pick of a layout: its number among all of the site, and whether it starts at the scope elements."""

    no: int
    inside: bool
    path: tuple[Segment, ...]


@dataclass(frozen=True)
class SitePaths:
    """Layouts in the order they are tried: the path of the scope elements and the picks."""

    layouts: tuple[tuple[tuple[Segment, ...], tuple[Rule, ...]], ...]


class Page:
    """One page: tags, parents, texts and ends of its nodes, attributes and element lists."""

    def __init__(
        self, tags: list[str], parents: Sequence[int], texts: list[str | None], ends: Sequence[int],
        attrs: dict[int, dict[int, str]], index: dict[str, list[int]],
    ):
        self.tags, self.parents, self.texts, self.ends, self.attrs, self.index = tags, parents, texts, ends, attrs, index
        self.child_lists: dict[int, list[int]] = {}
        self.ranks: dict[tuple[int, Test], dict[int, int]] = {}

    def children(self, pos: int) -> list[int]:
        found = self.child_lists.get(pos)
        if found is None:
            found, at, end = [], pos + 1, self.ends[pos] if pos >= 0 else len(self.tags) - 1
            while at <= end:
                found.append(at)
                at = self.ends[at] + 1
            self.child_lists[pos] = found
        return found

    def plain(self, pos: int, t: Test) -> bool:
        """Tag and attribute."""
        if t.tag is not None and self.tags[pos] != t.tag:
            return False
        if t.slot is None:
            return True
        value = self.attrs.get(pos, {}).get(t.slot)
        if value is None:
            return False
        if t.op == "eq":
            return value == t.value
        if t.op == "contains":
            return t.value in value
        if t.op == "starts":
            return value.startswith(t.value)
        return t.op == "present" or f" {t.value} " in f" {BLANK.sub(' ', value)} "

    def rank(self, pos: int, t: Test) -> int:
        """Place of an element among the siblings that pass the plain test, from 1."""
        parent = self.parents[pos]
        found = self.ranks.get((parent, t))
        if found is None:
            passing = [c for c in self.children(parent) if self.tags[c] != TEXT and self.plain(c, t)]
            found = self.ranks[parent, t] = {c: i for i, c in enumerate(passing, 1)}
        return found[pos]

    def _probe(self, pos: int, text_of: str) -> str | None:
        if text_of == ".":
            return next((self.texts[c] for c in self.children(pos) if self.tags[c] == TEXT), None)
        first = next((c for c in self.children(pos) if self.tags[c] == text_of), None)
        if first is None:
            return None
        return "".join(self.texts[i] for i in range(first, self.ends[first] + 1) if self.tags[i] == TEXT)

    def fits(self, pos: int, t: Test) -> bool:
        if not self.plain(pos, t) or t.nth is not None and self.rank(pos, t) != t.nth:
            return False
        if t.has or t.lacks:
            tags = {self.tags[c] for c in self.children(pos)}
            if not tags.issuperset(t.has) or not tags.isdisjoint(t.lacks):
                return False
        if t.text_of is not None:
            text = self._probe(pos, t.text_of)
            return text is not None and (text.startswith(t.text_value) if t.text_op == "starts" else t.text_value in text)
        return True

    def hits(self, segment: Segment) -> list[tuple[int, int]]:
        """(last element, head) of every match of a segment, in document order."""
        if segment.key == EVERY:
            places = [i for i, tag in enumerate(self.tags) if tag != TEXT]
        else:
            places = self.index.get(segment.key, ())
        found = []
        for pos in places:
            if not self.fits(pos, segment.test):
                continue
            head = pos
            for test in segment.ups:
                head = self.parents[head]
                if head < 0 or not self.fits(head, test):
                    break
            else:
                found.append((pos, head))
        return found

    def above(self, axis: str, earlier: list[int], heads: list[int], head: int) -> list[int]:
        """Those of the elements ``earlier`` (sorted) from which ``head`` is reached; ``heads`` are its rivals."""
        parents, ends = self.parents, self.ends
        parent = parents[head]
        before = earlier[: bisect_right(earlier, head - (axis != "self"))]
        if axis == "child":
            return [a for a in before if a == parent]
        if axis in ("desc", "deep", "self"):
            return [a for a in before if head <= ends[a] and not (axis == "deep" and a == parent)]
        found = [a for a in before if parents[a] == parent]
        if axis == "after":
            between = lambda a: any(a < o < head and parents[o] == parent for o in heads)
            return [a for a in found if not between(a)]
        return found

    def follow(self, path: tuple[Segment, ...], scopes: list[int] | None) -> dict[int, list[int]]:
        """The elements that a path reaches, each with the scope elements that it is reached from.

        Without ``scopes`` the path starts anywhere in the page.
        """
        reached: dict[int, list[int]] = {}
        for step, segment in enumerate(path):
            hits = self.hits(segment)
            heads = [h for _, h in hits]
            now: dict[int, list[int]] = {}
            earlier = sorted(reached) if step else scopes
            for pos, head in hits:
                if earlier is None:
                    now[pos] = []
                    continue
                over = self.above(segment.axis, earlier, heads, head)
                if over:
                    origins = {s for a in over for s in reached[a]} if step else over
                    now[pos] = sorted({*now.get(pos, ()), *origins})
            reached = now
        return reached


def match(page: Page, site: SitePaths) -> tuple[list[int], list[tuple[int, int, list[int]]]]:
    """Scope elements of the first layout that has any, and (rule, element, scopes it belongs to) of its picks."""
    for base, rules in site.layouts:
        scopes = sorted(page.follow(base, None))
        if scopes:
            hits = [
                (rule.no, pos, origins)
                for rule in rules
                for pos, origins in page.follow(rule.path, scopes if rule.inside else None).items()
            ]
            return scopes, hits
    return [], []
