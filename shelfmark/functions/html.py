"""The one Python step: read HTML once and return the texts the rules ask for.

Class selectors with nesting cannot be written as Spark expressions, so an
Arrow-batched map scans each page a single time and returns, per rule, the
list of texts it matched. Everything after that (fallbacks, clean-up, defaults)
is Spark code in ``operators.fields``.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from html import unescape

import pyarrow as pa

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# An opening tag of these closes an open one of the same name.
_SELF_CLOSING = frozenset(("li", "p", "option", "tr", "td", "th", "dt", "dd"))

_IN_TAG = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_TOKEN = re.compile(
    rf"""(?P<text>(?:[^<]++|<(?![a-zA-Z/!?]))++)
    |<(?P<raw>script|style)\b(?P<raw_attrs>{_IN_TAG})>(?P<body>.*?)(?:</(?P=raw)[^>]*>|\Z)
    |<(?P<open>[a-zA-Z][^\s/>]*+)(?P<attrs>{_IN_TAG})>
    |</(?P<close>[a-zA-Z][^\s/>]*+)[^>]*+>
    |<!--.*?(?:-->|\Z)
    |<[!?/][^>]*+>""",
    re.VERBOSE | re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(
    r"""(?<![^\s"'/])(class|id|href)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE
)


def _attributes(text: str) -> dict[str, str]:
    """The attributes that rules look at; the first of a name counts."""
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


class Page:
    """Elements of one page in document order, with the texts in and below each."""

    def __init__(self, html: str):
        # Element 0 is the page itself.
        self.tags = ["#root"]
        self.parents = [-1]
        self.own: list[list[str]] = [[]]  # texts directly inside an element
        self._attrs: dict[int, dict[str, str]] = {}
        self._texts: list[str] = []  # all texts of the page
        self._text_from = [0]
        self._text_to: dict[int, int] = {}
        self._end: dict[int, int] = {}  # first element after the subtree
        self._by_tag: dict[str, list[int]] = {}
        self._by_class: dict[str, list[int]] = {}
        self._scan(html)

    def _scan(self, html: str) -> None:
        is_open = [0]
        opened: dict[str, int] = {}  # open elements of each name

        def close_last() -> None:
            i = is_open.pop()
            if i:
                opened[self.tags[i]] -= 1
            self._close(i)

        for token in _TOKEN.finditer(html):
            kind = token.lastgroup
            if kind == "text":
                self._text(token["text"], is_open[-1])
            elif kind == "attrs":
                tag = token["open"].lower()
                if tag in _SELF_CLOSING and self.tags[is_open[-1]] == tag:
                    close_last()
                is_open.append(self._add(tag, token["attrs"], is_open[-1]))
                opened[tag] = opened.get(tag, 0) + 1
                if tag in _VOID:
                    close_last()
            elif kind == "close":
                tag = token["close"].lower()
                # An end tag without its element costs nothing, and a look at an open
                # element is paid for by closing it.
                while opened.get(tag):
                    found = self.tags[is_open[-1]] == tag
                    close_last()
                    if found:
                        break
            elif kind == "body":
                i = self._add(token["raw"].lower(), token["raw_attrs"], is_open[-1])
                if token["body"]:
                    self._text(token["body"], i)
                self._close(i)
        while is_open:
            close_last()

    def _add(self, tag: str, attributes: str, parent: int) -> int:
        i = len(self.tags)
        self.tags.append(tag)
        self.parents.append(parent)
        self.own.append([])
        self._text_from.append(len(self._texts))
        if "=" in attributes:
            found = self._attrs[i] = _attributes(attributes)
            value = found.get("class", "")
            for name in {value, *value.split()}:
                self._by_class.setdefault(name, []).append(i)
        return i

    def _text(self, text: str, owner: int) -> None:
        if "&" in text:
            text = unescape(text)
        self._texts.append(text)
        self.own[owner].append(text)

    def _close(self, i: int) -> None:
        self._text_to[i] = len(self._texts)
        self._end[i] = len(self.tags)

    def tagged(self, tag: str, under: int = 0) -> list[int]:
        """Elements with a tag name below ``under``, in document order."""
        if tag not in self._by_tag:
            self._by_tag[tag] = [i for i, t in enumerate(self.tags) if t == tag]
        return self._below(self._by_tag[tag], under)

    def _below(self, found: list[int], under: int) -> list[int]:
        return found[bisect_right(found, under) : bisect_left(found, self._end[under])]

    def classed(self, name: str, under: int = 0) -> list[int]:
        """Elements with ``name`` as one class or as their whole class value."""
        return self._below(self._by_class.get(name, []), under)

    def value(self, i: int, attribute: str) -> str:
        """A class, id or href; empty where the element has none."""
        return self._attrs[i].get(attribute, "") if i in self._attrs else ""

    def with_id(self, name: str) -> list[int]:
        """Elements with an id."""
        return [i for i, found in self._attrs.items() if found.get("id") == name]

    def texts(self, i: int) -> list[str]:
        """All texts below an element, in order."""
        return self._texts[self._text_from[i] : self._text_to[i]]

    def squeezed(self, i: int) -> str:
        """All texts below an element, each stripped, run together."""
        return "".join(t.strip() for t in self.texts(i))


Rule = Callable[[Page], list[str]]


_MARKUP = re.compile(r"<[^>]*+>")


def _occurs(html: str, markers: tuple[str, ...]) -> bool:
    """Case is ignored, as the scanner does for tags; a text may be split by inner markup."""
    lowered = html.lower()
    wanted = [m.lower() for m in markers]
    if any(m in lowered for m in wanted):
        return True
    for text in (unescape(lowered), unescape(_MARKUP.sub("", lowered))):
        if any(m in text for m in wanted):
            return True
    return False


def match_rules(
    batches: Iterator[pa.RecordBatch], rules: dict[str, Rule], markers: tuple[str, ...]
) -> Iterator[pa.RecordBatch]:
    """Replace the ``html`` column by one list-of-text column per rule.

    ``markers`` are strings of which a page must contain one, after entities are
    decoded, for any rule to match; a page without them is not scanned.
    """
    for batch in batches:
        found: dict[str, list[list[str]]] = {name: [] for name in rules}
        for html in batch.column("html").to_pylist():
            page = Page(html) if html and _occurs(html, markers) else None
            for name, rule in rules.items():
                found[name].append(rule(page) if page else [])
        kept = [n for n in batch.schema.names if n != "html"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in kept]
            + [pa.array(v, pa.list_(pa.string())) for v in found.values()],
            names=kept + list(found),
        )
