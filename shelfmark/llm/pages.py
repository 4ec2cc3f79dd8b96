"""Main text of web pages by smoothed text-to-tag ratios (operator 5).

The standard library's parser streams over the whole page. Its events give
lines: runs of text between block elements, each with the number of tags met in
it and the characters that stand in links. Elements that never hold article
text (by name, role, class or id) are left out with all below them. Blocks left
out by class or id, and forms, are kept if a ``main`` stands in them, or an
``article`` and none elsewhere, or if those of one name hold most of the page's
high-ratio text: layouts use such names for wrappers of the whole page.

Every line has a ratio, its text characters outside links for each of its tags.
The ratios are smoothed by a Gaussian along the page, and split by two-means
into a high and a low cluster: lines of the high cluster are content. The
content region is the ``article`` or ``main`` element with most content, with
the lines of the ``main`` around it and the other articles there with ``SIBLING``
of its text or more; if the page has none, the stretch from the first to the last content line, with the
headings before it and the rest of the division that holds most content. All
lines of the region are kept, however short; outside an article lines of links
go, unless one stands between two lines of text of the chosen division.

Cases: a null or empty page, or one without text, gives an empty text; unclosed
and wrongly nested elements are closed by their parents, end tags without an element cost
nothing, and tags that never end are text; repeated rows get
equal answers; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import table

SIGMA = 1.0  # of the smoothing, in lines
_FEED = 1 << 16
SIBLING = 0.25  # share of the heaviest region's text that makes another one part of the article

#: Fixed values of HTML.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main"
    " menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul"
    .split()
)
#: What closes an open paragraph, item or cell.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
_CLOSES |= {"tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: Elements without article text.
_OUT = set(
    "script style noscript template iframe object embed svg canvas audio video head title nav"
    " footer aside form button select textarea input dialog menu search datalist".split()
)
_OUT_ROLES = set(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar"
    " toolbar tablist".split()
)
_OUT_NAMES = (
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo"
    " promotion cookie cookies consent gdpr notice newsletter subscribe subscription popup modal"
    " overlay sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer masthead"
    " comment comments commentlist disqus replies respond share sharing social related"
    " recommended recommendations widget widgets pagination pager login signup toolbar"
).split()
_OUT_NAME = re.compile(
    rf"(?:(?!has|with|no|without)[a-z0-9]+[-_]+)*(?:{'|'.join(_OUT_NAMES)})(?:[-_]*\d+|[-_]+[a-z0-9_-]*)?",
    re.IGNORECASE,
)
_BOXES = {"body", "div", "section", "td", "center"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
_NEVER_OUT = {"html", "body", "main", "article"}
#: Of readers, however long.
_COMMENTS = re.compile(r".*(?:comment|disqus|replies|respond).*", re.IGNORECASE)
_BEGINS = re.compile("<(?=[a-zA-Z/])")
_HEADERS = re.compile(r"(?:(?:site|page|top|main|global)[-_]?)?header", re.IGNORECASE)


@dataclass
class Line:
    text: str
    tags: int
    linked: int
    region: int  # number of the article or main element, 0 outside
    box: int  # number of the division it stands in
    heading: bool
    within: tuple[int, ...]  # numbers of the doubtful blocks it stands in


class Lines(HTMLParser):
    """Collects the lines of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        #: name, left out, region, box, doubtful blocks
        self.open: list[tuple[str, bool, int, int, tuple[int, ...]]] = []
        self.doubtful: list[tuple[str, ...]] = []  # the names of each
        self.mains: set[int] = set()  # doubtful blocks with a main
        self.articles: set[int] = set()
        self.plain = False  # an article or main stands in no doubtful block
        self.text: list[str] = []
        self.counts: Counter[str] = Counter()  # open elements by name
        self.parents: dict[int, int] = {}  # of a region, the one it stands in
        self.tags = self.linked = self.links = self.regions = self.boxes = 0

    def _state(self) -> tuple[bool, int]:
        return (self.open[-1][1], self.open[-1][2]) if self.open else (False, 0)

    def _within(self) -> tuple[int, ...]:
        return self.open[-1][4] if self.open else ()

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            heading = any(x[0] in _HEADINGS for x in self.open[-3:])
            box = self.open[-1][3] if self.open else 0
            self.lines.append(
                Line(text, self.tags, self.linked, self._state()[1], box, heading, self._within())
            )
        self.text, self.tags, self.linked = [], 0, 0

    def _out(self, tag: str, given: dict[str, str | None], region: int) -> tuple[bool, tuple]:
        """Is it left out; and if that is in doubt, its names."""
        if tag in _NEVER_OUT and not (tag == "article" and region):
            return False, ()
        role = (given.get("role") or "").lower()
        form = tag == "form" and role in ("", "form")
        if "hidden" in given or not form and (tag in _OUT or role in _OUT_ROLES):
            return True, ()
        names = f"{given.get('class') or ''} {given.get('id') or ''}".split()
        if tag == "header" or any(_HEADERS.fullmatch(n) for n in names):
            if not region:
                return True, ()
        found = tuple(n for n in names if _OUT_NAME.fullmatch(n))
        if form:
            found += ("form",)
        if found and tag in _BLOCKS:
            return False, found
        return bool(found), ()

    def handle_starttag(self, tag, attrs):
        out, region = self._state()
        if tag in _BLOCKS:
            self.flush()
            if tag in _CLOSES:
                self._close(_CLOSES[tag], {"ul", "ol", "dl", "table", "select"})
            else:
                self._close({"p"}, {"div", "td", "th", "li", "article", "main", "section", "body"})
            out, region = self._state()
        if not out:
            self.tags += 1
        if tag in _VOID:
            if tag == "br" and not out:
                self.text.append(" ")
            return
        given = dict(attrs)
        gone, names = (True, ()) if out else self._out(tag, given, region)
        within = self._within()
        if names:
            within += (len(self.doubtful),)
            self.doubtful.append(names)
        if not gone and (
            tag in ("article", "main") or (given.get("role") or "").lower() in ("main", "article")
        ):
            if not region or tag == "article":
                self.regions += 1
                self.parents[self.regions] = region
                region = self.regions
            self.plain |= not within
            main = tag == "main" or (given.get("role") or "").lower() == "main"
            (self.mains if main else self.articles).update(within)
        if tag == "a" and not gone:
            self.links += 1
        if tag in _BOXES:
            self.boxes += 1
            box = self.boxes
        else:
            box = self.open[-1][3] if self.open else 0
        self.open.append((tag, gone, region, box, within))
        self.counts[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def _close(self, tags: set[str], within: set[str]) -> None:
        """Close the nearest open element of these names, if none of ``within`` is nearer."""
        if not any(self.counts[t] for t in tags):
            return
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if name in tags:
                self._pop(i)
                return
            if name in within:
                return

    def _pop(self, at: int) -> None:
        for name, gone, *_ in self.open[at:]:
            self.counts[name] -= 1
            if name == "a" and not gone:
                self.links -= 1
        del self.open[at:]

    def handle_endtag(self, tag):
        if tag in _VOID:
            return
        out, _ = self._state()
        if not out:
            self.tags += 1
        if tag in _BLOCKS:
            self.flush()
        if not self.counts[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self._pop(i)
                return

    def handle_data(self, data):
        if self._state()[0]:
            return
        self.text.append(data)
        if self.links:
            self.linked += len(data.strip())


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    over = np.convolve(ratios, kernel)[reach : reach + len(ratios)]
    return over / np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """Middle between the means of two clusters."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        cut = (low + high) / 2
        upper = values >= cut
        if upper.all() or not upper.any():
            return low
        new = float(values[~upper].mean()), float(values[upper].mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def ratios(lines: list[Line]) -> tuple[np.ndarray, np.ndarray]:
    """Text characters outside links, and which lines are content."""
    plain = np.array([max(len(x.text) - x.linked, 0) for x in lines], dtype=float)
    ratio = smoothed(plain / np.array([max(x.tags, 1) for x in lines]))
    return plain, ratio >= threshold(ratio)


def kept_lines(parser: Lines) -> list[Line]:
    """Lines without those of doubtful blocks that are no article text."""
    lines = parser.lines
    if not any(x.within for x in lines):
        return lines
    held: dict[tuple[str, ...], float] = {}
    plain, content = ratios(lines)
    for i in np.flatnonzero(content).tolist():
        for names in {parser.doubtful[b] for b in lines[i].within}:
            held[names] = held.get(names, 0) + plain[i]
    most = plain[content].sum() / 2
    good = set(parser.mains) | (set() if parser.plain else parser.articles)
    for block, names in enumerate(parser.doubtful):
        if held.get(names, 0) > most and not any(_COMMENTS.fullmatch(n) for n in names):
            good.add(block)
    return [x for x in lines if good.issuperset(x.within)]


def together(parser: Lines, weight: dict[int, float], best: int) -> set[int]:
    """Regions of the article: the heaviest, what it stands in, and what else stands there with
    ``SIBLING`` of its text or more."""
    above = {0}
    region = best
    while region:
        above.add(region)
        region = parser.parents[region]
    root = min(above - {0})
    kept = set(above)
    for region, own in weight.items():
        path = [region]
        while parser.parents[path[-1]]:
            path.append(parser.parents[path[-1]])
        if path[-1] == root and own >= SIBLING * weight[best]:
            kept.update(path)
    return kept - {0}


def main_text(html: str) -> str:
    """The article of a page, a line for each block."""
    parser = Lines()
    # No tag ends behind the last bracket: what begins there is text, not looked through again.
    end = html.rfind(">") + 1
    if "<" in html[end:]:
        html = html[:end] + _BEGINS.sub("&lt;", html[end:])
    for low in range(0, len(html), _FEED):
        parser.feed(html[low : low + _FEED])
    parser.close()
    parser.flush()
    lines = kept_lines(parser)
    if not lines:
        return ""
    plain, content = ratios(lines)
    weight: dict[int, float] = {}
    sizes: dict[int, float] = {}  # in characters, of all lines
    for line, own, chosen in zip(lines, plain, content, strict=True):
        if line.region:
            sizes[line.region] = sizes.get(line.region, 0) + own
            weight[line.region] = weight.get(line.region, 0) + own * (1 if chosen else 1e-3)
    if weight:
        best = max(weight, key=lambda r: (weight[r], -r))
        regions = together(parser, sizes, best)
        kept = [x.text for x in lines if x.region in regions]
    else:
        at = np.flatnonzero(content)
        first, last = int(at[0]), int(at[-1])
        inside: dict[int, float] = {}
        for i in at.tolist():
            inside[lines[i].box] = inside.get(lines[i].box, 0) + plain[i]
        best = max(inside, key=lambda b: (inside[b], -b))
        own = [i for i, x in enumerate(lines) if x.box == best]
        first, last = min(first, own[0]), max(last, own[-1])
        while first and lines[first - 1].heading:
            first -= 1
        linked = [2 * x.linked >= len(x.text) for x in lines]
        # A block of links between two of text of the article's own division stays.
        kept = [
            x.text
            for i, x in enumerate(lines[first : last + 1], first)
            if not linked[i]
            or first < i < last
            and not (linked[i - 1] or linked[i + 1])
            and lines[i - 1].box == x.box == lines[i + 1].box == best
        ]
    return "\n".join(kept)


def extracted(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            for low in range(0, batch.num_rows, 256):
                part = batch.column(2).slice(low, 256).to_pylist()
                texts += [main_text(h) if h else "" for h in part]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op5_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
