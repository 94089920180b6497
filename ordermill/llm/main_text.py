"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clusters."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements that start a new line of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td"
    " tfoot th thead title tr ul".split()
)
#: Elements without content, elements whose content is never main text, and elements that may be the content region.
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "nav footer aside form script style noscript template head title iframe object svg math canvas audio video button select textarea"
    " datalist dialog menu search map".split()
)
REGIONS = frozenset("article main section div td body html".split())
#: What an open element ends when it starts without an end tag before.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Words of class and id attributes that mark what is not main text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr"
    " notice notices notification alert sidebar sidebars aside menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments"
    " commentlist commentform disqus respond reply replies discussion share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay"
    " widget widgets pagination pager toolbar".split()
)
#: Those that name what is never an article's own text, and the elements whose names are heeded inside an article.
ALWAYS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored comment comments commentlist commentform disqus"
    " cookie cookies consent gdpr newsletter".split()
)
CONTAINERS = frozenset("div section aside ul ol dl table figure span".split())
#: Words of names that say how a part is laid out, not what it is.
LAYOUT = frozenset(
    "box block container wrapper wrap inner outer left right top bottom area item items list link links section panel col row bar button buttons text"
    " content body group holder small large".split()
)
_WORD = re.compile("[A-Z]?[a-z]+|[A-Z]+")
_TAG = re.compile("<[A-Za-z/!?]")
_STATE = re.compile(r"(?:has|no|with|without|is|not)[-_]|.*[-_](?:open|enabled|disabled|visible|hidden)$", re.I)


def _names(value: str) -> set[str]:
    """The words of a class or id, but for names of a state such as has-sidebar."""
    return {word.lower() for name in value.split() if not _STATE.match(name) for word in _WORD.findall(name)}


class Line(NamedTuple):
    text: str
    tags: int  # met since the last line
    links: int  # characters in links
    region: int  # the innermost region around it, -1 for none
    part: int  # the innermost part of doubtful name around it, -1 for none


class _Lines(HTMLParser):
    """Collects lines outside dropped elements. Regions and parts are numbered as they open and know the one around them.

    What is open is found by counts and by the places of the open blocks, so a page costs in proportion to its length, however it is nested.
    """

    def __init__(self, marks: bool) -> None:
        super().__init__(convert_charrefs=True)
        self.marks = marks
        self.open: list[tuple[str, bool, int, int]] = []  # tag, dropped, region and part before it
        self.blocks: list[int] = []  # places of the open blocks
        self.counts: Counter[str] = Counter()  # open blocks by tag
        self.inline: list[Counter[str]] = [Counter()]  # open other elements by tag, inside each open block
        self.dropped = self.contents = self.links = 0  # open dropped elements, articles and mains, links
        self.region = self.part = -1
        self.around: list[int] = []  # the region around each region
        self.outer: list[int] = []  # the part around each part
        self.articles: set[int] = set()  # regions that are article or main elements
        self.parts: list[str] = []
        self.tags = self.linked = 0
        self.lines: list[Line] = []

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            self.lines.append(Line(text, max(1, self.tags), self.linked, self.region, self.part))
            self.tags = 0
        self.linked = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += not self.dropped
        if tag == "br":
            self.parts.append(" ")
        if tag in BLOCKS:
            self.end_line()
            self._close_implied(tag)
        if tag in VOID:
            return
        verdict = self._marked(tag, attrs)
        dropped = tag in DROPPED or tag == "header" and not self.contents or verdict == "drop"
        self.open.append((tag, dropped, self.region, self.part))
        if tag in REGIONS:
            self.around.append(self.region)
            self.region = len(self.around) - 1
            if tag in ("article", "main"):
                self.articles.add(self.region)
        if verdict == "doubt":
            self.outer.append(self.part)
            self.part = len(self.outer) - 1
        if tag in BLOCKS:
            self.blocks.append(len(self.open) - 1)
            self.counts[tag] += 1
            self.inline.append(Counter())
        else:
            self.inline[-1][tag] += 1
        self.contents += tag in ("article", "main")
        self.links += tag == "a"
        self.dropped += dropped

    def _marked(self, tag: str, attrs: list[tuple[str, str | None]]) -> str:
        """`drop`, `doubt` or nothing. Inside an article only containers are judged by name, and a class that merely has such a word, or an id,
        which is often made of a heading's words, leaves a doubt that the part's own text decides."""
        if not attrs or tag in ("html", "body", "main") or tag == "article" and not self.contents:
            return ""
        doubt = ""
        for name, value in attrs:
            value = value or ""
            if name == "role" and value.strip().lower() in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
                return "drop"
            if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return "drop"
            if name in ("class", "id") and self.marks:
                names = _names(value)
                if not self.contents:
                    if not MARKS.isdisjoint(names) or "header" in names:
                        return "drop"
                elif tag in CONTAINERS or tag == "article":
                    found = names & MARKS
                    if found & ALWAYS or found and name == "class" and _named_by_mark(value):
                        return "drop"
                    if found:
                        doubt = "doubt"
        return doubt

    def _close_implied(self, tag: str) -> None:
        """A block ends an open paragraph, and an item or cell its forerunner, up to the nearest list or table."""
        ends = ENDS.get(tag, frozenset())
        at = len(self.blocks) - 1
        while at >= 0:
            name = self.open[self.blocks[at]][0]
            if name == "p" or name in ends:
                self._pop_to(self.blocks[at])
            elif name not in ("tbody", "thead", "tfoot"):
                break
            at = min(at, len(self.blocks)) - 1

    def _pop_to(self, at: int) -> None:
        while len(self.open) > at:
            tag, dropped, self.region, self.part = self.open.pop()
            if tag in BLOCKS:
                self.blocks.pop()
                self.inline.pop()
                self.counts[tag] -= 1
            else:
                self.inline[-1][tag] -= 1
            self.dropped -= dropped
            self.contents -= tag in ("article", "main")
            self.links -= tag == "a"

    def handle_endtag(self, tag: str) -> None:
        self.tags += not self.dropped
        if tag in BLOCKS:
            self.end_line()
            if self.counts[tag]:
                at = len(self.blocks) - 1
                while self.open[self.blocks[at]][0] != tag:
                    at -= 1
                self._pop_to(self.blocks[at])
        elif self.inline[-1][tag]:
            at = len(self.open) - 1
            while self.open[at][0] != tag:
                at -= 1
            self._pop_to(at)

    def handle_data(self, data: str) -> None:
        if not self.dropped:
            self.parts.append(data)
            if self.links:
                self.linked += len(data)


def _named_by_mark(value: str) -> bool:
    """Whether the word that says what a class is, the last that is not one of layout, marks it: `siteFooter`, `share-links`, not `related-work`."""
    for name in value.split():
        words = [word.lower() for word in _WORD.findall(name)]
        telling = [word for word in words if word not in LAYOUT] or words
        if telling and telling[-1] in MARKS and not _STATE.match(name):
            return True
    return False


def _added_up(values: list[float], around: list[int]) -> list[float]:
    """For every region (or part) its own value and those of all inside it; what is around one has a smaller number."""
    sums = list(values)
    for at in range(len(sums) - 1, -1, -1):
        if around[at] >= 0:
            sums[around[at]] += sums[at]
    return sums


def smoothed(values: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; the ends count with the neighbours they have."""
    reach = int(np.ceil(3 * sigma))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(values, weights)[reach : reach + len(values)]
    return total / np.convolve(np.ones(len(values)), weights)[reach : reach + len(values)]


def densities(lines: list[Line], sigma: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Each line's characters per tag, these smoothed, and the threshold: the spread (standard deviation) of the smoothed ones."""
    own = np.array([len(line.text) / line.tags for line in lines])
    near = smoothed(own, sigma)
    return own, near, float(near.std())


def content_region(lines: list[Line], around: list[int], articles: set[int], sigma: float, share: float) -> int | None:
    """The article or main around the innermost region that holds this share of the text in dense lines, None if no region does.

    Where no article or main is around it, the innermost region around it that holds all lines dense in themselves. Lines whose smoothed density
    reaches the threshold are dense.
    """
    own, near, least = densities(lines, sigma)
    dense, firm = near >= least, (near >= least) & (own >= least)
    held, firms = [0.0] * len(around), [0.0] * len(around)
    for line, is_dense, is_firm in zip(lines, dense.tolist(), firm.tolist(), strict=True):
        if line.region >= 0:
            held[line.region] += len(line.text) * is_dense
            firms[line.region] += is_firm
    total = sum(len(line.text) for line, is_dense in zip(lines, dense.tolist(), strict=True) if is_dense)
    held, firms = _added_up(held, around), _added_up(firms, around)
    enough = [region for region, size in enumerate(held) if size > 0 and size >= share * total]
    if not enough:
        return None
    chosen = max(enough)  # regions are numbered as they open, so the largest lies innermost
    path = []
    while chosen >= 0:
        path.append(chosen)
        chosen = around[chosen]
    for wanted in ((region in articles for region in path), (firms[region] == firm.sum() for region in path)):
        for region, fits in zip(path, wanted, strict=True):
            if fits:
                return region
    return None


def _without_doubt(lines: list[Line], outer: list[int], sigma: float) -> list[Line]:
    """The lines but for those of doubtful parts that are not mostly dense text, or are links by more than a third."""
    if not outer:
        return lines
    own, _, least = densities(lines, sigma)
    size, firm, linked = ([0.0] * len(outer) for _ in range(3))
    for line, density in zip(lines, own.tolist(), strict=True):
        if line.part >= 0:
            size[line.part] += len(line.text)
            firm[line.part] += len(line.text) * (density >= least)
            linked[line.part] += line.links
    size, firm, linked = (_added_up(values, outer) for values in (size, firm, linked))
    stays: list[bool] = []
    for part, parent in enumerate(outer):
        stays.append(2 * firm[part] >= size[part] and 3 * linked[part] <= size[part] and (parent < 0 or stays[parent]))
    return [line for line in lines if line.part < 0 or stays[line.part]]


def _parsed(html: str, marks: bool) -> _Lines:
    parser = _Lines(marks)
    end = html.rfind(">") + 1  # a tag that begins behind it never ends: it is dropped, as browsers do, without a search for its end
    unended = _TAG.search(html, end)
    parser.feed(html[: unended.start()] if unended else html)
    parser.close()
    parser.end_line()
    return parser


def main_text(html: str, sigma: float = 1.0, share: float = 0.75) -> str:
    """The lines of the content region, without dropped elements, joined by line feeds. Every line has its white space made single.

    Where names of classes leave nothing (a frame around all of a page may have such a name) they are not heeded.
    """
    parser = _parsed(html, True)
    if not parser.lines:
        parser = _parsed(html, False)
    if not parser.lines:
        return ""
    region = content_region(parser.lines, parser.around, parser.articles, sigma, share)
    inside = [False] * len(parser.around)
    for at, parent in enumerate(parser.around):
        inside[at] = at == region or parent >= 0 and inside[parent]
    lines = _without_doubt(parser.lines, parser.outer, sigma)
    return "\n".join(line.text for line in lines if region is None or line.region >= 0 and inside[line.region])


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """`pages` with the main text in place of the html column.

    Null and empty html, and pages of nothing but dropped elements, give the empty text. Unclosed and crossed tags are
    borne as a browser does; a page is read in one pass, in time proportional to its length. Repeated rows each get their text, other columns stay as they
    are; an empty table stays empty.
    """
    at = pages.columns.index(html_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html or "") for html in batch.column(at).to_pylist()]
            columns = [*batch.columns[:at], pa.array(texts, pa.string()), *batch.columns[at + 1 :]]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return pages.select(*[F.col(name) for name in pages.columns]).mapInArrow(run, pages.schema)
