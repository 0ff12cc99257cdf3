"""Main text of web pages from parser events, text-to-tag ratios and threshold clustering.

1. The standard library's parser streams events; they become lines (one block of running text
   each) with their characters, their tags and the container that they stand in. Elements that
   never hold an article's text (navigation, headers, footers, asides, forms, scripts, styles;
   and those whose class, id or role says so: adverts, notices, comments, ...) give no lines. A name
   hides neither an article or main nor what holds one (inside an article it still does: an article
   there is a comment on it). A page that is left without lines gets back those that names hid.
2. Each line has a text-to-tag ratio. The ratios are smoothed by a Gaussian along the page, and
   clustered in two with their slopes, one cluster held at the origin: lines outside it are content.
3. Where a page marks its articles, all lines of every marked one are the text. Elsewhere a region is a
   container with its own lines; regions pass if most of their text is content lines and their ratio
   as a whole is on the content's side. The lowest container that holds all that passed is the
   article, with all its lines, so short headings and paragraphs stay, and what stands between.

Inputs: null html is an empty page with empty text; unclosed or stray tags, pages cut off in the
middle and pages of any length are read whole; every row gives one row, repeated ones too; a
null page_id or url is kept; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histwise.llm.bpe import slices
from histwise.llm.common import ready

# HTML's element groups.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
NO_TEXT = set("aside audio button canvas datalist dialog embed footer form head header iframe input menu nav noscript object script select style svg template textarea title video".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
ENDS_PARAGRAPH = BLOCK - {"html", "head", "body", "option", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "legend", "title"}
MARKED = {"article", "main"}
CONTAINERS = MARKED | {"body", "div", "section", "td"}
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Words in a class, id or role that mark what is not the article: whole names, made of these words alone.
WORDS = (
    r"(?:ads?|advert[a-z]*|sponsor[a-z]*|promo[a-z]*|banner|nav[a-z]*|menu[a-z]*|breadcrumbs?|sidebar|side|aside|footer|header|masthead|comments?|replies|disqus|"
    r"cookies?|consent|notices?|alert|popup|modal|newsletter|subscribe|signup|login|share|sharing|social|related|recommend[a-z]*|widget|search|copyright|complementary|contentinfo)")
NOT_ARTICLE = re.compile(rf"(?<!\S){WORDS}(?:[_-]{WORDS})*(?!\S)", re.I)
SIGMA = 1.0


class Lines(HTMLParser):
    """Collects lines from the events of one page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, int]] = []  # tag, without text, container, innermost element hidden by name
        self.places: dict[str, list[int]] = {}  # of each tag among the open ones, so that no event scans them
        self.textless = 0  # open tags in NO_TEXT
        self.named_in: list[int] = [0]  # for each element hidden by name the one around it; 0: none
        self.holds: list[bool] = [True]  # whether it holds an article or main
        self.regions = 1
        self.parents = [0]
        self.marked: set[int] = set()
        self.parts: list[tuple[str, int]] = []  # text, innermost element hidden by name
        self.tags = 0
        self.blocks: list[tuple[list[tuple[str, int]], int, int]] = []  # parts, tags, container

    def push(self, tag: str, hidden: bool, region: int, by: int) -> None:
        self.places.setdefault(tag, []).append(len(self.open))
        self.textless += tag in NO_TEXT
        self.open.append((tag, hidden, region, by))

    def pop(self) -> str:
        tag = self.open.pop()[0]
        self.places[tag].pop()
        self.textless -= tag in NO_TEXT
        return tag

    def last(self, tags: set[str]) -> int:
        """The innermost place of one of ``tags``; -1 where none is open."""
        return max((places[-1] for t in tags if (places := self.places.get(t))), default=-1)

    def line(self) -> None:
        if any(text.strip() for text, _ in self.parts):
            self.blocks.append((self.parts, self.tags, self.open[-1][2] if self.open else 0))
            self.tags = 0
        self.parts = []

    def lines(self) -> list[tuple[str, int, int]]:
        """Text, tags and container of each line."""
        shown = [True]
        for around, holds in zip(self.named_in[1:], self.holds[1:]):
            shown.append(holds and shown[around])
        for every in (False, True):
            out, carried = [], 0
            for parts, tags, region in self.blocks:
                carried += tags
                if text := " ".join("".join(t for t, by in parts if every or shown[by]).split()):
                    out.append((text, carried, region))
                    carried = 0
            if out:
                break
        return out

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.tags += 1
            self.parts.append((" ", self.open[-1][3] if self.open else 0))
            return
        if tag in BLOCK:
            self.line()
        self.tags += 1
        if tag in VOID:
            return
        if tag in MARKED:  # no article stands in a menu: what is open there was never closed
            while self.textless:
                self.pop()
        if tag in ENDS_PARAGRAPH and self.places.get("p"):
            self.leave({"p"}, CONTAINERS | {"li", "blockquote"})
        if tag in SAME_CLOSES:
            self.leave(SAME_CLOSES[tag], {"ul", "ol", "dl", "table", "select"})
        hidden = bool(self.open) and self.open[-1][1]
        region = self.open[-1][2] if self.open else 0
        inside = region in self.marked
        if tag == "header" and inside:  # an article's own header: its headings stay
            hidden = hidden or "headings"
        elif tag in NO_TEXT:
            hidden = True
        elif hidden == "headings" and tag in HEADINGS:
            hidden = False
        by = self.open[-1][3] if self.open else 0
        if tag in MARKED and not self.places.get("article"):
            at = by
            while not self.holds[at]:
                self.holds[at], at = True, self.named_in[at]
        elif tag not in ("html", "body") and self.named(attrs):
            self.named_in.append(by)
            self.holds.append(False)
            by = len(self.holds) - 1
        if tag in CONTAINERS and not inside:
            self.parents.append(region)
            region, self.regions = self.regions, self.regions + 1
            if tag in MARKED:
                self.marked.add(region)
        self.push(tag, hidden, region, by)

    @staticmethod
    def named(attrs) -> bool:
        return any(k in ("class", "id", "role") and v and NOT_ARTICLE.search(v) or k in ("hidden",) or k == "aria-hidden" and v == "true" for k, v in attrs)

    def leave(self, tags: set[str], limit: set[str]) -> None:
        at = self.last(tags)
        if at > self.last(limit):
            self.line()
            while len(self.open) > at:
                self.pop()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("script", "style", "p", "div"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCK or tag in NO_TEXT:
            self.line()
        self.tags += 1
        if self.places.get(tag):
            while self.pop() != tag:
                pass

    def handle_data(self, data):
        if self.open and self.open[-1][1]:
            return
        self.parts.append((data, self.open[-1][3] if self.open else 0))


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """The ratios under a Gaussian of ``sigma`` lines, its weights summing to one at the ends too."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weighted = np.convolve(ratio, kernel)[reach:reach + len(ratio)]
    return weighted / np.convolve(np.ones(len(ratio)), kernel)[reach:reach + len(ratio)]


def content_lines(ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Two clusters over (smoothed ratio, slope), one held at the origin: True outside it, and
    the ratio halfway between the two."""
    smooth = smoothed(ratio)
    points = np.stack([smooth, np.abs(np.gradient(smooth)) if len(smooth) > 1 else np.zeros(1)], axis=1)
    centre = points[np.argmax(smooth)]
    for _ in range(50):
        chosen = ((points - centre) ** 2).sum(axis=1) < (points ** 2).sum(axis=1)
        if not chosen.any():
            break
        moved = points[chosen].mean(axis=0)
        if np.allclose(moved, centre):
            break
        centre = moved
    return chosen, centre[0] / 2


def main_text(html: str) -> str:
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.line()
    lines = parser.lines()
    if not lines:
        return ""
    length = np.array([len(text) for text, _, _ in lines], float)
    tags = np.array([max(1, tags) for _, tags, _ in lines], float)
    content, halfway = content_lines(length / tags)
    region, number = np.array([r for _, _, r in lines]), parser.regions
    chars, inside = np.bincount(region, length, number), np.bincount(region, length * content, number)
    # Smoothing lifts a short line beside the article: the region's own ratio must hold as well.
    passed = (inside >= 0.5 * chars) & (chars >= halfway * np.bincount(region, tags, number)) & (chars > 0)
    if not passed.any():
        passed[np.argmax(inside)] = True
    kept = np.zeros(number, bool)
    kept[list(parser.marked)] = True
    if not kept[region].any():
        held = passed.astype(int)  # a container's number is above that of the one around it
        for r in range(number - 1, 0, -1):
            held[parser.parents[r]] += held[r]
        kept[:] = False
        kept[np.nonzero(held == passed.sum())[0][-1]] = True
        for r in range(1, number):
            kept[r] |= kept[parser.parents[r]]
    return "\n".join(text for (text, _, r) in lines if kept[r])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every row of ``pages`` (page_id, url, html), in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 64):
                yield pa.record_batch({"page_id": part.column("page_id"), "url": part.column("url"), "text": pa.array([main_text(h) for h in part.column("h").to_pylist()], pa.string())})

    ready(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("h")).mapInArrow(run, "page_id long, url string, text string")


def contract(pages: DataFrame) -> DataFrame:
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
