"""Main text of web pages from parser events, by text-to-tag ratios.

The standard library's parser streams events; block-level tags cut the page
into lines.  Each line has a ratio: characters of its text outside links, by
the tags seen in it.  The ratios are smoothed over neighbouring lines by a
Gaussian kernel, and a threshold between their two clusters (two means,
iterated on square roots, so that a few long lines do not make clutter of shorter
ones) tells content from clutter.  Lines are not taken one by one: they are
joined in regions (the innermost article, section, cell or division they stand
in, inside an article or main element too), and a region is content where most of
its text lies outside links in lines above the threshold, so a short paragraph
beside longer ones of its region stays.  All lines of the page are smoothed and
divided together.  An article or main element decides nothing by itself: its lines
have their ratios weighted by ARTICLE_WEIGHT before that.

What is never content: head, scripts, styles, menus, headers, footers, asides,
forms and buttons, hidden elements, and elements whose class, id or role names
an advert, a notice, a sidebar, a menu, sharing or reader comments and nothing
else: a name with a word of its own beside that (`entry-header`) hides nothing.

Defined cases: a null or empty page, and one without text, gives an empty text;
unclosed and stray tags are tolerated much as browsers do (a block ends an open
paragraph, items, cells, rows and options end their own kind, end tags do not reach
out of a cell); repeated rows are pages of
their own; other columns of the input are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import staging

#: Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLUTTER = frozenset(
    "head script style noscript template nav header footer aside form button select textarea iframe object svg "
    "canvas audio video dialog menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot "
    "th thead title tr ul".split())
REGIONS = frozenset("article body div main section td th".split())
ARTICLES = frozenset(("article", "main"))
#: Parts of class names and ids: what names clutter, and what only says where or in what form it stands.
CLUTTER_WORDS = re.compile(
    r"ads?|advert\w*|banners?|promo|promos|promoted|promotions?|sponsor|sponsored|sponsors|cookies?|consent|notices?|"
    r"popups?|modal|newsletter|subscribe|subscription|subscriptions|sidebar|side|aside|menu|menus|nav|navbar|navigation|"
    r"breadcrumbs?|header|masthead|footer|share|sharing|social|related|recommend\w*|comments?|respond|replies|disqus|"
    r"widgets?")
PLAIN_WORDS = frozenset(
    "area bar block body bottom box button buttons center column container content form global group holder icons inner "
    "item items left line link links list local main media mobile outer page panel post posts primary rail region right "
    "row secondary section sign signup site slot sticky strip text thread title toolbar top unit up web wrap "
    "wrapper".split())
#: With one of these a header is that of a text, not of a site.
TITLED = frozenset("body content item post section text title".split())
#: Words of a name: runs of letters, cut before capitals; figures do not count.
NAME_PARTS = re.compile(r"[^\W\d_A-Z]+|[A-Z]+(?![^\W\d_A-Z])|[A-Z][^\W\d_A-Z]+")
CLUTTER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

#: Elements that an end tag, or the search for a paragraph to end, does not reach out of.
SCOPES = frozenset("button caption object table td template th".split())
#: Parts of tables: their end tags reach out of cells, not of the table.
PARTS = frozenset("caption tbody td tfoot th thead tr".split())
SECTIONS = frozenset("caption tbody tfoot thead".split())
CELLS = frozenset(("td", "th"))
TERMS = frozenset(("dd", "dt"))
TABLES = frozenset(("table", "template"))
LISTED = frozenset(("li", *TERMS))
#: What bounds the search for an item to end.
ITEM_BOUNDS = (BLOCKS | CLUTTER | frozenset(("template",))) - LISTED - frozenset("address div p".split())
#: Blocks that do not end a paragraph.
INSIDE_PARAGRAPH = PARTS | frozenset("body br html option".split())


def implied_ends(tag: str) -> list[tuple[frozenset[str], frozenset[str]]]:
    """(kinds that a start tag ends, elements that bound the search)."""
    ends = []
    if tag in ("li", *TERMS):
        ends.append((frozenset(("li",)) if tag == "li" else TERMS, ITEM_BOUNDS))
    if tag == "option":
        ends.append((frozenset(("option",)), BLOCKS - {"option"} | {"select"}))
    if tag == "a":
        ends.append((frozenset(("a",)), SCOPES | BLOCKS))
    if tag in CELLS:
        ends.append((CELLS, TABLES | {"tr"}))
    if tag == "tr":
        ends.append((CELLS | {"tr", "caption"}, TABLES))
    if tag in SECTIONS:
        ends.append((CELLS | SECTIONS | {"tr"}, TABLES))
    if tag in BLOCKS and tag not in INSIDE_PARAGRAPH:
        ends.append((frozenset(("p",)), SCOPES))
    return ends


#: By tag; what is not in it ends nothing.
IMPLIED = {tag: ends for tag in sorted(BLOCKS | {"a"}) if (ends := implied_ends(tag))}

SIGMA = 1.5
#: Factor up to which the means of two clusters count as one.
ONE_CLUSTER = 2
#: Factor of the ratios of lines inside an article or main element.
ARTICLE_WEIGHT = 1.5


@dataclass
class Line:
    region: int
    in_article: bool
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    tags: int = 0


def names_clutter(value: str) -> bool:
    """Whether one of the names in a class or id says clutter and nothing else.

    `site-footer` and `adSlot2` do; `entry-header`, `share-price` and `promotions-history` name something of their own,
    and `post-header` the heading of a text.
    """
    for name in value.split():
        parts = [part.lower() for part in NAME_PARTS.findall(name)]
        said = [part for part in parts if CLUTTER_WORDS.fullmatch(part)]
        if not said or not all(part in PLAIN_WORDS for part in parts if part not in said):
            continue
        if not {"header", "masthead"}.issuperset(said) or TITLED.isdisjoint(parts):
            return True
    return False


def is_clutter(tag: str, attributes: list[tuple[str, str | None]]) -> bool:
    if tag in CLUTTER:
        return True
    for name, value in attributes:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value and value.lower() in CLUTTER_ROLES:
            return True
        if name in ("class", "id") and value and tag not in ("html", "body") and names_clutter(value):
            return True
        if name == "style" and value and "display:none" in value.replace(" ", "").lower():
            return True
    return False


class Lines(HTMLParser):
    """Cuts a page into lines.

    The stack holds the open blocks and clutter, and all that is open inside hidden elements.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        # (tag, region before, articles before, clutter before)
        self.open: list[tuple[str, int, int, int]] = []
        self.places: dict[str, list[int]] = {}  # of each tag in the stack
        self.region = self.regions = self.articles = self.clutter = self.links = 0
        self.fresh = True

    def _line(self) -> Line:
        if self.fresh or not self.lines:
            self.lines.append(Line(self.region, self.articles > 0))
            self.fresh = False
        return self.lines[-1]

    def _last(self, tags: frozenset[str]) -> int:
        return max((at[-1] for tag, at in self.places.items() if tag in tags), default=-1)

    def _end(self, kinds: frozenset[str], bounds: frozenset[str], once: bool = False) -> None:
        """Close the innermost open element of these kinds (all of them unless once) inside the bounds."""
        while not kinds.isdisjoint(self.places) and (k := self._last(kinds)) > self._last(bounds):
            self.fresh = True
            _, self.region, self.articles, self.clutter = self.open[k]
            for tag, *_ in self.open[k:]:
                self.places[tag].pop()
                if not self.places[tag]:
                    del self.places[tag]
            del self.open[k:]
            if once:
                return

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.fresh = True
        for kinds, bounds in IMPLIED.get(tag, ()):
            self._end(kinds, bounds)
        if tag in VOID:
            return
        hides = is_clutter(tag, attributes)
        if tag == "a":
            self.links += 1
        if hides or self.clutter or tag in BLOCKS:
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append((tag, self.region, self.articles, self.clutter))
            self.clutter += hides
            if tag in ARTICLES:
                self.articles += 1
            if tag in REGIONS:
                self.regions += 1
                self.region = self.regions
            self.fresh |= bool(hides)
        if not self.clutter:
            self._line().tags += 1

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in BLOCKS:
            self.fresh = True
        if tag not in self.places:
            return
        if tag in PARTS or tag == "table":
            bounds = TABLES - {tag}
        elif tag in LISTED:
            bounds = SCOPES | {"ul", "ol", "dl"}
        else:
            bounds = SCOPES - {tag}
        self._end(frozenset((tag,)), bounds, True)

    def handle_data(self, data: str) -> None:
        if self.clutter or not data:
            return
        line = self._line()
        line.pieces.append(data)
        if self.links:
            line.linked += len(data.strip())


def threshold(ratios: np.ndarray) -> float:
    """Between the means of the two clusters of the ratios, by their square roots; all is content where there is one."""
    scale = np.sqrt(ratios)
    low, high = float(scale.min()), float(scale.max())
    for _ in range(30):
        middle = (low + high) / 2
        above = scale > middle
        if above.all() or not above.any():
            break
        new = float(scale[~above].mean()), float(scale[above].mean())
        if new == (low, high):
            break
        low, high = new
    return ((low + high) / 2) ** 2 if high * high > ONE_CLUSTER * low * low else float(ratios.min())


def smoothed(ratios: np.ndarray, sigma: float) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    ends = np.convolve(np.ones(len(ratios)), kernel, "full")[reach: reach + len(ratios)]
    return np.convolve(ratios, kernel, "full")[reach: reach + len(ratios)] / ends


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """The text of the content regions, blocks joined by one space."""
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    lines = [(line, " ".join("".join(line.pieces).split())) for line in parser.lines]
    lines = [(line, text) for line, text in lines if text]
    if not lines:
        return ""
    plain = np.array([max(0, len(text) - line.linked) for line, text in lines], float)
    weights = np.array([ARTICLE_WEIGHT if line.in_article else 1.0 for line, _ in lines])
    ratios = smoothed(weights * plain / np.array([max(1, line.tags) for line, _ in lines]), sigma)
    limit = threshold(ratios)
    total: dict[int, int] = {}
    content: dict[int, int] = {}
    for (line, text), ratio, outside in zip(lines, ratios, plain.tolist(), strict=True):
        total[line.region] = total.get(line.region, 0) + len(text)
        content[line.region] = content.get(line.region, 0) + (outside if ratio >= limit else 0)
    chosen = {region for region, n in total.items() if 2 * content[region] >= n}
    if not chosen:
        chosen = {max(content, key=content.get)}
    return " ".join(text for line, text in lines if line.region in chosen)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row of pages: page_id, url, text, n_chars."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(*[staging.quoted(c) for c in (key, url)], staging.quoted(html).cast("string"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(apply, f"page_id {kinds[key]}, url {kinds[url]}, text STRING, n_chars BIGINT")


def query(spark, sf_dir: str) -> DataFrame:
    """Every page of the table."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).select(
        "page_id", "url", F.col("text"), "n_chars")
