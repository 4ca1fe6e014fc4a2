"""Main text of web pages: text-to-tag ratios of parsed lines, smoothed and clustered.

The standard-library parser streams its events. Each block of a page becomes a line with its characters and the tags
met in it; the ratio of the two is high in prose and low in menus. The ratios, in page order, are smoothed with a
Gaussian kernel, split into a low and a high cluster (one-dimensional two-means), and the midpoint of the clusters is
the threshold.

Lines belong to regions: a content element (``article``, ``main``) with all that is in it, else the innermost grouping
element (``div``, ``section``, ``body``, ...) around them. A region's weight is the length of its lines above the
threshold. Content elements are taken if they weigh at least half of what the heaviest other region does; otherwise the
regions outside of them compete. A region that has a line above the threshold is taken as a whole, so that its short
first and last paragraphs stay, and so are the lines between two regions taken and a line just above the first.
Elements that are never part of an article (menus, headers, footers, forms, adverts, comments, ...) are left out by tag,
role or class name, but their lines take part in the clustering. A class name that only tells of another element
(``has-sidebar``) leaves nothing out, nor does one of a text within a content element (``share-text``).

Defined results: null, empty or text-free html gives the empty text; a page without any content element still gives
its best lines; repeated rows are extracted each; broken markup is read as the parser recovers it; ``page_id`` and
``url`` pass through, nulls too.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from terroir.llm.common import only, record_batches, texts_of

# HTML element names by their role, and the class, id and role words of parts around an article.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section"
    " search select summary table tbody td tfoot th thead title tr ul".split()
)
CONTAINERS = frozenset(
    "address article aside blockquote body button canvas datalist details dialog div dl fieldset figure footer form"
    " head header hgroup html iframe main menu nav noframes noscript object ol optgroup picture pre search section"
    " select svg math table td template textarea th title tr ul audio video li".split()
)
LEFT_OUT = frozenset(
    "aside audio button canvas datalist dialog fieldset footer form head iframe input math menu nav noframes noscript"
    " object script search select style svg template textarea title video".split()
)
LEFT_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist"
    " consent contentinfo cookie cookies disqus dialog footer gdpr header hidden masthead menu modal nav navbar"
    " navigation newsletter notice notices notification outbrain pager pagination popup promo promoted promotion"
    " related replies reply search share sharing sidebar sidenav signup skip social sponsor sponsored subscribe"
    " subscription taboola toc toolbar widget widgets alert complementary".split()
)
CONTENT = frozenset({"article", "main"})
#: Elements whose own lines are a region; others belong to the region around them.
GROUPING = frozenset("article body center dd details div html main section td th".split())
#: Words that make a class name tell of another element, and words that end the name of a text.
MODIFIERS = frozenset("has no not with without".split())
TEXT_WORDS = frozenset("text body content story copy".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

WORDS = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")
SIGMA = 1.0
RADIUS = 2


def _names_part(name: str, content: int) -> bool:
    """Whether a class, id or role is the name of a part around an article."""
    words = WORDS.findall(name)
    if LEFT_OUT_WORDS.isdisjoint(words) or not MODIFIERS.isdisjoint(words):
        return False
    return not (content and words[-1] in TEXT_WORDS)


class Lines(HTMLParser):
    """Lines of a page: ``(text, tags, left out, content element or 0, region)`` in page order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, bool, int, int]] = []
        self._open: list[tuple[str, bool, int, int]] = []  # name, left out, content element, region
        self._text: list[str] = []
        self._tags = 0
        self._heading = False
        self._contents = self._regions = 0

    def _state(self) -> tuple[bool, int, int]:
        return self._open[-1][1:] if self._open else (False, 0, 0)

    def end_line(self) -> None:
        text = SPACE.sub(" ", "".join(self._text)).strip()
        if text:
            out, content, region = self._state()
            if out and self._heading and content and all(x[0] == "header" or not x[1] for x in self._open):
                out = False  # the heading of an article, set in a header of its own
            self.lines.append((text, self._tags, out, content, region))
            self._tags = 0
        self._text = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._tags += 1
        if tag in BLOCKS or tag in CONTAINERS:
            self.end_line()
        elif tag == "br":
            self._text.append(" ")
        if tag in HEADINGS:
            self._heading = True
        if tag == "li":
            self._close_to("li", {"ul", "ol", "menu"})
        elif tag in ("td", "th"):
            self._close_to(("td", "th"), {"table"})
        elif tag == "tr":
            self._close_to("tr", {"table"})
        if tag in CONTAINERS:
            out, content, region = self._state()
            if tag in CONTENT or any(k == "role" and v in CONTENT for k, v in attrs):
                if not content:
                    self._contents += 1
                    content = self._contents
            if tag in GROUPING:
                self._regions += 1
                region = self._regions
            self._open.append((tag, out or self._left_out(tag, attrs, content), content, region))

    def _left_out(self, tag: str, attrs: list[tuple[str, str | None]], content: int) -> bool:
        if tag in LEFT_OUT or tag == "header":
            return True
        if tag in ("html", "body", *CONTENT):
            return False
        for key, value in attrs:
            if key in ("class", "id", "role") and any(_names_part(x, content) for x in (value or "").lower().split()):
                return True
            if key == "hidden" or key == "aria-hidden" and value == "true":
                return True
            if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value or "", re.I):
                return True
        return False

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        """HTML ignores the slash: ``<div/>`` opens a div."""
        self.handle_starttag(tag, attrs)

    def _close_to(self, names: str | tuple[str, ...], until: set[str]) -> None:
        names = (names,) if isinstance(names, str) else names
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] in until:
                return
            if self._open[i][0] in names:
                del self._open[i:]
                return

    def handle_endtag(self, tag: str) -> None:
        self._tags += 1
        if tag in BLOCKS or tag in CONTAINERS:
            self.end_line()
        if tag in HEADINGS:
            self._heading = False
        if tag in CONTAINERS:
            for i in range(len(self._open) - 1, -1, -1):
                if self._open[i][0] == tag:
                    del self._open[i:]
                    return

    def handle_data(self, data: str) -> None:
        # Text of scripts and styles arrives here too, between their tags.
        if self.cdata_elem not in ("script", "style"):
            self._text.append(data)


def lines_of(html: str) -> list[tuple[str, int, bool, int, int]]:
    """Lines of ``html``; a declaration that the parser refuses is read as text."""
    for refused in (None, "<![", "<!", "<"):
        if refused:
            html = html.replace(refused, refused.replace("<", "&lt;"))
        parser = Lines()
        try:
            parser.feed(html)
            parser.close()
            parser.end_line()
            return parser.lines
        except AssertionError:
            continue
    return parser.lines


def smoothed(values: list[float]) -> list[float]:
    """Gaussian kernel of ``RADIUS`` lines on each side, renormalised at the ends."""
    weights = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(-RADIUS, RADIUS + 1)]
    out = []
    for i in range(len(values)):
        total = norm = 0.0
        for d, w in enumerate(weights, -RADIUS):
            if 0 <= i + d < len(values):
                total += w * values[i + d]
                norm += w
        out.append(total / norm)
    return out


def threshold(values: list[float]) -> float:
    """Midpoint of the two clusters of ``values``; the least value if all are equal."""
    low, high = min(values), max(values)
    cut = (low + high) / 2
    while low < high:
        above = [v for v in values if v >= cut]
        below = [v for v in values if v < cut]
        if not below:
            break
        new = (sum(above) / len(above) + sum(below) / len(below)) / 2
        if new == cut:
            break
        cut = new
        if not any(v >= cut for v in values):
            break
    return cut


def main_text(html: str) -> str:
    lines = lines_of(html)
    if not lines:
        return ""
    # Ratios are compared on a logarithmic scale: one very long paragraph is no class of its own.
    ratios = smoothed([math.log1p(len(text) / (1 + tags)) for text, tags, *_ in lines])
    cut = threshold(ratios)
    usable = [i for i, line in enumerate(lines) if not line[2]]
    high = [i for i in usable if ratios[i] >= cut] or usable
    weights: dict[tuple[int, int], int] = {}
    for i in high:
        region = _region(lines[i])
        weights[region] = weights.get(region, 0) + len(lines[i][0])
    inside = sum(w for (content, _), w in weights.items() if content)
    outside = max([w for (content, _), w in weights.items() if not content], default=0)
    chosen = {region for region in weights if bool(region[0]) == (inside > 0 and 2 * inside >= outside)}
    kept = [i for i in usable if _region(lines[i]) in chosen]
    if not kept:
        return ""
    if not next(iter(chosen))[0]:
        # Short blocks between two regions that are taken belong to the text, and so does a heading just above.
        taken = [i for i in high if _region(lines[i]) in chosen]
        first = min(kept[0], taken[0] - 1)
        kept = sorted({*kept, *(i for i in usable if first <= i <= taken[-1] and not lines[i][3])})
    return "\n".join(lines[i][0] for i in kept)


def _region(line: tuple[str, int, bool, int, int]) -> tuple[int, int]:
    """The content element with all in it, or the grouping element."""
    return (line[3], 0) if line[3] else (0, line[4])


RESULT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for page, url, html in zip(batch.column(0), batch.column(1), texts_of(batch, "html"), strict=True):
                text = main_text(html)
                yield page.as_py(), url.as_py(), text, len(text)

    return record_batches(rows(), RESULT, 500)


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` (code points) of every row of ``pages`` (page_id, url, html)."""
    rows = only(pages, page_id="long", url="string", html="string")
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
