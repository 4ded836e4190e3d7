"""Main text of web pages from parser events, text-to-tag ratios and their smoothed clusters.

The standard library's streaming parser gives events; block-level tags cut them into lines. A line's ratio
is its text outside links over its tags, and 0 in elements that say they are no article: menus, footers and the
like, by tag, role or a whole class or id. Ratios are smoothed by a Gaussian along the page, and lines over the
threshold, the standard deviation of the smoothed ratios, are the content; none of them is left out. Clusters of
content say which elements hold the article: the outermost `article` around a content line, or `main` where there
is no article, with all its lines but those of ratio 0 by name. Elsewhere a region runs from the first to the last
content line, and on over lines beside these in the same element.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.5

# HTML elements by what they do here.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section summary table tbody td template tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template head title svg math iframe object canvas audio video select option button textarea input datalist".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog search".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY = {"p": BLOCKS, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}), "tr": frozenset({"tr", "tbody", "tfoot"}), "option": frozenset({"option"})}
# Words of class and id that mark menus, page heads and feet, notices, adverts and comments.
WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion promoted banner "
    "cookie cookies consent gdpr notice notices notification newsletter subscribe subscription paywall popup modal overlay "
    "nav navbar navigation menu menubar submenu breadcrumb breadcrumbs pagination pager toolbar topbar masthead sidebar sidebars aside widget widgets header "
    "footer comment comments commentlist disqus replies reply respond related recommended recommendations share sharing social "
    "login signup signin register searchbox searchform skiplink copyright disclaimer hidden".split()
)
# Words that say nothing beside one of the above ("footer-left"); beside any other word none of the above counts.
PLAIN = frozenset("a area bar block box bottom button buttons center col column container form group holder icon icons inner item items left link links list main outer page panel right row section site slot small top unit wrap wrapper zone".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar status".split())
_SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
_HIDE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _says(name: str) -> bool:
    """Whether a class or an id as a whole names boilerplate: "cookie-banner" does, "share-price" does not."""
    said = {x.lower() for x in _SPLIT.split(name) if x and not x.isdigit()}
    return not said.isdisjoint(WORDS) and said <= WORDS | PLAIN


def _marked(tag: str, attrs: list) -> bool:
    """Whether an element's tag or attributes make it boilerplate."""
    if tag in BOILERPLATE:
        return True
    for k, v in attrs:
        v = v or ""
        if k == "hidden" or k == "aria-hidden" and v.lower() == "true" or k == "style" and _HIDE.search(v):
            return True
        if k == "role" and v.lower() in ROLES:
            return True
        if k in ("class", "id") and tag not in ("html", "body", "main", "article") and any(_says(x) for x in v.split()):
            return True
    return False


class _Lines(HTMLParser):
    """Lines of a page: (text, tags, characters in links, element number, marked). Time is linear in the page.

    Elements are numbered as they open; parent, kind and region (the outermost article around, else the outermost
    main, else 0) are lists by number.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple] = []
        self.parts: list[str] = []
        self.tags = self.linked = self.links = 0
        # tag, number, marked, silent, marked only as the head of an article, place of the innermost block
        self.open: list[tuple] = [("", 0, False, False, False, 0)]
        self.places: dict[str, list[int]] = {}
        self.parent, self.kind, self.article, self.main = [0], [""], [0], [0]

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text or self.tags:
            _, number, marked, *_ = self.open[-1]
            self.lines.append((text, self.tags, self.linked, number, marked))
        self.parts, self.tags, self.linked = [], 0, 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            while self.open[-1][0] in CLOSED_BY and tag in CLOSED_BY[self.open[-1][0]]:
                self.pop()
            block = self.open[-1][5]
            if self.open[block][0] == "p" and len(self.open) - block < 4:  # inline elements left open in a paragraph
                self.pop_to(block)
            self.flush()
        self.tags += 1
        if tag in VOID:
            if tag in ("br", "hr"):
                self.parts.append(" ")
            return
        _, above, marked, silent, head, block = self.open[-1]
        if not marked:
            inside = self.article[above] or self.main[above]
            if tag == "header":
                marked, head = True, bool(inside)
            elif tag not in HEADINGS and (tag in BLOCKS or attrs):
                marked = _marked(tag, attrs)
        elif head and tag in HEADINGS:
            marked = False  # an article's own title
        number = len(self.parent)
        self.parent.append(above)
        self.kind.append(tag)
        self.article.append(self.article[above] or (number if tag == "article" else 0))
        self.main.append(self.main[above] or (number if tag == "main" else 0))
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, number, marked, silent or tag in SILENT, head, len(self.open) if tag in BLOCKS else block))
        self.links += tag == "a"

    def pop(self) -> None:
        if self.open[-1][0] in BLOCKS:
            self.flush()
        tag = self.open.pop()[0]
        self.places[tag].pop()
        self.links -= tag == "a"

    def pop_to(self, place: int) -> None:
        while len(self.open) > place:
            self.pop()

    def handle_endtag(self, tag):
        self.tags += 1
        at = self.places.get(tag)
        if at and (tag in BLOCKS or at[-1] > self.open[-1][5]):  # an inline end tag closes nothing beyond its block
            self.pop_to(at[-1])
        elif tag == "p":
            self.flush()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data):
        if self.open[-1][3]:
            return
        self.parts.append(data)
        if self.links:
            self.linked += len(data)


def smooth(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian smoothing along the lines; weights beyond an end are left out and the rest made up to 1."""
    reach = int(math.ceil(3 * sigma))
    kernel = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        a, z = max(0, i - reach), min(len(values), i + reach + 1)
        w = kernel[a - i + reach : z - i + reach]
        out.append(sum(x * y for x, y in zip(w, values[a:z])) / sum(w))
    return out


def ratio(line: tuple) -> float:
    """Characters outside links over tags; 0 for lines of marked elements."""
    text, tags, linked, _, marked = line
    return 0.0 if marked else max(len(text) - linked, 0) / max(tags, 1)


def content_lines(lines: list[tuple]) -> list[int]:
    """Lines whose smoothed ratio reaches the standard deviation of all, and whose own ratio is not 0."""
    own = [ratio(x) for x in lines]
    even = smooth(own)
    mean = sum(even) / max(len(even), 1)
    threshold = math.sqrt(sum((x - mean) ** 2 for x in even) / max(len(even), 1))
    return [k for k, x in enumerate(even) if x >= threshold and own[k] > 0]


def main_text(html: str | None) -> str:
    """Main text of a page; '' for null, empty and textless pages. Broken and unclosed tags are taken as browsers do, nearly."""
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    page.close()
    page.flush()
    lines, parent = page.lines, page.parent
    free = [k for k, x in enumerate(lines) if x[0] and not x[4]]
    content = content_lines(lines) or free  # a page of links alone
    if not content:
        return ""
    region = lambda k: page.article[lines[k][3]] or page.main[lines[k][3]]
    named = {region(k) for k in content} - {0}
    kept = {k for k in free if named & {page.article[lines[k][3]], page.main[lines[k][3]]}} | set(content)
    if not named:  # no element says where the article is
        first, last = content[0], content[-1]
        kept.update(k for k in free if first < k < last and ratio(lines[k]) > 0)
        of = lambda k: parent[lines[k][3]]
        before, after = [k for k in free if k < first], [k for k in free if k > last]
        # short lines beside the content in the same element, and the heading above it
        for edge, rows in ((first, reversed(before)), (last, after)):
            for k in rows:
                if of(k) != of(edge) or not ratio(lines[k]):
                    break
                kept.add(k)
        first = min(kept)
        heads = [k for k in before if k < first and page.kind[lines[k][3]] in HEADINGS]
        if heads and heads[-1] >= first - 4:
            kept.update(k for k in before if heads[-1] <= k < first and ratio(lines[k]) > 0)
    return "\n".join(lines[k][0] for k in sorted(kept))


def extract(pages: DataFrame, column: str = "html", into: str = "text") -> DataFrame:
    """pages with the main text of `column` as `into` (replaced if there) and n_chars, its code points.

    One row out for each row in, repeated rows included; null html gives ''. Whole pages are parsed.
    """

    @F.arrow_udf("string")
    def run(html: pa.Array) -> pa.Array:
        return pa.array([main_text(x) for x in html.to_pylist()], pa.string())

    return pages.withColumn(into, run(F.col(f"`{column}`").cast("string"))).withColumn("n_chars", F.char_length(into).cast("long"))
