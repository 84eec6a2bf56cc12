"""Op 7: main text of web pages from parser events and smoothed text-to-tag ratios.

A streaming parser turns a page into lines, one for each block, with their text, number of tags and
link text; elements that hold no article by their tag (menus, headers, footers, scripts, styles) are left out on
the way. Forms and elements that a whole class, id or role names as clutter (sidebars, notices, adverts, comments) are
left out too, but not headings or, other than adverts and comments, paragraphs; nor, other than adverts and
comments, an element that holds more content (a form: prose) than all that lies outside such elements. Each line's
text-to-tag ratio is smoothed with a Gaussian over its neighbours, and a two-means threshold parts
content from clutter; longer prose (``PROSE``) is content on either side of it. The region is the article or main
element with the most content and all other articles beside it or with content of their own, or where the page
names none the deepest element that holds all content, and in it the story: from the first content line to the last,
with the headings before and the neighbours of both. All remaining blocks of these are kept, short ones too;
only blocks that are mostly links and no content go, and in the heaviest article they stay as well.

Every pass is linear in the page, however deep it nests.
Rows are independent: a narrow Arrow map, bounded by one page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pacewise.llm.common import appended, extend, pieces, texts, without

# Element names of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q ruby rb rp rt s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
CLUTTER = frozenset("script style noscript template head title nav footer aside button select option textarea iframe "
                    "svg canvas object audio video dialog menu fieldset label input".split())
CLOSED_BY_NEXT = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
                  "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                     "main nav ol p pre section table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLES = frozenset(["article", "main"])
# Words of class names, ids and roles that name clutter.
CLUTTER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup paywall sidebar sidebars aside widget widgets "
    "related recommended recommendations share sharing social comment comments disqus respond responses replies nav navbar "
    "navigation menu menus breadcrumb breadcrumbs pagination pager footer header masthead topbar toolbar login search skip "
    "complementary contentinfo dialog form".split())
# Of these, words for what others wrote or pay for; such an element goes however long it is.
FOREIGN_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored cookie cookies gdpr comments disqus respond replies".split())
ADMONITIONS = frozenset("notice notices alert".split())  # clutter of a page, but text inside an article
# Words that a name of clutter may hold besides, those of the text itself, and tags that are text, not boxes of it.
OWN_WORDS = frozenset("article content entry main page post story".split())
NEUTRAL_WORDS = OWN_WORDS | frozenset(
    "area articles bar block blocks bottom box button buttons container global group holder icon icons inner item items left "
    "link links list media module news outer panel posts primary reader right secondary section site slot stories text title "
    "thread threads top unit user wrap wrapper zone".split())
TEXT_TAGS = frozenset("p pre blockquote dt dd figcaption".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
HIT, FOREIGN = 1, 2

SIGMA = 1.0      # of the Gaussian, in lines
LIFTED = 0.25    # share of the upper cluster's mean ratio under which a line of mostly links isn't in it
PROSE = 40       # characters of a line that is content without the upper cluster, if it is not mostly links


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parents, self.tags = [-1], [""]              # of each element; element 0 is the page
        self.hits = [0]                                   # of each element: HIT or FOREIGN if its names say clutter
        self.doubtful: set[int] = set()                   # articles whose names say clutter
        self.stack: list[tuple[str, int, bool]] = [("", 0, False)]  # tag, element, left out
        self.open: Counter[str] = Counter()               # tags on the stack
        self.lines: list[tuple[str, int, int, int]] = []  # text, tags, link characters, element
        self.parts: list[str] = []
        self.n_tags = self.n_link = self.links = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.n_tags, self.n_link, self.stack[-1][1]))
            self.n_tags = self.n_link = 0
        self.parts = []

    def close_to(self, depth: int) -> None:
        self.flush()
        self.open.subtract(t for t, _, _ in self.stack[depth:])
        del self.stack[depth:]

    def push(self, tag: str, element: int, out: bool) -> None:
        self.open[tag] += 1
        self.stack.append((tag, element, out))

    def clutter(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in CLUTTER:
            return True
        if tag == "header":
            return not self.inside()
        if tag in ("html", "body", *ARTICLES):
            return False
        return any(name == "hidden" or name == "aria-hidden" and value == "true" for name, value in attrs)

    def inside(self) -> bool:
        return any(self.open[t] > 0 for t in ARTICLES)

    def named(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        """HIT or FOREIGN if a whole class, id or role names clutter; a word of it alone ('has-sidebar') says nothing."""
        if tag in ("html", "body", *HEADINGS):
            return 0
        found = HIT if tag == "form" else 0
        for name, value in attrs:
            if name not in ("class", "id", "role") or not value:
                continue
            split = [{w.lower() for w in _WORDS.findall(token)} for token in value.split()]
            wrapper = any(words and words <= OWN_WORDS for words in split)
            for words in split:
                hit = words & CLUTTER_WORDS
                rest = {w for w in words - hit if len(w) > 1 and not w.isdigit()}
                if not hit or not rest <= NEUTRAL_WORDS or hit == {"header"} and rest & OWN_WORDS:
                    continue
                if hit & FOREIGN_WORDS:
                    found = max(found, HIT if wrapper else FOREIGN)
                elif not (hit <= ADMONITIONS and self.inside() or name == "id" and tag == "section"):
                    found = max(found, HIT)
        return found if found == FOREIGN or tag not in TEXT_TAGS and tag not in INLINE else 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.n_tags += 1
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            elif tag == "hr":
                self.flush()
            return
        if tag in INLINE:
            self.links += tag == "a"
            if self.clutter(tag, attrs) or self.named(tag, attrs) == FOREIGN:
                self.push(tag, self.stack[-1][1], True)
            return
        self.links = 0
        if tag in ARTICLES and self.stack[-1][2]:  # an unclosed piece of clutter doesn't swallow the article
            k = len(self.stack) - 1
            while self.stack[k - 1][2]:  # all inside it are left out as well
                k -= 1
            self.close_to(k)
        closes = CLOSED_BY_NEXT.get(tag, ()) + (("p",) if tag in CLOSES_P else ())
        for k in range(len(self.stack) - 1, 0, -1) if any(self.open[t] > 0 for t in closes) else ():
            if self.stack[k][0] in closes:
                self.close_to(k)
                break
            if self.stack[k][0] not in INLINE and self.stack[k][0] not in ("p", "dt", "dd"):
                break
        self.flush()
        out = self.stack[-1][2] or self.clutter(tag, attrs)
        self.parents.append(self.stack[-1][1])
        self.tags.append(tag)
        hit = 0 if out else self.named(tag, attrs)
        if hit and tag in ARTICLES:
            self.doubtful.add(len(self.parents) - 1)
        self.hits.append(0 if tag in ARTICLES else hit)
        self.push(tag, len(self.parents) - 1, out)

    def handle_endtag(self, tag: str) -> None:
        self.n_tags += 1
        if tag in INLINE:
            self.links = max(0, self.links - (tag == "a"))
            if self.stack[-1][0] == tag:
                self.open[tag] -= 1
                del self.stack[-1]
            return
        if self.open[tag] <= 0:
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] == tag:
                self.close_to(k)
                return

    def handle_data(self, data: str) -> None:
        if self.stack[-1][2]:
            return
        if self.open["header"] > 0 and not any(self.open[t] > 0 for t in HEADINGS):
            return
        self.parts.append(data)
        if self.links:
            self.n_link += len(data)


def smoothed(ratios: np.ndarray) -> np.ndarray:
    reach = max(1, int(3 * SIGMA))
    kernel = np.exp(-np.arange(-reach, reach + 1) ** 2 / (2 * SIGMA**2))
    full = np.convolve(ratios, kernel)[reach: reach + len(ratios)]
    return full / np.convolve(np.ones(len(ratios)), kernel)[reach: reach + len(ratios)]


def content_lines(ratios: np.ndarray) -> np.ndarray:
    """Two-means over the smoothed ratios: whether each line is in the upper cluster."""
    values = smoothed(ratios)
    low, high = values.min(), values.max()
    while high > low:
        upper = values > (low + high) / 2
        a, b = values[~upper].mean(), values[upper].mean()
        if (a, b) == (low, high):
            return upper
        low, high = a, b
    return np.ones(len(values), bool)


# What follows are passes over the elements, each after its parent or, for sums, before it: linear in page and depth.


def _named_out(page: _Page, least: int) -> list[bool]:
    """Of each element, whether one around it, up to its article, or itself is at least so clearly clutter by its names."""
    out = [False]
    for e in range(1, len(page.parents)):
        out.append(page.hits[e] >= least or page.tags[e] not in ARTICLES and out[page.parents[e]])
    return out


def _chosen(page: _Page, size: np.ndarray, least: int) -> np.ndarray:
    """The content lines, those of the upper cluster and of prose, of all that no name leaves out."""
    named = _named_out(page, least)
    at = [k for k, line in enumerate(page.lines) if not named[line[3]]]
    out = np.zeros(len(page.lines), bool)
    if at:
        ratios = size[at] / np.maximum(1, [page.lines[k][1] for k in at])
        linked = 2 * np.array([page.lines[k][2] for k in at]) > size[at]
        upper = content_lines(ratios)
        lifted = linked & (ratios < LIFTED * ratios[upper].mean())  # a menu beside long prose, by the smoothing alone
        out[at] = upper & ~lifted | (size[at] >= PROSE) & ~linked
    return out


def _spare(page: _Page, size: np.ndarray) -> None:
    """Takes the HIT from elements that hold more content than lies outside all of them: wrappers, whatever their name.
    Of a form only prose counts."""
    worst = [0]
    for e in range(1, len(page.parents)):
        worst.append(max(page.hits[e], worst[page.parents[e]]))
    held, prose, free = [0.0] * len(worst), [0.0] * len(worst), 0.0
    for (_, _, _, e), n, yes in zip(page.lines, size.tolist(), _chosen(page, size, FOREIGN), strict=True):
        if yes and not worst[e]:
            free += n
        elif yes and worst[e] < FOREIGN:
            held[e] += n
            prose[e] += n if n >= PROSE else 0
    for e in range(len(worst) - 1, 0, -1):
        held[page.parents[e]] += held[e]
        prose[page.parents[e]] += prose[e]
        if (prose if page.tags[e] == "form" else held)[e] > free and page.hits[e] < FOREIGN:
            page.hits[e] = 0


def _weights(page: _Page, size: np.ndarray, chosen: np.ndarray) -> list[float]:
    """The content of each element; clutter has none and is no content of what is around it."""
    weight = [0.0] * len(page.parents)
    for (_, _, _, e), n, yes in zip(page.lines, size.tolist(), chosen, strict=True):
        weight[e] += n if yes else 0
    for e in range(len(weight) - 1, 0, -1):
        if page.hits[e]:
            weight[e] = 0.0
        weight[page.parents[e]] += weight[e]
    return weight


def _articles(page: _Page, weight: list[float]) -> list[int]:
    """The article or main element with the most content, of nested ones of a weight the innermost, and then all
    others apart from it that hold content or stand beside it, but none in or named as clutter."""
    apart = [False]  # whether an element is inside clutter
    for e in range(1, len(page.parents)):
        apart.append(apart[page.parents[e]] or bool(page.hits[e]) or e in page.doubtful)
    named = [e for e, tag in enumerate(page.tags) if tag in ARTICLES]
    found = sorted((e for e in named if weight[e]), key=lambda e: (apart[e], -weight[e], -e))
    if not found:
        return []
    first = found[0]
    beside = [e for e in named if page.parents[e] == page.parents[first]]
    if apart[first]:  # unclosed clutter around all articles
        others = [e for e in beside if e not in page.doubtful]
    else:
        others = [e for e in [*found, *beside] if not apart[e]]
    regions, around, inside = [], {0}, set()
    for e in [first, *others]:
        way, x = [], e
        while x not in around and x not in inside:
            way.append(x)
            x = page.parents[x]
        if not way:
            continue
        if x in inside:
            inside.update(way)
        else:
            regions.append(e)
            inside.add(e)
            around.update(way[1:])
    return regions


def _unnamed(page: _Page, weight: list[float], chosen: np.ndarray) -> tuple[int, np.ndarray]:
    """Where a page names no article: the deepest element with all content, and the lines of the story. These reach from the
    first content line to the last, with the headings right before the first, and with the neighbours of both in their element."""
    region = max(e for e, w in enumerate(weight) if w == weight[0])
    while region and page.tags[region] not in ("div", "section", "td", "body"):
        region = page.parents[region]
    element = [line[3] for line in page.lines]
    at = [k for k in np.flatnonzero(chosen).tolist() if weight[element[k]]]
    story = np.zeros(len(element), bool)
    story[at[0]: at[-1] + 1] = True
    beside = {page.parents[element[at[0]]], page.parents[element[at[-1]]]}
    for k, e in enumerate(element):
        story[k] |= e in beside or page.parents[e] in beside
    k = next((k for k in range(at[0] - 1, -1, -1) if page.tags[element[k]] in HEADINGS), 0)
    if page.tags[element[k]] in HEADINGS:
        story[k: at[0]] = True
        while k and page.tags[element[k - 1]] in HEADINGS:
            k -= 1
            story[k] = True
    return region, story


def main_text(html: str) -> str:
    page = _Page()
    page.feed(html)
    page.close()
    page.close_to(1)
    if not page.lines:
        return ""
    size = np.array([len(x[0]) for x in page.lines], float)
    if any(page.hits):
        _spare(page, size)
    chosen = _chosen(page, size, HIT)
    weight = _weights(page, size, chosen)
    if not any(weight):
        return ""
    regions = _articles(page, weight)
    whole = regions[:1]  # a named article keeps its lists of links
    story = np.ones(len(size), bool)
    if not regions:
        region, story = _unnamed(page, weight, chosen)
        regions = [region]
    of = [0 if 0 in regions else -1]  # the region that an element is in, -1: none, or clutter inside it
    wanted = set(regions)
    for e in range(1, len(page.parents)):
        of.append(e if e in wanted else -1 if page.hits[e] else of[page.parents[e]])
    kept = []
    for (text, _, links, e), yes, told in zip(page.lines, chosen, story, strict=True):
        if of[e] >= 0 and (yes or of[e] in whole or told and 2 * links <= len(text)):
            kept.append(text)
    return " ".join(kept)


def extract(df: DataFrame, html: str = "html") -> DataFrame:
    """Adds ``text``, the main text (empty if none; null pages are empty). An input column ``text`` gives way."""
    kept = without(df, "text") if html.lower() != "text" else df.withColumnRenamed(html, "html")
    source = "html" if html.lower() == "text" else html

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, source):
                yield extend(piece, text=pa.array([main_text(h) for h in texts(piece, source)], pa.string()))

    return kept.mapInArrow(run, appended(kept, T.StructField("text", T.StringType())))
