"""Main text of HTML pages: parser events, text-to-tag ratios per line, smoothing, clustering.

Events of the standard library's parser build a page's lines (the text of one block element each, white space as one
blank) without a tree.  A line's ratio is its characters per tag; ratios are smoothed by a Gaussian over neighbouring
lines, and lines at or above the threshold (a share of the mean) are content.  Neighbouring content lines are clusters.
The article element that holds nearly all of the clusters' text, or else the innermost section that holds all of it and the
title, is the article, and its lines are the result, short ones too.  A cluster begins and ends with a line that is content by its own ratio, or a section
that it reaches as a whole.  Lines in
elements that are never article text (menus, headers, footers, asides, forms, scripts), or whose class, id or role says so as a
whole (adverts, notices, comments, ...; ``related-work`` does not), neither count nor are returned; paragraphs, headings and such, and
sections by their id, only if named as comments, adverts or teasers, since those names may be words of the article.  Nor, outside an
article element, menus: lines that are mostly links, have less text to a tag than content has, and stand in a section or list
that is mostly links (a section of one line counts with the section around it).

Edge cases.  Null and empty pages, and pages without content, have an empty text.  Elements that are never closed end with
their parent, broken markup is read as the parser reads it, and nothing is cut: very long pages are read whole.
A column function, so further columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.blocks import utf8

SIGMA, THRESHOLD, HOLDS, LINKS = 1.0, 0.3, 0.9, 0.5   # HOLDS: of an article element; other sections hold all
# Elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("head title script style noscript template svg math iframe object canvas audio video nav aside footer form "
                  "fieldset button select option textarea label dialog menu".split())
BREAKS = frozenset("html body article main section div header hgroup address p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote "
                   "pre figure figcaption table caption thead tbody tfoot tr hr details summary center".split()) | NEVER - {"label"}
SECTIONS = frozenset("html body article main section div td".split())
LISTS = frozenset("ul ol dl table".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TRACKED = BREAKS | SECTIONS
HINTS = frozenset("ad ads adv advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner nav navbar "
                  "navigation menu breadcrumb breadcrumbs sidebar aside widget widgets footer foot masthead topbar "
                  "cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe "
                  "subscription signup login comment comments commentlist reply replies respond disqus share sharing "
                  "social related recommended recommendations teaser pagination pager copyright legal disclaimer toolbar "
                  "search searchform hidden complementary contentinfo dialog alertdialog".split())
SITE_HEADER = frozenset("site page top global main header".split())
ARTICLE_HINTS = frozenset("comment comments reply replies related teaser promo sponsored ad ads advert".split())
# Words that say nothing of what an element is for.
NEUTRAL = frozenset("post posts article articles story stories entry page site user users reader readers author main primary "
                    "secondary global top bottom left right inner outer header body content text title list item items box boxes "
                    "container wrapper wrap section block area zone unit slot panel group row col column columns bar link links button "
                    "buttons icon icons form field media module region message policy google thread count fixed sticky floating "
                    "mobile desktop small large first last even odd".split())
PARAGRAPHS = HEADINGS | frozenset("p blockquote pre li tr td dt dd figure figcaption caption table hr address".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+").findall


class Lines(HTMLParser):
    """The lines of a page: (text, tags, characters in links, path of sections, never content, name of its heading, groups)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int, int]] = []   # open block elements: name, never content, section, group
        self.lines: list[tuple[str, int, int, tuple[int, ...], bool, str, tuple[int, ...]]] = []
        self.sections: list[str] = []
        self.parts: list[str] = []
        self.tags = self.linked = self.link = self.groups = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            path = tuple(section for _, _, section, _ in self.stack if section >= 0)
            groups = tuple(group for *_, group in self.stack if group >= 0)[-2:]
            never = any(bad for _, bad, _, _ in self.stack)
            heading = next((name for name, *_ in self.stack[-2:] if name in HEADINGS), "")
            if any(name == "header" for name, *_ in self.stack):
                never |= not heading or not any(name in ("article", "main") for name, *_ in self.stack)
            self.lines.append((text, self.tags, min(self.linked, len(text)), path, never, heading, groups))
        self.parts, self.tags, self.linked = [], 0, 0

    def handle_starttag(self, tag, attrs):
        if tag in BREAKS:
            self.end_line()
            self.link = 0
        self.tags += 1
        if tag == "a":
            self.link = 1
        if tag in ("br", "td", "th"):
            self.parts.append(" ")
        if tag in VOID or tag not in TRACKED:
            return
        if tag in ("p", "li", "tr", "td", "dt", "dd", "option"):
            self.close_open(tag, within=SECTIONS - {"td"} | {"ul", "ol", "table", "dl", "select"} if tag != "p" else SECTIONS)
        elif tag in ("article", "main"):
            while self.stack and self.stack[-1][0] in ("nav", "header", "p", "ul", "li"):
                self.stack.pop()
        section = group = -1
        if tag in SECTIONS:
            section = len(self.sections)
            self.sections.append(tag)
        if tag in SECTIONS or tag in LISTS:
            group = self.groups
            self.groups += 1
        self.stack.append((tag, tag in NEVER or named_so(tag, attrs), section, group))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BREAKS:
            self.end_line()
        self.tags += 1
        if tag == "a":
            self.link = 0
        if tag in TRACKED:
            self.close_open(tag)

    def finish(self) -> None:
        """Read what is left at the end of the page."""
        self.goahead(True)
        self.end_line()

    def close_open(self, tag: str, within: frozenset[str] = frozenset()) -> None:
        """Close the innermost open element of that name, and what is open inside it."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return
            if self.stack[i][0] in within:
                return

    def handle_data(self, data):
        self.parts.append(data)
        if self.link:
            self.linked += len(data)

    def unknown_decl(self, data):
        """Marked sections, such as CDATA outside of scripts, are not text."""


def named_so(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """Whether attributes say that an element is not part of the article."""
    if not attrs or tag in ("html", "body"):
        return False
    for name, value in attrs:
        value = value or ""
        if name in ("class", "id", "role"):
            if name == "id" and tag in HEADINGS:
                continue   # a heading's id is made of its words
            few = tag in ("article", "main") or tag in PARAGRAPHS or name == "id" and tag == "section"
            hints = ARTICLE_HINTS if few else HINTS
            for token in value.split():
                words = {word.lower() for word in WORDS(token) if not word.isdigit()}
                if words & hints and words <= hints | NEUTRAL or "header" in words and words <= SITE_HEADER:
                    return True
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (
                name == "style" and "display:none" in value.replace(" ", "").lower()):
            return True
    return False


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """The ratios averaged over their neighbours with Gaussian weights."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel, "full")[reach:reach + len(ratios)]
    return np.convolve(ratios, kernel, "full")[reach:reach + len(ratios)] / weight


def clustered(lines: list[tuple], level: np.ndarray, ratios: np.ndarray, least: float) -> np.ndarray:
    """Which lines are in clusters: smoothed ratios at or above ``least``, from the first to the last line with such a ratio of its own.

    Smoothing has a cluster reach into what stands before and after it; a section counts there only if reached as a whole.
    """
    chosen = level >= least
    own = np.flatnonzero(chosen & (ratios >= least))
    run = np.cumsum(~chosen)                 # equal within a cluster
    out = np.zeros(len(level), bool)
    if len(own):
        out[own] = True
        innermost = [path[-1] if path else -1 for _, _, _, path, *_ in lines]
        missed = {section for section, there in zip(innermost, chosen.tolist()) if not there}
        out |= chosen & np.array([section not in missed for section in innermost])
        for a, b in zip(own[:-1].tolist(), own[1:].tolist()):
            if b > a + 1 and run[a] == run[b]:
                out[a:b] = True
    return out


def main_text(html: str) -> str:
    """The article of one page: its blocks in order, a line each."""
    page = Lines()
    page.feed(html)
    page.finish()
    lines = [line for line in page.lines if not line[4]]
    if not lines:
        return ""
    ratios = np.array([len(text) / max(1, tags) for text, tags, *_ in lines])
    level = smoothed(ratios)
    least = THRESHOLD * level.mean()
    menu = menus(lines, ratios, least)
    content = clustered(lines, level, ratios, least) & ~menu
    mass: dict[int, int] = {}
    total = 0
    for line, chosen in zip(lines, content.tolist()):
        if chosen:
            total += len(line[0])
            for section in line[3]:
                mass[section] = mass.get(section, 0) + len(line[0])
    best = -1
    title = next((line[3] for level in ("h1", "h2") for line in lines if line[5] == level), None)
    for section in sorted(mass):   # a section's number is above those of the sections around it
        element = page.sections[section] in ("article", "main")
        named = element or title is None or section in title
        if mass[section] >= (HOLDS if element else 1) * total and named and (
                best < 0 or page.sections[best] not in ("article", "main")):
            best = section
    article = any(page.sections[s] in ("article", "main") for line in lines for s in line[3] if best in line[3] and s <= best)
    return "\n".join(line[0] for line, left_out in zip(lines, menu.tolist())
                     if (best < 0 or best in line[3]) and (article or line[5] or not left_out))


def menus(lines: list[tuple], ratios: np.ndarray, least: float) -> np.ndarray:
    """Which lines are of menus: mostly links, with a ratio below ``least``, in a section or list that is mostly links."""
    sizes: dict[int, int] = {}
    for line in lines:
        for group in line[6][-1:]:
            sizes[group] = sizes.get(group, 0) + 1
    # A section of one line is a paragraph of the section around it.
    homes = [(groups[0] if len(groups) > 1 and sizes[groups[-1]] == 1 else groups[-1]) if groups else -1
             for *_, groups in lines]
    chars: dict[int, int] = {}
    linked: dict[int, int] = {}
    for line, home in zip(lines, homes):
        chars[home] = chars.get(home, 0) + len(line[0])
        linked[home] = linked.get(home, 0) + line[2]
    return np.array([line[2] >= LINKS * len(line[0]) and ratio < least and linked[home] >= LINKS * chars[home]
                     for line, ratio, home in zip(lines, ratios.tolist(), homes)], bool)


def extracted(html: str = "html") -> Column:
    """The main text of a column of pages."""
    @F.arrow_udf(T.StringType())
    def texts(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([main_text(page.decode()) for page in utf8(column)], pa.string())

    return texts(F.col(html))
