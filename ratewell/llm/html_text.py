"""Main text of web pages by text-to-tag ratio, Gaussian smoothing and a threshold.

A page is read as a stream of parser events and cut into lines, one for each block of text.  A line's
ratio is its characters outside links over its tags.  Ratios are smoothed with a Gaussian kernel along
the page, and lines at or above a threshold taken from the page's own spread are seeds.  Seeds cluster
by the container that holds them; the content region is the innermost container, no deeper than an article or main,
that holds all seeds, and short lines inside it belong to it.  What stands in navigation, page headers and
footers, sidebars, notices, adverts, forms or comments is never content.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.llm.common import batch_of
from ratewell.llm.words import in_slices

# Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot "
    "th thead tr ul".split()
)
CONTAINERS = set("article body div main section table td".split())
HIDDEN = set(
    "script style noscript template head title svg math canvas iframe object audio video select option textarea button "
    "datalist map".split()
)
IN_HEAD = set("html head base basefont bgsound link meta title style script noscript template".split())
BOILERPLATE = set("nav aside footer form menu dialog search fieldset".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
CLOSES_P = BLOCKS - {"html", "body", "caption", "legend", "summary", "td", "th", "tr", "tbody", "thead", "tfoot", "dd", "dt", "li"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

# Words in a class or id that name something other than the article.
NAMES = (
    "ads? adverts? advertisements? advertising banners? breadcrumbs? captcha comments? cookies? consent disclaimer disqus footers? gdpr "
    "login menus? modals? navs? navbar navigation newsletters? notices? notifications? pagination pager popups? promos? promotions? "
    "sidebars? signup site-?header page-?header skip sponsors? sponsored subscribe subscription toolbar topbar widgets?"
).split()
TOPICS = "related replies reply respond share sharing social".split()  # as often what an article is about
AROUND = "area article bar block bottom box buttons container content form inner inline js links list main page post reader section site slot top unit user wrap wrapper".split()
UNWANTED = re.compile(rf"(?:^|[\s_-])(?:{'|'.join(NAMES + TOPICS)})(?:$|[\s_-]|\d)", re.I)
OTHER = re.compile(rf"(?:(?:{'|'.join(AROUND)})[_-])*(?:{'|'.join(NAMES)})(?:[_-]?(?:{'|'.join(AROUND)}|\d+))*", re.I)


class Lines(HTMLParser):
    """The lines of a page: text, characters in links, tags, container, whether never content, suspect.

    Outside an article or main the words of a class or id decide.  Inside, only a name that says nothing
    else does; an element with such a word in another name is a suspect, and content unless most of its
    characters are in links.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int, int]] = []  # tag, unwanted, container, suspect
        self.open: Counter[str] = Counter()
        self.suspects = [-1]  # the suspect that holds each suspect; the first stands for none
        self.parents, self.depth, self.within = [-1], [0], [False]  # of each container; within an article or main
        self.lines: list[tuple[str, int, int, int, bool, int]] = []
        self.hidden = self.links = self.tags = self.linked = 0
        self.held: list[str] = []

    def cut(self) -> None:
        text = " ".join("".join(self.held).split())
        if text:
            _, unwanted, container, suspect = self.stack[-1] if self.stack else ("", False, 0, 0)
            self.lines.append((text, min(self.linked, len(text)), self.tags, container, unwanted, suspect))
            self.tags = 0
        self.held, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        self.close_head(tag)
        if tag in VOID:
            if tag == "hr":
                self.close_p()
                self.cut()
            elif tag in ("br", "wbr") and not self.hidden:
                self.held.append(" " if tag == "br" else "")
            return
        if tag in BLOCKS:
            if tag in CLOSES_P:
                self.close_p()
            elif tag in CLOSES:
                self.close_until(CLOSES[tag], {"ul", "ol", "dl", "table", "menu"})
            self.cut()
        _, unwanted, container, suspect = self.stack[-1] if self.stack else ("", False, 0, 0)
        inside = self.open["article"] + self.open["main"] > 0
        unwanted = unwanted or tag in BOILERPLATE or (tag == "header" and not inside)
        if not unwanted and attrs and tag not in ("html", "body"):
            named = {k: v or "" for k, v in attrs}
            about = f"{named.get('class', '')} {named.get('id', '')}"
            unwanted = named.get("role", "").lower() in ROLES or "hidden" in named or named.get("aria-hidden") == "true"
            if not unwanted and tag not in ("article", "main") and UNWANTED.search(about):
                unwanted = not inside or any(OTHER.fullmatch(name) for name in about.split())
                if not unwanted:
                    self.suspects.append(suspect)
                    suspect = len(self.suspects) - 1
        if tag in CONTAINERS:
            self.parents.append(container)
            self.depth.append(self.depth[container] + 1)
            self.within.append(self.open["article"] > 0 or tag != "article" and self.open["main"] > 0)
            container = len(self.parents) - 1
        self.hidden += tag in HIDDEN
        self.links += tag == "a"
        self.open[tag] += 1
        self.stack.append((tag, unwanted, container, suspect))

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in VOID:
            return
        if tag in BLOCKS:
            self.cut()
        if not self.open[tag]:
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                self.drop(k)
                return
            if tag not in BLOCKS and self.stack[k][0] in BLOCKS:
                return  # a stray end of an inline tag

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "path", "use"):
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if self.hidden and data.strip():
            self.close_head("")
        if not self.hidden:
            self.held.append(data)
            if self.links:
                self.linked += len(data)

    def drop(self, k: int) -> None:
        for tag, *_ in self.stack[k:]:
            self.hidden -= tag in HIDDEN
            self.links -= tag == "a"
            self.open[tag] -= 1
        del self.stack[k:]

    def close_head(self, tag: str) -> None:
        """The end of a head may be left out: what cannot stand in it, or text, ends it, and a body always."""
        if not self.hidden or tag in IN_HEAD:
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == "head":
                self.cut()
                self.drop(k)
                return
            if tag != "body":
                return

    def close_p(self) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == "p":
                self.cut()
                self.drop(k)
                return
            if self.stack[k][0] in BLOCKS:
                return

    def close_until(self, tags: set[str], fence: set[str]) -> None:
        if not any(self.open[tag] for tag in tags):
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in tags:
                self.cut()
                self.drop(k)
                return
            if self.stack[k][0] in fence:
                return


def smooth(ratio: np.ndarray, sigma: float) -> np.ndarray:
    """Convolution with a Gaussian of ``sigma`` lines; the ends count what there is of the kernel."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = np.convolve(ratio, kernel)[reach : reach + len(ratio)]
    return full / np.convolve(np.ones(len(ratio)), kernel)[reach : reach + len(ratio)]


def never_content(page: Lines) -> list[bool]:
    """Of each line whether it can't be content: it is unwanted, or in a suspect that is mostly links."""
    chars, linked = [0] * len(page.suspects), [0] * len(page.suspects)
    for text, in_links, _, _, unwanted, suspect in page.lines:
        if not unwanted:
            chars[suspect] += len(text)
            linked[suspect] += in_links
    for k in range(len(page.suspects) - 1, 0, -1):  # what holds a suspect comes before it
        chars[page.suspects[k]] += chars[k]
        linked[page.suspects[k]] += linked[k]
    out = [False] * len(page.suspects)
    for k in range(1, len(page.suspects)):
        out[k] = out[page.suspects[k]] or 2 * linked[k] > chars[k]
    return [unwanted or out[suspect] for *_, unwanted, suspect in page.lines]


def region_of(seeds: list[int], parents: list[int], depth: list[int], within: list[bool]) -> int:
    """The innermost container of all ``seeds`` that isn't inside an article or main.

    ``seeds`` are the containers of the seed lines.  An article or main is not looked into, but for an
    article in a main: its sections belong together.
    """
    held = [0] * len(parents)
    for node in seeds:
        held[node] += 1
    for node in range(len(parents) - 1, 0, -1):  # a container comes after the one that holds it
        held[parents[node]] += held[node]
    return max((n for n, c in enumerate(held) if c == len(seeds) and not within[n]), key=depth.__getitem__, default=0)


def main_text(html: str | None, sigma: float = 1.0) -> str:
    """The blocks of the content region in page order, joined by two line ends."""
    page = Lines()
    page.feed(html or "")
    page.close()
    page.cut()
    lines = page.lines
    if not lines:
        return ""
    never = never_content(page)
    ratio = np.array([0.0 if no else (len(x[0]) - x[1]) / max(x[2], 1) for x, no in zip(lines, never)])
    found = smooth(ratio, sigma)
    seeds = (found >= min(found.std(), found.max())) & (ratio > 0)
    if not seeds.any():
        seeds = ratio > 0
    if not seeds.any():
        return ""
    region = region_of([lines[k][3] for k in np.flatnonzero(seeds)], page.parents, page.depth, page.within)
    inside = [node == region for node in range(len(page.parents))]
    for node in range(1, len(inside)):
        inside[node] = inside[node] or inside[page.parents[node]]
    return "\n\n".join(x[0] for x, no in zip(lines, never) if not no and inside[x[3]])


def extract_text(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text and n_chars, its code points.

    The whole html is read, however long.  A null or empty html, or one without content, gives the
    empty text; null ids and urls stay null; repeated rows give repeated rows; other columns are left
    out.  Rows are independent, so there is no shuffle.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "html"):
            found = [main_text(x.as_py()) for x in batch.column("html")]
            yield batch_of(schema, batch.column("page_id"), batch.column("url"), found, [len(x) for x in found])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(read, "page_id long, url string, text string, n_chars long")
