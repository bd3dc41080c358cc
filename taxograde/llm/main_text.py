"""Operator 11: main text of web pages by the distribution of line blocks.

A page is stripped of its markup into lines, one per block of text; comments,
scripts, styles and other raw-text elements give none. Every line weighs its
characters outside links, and nothing where it lies in a part that holds no
article text (menus, page headers and footers, asides, forms, and elements whose
class, id or role says advert, notice, comments and the like). Where a container
begins or ends, empty lines separate what stands on its two sides, as its markup
lines do in a page's source. The weights of WINDOW neighbouring lines are summed:
the text surges where such a sum rises from nothing and dives where it is nothing
again, and the lines from a surge to its dive are one stretch.

If the page marks its article (``article`` or ``main`` elements), only lines inside
count, links included; else all lines count. Stretches whose largest window
reaches SURGE characters are the text; if none does, the heaviest stretch is.

Character references are decoded as browsers do, white space inside a block is one
space, blocks are joined by a line feed in page order. Nulls and edges: a null,
empty or text-free page gives the empty string and 0 characters; an unclosed
comment or raw-text element reaches to the end of the page; a tag cut off by the
end is markup; rows of equal ids or texts and null ids are kept row by row; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles as S
from .common import prepared, table

WINDOW = 3
SURGE = 86

#: Elements of HTML by what they do to a line of text.
RAW = frozenset("script style title textarea noscript iframe template xmp noembed noframes svg math canvas audio video object".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img".split())
NOISE = frozenset("nav header footer aside form menu dialog button select option datalist fieldset head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert alertdialog dialog toolbar".split())
NAMES = frozenset("ad ads adv advert adverts advertisement advertising advertorial banner sponsor sponsored promo promotion "
                  "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar "
                  "cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup login paywall "
                  "popup modal overlay comment comments reply replies respond discussion disqus "
                  "share sharing social related recommended recommendations widget pager pagination search".split())
_MARKS = frozenset(["article", "main"])
_WHOLE = frozenset(["html", "body"])

_TAG = re.compile(r"(/?)([A-Za-z][^\s/>]*)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>")
_CUT_TAG = re.compile(r"(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"(?i)\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_ROLE = re.compile(r"(?i)\brole\s*=\s*[\"']?([A-Za-z]+)")
_HIDDEN = re.compile(r"(?i)(?:^|\s)hidden(?:[\s=/]|$)")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def tokens(page: str):
    """(text, closing, name, attributes) in order: text before each tag, and the tag or None at the end."""
    at, end, text_from = 0, len(page), 0
    while True:
        at = page.find("<", at)
        if at < 0:
            yield page[text_from:], False, None, ""
            return
        if page.startswith("<!--", at):
            stop = page.find("-->", at + 4 if not page.startswith("<!-->", at) else at + 2)
            yield page[text_from:at], False, "!", ""
            at = text_from = end if stop < 0 else stop + 3
        elif page.startswith(("<!", "<?"), at):
            stop = page.find(">", at)
            yield page[text_from:at], False, "!", ""
            at = text_from = end if stop < 0 else stop + 1
        else:
            m = None
            if page[at + 1:at + 2].isalpha() or page[at + 1:at + 2] == "/" and page[at + 2:at + 3].isalpha():
                m = _TAG.match(page, at + 1) or _CUT_TAG.match(page, at + 1)
                if m is None:  # cut off by the end of the page, or no tag of this alphabet
                    if page[at + 1:at + 3].isascii():
                        yield page[text_from:at], False, None, ""
                        return
            if m is None:
                at += 1
                continue
            name = m[2].lower()
            yield page[text_from:at], bool(m[1]), name, m[3]
            at = text_from = m.end()
            if not m[1] and name in RAW and not m[3].endswith("/"):
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = text_from = close.end() if close else end


def _named_noise(name: str, attributes: str) -> bool:
    if name in _WHOLE or name in _MARKS or not attributes:
        return False
    role = _ROLE.search(attributes)
    if role and role[1].lower() in ROLES:
        return True
    for m in _ATTRIBUTE.finditer(attributes):
        if any(w.lower() in NAMES for w in _NAME.findall(m[1] or m[2] or m[3] or "")):
            return True
    return bool(_HIDDEN.search(attributes))


class _Lines:
    """The lines of a page: text, weight, and the mark (article) they lie in; None is an empty line."""

    def __init__(self):
        self.out: list[tuple[str, int, int] | None] = []
        self.parts: list[str] = []
        self.linked = 0
        self.open: list[tuple[str, int, bool]] = []  # (name, noise: 0 none, 1 named, 2 element; opens a mark)
        self.noise = self.links = self.marks = self.mark = self.inside = 0

    def text(self, raw: str) -> None:
        if not raw or self.noise:
            return
        self.parts.append(raw)
        if self.links:
            self.linked += len("".join(html.unescape(raw).split()))

    def end_line(self) -> None:
        if self.parts:
            words = html.unescape("".join(self.parts)).split()
            if words:
                size = sum(map(len, words))
                self.out.append((" ".join(words), size if self.inside else max(0, size - self.linked), self.mark if self.inside else 0))
            self.parts, self.linked = [], 0

    def gap(self) -> None:
        if self.out and self.out[-1] is not None:
            self.out.append(None)

    def start(self, name: str, attributes: str) -> None:
        if name == "a":
            self.links = 1
        if name == "br":
            self.parts.append(" ")
        if name in INLINE and not _named_noise(name, attributes) or name in VOID and name != "hr":
            return
        self.end_line()
        if name in VOID:
            return
        if name in ("p", "li", "dt", "dd", "option", "tr", "td", "th") and self.open and self.open[-1][0] == name:
            self.end(name)
        noise = 0
        if name in NOISE and not (name == "header" and self.inside):
            noise = 2
        elif _named_noise(name, attributes):
            noise = 1
        marks = name in _MARKS and (not self.noise or name == "main") and not noise
        if marks and self.noise:  # a container that was never closed does not hide the article
            self.open, self.noise = [(n, 0, m) for n, _, m in self.open], 0
        if noise or marks:
            self.gap()
        if marks:
            if not self.inside:
                self.marks += 1
                self.mark = self.marks
            self.inside += 1
        if noise:
            self.noise += 1
        self.open.append((name, noise, marks))

    def end(self, name: str) -> None:
        if name == "a":
            self.links = 0
        held = any(n == name for n, _, _ in reversed(self.open))
        if name in INLINE and not held:
            return
        self.end_line()
        while held:
            n, noise, marks = self.open.pop()
            if noise:
                self.noise -= 1
            if marks:
                self.inside -= 1
            if noise or marks:
                self.gap()
            if n == name:
                return


def lines(page: str) -> list[tuple[str, int, int] | None]:
    """The stripped page: (text, weight, number of its article or 0) of each line, None between containers."""
    state = _Lines()
    for text, closing, name, attributes in tokens(page):
        state.text(text)
        if name is None or name == "!":
            continue
        (state.end(name) if closing else state.start(name, attributes))
    state.end_line()
    return state.out


def stretches(weights: list[int]) -> list[tuple[int, int, int]]:
    """(first, end, largest window) of each stretch from a surge to the dive that follows."""
    n = len(weights)
    window = [sum(weights[i:i + WINDOW]) for i in range(n)]
    out, at = [], 0
    while at < n:
        if not weights[at]:
            at += 1
            continue
        end = at
        while end < n and window[end]:
            end += 1
        end = min(end, n)
        last = max(i for i in range(at, end) if weights[i]) + 1
        out.append((at, last, max(window[at:last])))
        at = last
    return out


def main_text(page: str | None) -> str:
    """The article of one page."""
    found = lines(page or "")
    marked = any(x and x[2] for x in found)
    # a gap is as many empty lines as a window is long, so that no window reaches over it
    rows: list[tuple[str, int]] = []
    for x in found:
        if x is None:
            rows += [("", 0)] * WINDOW
        elif marked and not x[2]:
            rows.append(("", 0))
        else:
            rows.append((x[0], x[1]))
    some = stretches([w for _, w in rows])
    if not some:
        return ""
    kept = [s for s in some if s[2] >= SURGE] or [max(some, key=lambda s: sum(w for _, w in rows[s[0]:s[1]]))]
    if marked:
        kept = _same_articles(rows, some, kept, found)
    return "\n".join(text for first, end, _ in kept for text, _ in rows[first:end] if text)


def _same_articles(rows, some, kept, found):
    """All stretches of the articles that a kept stretch lies in: notes inside an article may part it."""
    of = []
    for x in found:
        of += [0] * WINDOW if x is None else [x[2]]
    chosen = {of[s[0]] for s in kept}
    return [s for s in some if of[s[0]] in chosen]


def _extract(batches):
    for batch in batches:
        for lo, n in S.chunks(batch.column(2)):
            part = batch.slice(lo, n)
            text = pa.array([main_text(x) for x in part.column(2).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), text], ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html, ...)`` -> (page_id, url, text, n_chars), a row per row."""
    prepared(pages.sparkSession)
    out = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return (out.mapInArrow(_extract, "page_id long, url string, text string")
            .withColumn("n_chars", F.length("text").cast("long")))


def op11_line_blocks(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"))


#: The same rows for pages of one article without inner notes: its blocks, references decoded.
ORACLE = """
with body as (
  select page_id, url, regexp_extract(html, '(?s)<article>(.*)</article>', 1) as a from pages),
blocks as (
  select page_id, url, list_transform(regexp_split_to_array(a, '</?(p|h1)>'), lambda b: trim(regexp_replace(regexp_replace(
    replace(replace(regexp_replace(regexp_replace(regexp_replace(b, '<br>', ' ', 'g'), '</?b>', '', 'g'),
      '&quot;?', '"', 'g'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '[\\s\\x{00A0}]+', ' ', 'g'))) as bs from body),
joined as (
  select page_id, url, array_to_string(list_filter(bs, lambda b: b <> ''), chr(10)) as text from blocks)
select page_id, url, text, cast(length(text) as bigint) as n_chars from joined
"""
