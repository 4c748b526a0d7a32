"""Main text of web pages by the distribution of line-block lengths.

Markup is stripped to lines: each block element of the page starts one, and lines inside
menus, headers, footers, side bars, forms and the like have length zero, as have lines
that are mostly link text. The lengths are summed over sliding windows of lines. Text
surges where a window's sum first passes the threshold and dives where the sums fall to
zero; the lines between are kept.

Words in class, id or role only raise a doubt: what lies in elements named like adverts,
notices or comments has length zero while text surges elsewhere. Where it does not, and
there are whole windows with far more of it, the lines with the fewest doubts are taken
in, then those with more.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm import common

WINDOW = 3
#: Least sum of a window in which text surges; less where the page has no such window.
SURGE = 80
#: A region of text counts when its highest window has this part of the page's highest.
PEAK = 0.25
#: A line with a larger part of its text in links has length zero.
LINKED = 0.6

#: Elements whose content is no text of the page, up to their end tags.
_REMOVED = frozenset(("script", "style", "noscript", "template", "textarea", "title", "iframe"))
_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)")
#: The rest of a tag: a quoted value follows an equals sign and may hold any character.
_REST = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?=[^\"'])))*+>")
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_INLINE = frozenset(
    ("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
     "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
     "var", "wbr", "img", "br")
)
_VOID = frozenset(
    ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
)
_OUTSIDE = frozenset(
    ("nav", "header", "footer", "aside", "form", "menu", "button", "dialog", "fieldset", "select", "svg", "math",
     "object", "audio", "video", "canvas")
)
_ARTICLE = frozenset(("article", "main"))
#: Ends of the elements above, in any case.
_ENDS = {name: re.compile(rf"</{name}\s*+>", re.IGNORECASE) for name in _REMOVED}
#: Words in class, id or role that tell what is not main text.
_NOT_TEXT = frozenset(
    ("ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
     "byline", "comment", "comments", "commentlist", "complementary", "contentinfo", "cookie", "cookies", "consent",
     "disclaimer", "disqus", "discussion", "footer", "gdpr", "header", "masthead", "menu", "modal", "nav", "navbar",
     "navigation", "newsletter", "notice", "notices", "notification", "pager", "pagination", "popup", "privacy",
     "promo", "promotion", "recommended", "related", "replies", "reply", "respond", "share", "sharing", "sidebar",
     "social", "sponsor", "sponsored", "subscribe", "teaser", "teasers", "toolbar", "topbar", "widget", "alert",
     "responses", "feedback", "login", "search", "copyright", "sidenav", "offcanvas", "overlay", "toc")
)
#: Those that also stand in names of whole articles; alone they raise half the doubt.
_WEAK = frozenset(
    ("alert", "feedback", "login", "notice", "notices", "overlay", "privacy", "promo", "related", "search", "share",
     "sharing", "social", "subscribe", "teaser", "teasers", "toolbar", "widget")
)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _is_hidden(tag: str, attributes: str) -> bool:
    if tag in _OUTSIDE:
        return True
    return bool(attributes) and re.search(
        r"\bhidden\b(?!\s*=\s*[\"']?until)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", attributes
    ) is not None


def _doubts(tag: str, attributes: str) -> int:
    """How far the names of an element tell that it is no main text: 0, 1 or 2."""
    if not attributes or tag in ("body", "html", "article", "main") and "comment" not in attributes.lower():
        return 0
    most = 0
    for m in _NAMED.finditer(attributes):
        value = m[1] or m[2] or m[3] or ""
        for name in value.split():
            if not name.lower().startswith(("has-", "with-", "no-", "without-")):
                for part in _PARTS.findall(name):
                    if part.lower() in _NOT_TEXT:
                        most = max(most, 1 if part.lower() in _WEAK else 2)
    return most


def _tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, name, attributes) of each tag in turn; what is left out whole, such
    as a comment or a script, has no name. One pass: a tag, comment or script that does not
    end goes on to the end of the page."""
    at = page.find("<")
    while at >= 0:
        slash = name = attributes = ""
        if page.startswith("<!--", at):
            end = _after(page, "-->", at + 4)
        elif page.startswith("<![CDATA[", at):
            end = _after(page, "]]>", at + 9)
        elif page.startswith(("<!", "<?"), at):
            end = _after(page, ">", at)
        elif m := _NAME.match(page, at):
            rest = _REST.match(page, m.end())
            end = len(page)
            if rest:
                slash, name, end = m[1], m[2].lower(), rest.end()
                attributes = page[m.end() : end - 1]
            if name in _REMOVED and not slash:
                close = _ENDS[name].search(page, end)
                end, name = close.end() if close else len(page), ""
        else:
            at = page.find("<", at + 1)
            continue
        yield at, end, slash, name, attributes
        at = page.find("<", end)


def _after(page: str, mark: str, at: int) -> int:
    found = page.find(mark, at)
    return len(page) if found < 0 else found + len(mark)


class _Line:
    __slots__ = ("doubts", "linked", "outside", "parts")

    def __init__(self, outside: bool, doubts: int):
        self.parts: list[str] = []
        self.linked = 0
        self.outside, self.doubts = outside, doubts


def lines_of(page: str) -> list[tuple[str, int, int]]:
    """(text, length, doubts) of each line of a page, where doubts are those that the names
    of the elements around it raise. A line that is none by its elements or
    links has length zero. Lines without any text are left out, but for those of length zero."""
    stack: list[tuple[str, bool, int]] = []  # tag, outside, doubts: each with its parents
    opened: Counter[str] = Counter()
    outside, doubts = False, 0
    links, at = 0, 0
    line = _Line(False, 0)
    lines = [line]
    resumed: _Line | None = None

    def text(part: str) -> None:
        if part:
            line.parts.append(part)
            if links:
                line.linked += len(part.strip())

    def close(depth: int) -> tuple[bool, int]:
        for tag, *_ in stack[depth:]:
            opened[tag] -= 1
        del stack[depth:]
        return stack[-1][1:] if stack else (False, 0)

    for start, end, slash, tag, attributes in _tags(page):
        text(page[at:start])
        at = end
        if not tag:
            line.parts.append(" ")
            continue
        if tag == "a":
            links = 0 if slash else 1
        if tag == "br":
            line.parts.append(" ")
        elif slash:
            if opened[tag]:
                depth = len(stack) - 1
                while stack[depth][0] != tag:
                    depth -= 1
                outside, doubts = close(depth)
        elif tag not in _VOID:
            hidden, doubted = _is_hidden(tag, attributes), _doubts(tag, attributes)
            if tag in _ARTICLE and not hidden and not doubted:
                outside = False  # an article does not lie in a menu that was never closed
            if tag == "p" and stack and stack[-1][0] == "p":
                outside, doubts = close(len(stack) - 1)
            outside, doubts = outside or hidden, doubts + doubted
            stack.append((tag, outside, doubts))
            opened[tag] += 1
        if tag not in _INLINE:
            links, resumed = 0, None
        elif (outside, doubts) == (line.outside, line.doubts):
            continue
        elif resumed is not None and (outside, doubts) == (resumed.outside, resumed.doubts):
            line, resumed = resumed, None  # a block goes on after an inline advert
            continue
        else:
            resumed = line
        line = _Line(outside, doubts)
        lines.append(line)
    text(page[at:])
    out = []
    for x in lines:
        joined = " ".join(html.unescape("".join(x.parts)).split())
        if x.outside and out and not out[-1][1]:
            continue  # what is left out between two lines of text takes one line
        if joined:
            wordy = not x.outside and x.linked <= LINKED * len(joined)
            out.append((joined, len(joined) if wordy else 0, x.doubts))
    return out


def regions(lengths: list[int], surge: int) -> list[tuple[int, int]]:
    """[start, end) of the lines between each surge and the dive that follows it."""
    n = len(lengths)
    sums = [sum(lengths[i : i + WINDOW]) for i in range(n)]
    found, i = [], 0
    while i < n:
        if sums[i] < surge or not lengths[i]:
            i += 1
            continue
        end, peak = i, 0
        while end < n and sums[end]:
            peak = max(peak, sums[end])
            end += 1
        last = max(j for j in range(i, min(end + WINDOW, n)) if lengths[j])
        first = i
        while first and lengths[first - 1] and (not found or first > found[-1][1]):
            first -= 1  # short lines right before the surge, such as a heading
        found.append((first, last + 1, peak))
        i = last + 1
    highest = max((p for _, _, p in found), default=0)
    return [(a, b) for a, b, p in found if p >= PEAK * highest]


def _highest(lengths: list[int], lines: int = 0) -> int:
    """The highest sum of a window that has so many lines of text."""
    windows = (lengths[i : i + WINDOW] for i in range(len(lengths)))
    return max((sum(w) for w in windows if len(w) - w.count(0) >= lines), default=0)


def main_text(page: str | None) -> str:
    """The kept lines of a page, joined by newlines; empty if there are none."""
    if not page:
        return ""
    lines = lines_of(page)
    best, lengths = 0, [0] * len(lines)
    for level in sorted({doubts for _, length, doubts in lines if length}):
        own = [length if doubts == level else 0 for _, length, doubts in lines]
        more = _highest(own, WINDOW if level else 0)
        if best < min(SURGE, PEAK * more):
            best, lengths = more, [length if doubts <= level else 0 for _, length, doubts in lines]
    # Doubted lines between two lines of text take one line, as others that are left out.
    rows: list[tuple[str, int]] = []
    for (joined, _, _), length in zip(lines, lengths):
        if length or not rows or rows[-1][1]:
            rows.append((joined, length))
    sizes = [length for _, length in rows]
    surge = min(SURGE, best) or 1
    return "\n".join(rows[i][0] for a, b in regions(sizes, surge) for i in range(a, b) if sizes[i])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in common.chunks(batches, "html"):
        texts = [main_text(x) for x in chunk.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                chunk.column("page_id"), chunk.column("url"),
                pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html).

    A null or empty page, and one without main text, has an empty text. Pages are read
    whole, however long, in time that grows with their length. Repeated rows are answered one by one, null ids and addresses
    stay, other columns are ignored. An empty table gives an empty result."""
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    ).mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
