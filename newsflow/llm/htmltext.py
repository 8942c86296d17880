"""Main text of HTML pages by line-block distribution.

Markup is stripped to lines: one for each block of the page, with the text that
lies inside menus, headers, footers, sidebars, notices, adverts, forms, comments,
scripts and styles left out. Over the lines, lengths are summed in sliding windows;
the text begins where the sums surge and ends where they dive, and the lines between
are kept. Where the page marks its article and most of the longest such text lies in
it, the distribution is taken inside it.
"""

from __future__ import annotations

import html as H
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

WINDOW = 3                       # lines of a block
SURGE = 60                       # characters in a block at which text may begin
LINKED = 0.5                     # share of a line's characters inside links from which it is a menu

# Elements of HTML.
RAW = {"script", "style", "iframe", "textarea", "title"}
EMBEDDED = {"noscript", "template", "object", "svg", "math", "select", "canvas", "audio", "video"}
CUT = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "head", "noindex"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
          "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "input"}
# end tags that may be missing: what an opening tag closes, up to the element it cannot leave
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "dt": {"dt", "dd", "p"},
          "dd": {"dt", "dd", "p"}, "option": {"option"}}
BOUNDS = {"ul", "ol", "table", "dl", "select", "article", "section", "main", "div", "body", "blockquote", "nav", "aside", "header", "footer", "form"}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
UNWANTED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adsense|banners?|sponsor(?:ed)?|promos?|promotion|sidebars?|side-?bar|menus?|nav(?:bar|igation)?|"
    r"breadcrumbs?|footers?|headers?|masthead|cookies?|consent|gdpr|notices?|alerts?|popups?|modals?|overlay|newsletters?|subscribe|subscription|signup|login|"
    r"comments?|disqus|responses?|replies|respond|related|recommended|recommendations|share|sharing|social|toolbar|pagination|pager|widgets?|"
    r"copyright|disclaimer|legal|contentinfo|complementary|search|skip-?link|toc)(?:$|[\s_-])", re.I)
SPACE = re.compile(r"\s+")


class Line:
    __slots__ = ("article", "linked", "text")

    def __init__(self, text: str, linked: int, article: bool):
        self.text, self.linked, self.article = text, linked, article


def _unwanted(name: str, attributes: str, cards: bool) -> bool:
    if name in CUT or name in EMBEDDED:
        return True
    if not attributes or name in ("html", "body", "main") or name == "article" and not cards:
        return False
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key in ("class", "id", "role"):
            if UNWANTED.search(value):
                return True
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


def lines(page: str, cards: bool = True) -> list[Line]:
    """The blocks of a page, without the text of unwanted elements (with ``cards``, an article may be one)."""
    out: list[Line] = []
    text: list[str] = []
    linked = 0
    stack: list[tuple[str, bool]] = []       # open elements: name, unwanted
    cut = links = articles = 0
    at, n = 0, len(page)

    def end_block():
        nonlocal linked
        if text:
            s = SPACE.sub(" ", H.unescape("".join(text))).strip()
            if s:
                out.append(Line(s, linked, articles > 0))
            text.clear()
        linked = 0

    def pop(down_to: int):
        nonlocal cut, links, articles
        while len(stack) > down_to:
            name, bad = stack.pop()
            cut -= bad
            if bad and not cut and name not in EMBEDDED:
                out.append(Line("", 0, False))      # an empty line where something was cut out
            links -= name == "a"
            if name in ("article", "main"):
                end_block()
                articles -= 1

    while at < n:
        m = TOKEN.search(page, at)
        piece = page[at:m.start() if m else n]
        if piece and not cut:
            text.append(piece)
            linked += len(piece) if links else 0
        if not m:
            break
        at = m.end()
        name = m[2].lower() if m[2] else ""
        if not name:
            continue
        if name not in INLINE and not cut:
            end_block()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    pop(k)
                    break
            continue
        if name in RAW:
            if not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if name in VOID or name in EMBEDDED and m[3].rstrip().endswith("/"):
            continue
        closes = CLOSES.get(name) or ({"p"} if name in BOUNDS else set())
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in closes:
                if name in INLINE:
                    break
                pop(k)
                break
            if stack[k][0] in BOUNDS:
                break
        bad = _unwanted(name, m[3], cards)
        if bad and not cut:
            end_block()
        stack.append((name, bad))
        cut += bad
        links += name == "a"
        if name in ("article", "main"):
            articles += 1
    end_block()
    return out


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The main text of one page; ``''`` for null, empty or text-free pages.

    Outside articles menu lines count as empty, and so does all outside the article where the
    page marks the one with its main text; a marked article may be short, so there any text is a surge.
    """
    found = lines(page) if page else []
    if page and not any(x.text for x in found):
        found = lines(page, cards=False)      # all of its text is in an article that looks like a card
    size = [0 if _menu(x) and not x.article else len(x.text) for x in found]
    marked = _marked(found, size, window, surge)
    size = [0 if marked and not x.article else s for x, s in zip(found, size, strict=True)]
    blocks = [sum(size[i:i + window]) for i in range(len(size))]
    keep = _between(size, blocks, 1 if marked else surge)
    if not any(keep):                         # no surge on the page: it is one short text
        keep = [s > 0 for s in size]
    return " ".join(x.text for x, k in zip(found, keep, strict=True) if k)


def _marked(found: list[Line], size: list[int], window: int, surge: int) -> bool:
    """Whether the page has a marked article, and most of its longest text from surge to dive is in one."""
    if not any(x.article for x in found):
        return False
    best = inner = total = marked = 0
    kept = _between(size, [sum(size[i:i + window]) for i in range(len(size))], surge)
    for i, (x, k) in enumerate(zip(found, kept, strict=True)):
        if k:
            total += size[i]
            marked += size[i] if x.article else 0
        if total > best:
            best, inner = total, marked
        if not any(size[i + 1:i + 1 + window]):      # the dive
            total = marked = 0
    return 2 * inner >= best


def _between(size: list[int], blocks: list[int], surge: int) -> list[bool]:
    """The lines with text from a surge (a block of ``surge`` characters) to the next dive (an empty block)."""
    keep, inside = [], False
    for s, b in zip(size, blocks, strict=True):
        inside = b > 0 and (inside or b >= surge)
        keep.append(inside and s > 0)
    return keep


def _menu(line: Line) -> bool:
    return line.linked >= LINKED * max(1, len(line.text)) and line.linked > 0 and len(line.text) < 200


def _extract(batches):
    for b in W.slices(batches, "html"):
        texts = [main_text(h) for h in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                         ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row for each row of ``pages(page_id, url, html, ...)``.

    Character references are decoded, white space inside a block becomes one space, blocks
    are joined by one space in page order. Null or empty html: empty text. Elements that
    are never closed end with the one around them; comments, scripts and quoted attributes
    may hold anything. Empty table: no rows.
    """
    return (pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
            .mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint"))
