"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block element. A line's length is the
text it has outside of links; what is left out (scripts, styles, menus, forms,
notices, adverts, sidebars, page headers and footers, reader comments) stays in
the distribution as lines of length zero, as many as it had. The lengths,
summed over a sliding window of lines, rise from zero at a surge point and fall
back to zero at a dive point, so a menu ends a block of text whether or not
anything names it, and a notice of a line or two doesn't. On every page the
blocks whose sums reach ``SURGE`` characters (or the largest, if none does) are
kept, from their first line of text to their last.

A marked article (article, main) is a weight: its characters count ``MARKED``
times, link or not; its edges end a block, and what is left out inside it is
one line short of a window, so that it doesn't cut the article in two. Where
all text of a page is in links, links count.

A left-out p, li, dt, dd, tr, td or th without an end tag ends where HTML says:
at the next sibling, or with an element around it.

Scale: one narrow pass over the pages, a batch at a time; no shuffle.

Defined results: NULL or empty html, or a page without text, gives an empty
text; a cut-off page keeps what it has; blocks with equal sums are kept or left
out together; repeated rows are extracted alike; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3  # lines whose lengths are summed
SURGE = 80  # characters within a window
MARKED = 4  # weight of a character in a marked article
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][\w:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][\w:-]*)([^>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
HREF = re.compile(r"\bhref\s*=", re.I)
RAW = {"script", "style", "textarea", "title", "xmp", "noframes"}
DROP = {"nav", "footer", "aside", "form", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "button", "select", "dialog", "menu", "head", "audio", "video", "datalist"}
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track", "param"}
BLOCK = set("""address article blockquote br body caption center dd details div dl dt fieldset figcaption figure footer h1 h2 h3 h4 h5 h6
header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul aside form""".split())
MAIN = {"article", "main"}
CONTAINER = {"div", "section", "ul", "ol", "dl", "p", "span", "table", "header", "article", "details", "figure", "a", "h2", "h3", "h4", "li", "td"}
BAD_WORD = set("""ad ads advert adverts advertisement advertising adbox adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies
disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification pagination pager popup promo promoted
promotion recommended related replies respond search share sharing sidebar signup social sponsor sponsored sponsors subscribe subscription teaser toolbar widget""".split())
BAD_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "form", "menu", "menubar", "note", "alertdialog"}
#: Elements whose end tag may be missing: start tags that end them, and the
#: elements inside them that keep such a tag from doing so.
_CELL, _ROW, _PART = {"td", "th"}, {"tr"}, {"tbody", "thead", "tfoot"}
_TABLE = {"table"}
_LIST = {"ul", "ol", "menu", "dl", "table"}
ENDS = {
    "p": (BLOCK - {"br", "body", "html", "caption", "legend", "tbody", "thead", "tfoot", "figcaption"} | {"menu", "nav", "search", "figcaption", "dialog"}, {"button", "object", "table"}),
    "li": ({"li"}, _LIST), "dt": ({"dt", "dd"}, _LIST), "dd": ({"dt", "dd"}, _LIST),
    "td": (_CELL | _ROW | _PART, _TABLE), "th": (_CELL | _ROW | _PART, _TABLE), "tr": (_ROW | _PART, _TABLE),
}


def _boilerplate(tag: str, attrs: str) -> bool:
    if tag in DROP:
        return True
    if tag not in CONTAINER or "=" not in attrs:
        return False
    for name, a, b, c in ATTRIBUTE.findall(attrs):
        words = re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", a or b or c).lower())
        if BAD_ROLE.intersection(words) if name.lower() == "role" else BAD_WORD.intersection(words):
            return True
    return False


def lines(html: str) -> tuple[list[str], list[int], list[bool]]:
    """Text of each line (empty where boilerplate was), its characters outside
    of links, and whether it lies in a marked article."""
    out: list[str] = []
    free: list[int] = []
    marked: list[bool] = []
    piece: list[str] = []
    plain: list[str] = []  # the piece without its links
    links = 0
    inside = 0  # depth of article/main
    skip, depth = "", 0  # the boilerplate element being left out
    within: list[str] = []  # open elements inside it, if its end tag may be missing
    around: dict[str, int] = {}  # block elements open outside of it
    raw = ""  # an element whose content is not markup

    def put(text, size):
        out.append(text)
        free.append(size)
        marked.append(inside > 0)

    def empty():
        """Empty lines just before here; a window of them at most."""
        have = 0
        while have < min(WINDOW, len(out)) and not out[-1 - have]:
            have += 1
        return have

    def flush():
        if piece:
            text = " ".join(unescape("".join(piece)).split())
            size = len("".join(unescape("".join(plain)).split())) if links or len(plain) < len(piece) else len(text)
            piece.clear()
            plain.clear()
            if text:
                put(text, size)

    def left_out():
        """A line of what is left out."""
        if piece:
            some = not "".join(piece).isspace()
            piece.clear()
            if some and empty() < (WINDOW - 1 if inside else WINDOW):
                put("", 0)

    def edge():
        flush()
        for _ in range(WINDOW - empty()):
            put("", 0)

    at = 0
    for m in TOKEN.finditer(html):
        if m.start() < at:
            continue
        if m.start() > at:
            piece.append(html[at:m.start()])
            if not skip and not links:
                plain.append(piece[-1])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attrs = bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in RAW and not closing:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        alone = tag in VOID or attrs.rstrip().endswith("/")
        if skip and (tag in BLOCK or tag == skip):
            left_out()
        if skip in ENDS:
            starts, keep = ENDS[skip]
            if not closing:
                if tag in starts and not keep.intersection(within):
                    skip = ""
                elif not alone:
                    within.append(tag)
            elif tag in within:
                del within[len(within) - 1 - within[::-1].index(tag):]
            elif tag == skip:
                skip = ""
                continue
            elif around.get(tag):  # an element around it ends
                skip = ""
            if skip:
                continue
        elif skip:
            if tag == skip and tag not in VOID:
                depth += -1 if closing else 0 if attrs.rstrip().endswith("/") else 1
                if depth == 0:
                    skip = ""
            continue
        if not closing and not alone and (_boilerplate(tag, attrs) or tag == "header" and not inside):
            flush()
            skip, depth = tag, 1
            links = 0
            within.clear()
            continue
        if tag in BLOCK:
            flush()
            links = 0 if closing else links  # a link without an end
            if not alone:
                around[tag] = max(0, around.get(tag, 0) + (-1 if closing else 1))
        if tag == "a":
            links = 0 if closing or alone or not HREF.search(attrs) else 1
        if tag in MAIN:
            before, inside = inside, max(0, inside + (-1 if closing else 1))
            if not (before and inside):  # the edge of an article
                edge()
    if not skip:
        if at < len(html):
            piece.append(html[at:])
            plain.extend([] if links else [piece[-1]])
        flush()
    return out, free, marked


def text_blocks(length: list[int]) -> list[tuple[int, int]]:
    """(surge, dive) line ranges: between them each window holds text."""
    found, start, gap = [], None, 0
    for i, n in enumerate(length):
        if n:
            start = i if start is None else start
            gap = 0
        elif start is not None:
            gap += 1
            if gap == WINDOW:  # the window's sum is back at zero
                found.append((start, i - gap + 1))
                start = None
    if start is not None:
        found.append((start, len(length)))
    return found


def main_text(html: str | None) -> str:
    if not html:
        return ""
    text, free, marked = lines(html)
    length = [len(x) * MARKED if m else n for x, n, m in zip(text, free, marked)]
    blocks = text_blocks(length)
    if not blocks:  # nothing outside of links
        length = [len(x) for x in text]
        blocks = text_blocks(length)
    if not blocks:
        return ""
    peak = [max(sum(length[i:i + WINDOW]) for i in range(a, b)) for a, b in blocks]
    kept = [x for x, p in zip(blocks, peak) if p >= min(SURGE, max(peak))]
    ends = [max(i for i in range(a, b) if length[i]) + 1 for a, b in kept]
    return "\n".join(x for (a, _), b in zip(kept, ends) for x in text[a:b] if x)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = pages.select(F.col("page_id").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    schema = f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"

    def run(batches):
        for b in batches:
            text = [main_text(x.as_py()) for x in b.column("html")]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(text, pa.string()), pa.array([len(x) for x in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, schema)
