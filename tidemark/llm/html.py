"""Main text of web pages by line-block distribution.

The markup is stripped into lines: a line is the text of one block element, and
a line break or an emptied element leaves a line end too.  Elements that are
page furniture by tag, role or class (menus, headers, footers, sidebars,
notices, adverts, forms, reader comments) leave a run of empty lines, so that
they show as a gap in the distribution, and so do the edges of <article> and
<main>.  A line's mass is its text less its link text twice, in a marked article
its text ``EVIDENCE`` times; ``WINDOW`` or more link lines in a row have none.
Masses are summed over windows of ``WINDOW`` lines; a window sum that leaves zero
is a surge, one that returns to it a dive, and the text between a surge and its
dive is a run.  A run is body if its highest window sum reaches the page's
typical line (the geometric mean).  Kept are the bodies, the short runs next to
them, and the short runs of a marked article that has a body.
"""

from __future__ import annotations

import math
import re
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import arrow_rows

WINDOW = 3
NEAR = 3 * WINDOW  # lines between runs next to each other: a stripped element and a few links
EVIDENCE = 2       # weight of text in a marked article

# --- fixed values: element and class names of HTML pages ------------------------
RAW = {"script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "xmp", "math", "canvas", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
    "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
    "var", "wbr",
}
FURNITURE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "head", "fieldset"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "menu", "menubar", "form", "alert"}
ARTICLE = {"article", "main"}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul",
}
# -------------------------------------------------------------------------------
_HINT = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsbygoogle|sponsor\w*|promo\w*|banner|side-?bar|nav|navbar|navigation|menu|breadcrumbs?|header|masthead"
    r"|footer|foot|comments?|comment-?list|disqus\w*|respond|cookies?|consent|gdpr|notices?|newsletter|subscribe\w*|signup|popup|modal"
    r"|share|sharing|social|related|recommended|widget|pagination|pager|skip-?link|login|search)(?=$|[\s_-])",
    re.I,
)
_KEEP = re.compile(r"(?:^|[\s_-])(?:article|content|post|entry|story|main)(?=$|[\s_-])", re.I)
_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # a quote counts only right behind an equals sign; anywhere else the tag ends at the first >
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s\"'>][^\s>]*)?)*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_BLANK = re.compile(r"\s+")


def _is_furniture(tag: str, attributes: str, inside_article: bool) -> bool:
    if tag in FURNITURE:
        return True
    if tag == "header":
        return not inside_article
    if tag in ARTICLE or tag in ("html", "body") or not attributes:
        return False
    for name, a, b, c in _ATTR.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if name in ("class", "id") and tag not in INLINE - {"span", "a"} and _HINT.search(value) and not _KEEP.search(value):
            return True
    return False


def lines_of(html: str) -> list[tuple[str, int, bool]]:
    """The page as lines: (text, characters of it in links, inside the article).

    A line without text stands for stripped furniture or an edge of the article.
    """
    lines: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    stack: list[str] = []                # open elements; an inline one that ended under open blocks is ""
    opened: dict[str, list[int]] = {}    # where in the stack each tag is open
    blocks: list[int] = []               # where in the stack the blocks are
    skip_at: int | None = None           # where the furniture starts that is being stripped
    article = linked = links = 0
    position, end = 0, len(html)

    def flush() -> None:
        nonlocal linked
        text = _BLANK.sub(" ", unescape("".join(parts))).strip()
        if text:
            lines.append((text, min(linked, len(text)), article > 0))
        parts.clear()
        linked = 0

    def leave(upto: int) -> None:
        nonlocal article, links, skip_at
        while len(stack) > upto or stack and not stack[-1]:
            tag = stack.pop()
            if not tag:
                continue
            opened[tag].pop()
            if blocks and blocks[-1] == len(stack):
                blocks.pop()
            if tag in ARTICLE:
                article -= 1
                lines.extend([("", 0, False)] * (0 if article else WINDOW))
            links -= tag == "a"
            if skip_at == len(stack):
                skip_at = None
                lines.extend([("", 0, article > 0)] * WINDOW)

    while position < end:
        found = _TOKEN.search(html, position)
        text_end = found.start() if found else end
        if text_end > position and skip_at is None:
            text = html[position:text_end]
            parts.append(text)
            if links:
                linked += len(text)
        if not found:
            break
        position = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            if not opened.get(tag):
                if tag in ("p", "br"):
                    flush()
                continue
            if tag not in INLINE:
                flush()
            depth = opened[tag][-1]
            # an inline end tag doesn't close the block around it
            if tag in INLINE and blocks and blocks[-1] > depth:
                stack[depth] = ""
                opened[tag].pop()
                links -= tag == "a"
                if skip_at == depth:
                    skip_at = None
            else:
                leave(depth)
            continue
        if tag in RAW:
            if not found[3].rstrip().endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, position)
                position = close.end() if close else end
            continue
        if tag not in INLINE:
            flush()
        if tag in VOID:
            continue
        if tag in CLOSES_P and opened.get("p") and blocks[-1] == opened["p"][-1]:
            leave(opened["p"][-1])
        if tag == "a" and opened.get("a") and (not blocks or blocks[-1] < opened["a"][-1]):
            leave(opened["a"][-1])
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1] == tag:
            leave(len(stack) - 1)
        if skip_at is None and _is_furniture(tag, found[3], article > 0):
            flush()
            lines.extend([("", 0, article > 0)] * WINDOW)
            skip_at = len(stack)
        opened.setdefault(tag, []).append(len(stack))
        if tag not in INLINE:
            blocks.append(len(stack))
        stack.append(tag)
        if tag in ARTICLE:
            lines.extend([("", 0, False)] * (0 if article else WINDOW))
            article += 1
        links += tag == "a"
    flush()
    return lines


def runs_of(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """Surge and dive points: [start, stop) of the lines between them.

    ``sums[i]`` is the text in lines i to i + window - 1.  It surges where it
    leaves zero and dives where it gets back to zero.
    """
    total = [0]
    for n in lengths:
        total.append(total[-1] + n)
    last = len(lengths)
    runs, surge = [], None
    for i in range(last + 1):
        mass = total[min(i + window, last)] - total[i]
        if mass and surge is None:
            surge = i
        elif not mass and surge is not None:
            runs.append((surge, i))
            surge = None
    return runs


def masses(lines: list[tuple[str, int, bool]], window: int = WINDOW) -> list[int]:
    """What every line adds to a window sum; fewer than ``window`` link lines beside text count as text."""
    mass = [EVIDENCE * len(text) if inside else max(len(text) - 2 * linked, 0) for text, linked, inside in lines]
    out, i = list(mass), 0
    while i < len(lines):
        stop = i
        while stop < len(lines) and lines[stop][0] and not mass[stop]:
            stop += 1
        beside = (i and mass[i - 1]) or (stop < len(lines) and mass[stop])
        if i < stop < i + window and beside:
            out[i:stop] = [len(line[0]) for line in lines[i:stop]]
        i = stop + 1
    return out


def main_text(html: str | None) -> str:
    """The article of a page, its blocks joined by line ends; empty if there is none."""
    if not html:
        return ""
    lines = lines_of(html)
    mass = masses(lines)
    runs = [[i for i in range(a, b) if mass[i]] for a, b in runs_of(mass)]
    if not runs:
        return ""
    typical = math.exp(sum(math.log(m) for m in mass if m) / sum(1 for m in mass if m)) * (1 - 1e-9)
    inside = [lines[r[0]][2] for r in runs]
    kept = [max(sum(mass[i : i + WINDOW]) for i in range(r[0], r[-1] + 1)) >= typical for r in runs]
    if any(k for k, own in zip(kept, inside, strict=True) if own):
        kept = [k or own for k, own in zip(kept, inside, strict=True)]
    # outwards from the bodies; a marked article has no short neighbours outside it
    for step in (1, -1):
        for i in range(len(runs))[::step]:
            j = i - step
            if 0 <= j < len(runs) and kept[j] and (inside[i] or not inside[j]):
                first, second = (runs[j], runs[i]) if step == 1 else (runs[i], runs[j])
                kept[i] = kept[i] or second[0] - first[-1] - 1 <= NEAR
    return "\n".join(lines[i][0] for r, k in zip(runs, kept, strict=True) if k for i in r)


SCHEMA = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType())]
)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text.

    A page that is null, empty or without an article has an empty text; null ids
    and urls stay null, repeated rows stay repeated, further columns are not
    carried along, and an empty table gives an empty result.  A page is taken
    whole whatever its length.
    """

    def work(_, ids, urls, pages):
        return ids, urls, [main_text(page) for page in pages]

    return arrow_rows(pages, [page_id, url, html], work, SCHEMA)
