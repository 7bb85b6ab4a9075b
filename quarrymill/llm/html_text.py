"""Main text of web pages by line-block distribution.

Markup is stripped to lines: one per block of text, blank ones where a container begins or ends. Elements that are no
article text by their name, role, class or visibility are stripped with their contents. The text lengths in a sliding window
of lines form a curve; it surges where text begins and dives to zero where a run of lines ends. The text between a surge and
its dive is kept where the curve's peak is high enough for the page and little of it is link text. The runs of one <article>
or <main> are judged together, by their highest peak and joint link share, and their peak counts ``ARTICLE_WEIGHT`` times; the
element decides nothing else.

Pages are independent rows, handled where they lie in Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
import html
import re

from pyspark.sql import DataFrame

WINDOW = 3
#: Peak of the curve, in characters, that a run needs, or this share of the page's highest peak.
SURGE_CHARS, SURGE_SHARE = 86, 0.25
ARTICLE_WEIGHT = 2

# fixed values: element names, roles and class words of HTML pages
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "svg", "math", "canvas", "object", "video", "audio", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
NOISE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "head", "fieldset"}
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar"}
NOISE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "banner", "cookie",
    "cookies", "consent", "notice", "notices", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar",
    "footer", "comment", "comments", "respond", "share", "social", "related", "newsletter", "subscribe", "popup", "modal",
    "masthead", "pagination", "widget",
}
BLOCKS = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "figcaption", "figure",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "ol", "p", "pre", "section",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
} | NOISE
CONTAINERS = {"article", "body", "div", "header", "main", "section", "table"} | NOISE
WALLS = CONTAINERS | {"ul", "ol", "dl"}
#: An opening tag of the second kind ends an open element of the first kind.
ENDS = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'=<>`]+))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _attributes(body: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTR.findall(body)}


def is_noise(tag: str, body: str, in_article: bool) -> bool:
    """Whether an element with its contents is no article text."""
    if tag in NOISE or tag == "header" and not in_article:
        return True
    if "=" not in body and "hidden" not in body:
        return False
    at = _attributes(body)
    if "hidden" in at or at.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", at.get("style", "").lower()):
        return True
    if at.get("role", "").lower() in NOISE_ROLES:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    names = f"{at.get('class', '')} {at.get('id', '')}"
    return any(w.lower() in NOISE_WORDS for w in _WORD.findall(names))


def lines_of(page: str) -> list[tuple[str, int, int]]:
    """(text, characters of it inside links, number of the outermost article around it or 0) for each line; blank lines where
    containers begin and end."""
    lines: list[tuple[str, int, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool]] = []  # open elements and whether they are noise
    places: defaultdict[str, list[int]] = defaultdict(list)  # in the stack, by name
    walls: list[int] = []  # places that an opening tag closes nothing below of
    noise = articles = number = links = linked = 0
    at, end = 0, len(page)

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                lines.append((text, min(linked, len(text)), number if articles else 0))
            parts.clear()
        linked = 0

    def gap():
        flush()
        lines.extend([("", 0, number if articles else 0)] * WINDOW)

    def close(depth: int):
        nonlocal noise, articles, links
        while len(stack) > depth:
            name, was_noise = stack.pop()
            places[name].pop()
            if name in WALLS:
                walls.pop()
            if name in CONTAINERS or was_noise:
                gap()
            elif name in BLOCKS:
                flush()
            noise -= was_noise
            articles -= name in ("article", "main")
            links -= name == "a"

    def say(text: str):
        nonlocal linked
        if not noise:
            parts.append(text)
            if links:
                linked += len(text.strip())

    while at < end:
        found = _TAG.search(page, at)
        if not found:
            say(page[at:])
            break
        if found.start() > at:
            say(page[at : found.start()])
        at = found.end()
        closing, name, body = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if closing:
            if places[name]:
                close(places[name][-1])
            elif name in BLOCKS and not noise:
                flush()
            continue
        if name in RAW:
            stop = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            if not body.rstrip().endswith("/"):
                at = stop.end() if stop else end
            continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name == "br":
                say(" ")
            continue
        ended = max((places[x][-1] for x, ends in ENDS.items() if name in ends and places[x]), default=-1)
        if ended >= 0 and (not walls or ended >= walls[-1]):
            close(ended)
        bad = is_noise(name, body, articles > 0)
        if name in CONTAINERS or bad:
            gap()
        elif name in BLOCKS:
            flush()
        places[name].append(len(stack))
        if name in WALLS:
            walls.append(len(stack))
        stack.append((name, bad))
        noise += bad
        if name in ("article", "main"):
            number += not articles
            articles += 1
        links += name == "a"
    close(0)
    flush()
    return lines


def main_text(page: str | None) -> str:
    """The kept lines of a page, joined by newlines."""
    if not page:
        return ""
    lines = lines_of(page)
    sizes = [len(text) for text, _, _ in lines]
    n = len(sizes)
    curve, total = [0] * n, 0
    for i in range(n - 1, -1, -1):
        total += sizes[i] - (sizes[i + WINDOW] if i + WINDOW < n else 0)
        curve[i] = total
    runs, i = [], 0
    while i < n:
        if not curve[i]:
            i += 1
            continue
        start = i
        while i < n and curve[i]:
            i += 1
        kept = [x for x in lines[start:i] if x[0]]
        runs.append((max(curve[start:i]), max(x[2] for x in kept), kept))
    groups = {}  # peak, characters and linked ones of the runs judged together: of an article, or one run
    for k, (peak, article, kept) in enumerate(runs):
        old = groups.get(article or -k - 1, (0, 0, 0))
        groups[article or -k - 1] = (max(old[0], peak), old[1] + sum(len(x[0]) for x in kept), old[2] + sum(x[1] for x in kept))
    text = {g: peak * (ARTICLE_WEIGHT if g > 0 else 1) for g, (peak, chars, linked) in groups.items() if linked < 0.5 * chars}
    floor = min(SURGE_CHARS, SURGE_SHARE * max(text.values(), default=0))
    chosen = [kept for k, (_, article, kept) in enumerate(runs) if text.get(article or -k - 1, -1) >= floor]
    return "\n".join(x[0] for kept in chosen for x in kept)


def extract_text(pages: DataFrame, column: str = "html", out: str = "text") -> DataFrame:
    """The rows of ``pages`` plus ``out``, the main text of the whole page in ``column``.

    Null and empty pages, and pages without article text, give an empty text. White space inside a block becomes one space,
    character references are decoded, blocks keep their order. Repeated rows each get their text; an empty table gives an
    empty result; other columns pass through and a column named like ``out`` is replaced.
    """
    import pyarrow as pa

    rest = pages.drop(out) if column != out else pages
    at = rest.columns.index(column)
    keep = [i for i, c in enumerate(rest.columns) if c != out]
    schema = rest.select(*[rest.columns[i] for i in keep]).schema.add(out, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array([main_text(x.as_py()) for x in batch.column(at)], pa.string())
            names = [batch.schema.names[i] for i in keep]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep], text], names=[*names, out])

    return rest.mapInArrow(run, schema)
