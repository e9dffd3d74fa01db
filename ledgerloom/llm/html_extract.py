"""Main text of web pages by tag-path ratios.

Every text node has a root-to-leaf tag path.  Text length and punctuation are summed per path and
divided by its number of nodes; both ratios are smoothed over neighbouring nodes in page order,
fused by their product and cut by a threshold that follows the page.  Paths below elements that by
tag, role, class or id are menus, notices, adverts and the like have ratio 0.  The content is what
lies below the nearest common container of the chosen paths, apart from such elements.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

THRESHOLD = 0.3  # of the mean fused ratio over the text of the page

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>|<(?=[a-zA-Z!?]|/[a-zA-Z])[^>]*\Z|(<)", re.S)
_NAMED = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)

RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr br img".split()
)
SKIPPED = set(
    "head nav header footer aside form script style noscript template iframe button select textarea svg canvas"
    " object dialog menu title input option datalist figure".split()
) - {"figure"}
HINTS = set(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside ad ads advert adverts"
    " advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice"
    " popup modal newsletter subscribe subscription share sharing social comment comments disqus reply replies"
    " related recommended widget login signup search pagination pager copyright alert contentinfo complementary"
    " dialog form hidden skip toolbar".split()
)
NEGATIONS = {"has", "with", "no", "without", "is"}
CONTAINERS = {"html", "body", "main", "article"}
CLOSED_BY = {  # an open element that the start of these elements ends
    "p": set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option"},
    "head": {"body"},
}
BARRIER = {"table", "ul", "ol", "dl", "body", "html", "article", "section", "div", "main"}


@dataclass
class Node:
    path: tuple[str, ...]
    block: int
    text: str
    skipped: bool


def _hinted(tag: str, attributes: str, inside: list[str]) -> bool:
    """Whether an element is boilerplate by its own tag and attributes."""
    if tag in SKIPPED and not (tag == "header" and any(t in ("article", "main") for t in inside)):
        return True
    if not attributes or tag in CONTAINERS:
        return False
    for name, a, b, c in _NAMED.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
            continue
        words = re.findall(r"[a-z]+", value)
        if any(w in HINTS and (k == 0 or words[k - 1] not in NEGATIONS) for k, w in enumerate(words)):
            return True
    return False


def nodes(page: str) -> list[Node]:
    """The text nodes of a page in order, each with its tag path and the number of its block."""
    out: list[Node] = []
    names: list[str] = []
    skips: list[int] = [0]  # number of boilerplate elements around, by depth
    block, at, n = 0, 0, len(page)

    def text(upto: int) -> None:
        if upto > at and not page[at:upto].isspace():
            out.append(Node(tuple(names), block, html.unescape(page[at:upto]), skips[-1] > 0))
        elif upto > at and out and out[-1].block == block:
            out[-1].text += " "

    def pop(depth: int) -> None:
        del names[depth:]
        del skips[depth + 1 :]

    while at < n:
        m = _TOKEN.search(page, at)
        while m and m.group(4):  # a lone "<" is text
            m = _TOKEN.search(page, m.end())
        if not m:
            text(n)
            break
        text(m.start())
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            for depth in range(len(names) - 1, -1, -1):
                if names[depth] == tag:
                    if any(t not in INLINE for t in names[depth:]):
                        block += 1
                    pop(depth)
                    break
            continue
        for depth in range(len(names) - 1, -1, -1):
            if tag in CLOSED_BY.get(names[depth], ()):
                block += 1
                pop(depth)
                break
            if names[depth] in BARRIER:
                break
        if tag == "br" and out and out[-1].block == block:
            out[-1].text += " "
        if tag not in INLINE:
            block += 1
        if tag in VOID or m.group(3).endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>|\Z", re.I).search(page, at)
            at = max(end.end(), at)
            continue
        skips.append(skips[-1] + _hinted(tag, m.group(3), names))
        names.append(tag)
    return out


def _smooth(values: list[float]) -> list[float]:
    k = (0.1, 0.2, 0.4, 0.2, 0.1)
    n = len(values)
    return [
        sum(w * values[i + d] for d, w in zip(range(-2, 3), k) if 0 <= i + d < n)
        / sum(w for d, w in zip(range(-2, 3), k) if 0 <= i + d < n)
        for i in range(n)
    ]


_PUNCTUATION = re.compile(r"[.,;:!?。，、？！…\"'()«»“”-]")


def main_text(page: str | None) -> str:
    """Blocks of the main text, joined by two line feeds; empty for NULL and for pages without content."""
    found = nodes(page or "")
    usable = [x for x in found if not x.skipped and x.text.strip()]
    if not usable:
        return ""
    length: dict = {}
    marks: dict = {}
    count: dict = {}
    for x in usable:
        length[x.path] = length.get(x.path, 0) + len(x.text)
        marks[x.path] = marks.get(x.path, 0) + len(_PUNCTUATION.findall(x.text))
        count[x.path] = count.get(x.path, 0) + 1
    by_length = _smooth([length[x.path] / count[x.path] for x in usable])
    by_marks = _smooth([marks[x.path] / count[x.path] for x in usable])
    fused: dict = {}
    for x, a, b in zip(usable, by_length, by_marks):
        fused[x.path] = max(fused.get(x.path, 0.0), a * (1 + b))
    total = sum(length.values())
    limit = THRESHOLD * sum(fused[p] * length[p] for p in fused) / total
    chosen = [p for p in fused if fused[p] >= limit]
    common = chosen[0]
    for p in chosen[1:]:
        k = 0
        while k < min(len(common), len(p)) and common[k] == p[k]:
            k += 1
        common = common[:k]
    while common and common[-1] in INLINE | {"p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre"}:
        common = common[:-1]  # the container of paragraphs, not a paragraph
    if "article" in common:
        common = common[: len(common) - common[::-1].index("article")]
    blocks: dict[int, list[str]] = {}
    for x in found:
        if not x.skipped and x.path[: len(common)] == common:
            blocks.setdefault(x.block, []).append(x.text)
    texts = (" ".join("".join(b).split()) for b in blocks.values())
    return "\n\n".join(t for t in texts if t)


@F.pandas_udf(StringType())
def _main_text(pages: pd.Series) -> pd.Series:
    return pages.map(main_text, na_action=None)


def extract_main_text(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text in the column ``out``.

    NULL and empty pages have an empty text.  Rows are independent: repeated rows stay, no rows
    give no rows.  A column that is called like ``out`` is replaced; all others stay.
    """
    return pages.withColumn(out, _main_text(F.col(html_col)))
