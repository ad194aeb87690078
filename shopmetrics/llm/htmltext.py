"""Main text of web pages by tag-path ratios (operator 10).

A page is a sequence of text nodes, each with its path of tags from the root. A path's ratio is its length of text, and its
punctuation, per node, less what stands in links. Ratios are smoothed over neighbouring nodes, fused over length and punctuation,
and fused along the path: headings, lists and short paragraphs share the ratio of the paths around them, up to the next container with a name,
or the marked article. Paths above the threshold, the deviation of all the page's nodes, are content. What is no text of the page (scripts,
styles, markup) has no ratio; what is marked as navigation, header, footer, sidebar, notice, advert, form or comments counts
for the threshold and never is a candidate; a page that marks its article has its candidates there. A mark on an element that
holds most of the marked article doesn't count.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?:svg|math)(?:[\s/](?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)?(?<=/)>"
    r"|<(script|style|textarea|title|noscript|template|svg|math|iframe|xmp)(?=[\s/>])[^>]*+>(?:.*?</\1\s*+>|.*\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S | re.I)
_ATTR = re.compile(r"(?:class|id|role|itemprop|aria-label|hidden|style)(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup "
                    "time tt u var wbr img label output".split())
#: Blocks of text: their container is the one around them.
_TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre figcaption caption summary".split())
_OUT = frozenset("nav header footer aside form button select option menu dialog label input fieldset legend".split())
#: Words that mark what is no article, as a whole class, role or id: alone, or between words that only say where or what kind of box. So
#: ``sidebar-left`` and ``social-share-buttons`` mark; ``no-sidebar``, ``side-effects`` and ``related-work`` don't.
_WORD = (r"(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|"
         r"nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|aside|rail|widget|related|recommend\w*|share|sharing|social|toolbar|"
         r"comments?|disqus|replies|respond|footer|header|masthead|copyright|login|signup|search|complementary|contentinfo|hidden)")
_WHERE = r"(?:site|page|main|top|bottom|left|right|global|primary|secondary|inline|sticky|post|article|user|reader|email|mobile|skip)"
_BOX = (r"(?:box|bar|list|links?|posts?|articles?|stories|buttons?|icons?|form|slot|unit|container|wrapper|wrap|block|section|panel|items?|area|"
        r"inner|left|right|top|bottom|thread|\d+)")
_MARK = re.compile(rf"(?:{_WHERE}[-_])*{_WORD}(?:[-_](?:{_WORD}|{_BOX}))*\d*", re.I)
_TITLE = re.compile(r"(?:post|article|main|page)?[-_]?header", re.I)
_VALUE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NONE = re.compile(r"display\s*:\s*none", re.I)
_MAIN = re.compile(r"articleBody|(?:^|[\s\"'=])main(?=[\s\"']|$)", re.I)


def _marked(attrs: str, in_main: bool) -> bool:
    """Whether a tag's classes, role or id say that it is no article, or it is hidden. An article's own header is part of it."""
    of: dict[str, str] = {}
    for name, a, b, c in _VALUE.findall(attrs):
        of.setdefault(name.lower(), a or b or c)
    words = [*of.get("class", "").split(), *of.get("role", "").split(), of.get("id", "").strip()]
    return bool("hidden" in of or of.get("aria-hidden", "").lower() == "true" or _NONE.search(of.get("style", ""))
                or any(_MARK.fullmatch(w) and not (in_main and _TITLE.fullmatch(w)) for w in words))


#: An open tag on the left is closed by a start of one on the right.
_CLOSES = {"p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
_PUNCTUATION = re.compile(r"[,.;:!?…。，、！？]")
_WHITE = re.compile(r"\s+")
SMOOTH = np.array([0.25, 0.5, 0.25])


class Node:
    __slots__ = ("text", "path", "groups", "above", "block", "out", "main", "marks", "link")

    def __init__(self, text: str, path: str, groups: tuple[str, ...], above: tuple | None, block: int, out: bool, main: int, marks: tuple[int, ...],
                 link: bool) -> None:
        self.text, self.path, self.groups, self.above, self.block = text, path, groups, above, block
        self.out, self.main, self.marks, self.link = out, main, marks, link


class Open(NamedTuple):
    """An open tag: with its class, whether it is out by its kind, the number of the article's mark around it (0: none), the numbers of the
    elements around it that are marked as no article, and in a marked article the nearest container: (its path, the container around that)."""

    tag: str
    label: str
    out: bool
    main: int
    marks: tuple[int, ...]
    box: tuple | None


_ROOT = Open("", "", False, 0, (), None)


def _settle(nodes: list[Node]) -> list[Node]:
    """An element that is marked as no article, but holds most of the text that is marked as one, is a wrapper: its mark doesn't count."""
    total, held = 0, {}
    for n in nodes:
        if n.main and not n.out:
            size = len(n.text.strip())
            total += size
            for m in n.marks:
                if m < n.main:
                    held[m] = held.get(m, 0) + size
    for n in nodes:
        n.out = n.out or any(m > n.main > 0 or 2 * held.get(m, 0) <= total or not total for m in n.marks)
    return nodes


def text_nodes(page: str) -> list[Node]:
    """Text nodes in page order, with their tag paths. Unclosed and misplaced tags are taken as browsers do, about."""
    nodes: list[Node] = []
    stack: list[Open] = []
    block, at, number = 0, 0, 0

    def add(raw: str) -> None:
        if raw:
            top = stack[-1] if stack else _ROOT
            # the tag of the node's block, and the one around it: in a marked article the nearest that has a name, or the article
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag not in _INLINE), -1)
            box = stack[k - (stack[k].tag in _TEXT)].box if k > 0 else None
            groups = ("/".join(s.label for s in stack[: k + 1]), box[0] if box else "/".join(s.label for s in stack[: max(k, 0)]))
            above = box[1] if box else None
            nodes.append(Node(html.unescape(raw), "/".join(s.label for s in stack), groups, above, block, top.out, top.main, top.marks,
                              any(s.tag == "a" for s in stack)))

    def close(k: int) -> None:
        nonlocal block
        if any(s.tag not in _INLINE for s in stack[k:]):
            block += 1
        del stack[k:]

    for m in _TOKEN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                continue
            if m[1] and m[1].lower() not in ("svg", "math", "noscript", "template"):
                block += m[1].lower() in ("textarea", "iframe", "title", "xmp")
            continue
        if m[2] or m[5]:
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag), None)
            if k is not None:
                close(k)
            continue
        attrs = m[4] if m[3] else m[7]
        if tag in _VOID:
            block += tag not in _INLINE
            continue
        if tag not in _INLINE:
            for i in range(len(stack) - 1, -1, -1):
                open_ = stack[i].tag
                if open_ in _CLOSES and (_CLOSES[open_] is None or tag in _CLOSES[open_]):
                    close(i)
                    break
                if open_ not in _INLINE and open_ not in _CLOSES:
                    break
            block += 1
        number += 1
        named = " ".join(_ATTR.findall(attrs)) if attrs else ""
        up = stack[-1] if stack else _ROOT
        main = up.main or (number if tag in ("article", "main") or bool(named and _MAIN.search(named)) else 0)
        own = named and tag not in ("html", "body", "article", "main") and _marked(attrs, bool(up.main))
        out = up.out or tag in _OUT and not (tag == "header" and up.main > 0)
        if not attrs or not attrs.rstrip().endswith("/") or tag in ("p", "div", "article"):
            label, box = tag + ("." + re.sub(r"\W+", ".", named) if named else ""), up.box
            if main and (not up.main or named and tag not in _INLINE):
                box = ("/".join([*(s.label for s in stack), label]), box)
            stack.append(Open(tag, label, out, main, (*up.marks, number) if own else up.marks, box))
    add(page[at:])
    return _settle(nodes)


def path_ratios(nodes: list[Node]) -> dict[str, tuple[float, float]]:
    """Of each tag path: text length per node and punctuation per node, links left out."""
    total: dict[str, list[float]] = {}
    for n in nodes:
        t = total.setdefault(n.path, [0, 0, 0])
        t[0] += 1
        if not n.link:
            t[1] += len(n.text.strip())
            t[2] += len(_PUNCTUATION.findall(n.text))
    return {p: (t[1] / t[0], t[2] / t[0]) for p, t in total.items()}


def content_nodes(nodes: list[Node]) -> list[Node]:
    shown = [n for n in nodes if n.text.strip()]
    live = [not n.out for n in shown]
    if any(n.main and not n.out for n in shown):
        live = [ok and n.main > 0 for n, ok in zip(shown, live, strict=True)]
    if not any(live):
        return []
    ratio = path_ratios(shown)
    size, points = (np.array([ratio[n.path][k] for n in shown]) for k in (0, 1))
    pad = lambda x: np.convolve(np.pad(x, 1, mode="edge"), SMOOTH, mode="valid")
    near = np.array([not n.link for n in shown])  # a link takes nothing from the text beside it
    fused = np.sqrt(np.maximum(size, near * pad(size)) * (1 + np.maximum(points, near * pad(points))))
    least = min(fused.std(), fused[live].max())
    score: dict[str, float] = {}
    for n, ok, f in zip(shown, live, fused, strict=True):
        if ok:
            for g in n.groups:
                score[g] = max(score.get(g, 0.0), f)
            above = n.above
            while above and score.get(above[0], -1.0) < f:  # a container has the best ratio of all in it
                score[above[0]], above = f, above[1]
    return [n for n, ok in zip(shown, live, strict=True) if ok and max(score[g] for g in n.groups) >= least]


def main_text(page: str | None) -> str:
    """Blocks of content joined by line breaks; "" where there is none."""
    blocks: dict[int, list[str]] = {}
    nodes = text_nodes(page or "")
    chosen = {id(n) for n in content_nodes(nodes)}
    open_blocks = {n.block for n in nodes if id(n) in chosen}
    for n in nodes:
        if id(n) in chosen or n.block in open_blocks and not n.out and not n.text.strip():
            blocks.setdefault(n.block, []).append(n.text)
    return "\n".join(t for t in (_WHITE.sub(" ", "".join(b)).strip() for b in blocks.values()) if t)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(p) for p in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                         names=["row", "text", "n_chars"])


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The columns of ``pages`` without its html, and text and n_chars (code points).

    A null or empty html has an empty text. Nothing else is left out or cut. Rows that repeat or have null ids give a row each. Columns
    of ``pages`` named text or n_chars are replaced.
    """
    plain = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    packed = pages.select(F.struct(*plain).alias("row"), F.col(html_col).cast("string").alias("html"))
    schema = T.StructType([packed.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return packed.mapInArrow(_extract, schema).select("row.*", "text", "n_chars")
