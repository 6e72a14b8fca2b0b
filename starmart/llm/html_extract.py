"""Main text of web pages by tag-path ratios.

Text nodes are grouped by their root-to-leaf tag path. A path's ratio is its
text length per node, and its punctuation per node; node by node these are
smoothed over the page order, fused into one score, and paths whose score is
over the page's mean are content. The content region is the lowest element that
holds the containers of all content nodes (of those in ``article`` or ``main``, if
most of the content paths' text is there), or an ``article`` or ``main`` above it
if there is one, and all blocks of that region are kept, short ones too, except
those inside elements that are furniture by their kind or name.

An element is furniture by name if a whole class token, or the id of what isn't
a heading, is made of names only, and its nodes' tag paths bear it out: inside
an article it isn't if most of its own text is on content paths; and if no article
or main stands outside of named elements, neither is what holds most of the
content paths' text, or the longest article or main.

Pages are parsed where they are read; a page needs nothing from another one.

Defined results: null and empty pages and pages without text give an empty
text; unclosed, misnested and unknown tags never fail; a page that is plain
text is one block; repeated rows are returned each.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import in_arrow

#: Kinds of elements.
RAW = ("script", "style", "noscript", "template", "textarea", "svg", "math", "iframe", "object", "title", "select")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
FURNITURE = frozenset("nav footer aside form button menu dialog label head".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
NAME = (r"(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|sidebar|side|menu|nav\w*|breadcrumbs?|header|footer|comments?|replies|disqus|"
        r"notice|cookies?|consent|gdpr|popup|modal|newsletter|subscribe|share|sharing|social|related|login|widget)")
#: A class token or id: names, with a word for the whole site before them.
NAMES = re.compile(rf"(?:(?:site|global)[_-]+)?{NAME}(?:[_-]+{NAME})*", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog menu alert".split())
#: Kinds of elements that are parts of a text; what holds them is a container.
PARTS = frozenset("""blockquote center dd details dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup li ol p pre section
summary table tbody td tfoot th thead tr ul""".split())
#: A start tag closes open elements of these kinds, up to the nearest other block.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。，،]")
SPACE = re.compile(r"\s+")


class Element:
    __slots__ = ("tag", "parent", "path", "furniture", "named")

    def __init__(self, tag: str, parent: Element | None, furniture: bool, named: bool = False):
        self.tag, self.parent, self.named = tag, parent, named
        self.path = f"{parent.path}/{tag}" if parent else tag
        self.furniture = furniture or bool(parent and parent.furniture)


def _is_furniture(tag: str, attributes: str, inside_article: bool) -> bool:
    if tag in FURNITURE or (tag == "header" and not inside_article):
        return True
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value, name = a or b or c, name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in ROLES):
            return True
    return False


def _is_named(tag: str, attributes: str) -> bool:
    """Whether a class or the id is a name of furniture."""
    if tag in ("html", "body", "article", "main"):
        return False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if (name == "class" or (name == "id" and tag not in HEADINGS)) and any(NAMES.fullmatch(x) for x in (a or b or c).split()):
            return True
    return False


def text_nodes(page: str):
    """(element, block number, raw text) of every text node, in page order."""
    root = Element("", None, False)
    at, here, block, out, stop = 0, root, 0, [], len(page)

    def add(raw: str):
        if raw and not raw.isspace():
            out.append((here, block, raw))
        elif raw:
            out.append((here, block, " "))

    while at < stop:
        m = TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at:m.start()])
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            node = here
            while node is not root and node.tag != tag:
                if tag not in BLOCKS and node.tag in BLOCKS:
                    node = root  # an inline end tag closes nothing beyond its block
                    break
                node = node.parent
            if node is not root:
                here = node.parent
            block += tag in BLOCKS
        elif tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else stop
        else:
            if tag in BLOCKS:
                block += 1
                # an open paragraph, or an item of this kind, ends here
                ends, scan = CLOSES.get(tag, {"p"}), here
                while scan is not root and (scan.tag not in BLOCKS or scan.tag in ends):
                    if scan.tag in ends:
                        here = scan.parent
                    scan = scan.parent
            if tag == "br":
                add(" ")
            if tag not in VOID and not m[3].endswith("/"):
                above, node = False, here
                while node is not root and not above:
                    above, node = node.tag in ("article", "main"), node.parent
                here = Element(tag, here, _is_furniture(tag, m[3], above), _is_named(tag, m[3]))
    return out


def smoothed(values: np.ndarray) -> np.ndarray:
    """A moving average over each node and its two neighbours."""
    padded = np.concatenate((values[:1], values, values[-1:]))
    return (padded[:-2] + 2 * padded[1:-1] + padded[2:]) / 4


def path_scores(nodes: list[tuple[Element, str]]) -> dict[str, float]:
    """Fused text and punctuation ratio of each tag path."""
    length, marks, count = {}, {}, {}
    for element, text in nodes:
        p = element.path
        length[p] = length.get(p, 0) + len(text)
        marks[p] = marks.get(p, 0) + len(PUNCTUATION.findall(text))
        count[p] = count.get(p, 0) + 1
    ratio = smoothed(np.array([length[e.path] / count[e.path] for e, _ in nodes]))
    dots = smoothed(np.array([marks[e.path] / count[e.path] for e, _ in nodes]))
    fused = ratio * (1 + dots)
    total: dict[str, float] = {}
    for (element, _), score in zip(nodes, fused.tolist(), strict=True):
        total[element.path] = total.get(element.path, 0.0) + score
    return {p: s / count[p] for p, s in total.items()}


def _ancestors(element: Element) -> list[Element]:
    """The elements from the root down to this one."""
    out = []
    while element is not None:
        out.append(element)
        element = element.parent
    return out[::-1]


def _article(element: Element) -> Element | None:
    """The outermost article or main that the element is in."""
    return next((e for e in _ancestors(element) if e.tag in ("article", "main")), None)


def _container(element: Element) -> Element:
    """The nearest block that isn't only a part of a text."""
    while element.parent is not None and (element.tag not in BLOCKS or element.tag in PARTS):
        element = element.parent
    return element


def _confirm_names(nodes: list[tuple[Element, str]]) -> None:
    """Clear ``named`` of elements whose text isn't furniture; see the top."""
    if not any(a.named for e in {id(e): e for e, _ in nodes}.values() for a in _ancestors(e)):
        return
    scores = path_scores(nodes)
    bar = float(np.mean([scores[e.path] for e, _ in nodes]))
    total, free = 0, False
    held: dict[int, list] = {}  # element, its text, its text on content paths
    articles: dict[int, list] = {}
    for element, text in nodes:
        above, content = _ancestors(element), len(text) * (scores[element.path] >= bar)
        total += content
        article = _article(element)
        if article is not None:
            articles.setdefault(id(article), [article, 0])[1] += len(text)
            free = free or not any(e.named for e in _ancestors(article))
        for e in above:
            if e.named:
                of = held.setdefault(id(e), [e, 0, 0])
                of[1] += len(text)
                of[2] += content
    for e, text, content in held.values():
        if (not free and 2 * content > total) or (_article(e) and 2 * content > text):
            e.named = False
    if articles and not free:
        for e in _ancestors(max(articles.values(), key=lambda x: x[1])[0]):
            e.named = False


def main_text(page: str | None) -> str:
    """The page's article, one block a line."""
    found = [(e, b, t) for e, b, t in text_nodes(page or "") if not e.furniture]
    _confirm_names([(e, t) for e, _, t in found if not t.isspace()])
    inside_named: dict[int, bool] = {}
    found = [x for x in found if not inside_named.setdefault(id(x[0]), any(e.named for e in _ancestors(x[0])))]
    nodes = [(e, t) for e, _, t in found if not t.isspace()]
    if not nodes:
        return ""
    scores = path_scores(nodes)
    bar = float(np.mean([scores[e.path] for e, _ in nodes]))
    content = [(e, t) for e, t in nodes if scores[e.path] >= bar] or nodes
    total = sum(len(t) for _, t in content)
    named = [(e, t) for e, t in content if _article(e)]
    if 2 * sum(len(t) for _, t in named) > total:
        content = named
    region = None
    for element in {id(e): e for e, _ in content}.values():
        above = _ancestors(_container(element))
        if region is None:
            region = above[-1]
            continue
        for x, y in zip(above, _ancestors(region), strict=False):
            if x is not y:
                break
            shared = x
        region = shared
    region = _article(region) or region

    def within(element: Element | None) -> bool:
        while element is not None:
            if element is region:
                return True
            element = element.parent
        return False

    blocks: dict[int, list[str]] = {}
    held: dict[int, bool] = {}
    for element, block, text in found:
        if held.setdefault(id(element), within(element)):
            blocks.setdefault(block, []).append(text)
    lines = (SPACE.sub(" ", html.unescape("".join(parts))).strip() for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return in_arrow(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), run,
                    "page_id long, url string, text string, n_chars long")
