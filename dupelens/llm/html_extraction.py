"""Main text of web pages by tag-path ratios.

A page is read into text leaves with their paths of block elements. For each path the text length and the punctuation
are taken per leaf, less what is link text; both series are smoothed over the leaves in page order, scaled and
multiplied, and leaves at or above a share of their mean are content, as are lists, tables and code that are not mostly
links. The article is the article or main element around nearly all content, else the innermost element around all of it;
all its blocks belong to the text, so short paragraphs, headings and small sections are not lost. Elements whose tag, role,
class or id says that they are no article text (menus, footers, forms, comments and the like) are left out, unless they
hold most of the content: then they are wrappers of the article.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dupelens.llm.tables import texts

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    # Quotes belong to a value only behind its equals sign.
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*+(?:\"[^\"]*\"|'[^']*')|[^>])*+)>?",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
PUNCTUATION = re.compile(r"[.,;:!?。，；：！？、…]")

RAW = frozenset("script style noscript template textarea title iframe svg annotation annotation-xml canvas object audio video".split())
SKIPPED = frozenset("nav header footer aside form button select option input label menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img "
    "math semantics mi mo mn ms mtext mrow msup msub msubsup mfrac msqrt mroot munder mover munderover mstyle mspace".split()
)
#: These stand inside a line of text as well, though their own text is no article text.
IN_LINE = INLINE | frozenset("label button select option output input".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dt dd".split()
)
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
LISTS = frozenset("ul ol dl table".split())
#: Elements whose text is content even though it is short and without punctuation.
STRUCTURES = LISTS | {"pre", "code"}
NOISE_WORDS = frozenset(
    "nav navbar navigation menu sidebar footer header masthead topbar ad ads advert adverts advertisement advertising "
    "banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "comment comments reply replies respond disqus discussion share sharing social related recommended breadcrumb "
    "breadcrumbs pagination pager newsletter subscribe subscription signup login search form widget toolbar skip".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Words that may stand beside a noise word in one name ("site-footer"); any other ("with-sidebar") says something else.
PLAIN_WORDS = frozenset("site main global top bottom left right list box block container wrapper bar inner item items links section area".split())
#: Marks of text that can be longer than the article beside it: such an element needs nearly all content to be a wrapper.
BESIDE = frozenset(
    "nav footer aside navigation contentinfo complementary navbar menu menubar ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo promotion comment comments reply replies respond disqus discussion related recommended".split()
)
#: Elements that hold an article as a whole.
CONTAINERS = frozenset("body main article section div center td".split()) | {""}
ARTICLES = frozenset("article main".split())
TABLE_PARTS = frozenset("table caption thead tbody tfoot tr td th".split())
SMOOTHING = np.array([0.05, 0.25, 0.4, 0.25, 0.05])
SHARE = 0.3
HELD = 0.9
MOST = 0.5


class Node:
    """An element: its parent, its tag, a number for the path of block elements down to it, and what says that it is no
    article text.

    ``hidden``: nothing inside is text of the page; ``marks``: the words of its tag, role, class and id that mark it.
    """

    __slots__ = ("parent", "tag", "path", "hidden", "marks", "depth")

    def __init__(self, parent: Node | None, tag: str, attributes: str = ""):
        self.parent, self.tag = parent, tag
        self.marks, hidden = _marks(tag, attributes)
        self.hidden = hidden or (parent is not None and parent.hidden)
        above = parent.path if parent else 0
        self.path = above if tag in INLINE else hash((above, tag))
        self.depth = parent.depth + 1 if parent else 0


def _marks(tag: str, attributes: str) -> tuple[frozenset[str], bool]:
    marks, hidden = set(), tag == "head"
    if tag in SKIPPED:
        marks.add(tag)
    for name, *values in ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        value = next((v for v in values if v), "")
        name = name.lower()
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            for token in value.split():
                words = set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower()))
                if words <= NOISE_WORDS | PLAIN_WORDS:
                    marks |= words & NOISE_WORDS
        elif name == "role" and value.lower() in NOISE_ROLES:
            marks.add(value.lower())
        elif tag in ("html", "body"):
            continue  # hidden until a script has run: still the page
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and UNSEEN.search(value)):
            hidden = True
    return frozenset(marks), hidden


class Leaf:
    """A piece of text: its innermost element, its block element, its text, whether it is in a link, the number of its block."""

    __slots__ = ("own", "node", "text", "link", "block", "structure")

    def __init__(self, own: Node, text: str, link: bool, block: int):
        self.own, self.node, self.text, self.link, self.block = own, _block_of(own), text, link, block
        self.structure = _nearest(own, STRUCTURES)


def leaves(page: str) -> list[Leaf]:
    """The text leaves outside hidden elements, in page order."""
    root = Node(None, "")
    stack, out = [root], []
    block, links, at = 0, 0, 0
    raw_until: re.Pattern | None = None
    size = len(page)

    def add(text: str) -> None:
        if not stack[-1].hidden and text:
            out.append(Leaf(stack[-1], html.unescape(text), links > 0, block))

    while at < size:
        found = TOKEN.search(page, at)
        if found is None:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        closing, attributes = found[1] == "/", found[3] or ""
        if closing:
            if tag in RAW:
                continue
            if any(n.tag == tag for n in stack[1:]):
                while stack[-1].tag != tag:
                    links -= stack[-1].tag == "a"
                    stack.pop()
                links -= tag == "a"
                stack.pop()
            if tag not in IN_LINE:
                block += 1
            continue
        if tag in RAW:
            raw_until = re.compile(rf"</{tag}\s*>", re.I)
            end = raw_until.search(page, at)
            at = end.end() if end else size
            continue
        if tag not in IN_LINE and tag != "br":
            block += 1
            if tag in CLOSES_P:
                links -= _close(stack, {"p"}, LISTS | {"td", "th"})
            if tag in SIBLINGS:
                links -= _close(stack, SIBLINGS[tag], LISTS)
        if tag == "br":
            add(" ")
            continue
        if tag in VOID:
            continue
        stack.append(Node(stack[-1], tag, attributes))
        links += tag == "a"
    return out


def _shown(found: list[Leaf]) -> list[Leaf]:
    """The leaves outside elements that are marked as no article text.

    Marked elements that hold most of the content (or the only article, or the main element) are wrappers and do not
    count as marked; those of ``BESIDE`` need nearly all of it. Inside a wrapper the other marks count as before.
    """
    above: dict[Node, list[Node]] = {}
    for leaf in found:
        if leaf.own not in above:
            above[leaf.own] = list(_upwards(leaf.own))
    marked = dict.fromkeys(n for nodes in above.values() for n in reversed(nodes) if n.marks)
    if not marked:
        return found
    weight: dict[Node, int] = defaultdict(int)
    total = 0
    for leaf, good in zip(found, _content(_scores(found)), strict=True):
        size = len(leaf.text.strip()) if good and not leaf.link else 0
        if size:
            total += size
            for node in above[leaf.own]:
                weight[node] += size
    whole = {tag: [n for n in weight if n.tag == tag] for tag in ARTICLES}
    wrappers: set[Node] = set()
    for node in sorted(marked, key=lambda n: n.depth):
        if any(n.marks and n not in wrappers for n in _upwards(node.parent)):
            continue
        beside = not BESIDE.isdisjoint(node.marks)
        # An article outside all marked elements says that this is not the wrapper, unless nearly all text is here.
        other = any(
            not _inside(n, node) and not _inside(node, n) and not any(m.marks and m not in wrappers for m in _upwards(n))
            for nodes in whole.values() for n in nodes
        )
        share = HELD if beside or other else MOST
        only = not beside and not other and any(len(nodes) == 1 and _inside(nodes[0], node) for nodes in whole.values())
        if total and (weight[node] > share * total or only):
            wrappers.add(node)
    noise = {own: _is_noise(nodes, wrappers) for own, nodes in above.items()}
    return [leaf for leaf in found if not noise[leaf.own]]


def _is_noise(nodes: list[Node], wrappers: set[Node]) -> bool:
    """Whether one of an element and its ancestors is marked; the headings of an article's own header are not noise."""
    at = next((i for i in range(len(nodes) - 1, -1, -1) if nodes[i].marks and nodes[i] not in wrappers), None)
    if at is None:
        return False
    top = nodes[at]
    of_article = top.tag == "header" and top.parent is not None and top.parent.tag in ("article", "main")
    return not (of_article and any(n.tag in HEADINGS for n in nodes[:at]))


def _upwards(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def _close(stack: list[Node], tags: set[str] | frozenset[str], fences: frozenset[str]) -> int:
    """Closes an open element of ``tags`` with all inside it; returns how many links that closes."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            links = sum(n.tag == "a" for n in stack[i:])
            del stack[i:]
            return links
        if stack[i].tag in fences or (stack[i].tag not in INLINE and stack[i].tag not in tags and "p" in tags and stack[i].tag != "p"):
            return 0
    return 0


def _block_of(node: Node) -> Node:
    while node.tag in INLINE and node.parent is not None:
        node = node.parent
    return node


def _scores(found: list[Leaf]) -> np.ndarray:
    """The fused, smoothed ratio of each leaf."""
    length: dict[int, float] = defaultdict(float)
    marks: dict[int, float] = defaultdict(float)
    blocks: dict[int, set[int]] = defaultdict(set)
    for leaf in found:
        path = leaf.node.path
        blocks[path].add(leaf.block)
        text = leaf.text.strip()
        length[path] += -len(text) if leaf.link else len(text)
        marks[path] += 0 if leaf.link else len(PUNCTUATION.findall(text))
    series = []
    for total in (length, marks):
        ratio = {p: max(0.0, total[p]) / len(blocks[p]) for p in blocks}
        values = np.array([ratio[leaf.node.path] for leaf in found])
        padded = np.pad(values, 2, mode="edge")
        smooth = np.convolve(padded, SMOOTHING, "valid")
        top = smooth.max(initial=0.0)
        series.append(smooth / top if top > 0 else smooth)
    return np.sqrt(series[0] * (series[1] + 0.05))


def _content(scores: np.ndarray) -> np.ndarray:
    return scores >= SHARE * scores.mean() if scores.max(initial=0.0) > 0 else np.ones(len(scores), bool)


def _structured(found: list[Leaf], content: np.ndarray) -> np.ndarray:
    """Whether each leaf stands in a list, a table or code that is not mostly links; tables around prose are layout."""
    size: dict[Node, int] = defaultdict(int)
    layout: set[Node] = set()
    for leaf, good in zip(found, content, strict=True):
        own = leaf.structure
        if own is None:
            continue
        n = len(leaf.text.strip())
        size[own] += -n if leaf.link else n
        if own.tag == "table":
            if good and n and leaf.node.tag not in TABLE_PARTS:
                layout.add(own)
            while (own := _nearest(own.parent, LISTS)) is not None:
                layout.add(own)
    return np.array([x.structure is not None and size[x.structure] > 0 and x.structure not in layout for x in found], bool)


def _article(found: list[Leaf], content: np.ndarray) -> Node | None:
    """The article or main element around nearly all content text, else the innermost element around all of it.

    Links do not count: smoothing lifts those of a menu beside the article. Those inside the element belong to the text.
    """
    weight: dict[Node, int] = defaultdict(int)
    total = 0
    for leaf, good in zip(found, content, strict=True):
        size = len(leaf.text.strip()) if good and not leaf.link else 0
        if not size:
            continue
        total += size
        node: Node | None = leaf.node
        while node is not None:
            weight[node] += size
            node = node.parent
    holding = [n for n, w in weight.items() if w >= HELD * total and n.tag in CONTAINERS]
    inner = max(holding, key=lambda n: n.depth, default=None)
    if inner is None:
        return None
    marked = _nearest(inner, ARTICLES)
    if marked is None:
        return max((n for n in holding if weight[n] == total), key=lambda n: n.depth)
    around = _nearest(marked.parent, ARTICLES)
    while around is not None and not any(n.tag == "article" and n is not marked and _inside(n, around) and not _inside(n, marked) and not _inside(marked, n) for n in weight):
        marked, around = around, _nearest(around.parent, ARTICLES)
    return marked


def _nearest(node: Node | None, tags: frozenset[str]) -> Node | None:
    """The node or its nearest ancestor with one of the tags."""
    while node is not None and node.tag not in tags:
        node = node.parent
    return node


def _inside(node: Node | None, top: Node) -> bool:
    while node is not None:
        if node is top:
            return True
        node = node.parent
    return False


def main_text(page: str) -> str:
    """The blocks of the article, one per line, white space inside a block as single spaces."""
    found = _shown(leaves(page))
    if not any(leaf.text.strip() for leaf in found):
        return ""
    content = _content(_scores(found))
    marked = next((n for n in _ancestors(found) if n.tag == "article"), None)
    content |= _structured(found, content)
    top = _article(found, content)
    if top is not None and top.tag not in ARTICLES and marked is not None and _inside(marked, top):
        top = marked if _weight(found, marked) >= HELD * _weight(found, top) else top
    blocks: dict[int, list[Leaf]] = {}
    for leaf in found:
        if top is None or _inside(leaf.node, top):
            blocks.setdefault(leaf.block, []).append(leaf)
    lines = [" ".join("".join(x.text for x in own).split()) for own in blocks.values()]
    return "\n".join(line for line in lines if line)


def _ancestors(found: list[Leaf]) -> Iterator[Node]:
    seen: set[int] = set()
    for leaf in found:
        node: Node | None = leaf.node
        while node is not None and id(node) not in seen:
            seen.add(id(node))
            yield node
            node = node.parent


def _weight(found: list[Leaf], top: Node) -> int:
    return sum(len(x.text.strip()) for x in found if _inside(x.node, top))


def extracted(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row of ``pages (page_id, url, html)``.

    Null and empty pages, and pages without text, give an empty text. Repeated rows give a row each, an empty table an
    empty result; other columns are left out.
    """
    texts(pages, "page_id", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [main_text(v.as_py() or "") for v in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(made, pa.string()), pa.array([len(m) for m in made], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    source = pages.selectExpr("cast(page_id as long) page_id", "url", "html")
    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")
