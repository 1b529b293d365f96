"""Main text of web pages by composite text density (operator 6).

For every node of a page: characters per tag, adjusted for links. A node's density sum adds
up its children's densities; the node with the largest sum is where most of the text sits.
The least density on the way from the body to it is the page's threshold: wherever it is
reached, the subtree of the largest sum below is main text.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column

# Element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
#: Elements that are never main text.
LEFT_OUT = frozenset(
    "nav footer aside form script style noscript template svg canvas iframe object embed select button textarea "
    "dialog menu head title input label fieldset".split()
)
#: Elements that only style a run of text; they are no tags when density is counted.
INLINE = frozenset(
    "abbr b bdi bdo big br cite code del dfn em font i ins kbd mark q s samp small span strong sub sup time tt u var wbr".split()
)
#: Text of different blocks goes on different lines.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
#: Elements that hold a paragraph of an article.
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt figcaption td th".split())
#: An open element that a new one of these ends, and the elements that shield it.
ENDED_BY = {
    "p": BLOCKS - {"caption", "dd", "dt", "li", "option", "tbody", "td", "tfoot", "th", "thead", "tr", "legend", "body"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot", "thead"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot", "thead"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot", "thead"}),
    "option": frozenset({"option"}),
}
SHIELDS = {"p": frozenset({"button", "td", "th", "caption", "table"}), "li": frozenset({"ul", "ol"}), "dt": frozenset({"dl"})}
SHIELDS |= {"dd": SHIELDS["dt"], **{t: frozenset({"table"}) for t in ("tr", "td", "th")}, "option": frozenset({"select"})}
#: Words in class, id or role that mark what isn't main text.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion banner "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices "
    "alert popup modal newsletter subscribe subscription signup login comment comments commentlist disqus reply "
    "replies share sharing social related recommended recommendations widget pagination pager toolbar search "
    "masthead complementary contentinfo hidden".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORDS = re.compile(r"[a-z]+")


class Node:
    """An element with its children (nodes and pieces of raw text) and, after ``measure``, its counts."""

    __slots__ = ("tag", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "total", "skip")

    def __init__(self, tag: str, parent: Node | None, skip: bool = False) -> None:
        self.tag, self.parent, self.skip = tag, parent, skip
        self.children: list[Node | str] = []


def _marked(attributes: str, paragraph: bool) -> bool:
    """Whether class, id or role hold a mark. A paragraph of an article needs one that is a name of its own: its
    ``related-work`` or ``search-results`` are about the text, not around it."""
    if not attributes.strip():
        return False
    if _HIDDEN.search(attributes):
        return True
    names = " ".join(a or b or c for a, b, c in _NAMED.findall(attributes)).lower()
    return not MARKS.isdisjoint(names.split() if paragraph else _WORDS.findall(names))


def parse(source: str) -> Node:
    """Tree of a page. Like a browser it takes any input: unclosed, misnested and cut-off elements included."""
    root = Node("html", None)
    here, at = root, 0
    while True:
        token = _TOKEN.search(source, at)
        text = source[at : token.start()] if token else source[at:]
        if text:  # references are decoded piece by piece, so what markup parts doesn't make one
            here.children.append(html.unescape(text))
        if token is None:
            return root
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:
            node = here
            while node is not None and node.tag != tag:
                node = node.parent
            if node is not None and node.parent is not None:
                here = node.parent
            continue
        for open_tag, enders in ENDED_BY.items():
            if tag in enders:
                node = here
                shields = SHIELDS.get(open_tag, frozenset())
                while node is not None and node.tag != open_tag and node.tag not in shields:
                    node = node.parent
                if node is not None and node.tag == open_tag and node.parent is not None:
                    here = node.parent
        inside_article = _has_ancestor(here, ("article", "main"))
        skip = tag in LEFT_OUT or (tag == "header" and not inside_article)
        skip = skip or _marked(token[3], inside_article and tag in PARAGRAPHS)
        # A mark on the page's own frame would leave nothing.
        node = Node(tag, here, skip and tag not in ("html", "body", "article", "main"))
        here.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
            at = end.end() if end else len(source)
        elif tag not in VOID and not token[3].rstrip().endswith("/"):
            here = node


def _has_ancestor(node: Node | None, tags: tuple[str, ...]) -> bool:
    while node is not None:
        if node.tag in tags:
            return True
        node = node.parent
    return False


def _order(root: Node) -> list[Node]:
    """Kept nodes, parents before children, without recursion: pages nest as deep as they like."""
    out = [root]
    for node in out:
        out += [c for c in node.children if isinstance(c, Node) and not c.skip]
    return out


def measure(root: Node) -> list[Node]:
    """Give every kept node its counts, density and density sum."""
    nodes = _order(root)
    for node in reversed(nodes):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for child in node.children:
            if isinstance(child, str):
                node.chars += sum(map(len, child.split()))
            elif not child.skip:
                node.chars += child.chars
                node.tags += child.tags + (child.tag not in INLINE)
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
    page = nodes[0]
    link_share = page.link_chars / max(1, page.chars)
    for node in nodes:
        c, t = node.chars, max(1, node.tags)
        lc, lt = max(1, node.link_chars), max(1, node.link_tags)
        if not c:
            node.density = 0.0
            continue
        base = math.log(c / max(1, c - node.link_chars) * lc + link_share * c + math.e)
        inner = max(1.0, c / lc * t / lt)
        node.density = c / t * math.log(inner + 1) / math.log(base + 1)
    for node in nodes:
        node.total = sum(c.density for c in node.children if isinstance(c, Node) and not c.skip)
        # Text directly in a node counts as a child without tags of its own.
        own = sum(sum(map(len, c.split())) for c in node.children if isinstance(c, str))
        if own:
            node.total += own / node.chars * max(1, node.tags) * node.density
    return nodes


def main_nodes(root: Node) -> list[Node]:
    """The subtrees that are main text, in page order."""
    nodes = measure(root)
    body = next((n for n in nodes if n.tag == "body"), root)
    below = _order(body)
    best = max(below, key=lambda n: n.total)
    if not best.chars:
        return []
    threshold, node = best.density, best
    while node is not None and node is not body.parent:
        threshold = min(threshold, node.density)
        node = node.parent
    # Of each node the largest density sum in its subtree, from the leaves up; the upper one of equals.
    largest: dict[int, Node] = {}
    for node in reversed(below):
        pick = node
        for child in node.children:
            if isinstance(child, Node) and not child.skip and largest[id(child)].total > pick.total:
                pick = largest[id(child)]
        largest[id(node)] = pick
    chosen: dict[int, Node] = {}
    for node in below:
        if node.density >= threshold and node.chars:
            pick = largest[id(node)]
            chosen[id(pick)] = pick
    out, covered = [], set()
    for node in below:  # parents first: a subtree inside a chosen one is part of it
        if node.parent is not None and id(node.parent) in covered:
            covered.add(id(node))
        elif id(node) in chosen:
            covered.add(id(node))
            out.append(node)
    return out


def _blocks(chosen: list[Node], root: Node) -> list[str]:
    """Texts of the blocks in page order, white space turned into single blanks."""
    wanted = {id(n) for n in chosen}
    blocks, current = [], []

    def close() -> None:
        text = " ".join("".join(current).split())
        if text:
            blocks.append(text)
        current.clear()

    # (child or node, inside main text, whether it is the end of a block)
    stack: list[tuple[Node | str, bool, bool]] = [(root, False, False)]
    while stack:
        item, inside, ending = stack.pop()
        if isinstance(item, str):
            if inside:
                current.append(item)
            continue
        if ending:
            close()
            continue
        if item.skip:
            continue
        if item.tag in ("br", "wbr", "img"):
            current.append(" " if item.tag == "br" else "")
            continue
        inside = inside or id(item) in wanted
        if item.tag in BLOCKS:
            close()
            stack.append((item, inside, True))
        for child in reversed(item.children):
            stack.append((child, inside, False))
    close()
    return blocks


def main_text(source: str) -> str:
    """Main text of a page: blocks joined by line feeds, empty if there is none."""
    root = parse(source)
    return "\n".join(_blocks(main_nodes(root), root))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page id, url, text, n_chars.

    No shuffle; pages don't depend on each other. Null or empty html gives an empty text.
    Repeated rows get a row each, null ids and urls stay null, an empty table gives no rows,
    and other columns are not read.
    """
    source = pages.select(
        column(id_col).alias("page_id"), column(url_col).alias("url"), F.coalesce(column(html_col), F.lit("")).alias("html")
    )
    kinds = {f.name: f.dataType.simpleString() for f in source.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    out = source.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
    return out.withColumnsRenamed({"page_id": id_col, "url": url_col})
