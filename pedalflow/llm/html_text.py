"""HTML extraction by composite text density.

A page is read into a tree of block elements (inline formatting is part of its
block's text).  Navigation, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments are cut out by tag, role and class.  Every
remaining node gets its composite text density: characters per tag, lowered by
the share of characters and tags that are links.  The node whose children's
densities sum highest leads to the article: it, or the outermost <article> around
it, and the subtrees beside its path from <body> (or <main>) whose density reaches
the lowest density on that path (headings among them are kept).  Groups of links
below that density are cut out of them.

The tree is one page's; pages are read independently, one at a time.

Defined cases: null and empty html give an empty text; unclosed, misnested and
truncated markup is closed as browsers do, but an object, noscript or template without an end
tag holds text of the page, and any block ends an svg; formulas are text; text outside any block is a block;
a page without text gives ''.  Extra columns are left behind.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_arrow, pick

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"""
    r"""|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<[!?/][^>]*>|<[A-Za-z!?/][^>]*\Z""",
    re.S,
)
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
#: A slash at the end of an unquoted value is part of it.
UNQUOTED_END = re.compile(r"""=\s*[^\s"']+/\Z""")

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())
#: Cut out as a whole if they are closed; one that is left open holds text of the page.
HELD = frozenset("object noscript template annotation annotation-xml".split())
#: Elements of svg whose content is HTML or text.
INSIDE_SVG = frozenset("foreignobject desc title".split())
BLOCK = frozenset(
    "html body head article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption blockquote pre figure figcaption header footer nav aside form fieldset details summary address center "
    "dialog menu hgroup search hr button select option label legend".split()
)
#: Inline elements of HTML; like block elements, they end an svg that is left open.
ENDS_SVG = BLOCK | frozenset("b big br code em embed i img nobr ruby s small span strong strike sub sup tt u var".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED = frozenset(
    "head nav footer aside form fieldset button select option label legend menu dialog search script style textarea "
    "title noscript template iframe svg object annotation annotation-xml foreignobject desc".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar sidebars menu "
    "nav navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login comment comments disqus respond share sharing social related "
    "widget header footer masthead copyright pagination pager toolbar skip".split()
)
KEEPS = frozenset("with has no without content main article post body entry".split())
#: An opening tag closes these when they are open, up to one of the limits.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: The tags that each distinct rule of CLOSES looks for on its way up, and all of them.
GROUPS = list(dict.fromkeys(frozenset(shut | limits) for shut, limits in CLOSES.values()))
SOUGHT = frozenset().union(*GROUPS)
GROUP_OF = {name: GROUPS.index(frozenset(shut | limits)) for name, (shut, limits) in CLOSES.items()}


class Node:
    __slots__ = (
        "tag", "parent", "items", "noise", "chars", "tags", "link_chars", "link_tags", "density", "total", "links", "in_link",
        "inside", "ends",
    )

    def __init__(self, tag: str, parent: Node | None, noise: bool = False):
        self.tag, self.parent, self.noise = tag, parent, noise
        self.items: list = []  # texts, (text in a link,) and block nodes in order
        self.links = 0  # <a> elements opened directly inside
        self.in_link = 0  # whether it stands in a link itself
        self.inside = parent is not None and (parent.inside or parent.tag in ("article", "main"))
        # the nearest node, itself or above, that each group of CLOSES looks for
        self.ends: tuple[Node | None, ...] = parent.ends if parent is not None else (None,) * len(GROUPS)
        if tag in SOUGHT:
            self.ends = tuple(self if tag in sought else up for sought, up in zip(GROUPS, self.ends, strict=True))
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _is_noise(tag: str, attributes: str, parent: Node | None) -> bool:
    if tag in DROPPED:
        return True
    if tag == "header" and not (parent is not None and (parent.inside or parent.tag in ("article", "main"))):
        return True
    if tag in ("html", "body", "main") or not attributes:
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if name.lower() == "role":
            if value in DROPPED_ROLES:
                return True
            continue
        for one in value.split():
            parts = [p for p in re.split(r"[-_]+", one) if p]
            if parts and not KEEPS.intersection(parts) and (parts[0] in NOISE or parts[-1] in NOISE):
                return tag != "article" or bool({"comment", "comments", "related"}.intersection(parts))
    return False


def parse(page: str) -> Node:
    """The page's tree of block elements."""
    root = Node("#root", None)
    node, links, at = root, 0, 0

    def text(s: str) -> None:
        if s:
            node.items.append((s, links > 0))

    open_: Counter[str] = Counter()  # so that a closing tag that matches nothing takes no walk

    def ended(low: Node, high: Node) -> Node:
        """Ends ``high`` by its tag, and the nodes from ``low`` up to it without one of their own; returns what is left open."""
        while low is not high:
            if low.tag in HELD:
                low.noise = False
            open_[low.tag] -= 1
            low = low.parent
        open_[high.tag] -= 1
        return high.parent

    while m := TAG.search(page, at):
        text(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing = (m[1] or m[4]) == "/"
        if closing:
            if name == "a":
                links = max(0, links - 1)
            elif name in BLOCK or name in HELD or name == "svg" or name in INSIDE_SVG:
                if open_[name] > 0:
                    up = node
                    while up.tag != name:
                        up = up.parent
                    node, links = ended(node, up), up.in_link
                elif name == "p":
                    text("\n")
            continue
        attributes = m[3] or m[6] or ""
        while node.tag == "svg" and name in ENDS_SVG:
            links = node.in_link
            node = ended(node, node)
        if name in HELD or name == "svg" or node.tag == "svg" and name in INSIDE_SVG:
            child = Node(name, node, True)
            child.in_link = links
            node.items.append(child)
            foreign = name == "svg" or node.tag == "svg"
            if not (foreign and attributes.endswith("/") and not UNQUOTED_END.search(attributes)):
                node, links = child, 0
                open_[name] += 1
            continue
        if name in RAW and node.tag != "svg":
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "br":
            text(" ")
        elif name == "a":
            links = 1  # links do not nest
            node.links += 1
        elif name in BLOCK:
            if name in CLOSES:
                shut, group = CLOSES[name][0], GROUP_OF[name]
                while (up := node.ends[group]) is not None and up.tag in shut:
                    node = ended(node, up)
            elif node.tag == "p" or node.tag in HEADING and name in HEADING:
                node = ended(node, node)
            child = Node(name, node, _is_noise(name, attributes, node))
            node.items.append(child)
            if name not in VOID:
                node, links = child, 0
                open_[name] += 1
    text(page[at:])
    while node is not root:
        node.noise = node.noise and node.tag not in HELD
        node = node.parent
    return root


def _children(n: Node) -> list[Node]:
    return [x for x in n.items if isinstance(x, Node) and not x.noise]


def _postorder(root: Node) -> list[Node]:
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        order.append(n)
        todo += _children(n)
    return order[::-1]


def measure(root: Node) -> list[Node]:
    """Densities and sums of all nodes that are no noise, children first."""
    order = _postorder(root)
    for n in order:
        for x in n.items:
            if isinstance(x, tuple):
                size = len(" ".join(html.unescape(x[0]).split()))
                n.chars += size
                n.link_chars += size * x[1]
        n.link_tags += n.links
        n.tags += n.links
        for c in _children(n):
            n.chars += c.chars
            n.link_chars += c.link_chars
            n.tags += c.tags + 1
            n.link_tags += c.link_tags
    share = root.link_chars / max(1, root.chars)
    for n in order:
        if not n.chars:
            continue
        tags, links, link_chars = max(1, n.tags), max(1, n.link_tags), max(1, n.link_chars)
        plain = max(1, n.chars - n.link_chars)
        base = math.log(n.chars / plain * n.link_chars + share * n.chars + math.e)
        adjust = math.log(max(1.0 + 1e-9, n.chars / link_chars * tags / links)) / math.log(max(base, 1.0 + 1e-9)) if base > 1 else math.log(
            max(1.0 + 1e-9, n.chars / link_chars * tags / links)
        )
        n.density = n.chars / tags * adjust
        n.total = sum(c.density for c in _children(n)) or n.density
    return order


def _blocks(n: Node, out: list[list[str]]) -> None:
    """Texts of ``n`` in page order; each list is one block."""
    todo: list = [n]
    while todo:
        x = todo.pop()
        if isinstance(x, tuple):
            out[-1].append(x[0])
        elif x is None:
            out.append([])
        elif not x.noise and not (x.tag == "header" and x is not n):
            out.append([])
            todo.append(None)
            todo += x.items[::-1]
        elif not x.noise:  # an article's own header: its headings
            todo.append(None)
            todo += [c for c in _postorder(x) if c.tag in HEADING][::-1]
            out.append([])


def _cut_menus(top: Node, least: float) -> None:
    """Marks groups of links under ``top`` as noise: mostly link text, and less dense than ``least``."""
    todo = [top]
    while todo:
        for c in _children(todo.pop()):
            if c.density < least and c.link_tags > 1 and 2 * c.link_chars > c.chars and c.tag != "p" and c.tag not in HEADING:
                c.noise = True
            else:
                todo.append(c)


def article_nodes(root: Node) -> list[Node]:
    """The subtrees that hold the article.

    The node of the highest density sum grows to the outermost <article> around it.
    Subtrees beside the path from there up to <main> or <body> are kept by the path's
    lowest density.
    """
    order = measure(root)
    best = max(order, key=lambda n: n.total)
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    tags = [n.tag for n in path]
    if "article" in tags:
        path = path[len(tags) - 1 - tags[::-1].index("article") :]
    tags = [n.tag for n in path]
    if "main" in tags:
        path = path[: tags.index("main") + 1]
    body = [n for n in path if n.tag not in ("#root", "html")] or path[:1]
    least = min(n.density for n in body)
    on_path = {id(n) for n in path}
    keep = [path[0]]
    for n in path[1:]:
        keep += [c for c in _children(n) if id(c) not in on_path and c.chars and (c.density >= least or c.tag in HEADING)]
    for n in keep:
        _cut_menus(n, least)
    return keep


def extract(page: str | None) -> str:
    """The main text: blocks in page order, joined by \\n."""
    if not page:
        return ""
    root = parse(page)
    out: list[list[str]] = [[]]
    nodes = article_nodes(root)
    if len(nodes) > 1:  # page order
        place = {id(n): i for i, n in enumerate(_preorder(root))}
        nodes.sort(key=lambda n: place[id(n)])
    for n in nodes:
        _blocks(n, out)
    texts = (" ".join(html.unescape("".join(b)).split()) for b in out)
    return "\n".join(t for t in texts if t)


def _preorder(root: Node) -> list[Node]:
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        order.append(n)
        todo += _children(n)[::-1]
    return order


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    p = pick(pages, "page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(h.as_py()) for h in b["html"]]
            yield pa.RecordBatch.from_arrays(
                [b["page_id"], b["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = p.schema["page_id"].dataType.simpleString()
    return map_arrow(p, run, f"page_id {kind}, url string, text string, n_chars long")
