"""HTML extraction by composite text density.

A tolerant pass over the tags builds the tree of each page. For every node the characters per tag
are adjusted by its links (composite text density); the densities of a node's children add up to its
density sum, and the least density on the path from the node with the greatest sum to the body is the
threshold. From the body down, each node that reaches the threshold marks the node of the greatest sum
in it as content. Element, role and name are weights on the density of a node and of what is below it:
menus, footers, adverts or comments need far more text to be content, and a part that holds most of a
page's text is none, whatever its name. Only what is never shown (scripts, styles, hidden elements) goes
without being measured. A node marked inside an article element stands for that article.

A page is one row: its tree lives in one task only while the row is read. Every step is linear in the
page, malformed ones included.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
#: Attributes up to the end of a tag; one that ends inside a quote is read again without quotes.
REST = re.compile(r"""((?:[^>"']++|"[^"]*"|'[^']*')*+)>""", re.S)
NAMES = re.compile(r"""\b(id|class|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
MAIN = re.compile(r"""\brole\s*=\s*["']?main\b""", re.I)

# Element names with a meaning of their own: fixed values.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noframes", "svg", "math"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
OUT = {"nav", "footer", "aside", "menu", "dialog", "select", "datalist", "object", "embed", "audio", "video", "canvas", "map"}
CONTROLS = {"button", "label", "input", "output", "progress", "meter"}
UNSEEN = {"head"} | RAW
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar", "status", "note"}
PARTS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "adbox", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar", "navigation", "menu", "topbar", "toolbar", "breadcrumb", "breadcrumbs", "sidebar", "aside", "widget", "widgets", "header", "masthead", "footer", "colophon", "copyright", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "comment", "comments", "commentlist", "disqus", "respond", "replies", "reply", "share", "sharing", "social", "related", "recommended", "recommendations", "pagination", "pager"}
CONTENT = {"article", "main"}
#: Names that say a layout has a part, not that it is one, and names of articles that are none.
ABOUT = {"has", "with", "no", "without"}
NO_ARTICLE = {"comment", "comments", "reply", "ad", "ads", "advert", "sponsored", "promo", "related", "recommended", "teaser"}
P_ENDS = ("td", "th", "table", "button", "div", "article", "section", "body", "li", "blockquote")
CELLS = {"td", "th", "tr", "table", "tbody", "thead", "tfoot", "div", "article", "main", "body", "section"}
#: Blocks of an article that are its text, whatever their names.
PROSE = {"p", "blockquote", "pre", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dd", "dt", "td", "th"}
#: Blocks that lay out a page, and lists, which are navigation where they consist of links.
LAYOUT = {"div", "section", "center", "table", "tbody", "thead", "tfoot", "tr", "td", "th", "article", "main", "body", "form", "header", "details", "address"}
LISTS = {"ul", "ol", "dl", "li", "dd", "dt", "p"}
WRAPS = {"form", "fieldset"}
TALK = {"comment", "comments", "commentlist", "disqus", "respond", "replies", "reply"}
#: Elements that weigh 1 where they have no attributes.
PLAIN = {"p", "a", "b", "i", "em", "strong", "span", "div", "br", "li", "ul", "ol", "td", "tr", "table", "h1", "h2", "h3"}
#: Words of a name that say where or how a part stands, not what it is.
NEUTRAL = {"", "left", "right", "top", "bottom", "box", "list", "item", "items", "wrap", "wrapper", "container", "section", "area", "block", "inner", "outer", "site", "page", "main", "global", "slot", "unit", "bar", "text", "link", "links", "js", "id", "the"}
#: Share of the text around it without links from which a part's weight is 1: of most parts, and of comments and parts by element.
MAJOR, NEARLY = 0.5, 0.9
#: Weight of a part by element or by a name that says nothing else, of a control, and of what stands beside the article of a page.
FAINT, CONTROL, BESIDE = 0.01, 0.3, 0.1
#: Shares of the greatest density sum that another subtree must reach to be content of its own: of a lone block, and of one with several prose blocks.
RIVAL, PROSE_RIVAL = 0.5, 0.1
#: A node below this weight is a part of the page, not of the text around it.
PART = 0.5
#: Start tags that end an open element of these kinds, unless one of the fences stands between.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"})}
CLOSES_P = BLOCK - {"br", "body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "optgroup", "summary", "legend", "li", "dt", "dd"} | {"li", "dd", "dt"}


RAW_ENDS = {tag: re.compile(rf"</{tag}(?![a-z0-9])", re.I) for tag in RAW}


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "article", "holds", "weight", "faint", "kids", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, attrs: str, parent: Node | None) -> None:
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []
        #: Whether this is an article or main element or plays the role of main; whether one stands below.
        self.article = tag in CONTENT or bool(attrs) and MAIN.search(attrs) is not None
        self.holds = False
        #: Own weight, and the weight with those above.
        self.weight = self.faint = 1.0

    def evidence(self, words: set[str]) -> float:
        """How far the id or a class is made of these words, without neutral ones: 1 if of nothing else."""
        most = 0.0
        for key, value in NAMES.findall(self.attrs):
            if key.lower() in ("id", "class"):
                for name in html.unescape(value.strip("\"'")).lower().split():
                    own = [w for w in re.split(r"[^a-z]+", name) if w not in NEUTRAL]
                    if own and not ABOUT.intersection(own):
                        most = max(most, sum(w in words for w in own) / len(own))
        return most


class Open:
    """The open elements of a page: their stack, and for each name the places of its elements in it."""

    def __init__(self, root: Node) -> None:
        self.stack, self.places = [root], defaultdict(list)

    def push(self, node: Node) -> None:
        self.places[node.tag].append(len(self.stack))
        self.stack.append(node)

    def close(self, place: int) -> None:
        """Close the element at a place and all in it."""
        while len(self.stack) > place:
            self.places[self.stack.pop().tag].pop()

    def last(self, *tags: str) -> int:
        """Place of the innermost open element with one of these names, or 0."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)


def tree(page: str) -> Node:
    """The tree of a page; children are nodes and texts. Unclosed and stray tags are taken as browsers mostly do."""
    root = Node("html", "", None)
    now, at, n, text = Open(root), 0, len(page), 0
    quoted, body = True, False

    def flush(upto: int) -> None:
        if upto > text:
            now.stack[-1].children.append(page[text:upto])

    while True:
        start = page.find("<", at)
        if start < 0:
            break
        if page.startswith("<!--", start):
            flush(start)
            end = page.find("-->", start + 4)
            at = text = end + 3 if end >= 0 else n
            continue
        name = NAME.match(page, start + 1)
        if not name and page[start + 1 : start + 2] not in ("!", "?"):
            at = start + 1
            continue
        end = page.find(">", start)
        if end < 0 and name:
            # no tag ends any more: the rest is text
            break
        flush(start)
        if not name:
            at = text = end + 1 if end >= 0 else n
            continue
        attrs = REST.match(page, name.end()) if quoted else None
        if attrs is None:
            # a quote that never closes: from here on, tags end at the next bracket
            quoted = False
            end = page.find(">", name.end())
        at = text = attrs.end() if attrs else end + 1
        attrs, tag = attrs[1] if attrs else page[name.end() : end], name[2].lower()
        if name[1]:
            place = now.last(tag)
            if place and (tag in CELLS or now.last("td", "th", "table") <= place):
                now.close(place)
            elif tag == "p":
                now.stack[-1].children.append(Node("p", "", now.stack[-1]))
            continue
        if tag == "html":
            continue
        if tag == "body":
            now.close(now.last("head") or len(now.stack))
            if body:
                continue
            body = True
        if now.places["p"] and tag in CLOSES_P and now.last("p") > now.last(*P_ENDS):
            now.close(now.last("p"))
        if tag in ENDS and any(now.places.get(t) for t in ENDS[tag][0]):
            own, fence = ENDS[tag]
            fenced = now.last(*fence)
            hits = [places[k] for t in own if (places := now.places.get(t)) and (k := bisect_right(places, fenced)) < len(places)]
            if hits:
                now.close(min(hits))
        above = now.stack[-1]
        node = Node(tag, attrs, above)
        above.children.append(node)
        if node.article and (not attrs or node.evidence(NO_ARTICLE) < PART):
            while above is not None and not above.holds:
                above.holds = True
                above = above.parent
        if tag in RAW:
            end = RAW_ENDS[tag].search(page, at)
            end = page.find(">", end.end()) if end else -1
            at = text = end + 1 if end >= 0 else n
        elif tag not in VOID:
            now.push(node)
    flush(n)
    return root


def weigh(node: Node, inside: bool) -> tuple[float, float]:
    """(weight, share of the text around it from which the weight is 1) of a node by its element, role and names; weight 0: never shown.

    inside: below an article or main element.
    """
    if node.tag in UNSEEN:
        return 0.0, 0.0
    if node.tag in ("html", "body"):
        return 1.0, 0.0
    weight, share = 1.0, MAJOR
    if node.tag in WRAPS:
        weight = 1.0 if node.holds else FAINT
    elif node.tag in OUT or node.tag == "header" and not inside:
        weight, share = FAINT, NEARLY
    elif node.tag in CONTROLS:
        # a control in a sentence of an article is part of the sentence
        weight = 1.0 if inside and node.parent.tag not in LAYOUT | WRAPS | OUT else CONTROL
    if not node.attrs:
        return weight, share
    for key, value in NAMES.findall(node.attrs):
        key, value = key.lower(), html.unescape(value.strip("\"'")).lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            return 0.0, 0.0
        if key == "role" and value in ROLES and not (value == "form" and node.holds):
            weight, share = FAINT, MAJOR if value == "form" else NEARLY
    if node.article:
        return (FAINT, NEARLY) if node.evidence(NO_ARTICLE) >= PART else (weight, share)
    if node.holds or node.tag in ("h1", "h2") or inside and node.tag in PROSE:
        return weight, share
    known = node.evidence(PARTS - {"header"} if inside else PARTS)
    if known and FAINT ** known**3 < weight:
        weight, share = FAINT ** known**3, NEARLY if node.evidence(TALK) >= PART else share
    return weight, share


def weights(root: Node) -> None:
    """Take out what is never shown and weigh every other node."""
    seen, found, stack = [], {}, [(root, root, False)]
    while stack:
        node, scope, in_link = stack.pop()
        if node.article:
            scope = node
        in_link = in_link or node.tag == "a"
        seen.append((node, scope, in_link))
        kept = []
        for c in node.children:
            if isinstance(c, Node):
                weight, share = (1.0, 0.0) if c.tag in PLAIN and not c.attrs else weigh(c, c.article or scope.article)
                if not weight:
                    continue
                if weight < 1:
                    found[id(c)] = weight, share
                stack.append((c, scope, in_link))
            kept.append(c)
        node.children = kept
    if not found:
        return
    for node, _, in_link in reversed(seen):
        own = 0 if in_link else sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        node.chars = own + sum(c.chars for c in node.children if isinstance(c, Node))
    for c, scope, _ in seen:
        if id(c) in found:
            weight, share = found[id(c)]
            # on a page with an article, parts outside it are none of it, however long
            if c.chars <= share * scope.chars or scope is root and root.holds and not c.holds:
                c.weight = weight


def measure(root: Node) -> list[Node]:
    """Count characters, tags and links of every node and its densities, children first; returns the nodes in that order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        node.kids = [c for c in node.children if isinstance(c, Node)]
        stack.extend(node.kids)
    order.reverse()
    for node in order:
        kids = node.kids
        own = 0
        for c in node.children:
            if c.__class__ is str:
                own += len("".join(c.split()))
        node.chars = own + sum(k.chars for k in kids)
        node.tags = sum(k.tags + 1 for k in kids)
        link = node.tag == "a"
        node.link_chars = node.chars if link else sum(k.link_chars for k in kids)
        node.link_tags = node.tags + 1 if link else sum(k.link_tags for k in kids)
    body_links = max(root.link_chars, 1) / max(root.chars, 1)
    for node in order:
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        if c == 0:
            node.density = 0.0
        else:
            plain = max(c - node.link_chars, 1)
            base = math.log(c / plain * node.link_chars + body_links * c + math.e)
            node.density = c / t * math.log(max((c / lc) * (t / lt), 1.0) + 1.0) / base
    sums(order, root.holds, body_links)
    return order


def sums(order: list[Node], beside: bool, body_links: float) -> None:
    """Weights with those above, and density sums of weighted densities. beside: what stands beside articles weighs little."""
    for node in reversed(order):
        above = node.parent
        node.faint = node.weight * (above.faint if above is not None else 1.0)
        if beside and above is not None and above.holds and not (node.holds or node.article or above.article or node.tag in ("html", "body")):
            node.faint *= BESIDE
    for node in order:
        kids = _kids(node)
        # text of the node itself counts like a child, up to the density of the node
        own = node.chars - sum(k.chars for k in kids)
        node.total = sum(k.density * k.faint for k in kids) + node.faint * min(own * math.log(own + 1.0) / math.log(body_links * own + math.e), node.density)


def _mostly_links(node: Node) -> bool:
    return 2 * node.link_chars > node.chars


def _rival(node: Node) -> float:
    prose = sum(k.tag in BLOCK and k.tag not in LAYOUT and k.chars > 0 and not _mostly_links(k) for k in _kids(node))
    return PROSE_RIVAL if prose > 1 else RIVAL


def _kids(node: Node) -> list[Node]:
    """Children that are elements, as measure() left them."""
    return node.kids


def content(order: list[Node]) -> tuple[set[int], set[int], set[int]]:
    """Ids of the content nodes, of nodes below them that are none, and of nodes whose own text alone is content.

    A node that reaches the threshold marks the node of the greatest density sum in it, if that is the greatest
    of the page or a good share of it, and its children are judged in turn; a marked node in an article stands for the outermost article around it. Headings,
    paragraphs, lists and loose text next to the path of a marked node, and what stands between two marked
    ones, go with it unless most of it is links; parts and blocks of links in a marked node go.
    """
    root = order[-1]
    rank = lambda x: (x.total, x.chars * x.faint)
    best = max(order, key=rank)
    if best.total == 0:
        return ({id(root)} if root.chars else set()), set(), set()
    #: the outermost article around each node
    of: dict[int, Node | None] = {}
    for x in reversed(order):
        of[id(x)] = (of[id(x.parent)] if x.parent is not None else None) or (x if x.tag == "article" and x.weight >= PART else None)
    if root.holds and not any(y.article for y in _path(best)):
        # the text is not in an article: those of the page are cards or teasers
        sums(order, False, max(root.link_chars, 1) / max(root.chars, 1))
        best = max(order, key=rank)
    path = _path(best)
    limit = min(x.density for x in [x for x in path if x.tag != "html"] or path)
    top: dict[int, Node] = {}
    for x in order:
        top[id(x)] = max([x, *(top[id(k)] for k in _kids(x))], key=rank)
    marked: set[int] = set()
    found, stack = [], [root]
    while stack:
        x = stack.pop()
        if id(x) in marked or not x.chars or (x is not root and x.density * x.faint < limit and not x.holds):
            continue
        target = top[id(x)]
        if target is not best and (target.density * target.faint < limit or target.total < _rival(target) * best.total):
            target = None
        if target is not None:
            target = of[id(target)] or target
            if id(target) not in marked:
                marked.add(id(target))
                found.append(target)
        if target is not x:
            stack.extend(_kids(x))

    dropped, loose, above = set(), set(), {}
    for x in order:
        if x.weight < PART and x.density * x.faint < limit:
            dropped.add(id(x))
    for x in found:
        if x.tag == "article":
            continue
        blocks = LAYOUT | LISTS if x.tag in ("body", "html") else LAYOUT
        dropped |= {id(k) for k in _kids(x) if k.tag in blocks and k.density < limit and _mostly_links(k)}
        while x.parent is not None and id(x.parent) not in above:
            x = x.parent
            above[id(x)] = x
    for x in above.values():
        kids = _kids(x)
        held = [k for k, y in enumerate(kids) if id(y) in marked or id(y) in above]
        for k, y in enumerate(kids):
            prose = y.tag not in LAYOUT and y.tag in BLOCK or held[0] < k < held[-1]
            if y.chars and id(y) not in above and y.faint >= PART and (y.tag == "h1" or prose and not _mostly_links(y)):
                marked.add(id(y))
        inline = [y for y in kids if y.tag not in BLOCK and id(y) not in above and y.faint >= PART]
        own = x.chars - sum(y.chars for y in kids)
        if own + sum(y.chars - 2 * y.link_chars for y in inline) >= 0:
            loose.add(id(x))
            marked |= {id(y) for y in inline}
    return marked, dropped, loose


def _path(node: Node | None) -> list[Node]:
    """The node and those around it, up to the root."""
    out = []
    while node is not None:
        out.append(node)
        node = node.parent
    return out


def main_text(page: str | None) -> str:
    """Main text of a page: its blocks in page order, white space in and between them as one space."""
    if not page:
        return ""
    root = tree(page)
    weights(root)
    order = measure(root)
    marked, dropped, loose = content(order)
    blocks: list[str] = []
    run: list[str] = []

    def close() -> None:
        text = " ".join(html.unescape("".join(run)).split())
        if text:
            blocks.append(text)
        run.clear()

    # depth first without recursion: (node or text or None for an end, whether content)
    stack: list[tuple[object, bool]] = [(order[-1], False)]
    while stack:
        item, inside = stack.pop()
        if item is None:
            close()
        elif isinstance(item, str):
            if inside:
                run.append(item)
        else:
            inside = (inside or id(item) in marked) and id(item) not in dropped
            if item.tag in BLOCK:
                close()
                stack.append((None, inside))
            own = inside or id(item) in loose
            stack.extend((c, own if isinstance(c, str) else inside) for c in reversed(item.children))
    close()
    return " ".join(blocks)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(p.as_py()) for p in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """Main text of every whole page.

    pages: page_id, url, html; more columns are ignored. Null, empty and text-free pages give an empty text;
    plain text counts as one block; repeated rows give repeated rows; an empty table gives an empty result.
    Returns page_id, url, text, n_chars (code points).
    """
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return slim.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
