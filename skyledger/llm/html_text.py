"""Main text of web pages by composite text density.

Every node of the document tree gets the density

    C / T * log(C / LC * T / LT) / log(log(C / N * LC + LC / C * body C + e))

of its C characters, T tags, LC characters and LT tags of links and N = C - LC,
a character-per-tag ratio that links pull down. The densities of a node's
children are summed; the threshold is the smallest density on the path from
body to the node with the largest sum. In every subtree that reaches it the node
with the largest sum is the article's, as is every node outside it that has a
quarter of the largest sum or more; the smallest subtree around all of these is
the article, so that its headings and short lines stay. All of this is measured
from body on every page, whatever its elements are called. Elements that never
hold article text are left out when the tree is built.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm import ragged
from skyledger.llm.inputs import pick

# fixed values: HTML elements without content
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# fixed values: HTML elements whose content is not markup
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}
# fixed values: HTML elements that never belong to an article's text
BARRED = {
    "head", "script", "style", "title", "textarea", "iframe", "noembed", "noframes", "noscript", "xmp", "template", "svg", "canvas", "object", "audio", "video",
    "nav", "footer", "aside", "select", "option", "input", "dialog", "menu", "datalist", "map", "applet", "annotation", "annotation-xml",
}
# fixed values: HTML elements that are parts of a form, but words of a sentence inside one of SENTENCES
CONTROLS = {"button", "label", "legend"}
SENTENCES = {"p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "th", "dd", "dt", "figcaption", "caption", "blockquote", "pre"}
# fixed values: HTML elements that stand in a line of text
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "rp", "rt", "ruby",
    "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
    "math", "mi", "mn", "mo", "mrow", "msup", "msub", "mfrac", "msqrt", "mtext", "semantics", "label", "button",
}
# fixed values: words in class, id or role that mark page furniture
FURNITURE = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promotion", "nav", "navbar", "navigation", "menu",
    "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "sidebar", "side", "aside", "widget", "related", "recommended", "share", "sharing", "social",
    "comment", "comments", "disqus", "reply", "replies", "respond", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter",
    "subscribe", "subscription", "signup", "login", "search", "pagination", "pager", "tags", "copyright", "legal", "toolbar", "complementary", "contentinfo",
    "dialog", "alert", "alertdialog", "skip", "hidden",
}
# fixed values: of these only the whole name counts, as in "hidden" but not "overflow-hidden", "header" but not "entry-header"
WHOLE = {"header", "hidden", "side"}
# fixed values: words that turn the furniture word behind them into a state of an element that is none
STATES = {"has", "have", "no", "not", "non", "with", "without"}
# fixed values: HTML elements that an opening tag closes if one of them is open
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
           "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
# fixed values: HTML elements inside which an implied end tag is looked for no further up
LIMITS = {"ul", "ol", "dl", "table", "td", "th", "body", "article", "section", "div", "main", "blockquote"}

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
# a link with this many characters is a paragraph, not an entry of a menu
PARAGRAPH = 150
SPACES = re.compile(r"\s+")
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
TEXT, BREAK = "#text", "#break"


class Node:
    __slots__ = ("tag", "parent", "children", "text", "barred", "chars", "tags", "link_chars", "link_tags", "density", "total", "named", "depth")

    def __init__(self, tag: str, parent: Node | None, barred: bool, text: str = ""):
        self.tag, self.parent, self.barred, self.text, self.named = tag, parent, barred, text, False
        self.depth = parent.depth + 1 if parent is not None else 0
        self.children: list[Node] = []
        if parent is not None:
            parent.children.append(self)


def hidden(attributes: str) -> bool:
    """Whether the attributes take the element out of sight."""
    for found in ATTRIBUTE.finditer(attributes):
        name, value = found[1].lower(), found[2] or found[3] or found[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    # what is left has no values
    return "hidden" in re.split(r"[\s/]+", ATTRIBUTE.sub(" ", attributes).lower())


def furniture(attributes: str, inner: bool = False) -> bool:
    """Whether class, id or role name a part that is not article text: a whole name, or the last word of one; ``inner`` headers belong to an article."""
    for found in ATTRIBUTE.finditer(attributes):
        if found[1].lower() not in ("class", "id", "role"):
            continue
        for token in (found[2] or found[3] or found[4] or "").split():
            whole = token.lower()
            if whole in FURNITURE:
                if not (inner and whole == "header"):
                    return True
                continue
            words = [w.lower() for w in NAME_WORDS.findall(token)]
            if words and words[-1] in FURNITURE - WHOLE and not STATES.intersection(words[:-1]):
                return True
    return False


def parse(page: str) -> Node:
    """The tree of a page; end tags that fit nothing are ignored, missing ones are implied."""
    body = Node("body", Node("html", None, False), False)
    here, at = body, 0
    opened: defaultdict[str, list[Node]] = defaultdict(list)  # open elements by tag, the innermost last

    def close(node: Node) -> Node:
        """Close everything up to and with the node."""
        up = here
        while up is not node.parent:
            opened[up.tag].pop()
            up = up.parent
        return up

    def nearest(tags: set[str], limits: set[str]) -> Node | None:
        """The outermost open element of ``tags`` that no element of ``limits`` shuts in."""
        shut = max((opened[t][-1].depth for t in limits if opened[t]), default=body.depth)
        first = (opened[t][i] for t in tags if (i := bisect_right(opened[t], shut, key=lambda n: n.depth)) < len(opened[t]))
        return min(first, key=lambda n: n.depth, default=None)

    while at < len(page):
        found = TAG.search(page, at)
        end = found.start() if found else len(page)
        if end > at:
            Node(TEXT, here, here.barred, html.unescape(page[at:end]))
        if not found:
            break
        at = found.end()
        if found[0].startswith("<![CDATA["):
            Node(TEXT, here, here.barred, found[0][9:].removesuffix("]]>"))
            continue
        tag = (found[2] or "").lower()
        if not tag or tag in ("html", "body"):
            continue
        if found[1]:
            if tag == "br" or tag == "p" and not opened["p"]:
                Node(BREAK, here, here.barred)
            elif opened[tag]:
                here = close(opened[tag][-1])
            continue
        if tag in IMPLIED and any(opened[t] for t in IMPLIED[tag]):
            last = nearest(IMPLIED[tag], LIMITS - IMPLIED[tag])
            here = close(last) if last else here
        elif opened["p"] and tag not in INLINE and tag not in VOID and tag not in RAW:
            last = nearest({"p"}, {"td", "th", "button", "object", "caption"})
            here = close(last) if last else here
        if tag in ("br", "hr"):
            Node(BREAK, here, here.barred)
            continue
        if tag in VOID:
            Node(tag, here, True)
            continue
        # a page header is furniture, the header of an article or of a section of it is not
        inner = bool(opened["article"] or opened["main"])
        barred = tag in BARRED or tag == "header" and not (inner or opened["section"]) or tag in CONTROLS and not any(opened[t] for t in SENTENCES)
        node = Node(tag, here, here.barred or barred or hidden(found[3]))
        node.named = furniture(found[3], inner)
        if tag in RAW:
            end_tag = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end_tag.end() if end_tag else len(page)
            continue
        opened[tag].append(node)
        here = node
    _bar_forms(body)
    return body


def _bar_forms(body: Node) -> None:
    """Bar the forms, but those that hold half of the page's text or more: some pages stand in a form as a whole."""
    nodes = [body]
    for node in nodes:
        nodes += [c for c in node.children if not c.barred and c.tag not in (TEXT, BREAK)]
    forms = [n for n in nodes if n.tag in ("form", "fieldset")]
    if not forms:
        return
    size: dict[int, int] = {}
    for node in reversed(nodes):
        size[id(node)] = sum(len("".join(c.text.split())) if c.tag == TEXT else size.get(id(c), 0) for c in node.children if not c.barred)
    for form in forms:
        form.barred = 2 * size[id(form)] < size[id(body)]


def _measure(body: Node) -> list[Node]:
    """All element nodes that may hold article text, parents first, with their sums and densities."""
    nodes, stack = [], [(body, False)]
    linked = {}
    while stack:
        node, link = stack.pop()
        linked[id(node)] = link = link or node.tag == "a"
        nodes.append(node)
        stack += [(c, link) for c in node.children if not c.barred and c.tag not in (TEXT, BREAK)]
    for node in reversed(nodes):
        node.chars = node.link_chars = 0
        node.tags = node.link_tags = 0
        for child in node.children:
            if child.barred or child.tag == BREAK:
                continue
            if child.tag == TEXT:
                size = len("".join(child.text.split()))
                node.chars += size
                node.link_chars += size if linked[id(node)] else 0
            else:
                node.chars += child.chars
                node.link_chars += child.link_chars
                node.tags += child.tags + 1
                node.link_tags += child.link_tags + (child.tag == "a")
    ratio = body.link_chars / body.chars if body.chars else 0
    for node in nodes:
        c, t, lc, lt = node.chars, max(node.tags, 1), node.link_chars, max(node.link_tags, 1)
        if not c:
            node.density = 0.0
            continue
        base = math.log(math.log(c / max(c - lc, 1) * lc + ratio * c + math.e))
        inner = c / max(lc, 1) * t / lt
        node.density = c / t * (math.log(inner) / base if base > 1e-12 and inner > 0 else math.log(max(inner, 1e-12)))
    for node in nodes:
        node.total = sum(c.density for c in node.children if not c.barred and c.tag not in (TEXT, BREAK)) + (
            sum(len("".join(c.text.split())) for c in node.children if c.tag == TEXT))
    return nodes


def _path(node: Node, top: Node) -> list[Node]:
    """The nodes from ``top`` down to ``node``, both included."""
    path = [node]
    while path[-1] is not top:
        path.append(path[-1].parent)
    return path[::-1]


def _bar_named(body: Node) -> Node | None:
    """Bar what class, id or role name as furniture, but no ancestor of the node with the largest sum of the page.

    That node itself stays barred only if the rest of the page has a text of a
    quarter of its sum. Where names on its path are overruled, the node with the
    largest sum outside them is returned, as it belongs to the article too.
    """
    nodes = _measure(body)
    named = [n for n in nodes if n.named]
    if not named:
        return None
    best = max(nodes, key=lambda n: n.total)
    most, path = best.total, _path(best, body)
    for node in named:
        node.barred = True
    rest = max(_measure(body), key=lambda n: n.total)
    overruled = [n for n in path if n.named and (n is not best or 4 * rest.total < most)]
    for node in overruled:
        node.barred = False
    return rest if overruled and rest.chars and 2 * rest.link_chars <= rest.chars else None


def article(body: Node) -> Node | None:
    """The smallest subtree that holds the article, with lists of links in it barred; None without text."""
    rest = _bar_named(body)
    nodes = _measure(body)
    if not body.chars:
        return None
    best = max(nodes, key=lambda n: n.total)
    threshold = min(n.density for n in _path(best, body))
    # in every subtree that reaches the threshold the node with the largest sum is the article's
    most: dict[int, Node] = {}
    for node in reversed(nodes):
        most[id(node)] = max([node, *(most[id(c)] for c in _elements(node))], key=lambda n: n.total)
    marked = {id(n): n for n in (most[id(n)] for n in nodes if n.density >= threshold and n.chars and 2 * n.link_chars <= n.chars)}
    # so are nodes beside the best whose sum is a good part of its own: a text may stand in several elements
    path = _path(best, body)
    below, above = {id(best)}, {id(n) for n in path}
    for node in nodes:
        if node.parent is not None and id(node.parent) in below:
            below.add(id(node))
        elif 4 * node.total >= best.total and 2 * node.link_chars <= node.chars and id(node) not in above:
            marked[id(node)] = node
    marked |= {id(n): n for n in (best, rest) if n is not None}
    held: Counter[int] = Counter(marked.keys())  # marked nodes of every subtree
    for node in reversed(nodes):
        if node is not body:
            held[id(node.parent)] += held[id(node)]
    top = next(n for n in reversed(path) if held[id(n)] == held[id(body)])
    inside = set(marked)  # marked nodes and all below them
    for node in nodes:
        if id(node.parent) in inside:
            inside.add(id(node))
    for node in nodes:
        if node.tag in INLINE or id(node) in marked or node is top:
            continue
        # links that stand in no marked node, but for whole paragraphs; what a marked node links to is part of its text
        menu = 2 * node.link_chars > node.chars and node.link_chars < PARAGRAPH * max(node.link_tags, 1)
        if not held[id(node)] and id(node) not in inside and menu:
            node.barred = True
    return top


def _elements(node: Node) -> list[Node]:
    return [c for c in node.children if not c.barred and c.tag not in (TEXT, BREAK)]


def blocks(top: Node) -> list[str]:
    """Text of the blocks below a node: white space inside a block is one space, empty blocks are none."""
    out: list[str] = []
    held: list[str] = []

    def close() -> None:
        text = SPACES.sub(" ", "".join(held)).strip()
        held.clear()
        if text:
            out.append(text)

    stack: list[Node | None] = [top]
    while stack:
        node = stack.pop()
        if node is None or node.tag == BREAK:
            close()
        elif node.barred:
            if node.tag not in INLINE and node.tag not in VOID:
                close()
        elif node.tag == TEXT:
            held.append(node.text)
        else:
            if node.tag not in INLINE:
                close()
                stack.append(None)
            stack += reversed(node.children)
    close()
    return out


def main_text(page: str) -> str:
    top = article(parse(page)) if page else None
    return "\n".join(blocks(top)) if top else ""


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    ``text`` has the blocks of the article, one a line; it is empty for a null
    or empty page and for one without article text, and n_chars counts its code
    points. Broken markup is read as far as it goes. Null ids and urls stay
    null, repeated rows stay repeated, pages are never cut; other columns are
    left out; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page or "") for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], np.int64))],
                names=["page_id", "url", "text", "n_chars"])

    return pick(pages, page_id="long", url="string", html="string").mapInArrow(ragged.tidy(run), "page_id long, url string, text string, n_chars long")
