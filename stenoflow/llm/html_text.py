"""Main text of web pages by composite text density.

Every DOM node gets the characters and tags below it, and of these the characters and
tags of links.  Its composite density is

    C / T * log(C / LT * T / LC, base log(C / nLC * LC + LC_body / C_body * C + e))

with C characters, LC of them in links, nLC not in links, T tags, LT link tags, and
counts of 0 taken as 1.  The body path runs from the body to its node of the highest density sum; the least
density on it is the page's threshold.  Content is the subtree below the threshold's reach with the largest sum of
its children's densities; its blocks are joined in page order.

Menus, headers, footers, side bars, notices, adverts, forms, scripts, styles and reader
comments inside the subtree are left out by element and by class or id name; so are blocks of
several links that stay under the threshold, and lines of rights at the end.  Elements of a
sentence are not dropped by name, and a header inside an article is the article's own.

Of equal density sums the outer node is taken, of nodes beside each other the later one.

Defined cases: null and empty pages have an empty text.  A page without tags is one
block.  Unclosed and stray tags are read as browsers do for paragraphs, list items and
table cells, and are otherwise ignored.  Only elements of raw text run to the page's end
without an end tag; drawings and formulas end at a page element, a selection at a block.  Pages of any length are read whole, with a stack
instead of recursion.  Repeated rows get equal results.  Columns named like the results
are replaced by them; other columns stay.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stenoflow.llm import common as C

# Element names by their role in a page.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe".split())
_FOREIGN = frozenset(["svg", "math"])
#: Elements whose tag is ignored if no end tag follows, so that the rest of the page is not part of them.
_ENDED = frozenset("noscript template object".split())
_OUT = frozenset("nav header footer aside form button menu dialog select svg annotation annotation-xml".split()) | _RAW | _ENDED | {"head"}
#: Elements of a sentence; their names say nothing about the place in a page, so none drops them.
_PHRASE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub "
    "sup time tt u var".split()
)
#: Start tags that end a drawing or formula, and elements in which they do not.
_BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var article section main aside nav header footer".split()
)
_INTEGRATION = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
_BLOCK = frozenset(
    "address article blockquote body center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 "
    "hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_LISTS = frozenset(["ul", "ol", "dl", "li", "dt", "dd"])
_INLINE_LINK = frozenset(["a", "button", "select"])
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_OUT_NAME = re.compile(
    r"(?:ads?|advert\w*|adverti[sz]ement|banner|breadcrumbs?|comments?|cookies?|consent|disclaimer|"
    r"footer|header|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|pagination|popup|promo|"
    r"related|respond|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscribe|toolbar|widget)\Z",
    re.I,
)
#: Parts that a name may have besides; with any other part, as in has-sidebar, it names something else.
_BESIDE = frozenset(
    "site main page top bottom left right primary secondary global list bar box area section block wrapper wrap "
    "container inner outer links link buttons form posts articles user reader id".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=)*)>?|<[!?/][^>]*>?", re.S
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>]+)))?")
#: Share of link characters from which a block of several links is a list of links.
LINK_LIST = 0.8
#: A whole line of rights at the end of a page: a mark, years, and a holder's name.
_RIGHTS = re.compile(
    r"(?:(?i:©|\(c\)|copyright)\s*)+(?:\d{4}(?:\s*[-–,]\s*\d{2,4})*)?[\s,.]*(?:(?i:by)\s+)?(?:(?:[A-ZÀ-ÖØ-Þ0-9]\S*|of|and|the|for|de|la|&)[\s,.]*){0,6}(?i:all rights reserved)?[\s.]*\Z"
)
#: Names of reader comments count on articles too, beside or inside another one.
_COMMENT = re.compile(r"(?:comments?|respond|reply)\Z", re.I)
_NONE = re.compile(r"display\s*:\s*none", re.I)


def _named_out(name: str) -> bool:
    parts = [x for x in re.split(r"[_-]+", name) if x]
    marks = [bool(_OUT_NAME.match(x)) for x in parts]
    return any(marks) and all(m or x.lower() in _BESIDE or x.isdigit() for m, x in zip(marks, parts, strict=True))


def _marked_out(tag: str, attributes: str, after: bool = False) -> bool:
    """Whether the attributes hide an element or name it as none of the content; after: text of the page's own stands before it."""
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "style" and _NONE.search(value)):
            return True
        if name == "aria-hidden" and value.strip().lower() == "true":
            return True
        if name in ("class", "id", "role") and tag not in _PHRASE and tag not in ("main", "article") and any(map(_named_out, value.split())):
            return True
        if after and tag == "article" and name in ("class", "id") and any(_named_out(x) and _COMMENT.search(re.split(r"[_-]", x)[0]) for x in value.split()):
            return True
    return False


class Node:
    __slots__ = ("tag", "out", "link", "children", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, out: bool, link: bool):
        self.tag, self.out, self.link = tag, out, link
        #: Nodes and raw strings in page order.
        self.children: list = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


#: Tags that end an open element of the second kind, up to an element of the third.
_ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}


def parse(page: str) -> Node:
    """Tree of the page; elements that hold no content are marked out."""
    root = Node("#root", False, False)
    stack, at, n = [root], 0, len(page)
    last_end: dict[str, int] = {}
    # places in the stack of drawings, formulas and page's parts in them, and of elements that are out
    drawings: list[int] = []
    outs: list[int] = []
    own = False
    # open elements by name, so that stray end tags are told without a search
    count: dict[str, int] = {}

    def close(k: int) -> None:
        for x in stack[k:]:
            count[x.tag] -= 1
        del stack[k:]
        for places in (drawings, outs):
            while places and places[-1] >= k:
                places.pop()

    def push(node: Node) -> None:
        if node.tag in _FOREIGN or node.tag in _INTEGRATION:
            drawings.append(len(stack))
        if node.out:
            outs.append(len(stack))
        stack.append(node)
        count[node.tag] = count.get(node.tag, 0) + 1

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):
            if not count.get(tag):
                continue
            # an inline end tag closes nothing beyond the block that it stands in
            wide = tag in _BLOCK or tag in _OUT
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
                if not wide and stack[k].tag in _BLOCK:
                    break
            continue
        attributes = m.group(3) or ""
        # the place of the drawing or formula that the tag stands in, if it is not a page's part again
        drawn = drawings[-1] if drawings and stack[drawings[-1]].tag in _FOREIGN else 0
        if drawn and tag in _BREAKOUT:
            close(drawn)
            drawn = 0
        if tag in _BLOCK and tag != "hr" or tag in ("input", "textarea", "select"):
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag not in ("option", "optgroup")), 0)
            if stack[k].tag == "select":
                close(k)
        if tag in _BLOCK:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in _BLOCK or stack[k].tag in _OUT:
                    break
        if tag in _ENDS:
            ends, stop = _ENDS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in stop:
                    break
                if stack[k].tag in ends:
                    close(k)
                    if tag != "tr":
                        break
        if tag in _ENDED:
            if tag not in last_end:
                last_end[tag] = max((e.start() for e in re.finditer(rf"</{tag}(?=[\s/>])", page, re.I)), default=-1)
            if last_end[tag] < at:
                continue
        # a header inside an article is the article's own
        out = tag in _OUT and not (tag == "header" and count.get("article"))
        if attributes and not out and tag not in ("html", "body"):
            out = _marked_out(tag, attributes, own)
        own = own or (tag in ("article", "p") and not out and not outs)
        node = Node(tag, out, tag in _INLINE_LINK)
        stack[-1].children.append(node)
        if tag in _VOID:
            continue
        closed = attributes.endswith("/")
        if drawn or tag in _FOREIGN:
            # self-closing counts in drawings and formulas, and nothing in them is raw text
            if not closed:
                push(node)
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if not closed or tag not in _INLINE_LINK:
            push(node)
    return root


def _post_order(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if isinstance(c, Node) and not c.out)
    return order[::-1]


def measure(root: Node) -> Node:
    """Fills in counts and densities; returns the body, or the root of a page without one."""
    order = _post_order(root)
    for node in order:
        for c in node.children:
            if isinstance(c, str):
                node.chars += len(" ".join(c.split()))
            elif not c.out:
                node.chars += c.chars
                node.tags += c.tags + 1
                node.link_chars += c.link_chars
                node.link_tags += c.link_tags + c.link
        if node.link:
            node.link_chars = node.chars
    body = next((x for x in reversed(order) if x.tag == "body"), root)
    ratio = body.link_chars / max(body.chars, 1)
    for node in order:
        c, lc, t, lt = (max(x, 1) for x in (node.chars, node.link_chars, node.tags, node.link_tags))
        if not node.chars:
            continue
        base = math.log(c / max(node.chars - node.link_chars, 1) * node.link_chars + ratio * c + math.e)
        node.density = c / t * max(0.0, math.log(c / lc * t / lt) / base if c * t > lc * lt else 0.0)
    for node in order:
        node.total = sum(c.density for c in node.children if isinstance(c, Node) and not c.out)
    return body


def _links(node: Node) -> bool:
    """Whether a node is hardly more than links."""
    return node.link_chars >= LINK_LIST * node.chars


def content(body: Node) -> tuple[Node, float]:
    """The subtree with the largest density sum among those that the body path's threshold admits, and the threshold."""
    inside = _post_order(body)
    best = max(reversed(inside), key=lambda x: x.total)
    parent = {id(c): x for x in inside for c in x.children if isinstance(c, Node)}
    threshold, node = best.density, best
    while node is not body and id(node) in parent:
        node = parent[id(node)]
        threshold = min(threshold, node.density)
    chosen, node = best, best
    # an ancestor takes over while text that lies beside the chosen subtree is as dense as the threshold
    while node is not body and id(node) in parent:
        up = parent[id(node)]
        beside = [c for c in up.children if isinstance(c, Node) and not c.out and c is not node and c.chars and not _links(c)]
        if any(c.density >= threshold or c.tag in _HEADINGS or c.tag == "p" for c in beside):
            chosen = up
        node = up
    return chosen, threshold


def _below(node: Node, threshold: float) -> bool:
    """Whether a block below the chosen subtree is a list of links that stays under the threshold."""
    return node.tag in _BLOCK and node.link_tags > 1 and node.density < threshold and _links(node)


def blocks(top: Node, threshold: float = 0.0) -> list[str]:
    """Texts of the blocks below a node, in page order, white space collapsed.

    Lists of links under the threshold, and lines of rights at the end, are left out, but for lists in articles and
    lines in articles and list items.
    """
    found, run = [], []
    held = int(top.tag == "article")  # open articles

    def flush(kept: bool = False) -> None:
        text = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if text:
            found.append((text, kept or held > 0))

    stack: list = [top]
    while stack:
        x = stack.pop()
        if isinstance(x, tuple):
            tag = x[0]
            flush(tag == "li")
            held -= tag == "article"
        elif isinstance(x, str):
            run.append(x)
        elif x.out or (x is not top and _below(x, threshold) and not (held and x.tag in _LISTS)):
            run.append(" " if x.tag not in _BLOCK else "")
            if x.tag in _BLOCK or x.tag in ("nav", "header", "footer", "aside", "form"):
                flush()
        elif x.tag == "br":
            run.append(" ")
        else:
            if x.tag in _BLOCK:
                flush()
                stack.append((x.tag,))
                held += x is not top and x.tag == "article"
            stack.extend(reversed(x.children))
    flush()
    while found and not found[-1][1] and _RIGHTS.match(found[-1][0]):
        found.pop()
    return [text for text, _ in found]


def extract(page: str | None) -> str:
    """Main text of a page."""
    if not page:
        return ""
    body = measure(parse(page))
    return "\n".join(blocks(*content(body)))


_EXTRACTED = T.StringType()


@F.arrow_udf(_EXTRACTED)
def _main_text(page: pa.Array) -> pa.Array:
    return pa.array([extract(p) for p in page.to_pylist()], pa.string())


def main_text(df: DataFrame, *, page: str = "html", to: tuple[str, str] = ("text", "n_chars")) -> DataFrame:
    """df with the main text of each page and its length in code points."""
    C.ship(df.sparkSession)
    text, n_chars = to
    t, name = C.free_name(df, "__t"), C.free_name(df, "__page")
    got = df.withColumn(t, _main_text(F.col(f"`{page}`").cast("string"))).withColumn(
        name,
        F.struct(F.col(t).alias(text), F.char_length(t).cast("long").alias(n_chars)),
    )
    return C.replace_columns(got.drop(t), name, [text, n_chars])


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = C.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text(pages).drop("html")
