"""Operator 10: main text of web pages by composite text density.

One pass over the markup builds the tree of block elements (formatting elements only add to their block's tags); elements
that are never article text by tag, role or class are left out.  Every node gets its characters per tag, adjusted for links;
the sum over a node's children says how much dense text hangs directly below it.  The subtree with the greatest sum is
the article; the least density on its path to the body is the threshold that lists of links must reach to count too."""

from __future__ import annotations

import html
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_slices, prepared

# Element names of HTML, and names that mark what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset("aside button canvas dialog footer head input map menu nav noscript object select svg math audio video".split())
#: Elements that may hold a whole page (as some frameworks' forms do): judged as blocks with a telling name are.
FORMS = frozenset(("form", "fieldset"))
RAW = "script|style|template|textarea|title|iframe|noembed|noframes|xmp"
UNCLOSED = DROPPED | {"header"}
HINTS = frozenset("ad ads adsense advert advertisement advertising banner breadcrumb breadcrumbs byline-share comment comments "
                  "consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter "
                  "notice notices pager pagination popup promo promoted related reply replies respond share sharing sidebar "
                  "signup skyscraper social sponsor sponsored subscribe toolbar widget".split())
#: Names of several words that do the same: where it stands and what it is, or what it is and how it is built.
COMPOUND = re.compile(
    "(?:site|global|top|bottom|main|primary|secondary|left|right|mobile|sticky|post|entry|article|blog|page)-(?:ads?|banner|breadcrumbs?"
    "|comments|footer|menu|nav|navbar|navigation|pagination|share|sharing|sidebar|toolbar)|(?:site|global|top)-header"
    "|(?:ads?|advert|advertisement|sponsor|sponsored|promo|cookies?|consent|gdpr|newsletter|signup|subscribe|share|sharing|social"
    "|related|comments?|reply|respond|nav|navbar|menu|breadcrumbs?|pagination|popup|modal|banner|sidebar|widget|footer)"
    "-(?:notice|banner|bar|box|popup|modal|slot|unit|container|wrapper|list|form|area|links|buttons?|icons|menu|nav|posts|articles"
    "|stories|widgets?|signup|overlay|dialog|consent|message|block|thread)")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("banner complementary contentinfo navigation search alert dialog menu menubar form".split())
#: What an opening tag closes implicitly when it is the innermost open element.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
WHOLE = frozenset(("article", "main"))

TOKEN = re.compile(
    rf"<!--.*?(?:--!?>|\Z)|<(?P<raw>{RAW})\b[^>]*+(?:/>|>.*?(?:</(?P=raw)\s*+>|\Z))"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[a-zA-Z/!?][^>]*+(?:>|\Z)", re.S | re.I)
ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)


class Node:
    __slots__ = ("tag", "parent", "begin", "end", "chars", "tags", "link_chars", "link_tags", "density", "sum", "named", "text")

    def __init__(self, tag, parent, begin, named=False):
        self.tag, self.parent, self.begin, self.end, self.named = tag, parent, begin, None, named
        self.chars = self.tags = self.link_chars = self.link_tags = self.text = 0
        self.density = self.sum = 0.0


def attributes(attrs: str) -> dict[str, str]:
    """Attribute values in lower case by name, the first of a name."""
    out: dict[str, str] = {}
    for name, a, b, c in ATTR.findall(attrs):
        out.setdefault(name.lower(), (a or b or c).lower())
    return out


def is_boilerplate(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    """By tag, role or not being shown.  ``inside``: within an article or main element, where a header belongs to the
    text."""
    if tag in DROPPED or tag == "header" and not inside:
        return True
    if not attrs or tag in ("html", "body", "article", "main"):
        return False
    return (attrs.get("role") in ROLES or attrs.get("hidden", "until-found") != "until-found" or attrs.get("aria-hidden") == "true"
            or bool(NOT_SHOWN.search(attrs.get("style", ""))))


def is_named(tag: str, attrs: dict[str, str]) -> bool:
    """Whether a class or the id of a block says that it is not the article."""
    if tag in FORMS:
        return True
    if not attrs or tag in INLINE or tag in HEADINGS or tag in ("html", "body", "article", "main"):
        return False
    names = [*attrs.get("class", "").split(), *attrs.get("id", "").split()]
    return any(n in HINTS or COMPOUND.fullmatch(n.replace("_", "-")) for n in names)


def parse(page: str, kept: frozenset[str] = frozenset()) -> tuple[list[Node], list[str]]:
    """Block elements in page order (the first is the body) and the text parts that their begin and end count.

    An element that is left out but never closed would take the rest of the page along: elements with its tag (``kept``)
    are then read again as blocks that are judged by their share of the text."""
    root = Node("body", None, 0)
    nodes, stack, parts = [root], [root], []
    links = 0
    skip, inner = "", {}  # the element being left out, and what is open within it
    at = whole = 0  # how many article and main elements are open

    def add(raw: str) -> None:
        if raw and not skip:
            text = html.unescape(raw)
            parts.append(text)
            n = len(" ".join(text.split()))
            stack[-1].chars += n
            if links:
                stack[-1].link_chars += n

    def close(k: int) -> None:
        nonlocal whole
        for node in stack[k:]:
            node.end = len(parts)
            whole -= node.tag in WHOLE
        del stack[k:]
        parts.append(" ")

    for m in TOKEN.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        name = m["name"]
        if not name:
            continue
        tag, attrs = name.lower(), m["attrs"]
        if skip:
            if m["end"]:
                if inner.get(tag, 0) > 0:
                    inner[tag] -= 1
                    if tag == skip and not inner[tag]:
                        skip = ""
                    continue
                if tag in INLINE or all(n.tag != tag for n in stack):
                    continue
                if skip in UNCLOSED:
                    return parse(page, kept | {skip})
                skip = ""  # an element around it ends
            elif skip in CLOSED_BY.get(tag, ()) or skip == "p" and tag not in INLINE and tag not in VOID:
                skip = ""
            else:
                if tag not in VOID:
                    inner[tag] = inner.get(tag, 0) + 1
                continue
        if m["end"]:
            if tag == "a":
                links = 0
            elif tag not in INLINE and tag not in VOID:
                k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
                if k:
                    close(k)
                    links = 0
            continue
        if tag in ("html", "body"):
            continue
        known = attributes(attrs) if attrs and not attrs.isspace() else {}
        if tag not in kept and is_boilerplate(tag, known, whole > 0):
            if tag not in VOID and not attrs.rstrip().endswith("/"):
                skip, inner = tag, {tag: 1}
            if tag not in INLINE:
                parts.append(" ")
            continue
        stack[-1].tags += 1
        if tag in INLINE or tag in VOID:
            if tag == "a":
                links = 1
                stack[-1].link_tags += 1
            elif tag in ("br", "hr"):
                parts.append(" ")
            continue
        if stack[-1].tag == "p":
            close(len(stack) - 1)
        while len(stack) > 1 and stack[-1].tag in CLOSED_BY.get(tag, ()):
            close(len(stack) - 1)
        parts.append(" ")
        node = Node(tag, stack[-1], len(parts), tag in kept or is_named(tag, known))
        nodes.append(node)
        stack.append(node)
        whole += tag in WHOLE
        links = 0
    if skip in UNCLOSED:
        return parse(page, kept | {skip})
    if not page.startswith("<", at) or not re.match(r"<[a-zA-Z/!?]", page[at:at + 2]):
        add(page[at:])
    for node in stack:
        node.end = len(parts)
    return nodes, parts


def without_named(nodes: list[Node], parts: list[str]) -> list[Node]:
    """The nodes outside named blocks, whose text parts are emptied.  A named block that holds most of the page's text
    stays, unless an article or main element beside it has text."""
    if not any(n.named for n in nodes):
        return nodes
    for n in reversed(nodes):
        n.text += n.chars
        if n.parent:
            n.parent.text += n.text
    whole = [n for n in nodes if n.tag in WHOLE and n.text]
    out, until = [], -1
    for n in nodes:
        if n.begin < until:
            continue
        if n.named and (2 * n.text <= nodes[0].text or any(w.end <= n.begin or w.begin >= n.end for w in whole)):
            n.parent.tags -= 1
            parts[n.begin:n.end] = [""] * (n.end - n.begin)
            until = n.end
            continue
        out.append(n)
    return out


def weigh(nodes: list[Node]) -> None:
    """Composite text density of every node, and the sum over its children.  The logarithm's base is kept from 1 upwards,
    so that pages without links have finite densities."""
    for n in reversed(nodes[1:]):
        p = n.parent
        p.chars += n.chars
        p.tags += n.tags
        p.link_chars += n.link_chars
        p.link_tags += n.link_tags
    body = nodes[0]
    share = body.link_chars / max(1, body.chars)
    for n in nodes:
        if n.chars:
            tags = max(1, n.tags)
            base = math.log(n.chars / max(1, n.chars - n.link_chars) * n.link_chars + share * n.chars + math.e)
            ratio = n.chars / max(1, n.link_chars) * tags / max(1, n.link_tags)
            n.density = max(0.0, n.chars / tags * math.log(max(1.0, ratio) + 1e-9) / max(1.0, math.log(base) + 1.0))
        if n.parent:
            n.parent.sum += n.density


def main_text(page: str) -> str:
    """The article of a page: white space collapsed, blocks joined by one space; "" if there is none."""
    nodes, parts = parse(page)
    nodes = without_named(nodes, parts)
    weigh(nodes)
    best = max(nodes, key=lambda n: n.sum)  # the first of equals: the outermost
    path = {best, *_above(best)}
    threshold = min(n.density for n in path)

    def dense(n: Node) -> bool:  # short blocks never reach the threshold, so only lists of links are left out by it
        return n.density >= threshold or 2 * n.link_chars <= n.chars

    whole = [n for n in nodes if n.tag in WHOLE and n.chars and not any(w.tag in WHOLE for w in _above(n))]
    if any(n in whole for n in path) or 2 * sum(n.chars for n in whole) > nodes[0].chars:
        chosen = [n for n in whole if n in path or dense(n)]
        return _joined(parts, [(n.begin, n.end) for n in chosen])
    ranges, at = [], 0
    for n in nodes:
        if n.begin < at or n in path and n is not best:
            continue
        if n is best or n.chars and n.density >= threshold:
            ranges.append((at, n.end))
            at = n.end
        elif not dense(n):
            ranges.append((at, n.begin))
            at = n.end
    return _joined(parts, [*ranges, (at, len(parts))])


def _joined(parts: list[str], ranges: list[tuple[int, int]]) -> str:
    return " ".join(" ".join(" ".join("".join(parts[a:b]).split()) for a, b in ranges).split())


def _above(n: Node):
    while n.parent:
        n = n.parent
        yield n


def extract_main_text(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html_col`` in ``name`` instead of that column.

    Null and empty markup give an empty text; broken markup (open tags, cut pages) is read as far as it goes.
    Each row is judged alone, so repeated rows repeat and an empty table stays empty."""
    prepared(pages.sparkSession)
    others = [c for c in pages.columns if c not in (html_col, name)]
    slim = pages.select(*others, F.col(html_col).cast("string").alias(name))
    schema = slim.schema

    def run(batches):
        import pyarrow as pa
        for batch in in_slices(batches, 500):
            texts = pa.array([main_text(t or "") for t in batch.column(len(others)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], batch.schema.names)

    return slim.mapInArrow(run, schema)
