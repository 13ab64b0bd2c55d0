"""HTML extraction by composite text density.

A tolerant pass over the tags builds the tree. Every node gets its text density adjusted for links (characters per tag,
scaled down where characters and tags are mostly links'), every node's density sum is that of its children, and the
subtree with the largest sum is the article's. The least density on the path from that node up to the body is the
threshold; subtrees beside the path that reach it are taken with it, and so are headings before it. The sums of all nodes
compete, inside and outside of article and main elements, which only decide between equal ones; but where the chosen node
is inside such an element, that is taken whole instead. Parts that are no article by their element, role or class are
cut off beforehand, article elements of comments and of other articles among them.

Everything is iterative over arrays of nodes, so deep nesting costs no stack.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|</([A-Za-z][^\s/>]*)[^>]*>|<([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*+)>", re.DOTALL)
#: The same without regard to quotes, for what follows a tag whose quote is never closed.
_PLAIN_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|</([A-Za-z][^\s/>]*)[^>]*>|<([A-Za-z][^\s/>]*)([^>]*)>", re.DOTALL)
_OPENING = re.compile(r"<(?=[!?/A-Za-z])")
_ATTRIBUTE = re.compile(r"([A-Za-z_:][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

# Elements as HTML has them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body html td th tr tbody thead tfoot legend summary".split()) | {"p"}
SCOPE = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",), "p": ("div", "article", "section", "td", "th", "li", "blockquote", "body", "main", "aside", "button", "table")}
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

#: Elements, roles and words of class or id that no article's text stands in.
NOT_ARTICLE = frozenset("head nav footer aside form script style noscript template iframe object button select textarea svg dialog title menu canvas audio video map datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
CLASSES = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar nav navbar navigation menu breadcrumb breadcrumbs footer cookie cookies consent notice alert popup modal overlay comment comments disqus reply replies share sharing social related recommended newsletter subscribe signup login widget pagination pager toolbar masthead".split()
)
#: Those of them that name others' texts; what they are on is cut even where it holds the most text or is an article.
OTHERS = frozenset("ad ads adsbygoogle advert adverts advertisement advertising sponsor sponsored promo promotion comment comments disqus reply replies related recommended newsletter".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())


class Tree:
    """Nodes in document order: tag, parent, cut (0, 1, or 2 where nothing lifts it), and items (text or child) in order."""

    def __init__(self):
        self.tag, self.parent, self.cut, self.items = ["#root"], [-1], [0], [[]]

    def add(self, tag: str, parent: int, cut: int) -> int:
        i = len(self.tag)
        self.tag.append(tag)
        self.parent.append(parent)
        self.cut.append(cut)
        self.items.append([])
        self.items[parent].append(i)
        return i


def _cut(tag: str, attributes: str) -> int:
    if tag in NOT_ARTICLE:
        return 2
    if not attributes or tag in ("html", "body", "main"):
        return 0
    found = 0
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "role" and value.strip().lower() in ROLES or name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
            found = max(found, 1)
        if name in ("class", "id"):
            if tag == "article":  # a class may name the article's subjects, so only its first word counts
                if any((w := _PART.search(x)) and w[0].lower() in OTHERS for x in value.split()):
                    return 2
                continue
            words = {w.lower() for w in _PART.findall(value)}
            if words & OTHERS:
                return 2
            found = max(found, int(not words.isdisjoint(CLASSES)))
    return found


def parse(source: str) -> Tree:
    """The tree of a page. Every character is looked at a bounded number of times: where a tag's quote is never closed,
    quotes are disregarded from there on, and what is behind the last ">" is text."""
    tree, stack, at = Tree(), [0], 0
    tags, opened, tag = tree.tag, Counter(), _TAG

    def text(value: str, literal: bool = False):
        if value:  # references are decoded where they stand; one doesn't reach over a tag
            tree.items[stack[-1]].append(value if literal else html_lib.unescape(value))

    def close(k: int):
        for i in stack[k:]:
            opened[tags[i]] -= 1
        del stack[k:]

    last = source.rfind(">")
    begin = 0
    while True:
        start = _OPENING.search(source, at)
        unclosed = start is None or start.start() > last and not source.startswith(("<!--", "<![CDATA["), start.start())
        if unclosed:
            text(source[begin:])
            return tree
        m = tag.match(source, start.start())
        if m is None and tag is _TAG:
            tag = _PLAIN_TAG
            m = tag.match(source, start.start())
        if m is None:
            at = start.end()
            continue
        text(source[begin : m.start()])
        begin = at = m.end()
        if m[1]:
            name = m[1].lower()
            for k in range(len(stack) - 1, 0, -1) if opened[name] else ():
                if tags[stack[k]] == name:
                    close(k)
                    break
                if name not in BLOCK and tags[stack[k]] in BLOCK:
                    break  # an inline end doesn't close blocks
        elif m[2]:
            name, attributes = m[2].lower(), m[3]
            closes = SAME.get(name, ()) + (("p",) if name in CLOSES_P else ())
            if any(opened[x] for x in closes):
                stop = SCOPE.get(name, ()) if name in SAME else SCOPE["p"]
                for k in range(len(stack) - 1, 0, -1):
                    if tags[stack[k]] in closes:
                        close(k)
                        break
                    if tags[stack[k]] in stop:
                        break
            node = tree.add(name, stack[-1], _cut(name, attributes))
            if name in RAW:
                end = re.compile(f"</{name}(?=[\\s/>])[^>]*>", re.IGNORECASE).search(source, at)
                begin = at = end.end() if end else len(source)
            elif name not in VOID and not (attributes.endswith("/") and name not in BLOCK and name not in ("a", "b", "i", "span", "em", "strong")):
                stack.append(node)
                opened[name] += 1
        elif source.startswith("<![CDATA[", m.start()):
            text(m[0][9:].removesuffix("]]>"), literal=True)


def _keep_around_article(tree: Tree) -> None:
    """A class name that tells of the layout doesn't cut what holds an article and most of the page's text; headers are
    cut outside of articles only."""
    n = len(tree.tag)
    inside, gone, held, chars = [False] * n, [False] * n, [False] * n, [0] * n
    for i in range(1, n):
        p = tree.parent[i]
        inside[i] = inside[p] or tree.tag[i] in ("article", "main")
        if tree.tag[i] == "header" and not inside[i]:
            tree.cut[i] = 2
        gone[i] = gone[p] or tree.cut[i] == 2
    for i in range(n - 1, -1, -1):
        if gone[i]:
            continue
        chars[i] += sum(len("".join(t.split())) for t in tree.items[i] if isinstance(t, str))
        held[i] = held[i] or tree.tag[i] in ("article", "main")
        if i:
            chars[tree.parent[i]] += chars[i]
            held[tree.parent[i]] = held[tree.parent[i]] or held[i]
    for i in range(1, n):
        if tree.cut[i] == 1 and held[i] and 2 * chars[i] > chars[0]:
            tree.cut[i] = 0


def main_subtree(tree: Tree) -> list[int]:
    """The roots of the subtrees to take, in document order."""
    n = len(tree.tag)
    gone = tree.cut[:]
    for i in range(1, n):
        gone[i] = gone[i] or gone[tree.parent[i]]
    chars, tags, link_chars, link_tags = [0] * n, [1] * n, [0] * n, [0] * n
    linked = [False] * n
    for i in range(1, n):
        linked[i] = linked[tree.parent[i]] or tree.tag[i] == "a"
    for i in range(n - 1, -1, -1):
        if gone[i]:
            continue
        own = sum(len("".join(t.split())) for t in tree.items[i] if isinstance(t, str))
        chars[i] += own
        if linked[i]:
            link_chars[i] += own
            link_tags[i] += tree.tag[i] == "a"
        p = tree.parent[i]
        if p >= 0:
            chars[p] += chars[i]
            tags[p] += tags[i]
            link_chars[p] += link_chars[i]
            link_tags[p] += link_tags[i]
    body = next((i for i in range(n) if tree.tag[i] == "body"), 0)
    whole = link_chars[body] / max(chars[body], 1)
    density = [0.0] * n
    for i in range(n):
        if chars[i]:
            base = math.log(chars[i] / max(chars[i] - link_chars[i], 1) * link_chars[i] + whole * chars[i] + math.e)
            scale = math.log(max(chars[i] / max(link_chars[i], 1) * tags[i] / max(link_tags[i], 1), 1.0)) / math.log(max(base, 1.0001)) if base > 1 else math.log(max(chars[i] * tags[i], 1.0)) + 1
            density[i] = chars[i] / tags[i] * scale
    sums = [0.0] * n
    for i in range(1, n):
        if not gone[i]:
            sums[tree.parent[i]] += density[i]
    candidates = [i for i in range(n) if not gone[i] and chars[i]]
    if not candidates:
        return []
    marked = [False] * n
    for i in range(1, n):
        marked[i] = marked[tree.parent[i]] or tree.tag[i] in ("article", "main")
    best = max(candidates, key=lambda i: (sums[i], density[i] if not sums[i] else 0.0, marked[i], -i))
    path, p = [best], tree.parent[best]
    while p >= 0:
        path.append(p)
        p = tree.parent[p]
    upto = path[: path.index(body) + 1] if body in path else path
    threshold = min(density[i] for i in upto)
    # short paragraphs and headings of the chosen text's own article are below any threshold
    around = [i for i in path if tree.tag[i] == "article"] or [i for i in path if tree.tag[i] == "main"]
    if around:
        return [around[-1]]
    # subtrees beside the path that are as dense as its least dense node, and headings before it
    on_path, taken = set(upto), {best}
    for p in upto[1:]:
        for child in tree.items[p]:
            if isinstance(child, int) and child not in on_path and not gone[child] and chars[child] and link_chars[child] * 2 < chars[child]:
                if density[child] >= threshold or tree.tag[child] in HEADINGS and child < best:
                    taken.add(child)
    return sorted(taken)


def blocks(tree: Tree, roots: list[int]) -> list[str]:
    """The texts of the blocks below the roots, white space as one space."""
    out: list[str] = []
    held: list[str] = []

    def close():
        value = " ".join("".join(held).split())
        held.clear()
        if value:
            out.append(value)

    for root in roots:
        close()
        stack: list[tuple[int, int]] = [(root, 0)]
        while stack:
            node, k = stack.pop()
            if k == 0 and tree.tag[node] in BLOCK:
                close()
            items = tree.items[node]
            while k < len(items):
                x = items[k]
                k += 1
                if isinstance(x, str):
                    held.append(x)
                elif tree.tag[x] == "br":
                    held.append(" ")
                elif not tree.cut[x]:
                    stack.append((node, k))
                    stack.append((x, 0))
                    break
            else:
                if tree.tag[node] in BLOCK:
                    close()
    close()
    return out


def extract(source: str | None) -> str:
    """The article's text, a line for each block; empty for null, empty and textless pages."""
    if not source:
        return ""
    tree = parse(source)
    _keep_around_article(tree)
    roots = main_subtree(tree)
    return "\n".join(blocks(tree, roots))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of pages.

    Null html has an empty text. Pages are read one by one and whole, so repeated rows each get a row; other columns
    are ignored; an empty table gives an empty result.
    """
    kind = pages.schema["page_id"].dataType

    def run(batches):
        for b in batches:
            texts = [extract(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, f"page_id {kind.simpleString()}, url string, text string, n_chars long")
