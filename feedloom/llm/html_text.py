"""Main text of web pages by composite text density.

Every node of a page has a density: its characters per tag, lowered by the share of
characters and tags that belong to links. The node whose children's densities have
the largest sum holds the article. The lowest density on its way up to the body is
a threshold: other subtrees count as content only from it upwards, and each of those
gives its own node of largest sum. A title (``h1``) beside the content belongs to it. An ``article`` (else a
``main``) element that the threshold chooses from is taken whole, and so are articles beside the best one
that are not mostly links; an only one takes over the sums of those around it of whose text it holds more than half.
Elements that are never article text leave the tree first: by tag (menus, forms,
scripts), if hidden, or by the words of their class, id or role (adverts, notices, comments). Such words
do not take out an article, or what holds the densest or most of the text with no article beside it.

Defined cases: NULL or empty html, and pages without text, give an empty text; markup that is
not closed, cut or nested wrongly is read as browsers do in the main; nesting may be of any
depth; equal pages get equal texts; an empty table gives an empty table. Chosen
columns pass unchanged.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_WORDS = str.split

VOID = frozenset(_WORDS("area base br col embed hr img input link meta param source track wbr"))
#: Elements whose content is not markup.
RAW = frozenset(_WORDS("script style title textarea noscript iframe xmp noembed noframes template"))
#: Elements that begin and end a block of text.
BLOCK = frozenset(
    _WORDS(
        "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure"
        " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section"
        " summary table tbody td tfoot th thead tr ul"
    )
)
#: Elements that are never article text.
NEVER = frozenset(
    _WORDS(
        "head nav footer aside menu dialog button select option input label fieldset object embed applet canvas svg"
        " audio video map"
    )
) | RAW
#: Words of a class, id or role that mark what is not the article.
MARKS = frozenset(
    _WORDS(
        "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion promotions"
        " nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toolbar sidebar sidebars aside widget"
        " widgets footer foot copyright masthead topbar cookie cookies consent gdpr notice notices notification alert"
        " banner popup modal overlay newsletter subscribe signup login share sharing social related recommended"
        " recommendations comment comments commentlist replies reply respond disqus discussion complementary contentinfo"
        " search skip hidden teaser teasers tagcloud"
    )
)
#: A start or end tag; quotes count only after an equals sign, as in a browser.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+)>""")
_ATTRIBUTE = re.compile(
    r"""(?:^|[\s"'/])(class|id|role|hidden|style|aria-hidden)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?(?=[\s/"']|$)""", re.I
)
_PART = re.compile(r"[a-z]+")
_BESIDE = re.compile(r"(?:^|[-_])(?:has|no|with|without)[-_]")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: What a start tag closes, and where the search for it stops.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
}
_P_STOPS = frozenset(_WORDS("table td th caption button object marquee html"))
_SCOPE = frozenset(_WORDS("table td th html"))


class Node:
    """An element: its parts are strings and elements, in page order."""

    __slots__ = ("tag", "up", "parts", "gone", "marked", "chars", "tags", "link_chars", "link_tags", "density", "total", "last")

    def __init__(self, tag: str, up: Node | None, gone: bool, marked: bool = False):
        self.tag, self.up, self.gone, self.marked = tag, up, gone, marked
        self.parts: list = []


def _unwanted(tag: str, inside: bool) -> bool:
    """Whether an element is not article text by its tag. ``inside``: of an article or a main element."""
    return tag in NEVER or (tag == "header" and not inside)


def _hidden(attributes: str) -> bool:
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).replace(" ", "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value):
            return True
    return False


def _marked(attributes: str, inside: bool) -> bool:
    """Whether a word of the class, id or role says that an element is not article text."""
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id", "role"):
            # What an element has, or has not, beside itself says nothing about it.
            names = [_BESIDE.split(n)[0] for n in value.split()]
            words = set(_PART.findall(_CAMEL.sub(" ", " ".join(names)).lower()))
            if words & MARKS or ("header" in words and not inside and not words & {"article", "post", "entry", "story"}):
                return True
    return False


def parse(html: str, marks: bool = True) -> list[Node]:
    """The elements of a page in page order; the first one is the root. ``marks``: whether
    the words of a class, id or role count."""
    root = Node("html", None, False)
    nodes, stack, at, end = [root], [root], 0, len(html)
    open_now: Counter[str] = Counter()  # so that no search goes through a deep stack in vain

    def pop_to(depth: int) -> None:
        open_now.subtract(node.tag for node in stack[depth:])
        del stack[depth:]

    def close(names, stops) -> None:
        if not any(open_now[name] for name in names):
            return None
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in names:
                pop_to(depth)
                return close(names, stops) if len(names) > 1 else None
            if stack[depth].tag in stops:
                return None

    while at < end:
        mark = html.find("<", at)
        if mark < 0:
            stack[-1].parts.append(html[at:])
            break
        if mark > at:
            stack[-1].parts.append(html[at:mark])
        if html.startswith("<!--", mark):
            stop = html.find("-->", mark + 2)
            at = end if stop < 0 else stop + 3
            continue
        if html.startswith(("<!", "<?"), mark):
            stop = html.find(">", mark)
            at = end if stop < 0 else stop + 1
            continue
        tag = _TAG.match(html, mark)
        if tag is None:
            if re.match(r"</?[a-zA-Z]", html[mark : mark + 3]):
                break  # a tag that never ends
            stack[-1].parts.append("<")
            at = mark + 1
            continue
        at = tag.end()
        name = tag[2].lower()
        if tag[1]:
            if open_now[name]:
                stops = _SCOPE - {name}
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == name:
                        pop_to(depth)
                        break
                    if stack[depth].tag in stops or (name not in BLOCK and stack[depth].tag in BLOCK):
                        break
            continue
        if name in ("html", "body"):
            if name == "body":
                close({"head"}, ())
            if name == "html" or open_now["body"]:
                continue
        if name in BLOCK:
            close({"p"}, _P_STOPS)
        if name in _CLOSES:
            close(*_CLOSES[name])
        up = stack[-1]
        inside = open_now["article"] + open_now["main"] > 0
        gone, marked = up.gone or _unwanted(name, inside), False
        if marks and tag[3] and not gone and name not in ("html", "body", "main"):
            gone = _hidden(tag[3])
            # An article is one whatever it is called, unless it lies in another one, as comments do.
            marked = not gone and (name != "article" or open_now["article"] > 0) and _marked(tag[3], inside)
        # A form is none of the article, unless the page lies in one; its fields never are.
        marked = marked or (marks and name == "form" and not gone)
        node = Node(name, up, gone, marked)
        up.parts.append(node)
        nodes.append(node)
        if name in RAW:
            stop = re.compile(f"</{name}(?=[\\s/>])", re.I).search(html, at)
            if stop is None:
                break
            closing = html.find(">", stop.end())
            at = end if closing < 0 else closing + 1
        elif name not in VOID:
            stack.append(node)
            open_now[name] += 1
    return nodes


def _composite(chars: int, tags: int, link_chars: int, link_tags: int, body_share: float) -> float:
    """Characters per tag, adjusted by links."""
    if not chars:
        return 0.0
    tags, other = max(tags, 1), max(chars - link_chars, 1)
    links, link_tags = max(link_chars, 1), max(link_tags, 1)
    base = math.log(chars / other * links + body_share * chars + math.e)
    return chars / tags * math.log(max(chars / links * tags / link_tags, 1.0)) / math.log(base)


def _measure(nodes: list[Node]) -> None:
    """Counts, density and sum of child densities of each node that stays."""
    own = {}
    for node in nodes:
        texts = [p for p in node.parts if p.__class__ is str]
        own[node] = sum(len("".join(t.split())) for t in texts) if texts else 0
        node.chars, node.tags = own[node], 0
        node.link_chars = node.link_tags = 0
    for at in range(len(nodes) - 1, 0, -1):
        node, up = nodes[at], nodes[at].up
        if node.gone:
            continue
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
        up.chars += node.chars
        up.tags += node.tags + 1
        up.link_chars += node.link_chars
        up.link_tags += node.link_tags
    root = nodes[0]
    share = root.link_chars / max(root.chars, 1)
    for node in nodes:
        node.density = _composite(node.chars, node.tags, node.link_chars, node.link_tags, share)
        node.total = _composite(own[node], 1, 0, 0, share)
    for node in nodes[1:]:
        if not node.gone:
            node.up.total += node.density


def _outermost(nodes: list[Node], tag: str) -> dict[Node, Node]:
    """The outermost element of a tag that each node lies in, or is."""
    home: dict[Node, Node] = {}
    for node in nodes:
        if node.up in home:
            home[node] = home[node.up]
        elif node.tag == tag:
            home[node] = node
    return home


def _drop_marked(nodes: list[Node]) -> None:
    """Takes out what is marked, unless it holds the node of largest sum, or most text that is no link, of the
    unmarked page. That does not count if an article or main element beside it has text."""
    if not any(node.marked for node in nodes):
        return
    _measure(nodes)
    best = max((n for n in nodes if not n.gone and n.chars), key=lambda n: n.total, default=None)
    way, node = set(), best
    while node is not None:
        way.add(node)
        node = node.up
    under: set[Node] = set()
    sure = []
    for node in nodes:
        if node.marked or node.up in under:
            under.add(node)
        elif node.tag in ("article", "main") and not node.gone and node.chars:
            sure.append(node)
    most = nodes[0].chars - nodes[0].link_chars

    def around(node: Node) -> set[Node]:
        found = set()
        while node is not None:
            found.add(node)
            node = node.up
        return found

    for node in nodes[1:]:
        if node.up.gone:
            node.gone = True
        elif node.marked and not node.gone:
            holds = node in way or (node.chars - node.link_chars) * 2 > most
            node.gone = not holds or (bool(sure) and not around(node).issuperset(sure))


def _pass_on(elements: set[Node]) -> None:
    """An only article or main element takes over the sums of those around it of whose text it holds more than half."""
    if len(elements) != 1:
        return
    (own,) = elements
    node = own.up
    while node is not None:
        if own.chars * 2 > node.chars:
            own.total, node.total = max(own.total, node.total), 0.0
        node = node.up


def content(nodes: list[Node]) -> list[Node]:
    """The subtrees that hold the article, in page order."""
    _drop_marked(nodes)
    _measure(nodes)
    kept = [n for n in nodes if not n.gone and n.chars]
    if not kept:
        return []
    articles, mains = _outermost(kept, "article"), _outermost(kept, "main")
    for inside in (articles, mains):
        _pass_on(set(inside.values()))
    best = max(kept, key=lambda n: n.total)
    home = articles if best in articles else mains
    threshold, node = best.density, best.up
    while node is not None and node.tag not in ("body", "html"):
        threshold = min(threshold, node.density)
        node = node.up
    # The largest sum in each subtree, children before parents.
    top = {n: n for n in kept}
    for node in reversed(kept):
        up = node.up
        if up in top and top[node].total > top[up].total:
            top[up] = top[node]
    chosen = {best} | {top[n] for n in kept if n.density >= threshold and n.tag not in ("body", "html")}
    # What is chosen inside an article, else main element, is that element.
    chosen = {home.get(n, n) for n in chosen}
    if best in articles:
        # Articles beside it are its equals, unless they are links.
        own = articles[best]
        chosen |= {n for n in articles.values() if n.up is own.up and n.link_chars * 2 < n.chars}
    # A title beside the content, or beside what the content lies in, belongs to it.
    above, node = set(), best.up
    while node is not None:
        above.add(node)
        node = node.up
    chosen |= {n for n in kept if n.tag == "h1" and n.up in above}
    roots, covered = [], set()
    for node in kept:
        if node.up in covered:
            covered.add(node)
        elif node in chosen:
            roots.append(node)
            covered.add(node)
    return roots


def blocks(root: Node) -> list[str]:
    """Texts of the blocks below a node, white space made one space."""
    found: list[str] = []
    words: list[str] = []

    def flush() -> None:
        text = " ".join(unescape("".join(words)).split())
        if text:
            found.append(text)
        words.clear()

    todo: list = [root]
    while todo:
        part = todo.pop()
        if part.__class__ is str:
            words.append(part)
        elif part is None:
            flush()
        elif not part.gone:
            if part.tag == "br":
                words.append(" ")
            elif part.tag in BLOCK:
                flush()
                todo.append(None)
                todo.extend(reversed(part.parts))
            else:
                todo.extend(reversed(part.parts))
    flush()
    return found


def main_text(html: str | None) -> str:
    """The article of a page, its blocks joined by an empty line."""
    if not html:
        return ""
    for marks in (True, False):  # a page of which the marks leave nothing is read without them
        found = [text for root in content(parse(html, marks)) for text in blocks(root)]
        if found:
            break
    return "\n\n".join(found)


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep``, and ``text, n_chars`` of each whole page. One pass without a shuffle."""
    rows = pages.select(*keep, html)
    fields = [rows.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [main_text(page.as_py()) for page in part.column(len(keep))]
                columns = [*part.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "text", "n_chars"])

    return rows.mapInArrow(run, schema)
