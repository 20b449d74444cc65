"""Main text of pages by ratios of tag paths.

A page is cut into blocks of text; each has the path of block-level tags (with
classes) from the root to it. Per path the length of text and the number of
punctuation marks are summed, and divided by the number of blocks: the path's
text ratio and punctuation ratio. Both are smoothed over neighbouring paths in page
order and fused into one score. Paths whose score reaches a threshold, taken
from the mean and spread of the scores by text, are content. A block is kept
if its path is content, or if it stands beside content: in the innermost
element that holds all of it, or an article or main element that holds most,
or in one element with content.

What is furniture by its tag, role or class (navigation, page headers and
footers, asides, notices, adverts, forms, comments, scripts, styles) is cut
out before the ratios are taken, unless it holds the page's only article, main
element or first heading, or most of the text of a page without these. A class or id
says so only if all its words do, or are words for a box: ``cookie-banner`` does,
``social-impact`` doesn't; headings, inline elements and code have no say. Linked
text doesn't count for a path's ratio; blocks that are mostly links are dropped
outside the element that holds the content.

Elements and paths are trees in arrays, so a page takes time in proportion to its
size, however deep it is nested.

Defined results: null and empty pages, and pages without text, give an empty
text. Broken markup is read leniently: unclosed paragraphs and list items end
where a new one starts, stray end tags are ignored. Repeated rows come out each
for itself; an empty table gives no rows. Columns other than those named aren't read.
"""

from __future__ import annotations

import html
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from freshet.llm.common import map_rows

# HTML's own element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg object canvas xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr li main menu nav ol p pre section table ul".split()
)
ALONE = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
# Elements, roles and class words of what surrounds an article.
FURNITURE = frozenset("nav header footer aside form button select dialog menu head noscript template fieldset".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr header masthead menu menus modal nav navbar navigation newsletter notice notices pagination popup "
    "promo promotion promoted related recommended share sharing sidebar sidebars social sponsor sponsored sponsors subscribe "
    "subscription toolbar widget widgets respond reply replies".split()
)

# Words that go with those in the name of a box, and elements whose names say nothing about a box.
BOX_WORDS = frozenset(
    "site page top bottom left right primary secondary main global inner outer list item items box block container wrapper wrap "
    "section area bar panel slot unit group row col column links link buttons button icons posts articles form signup count "
    "media message overlay dialog sticky fixed js id".split()
)
UNNAMED = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote figure figcaption table tr td th tbody thead caption hr".split())
MARKS = ("article", "main", "h1")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PUNCTUATION = re.compile(r"[.,;:!?。、！？…]")
_WORDS = re.compile(r"[a-z]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in RAW}


def _attributes(text: str) -> dict[str, str]:
    """Names and values in order; of a name that repeats the first counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def _is_hidden(attributes: dict[str, str]) -> bool:
    return "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower()


def _names_furniture(token: str) -> bool:
    words = {*_WORDS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", token).lower())}
    return bool(words & FURNITURE_WORDS) and words <= FURNITURE_WORDS | BOX_WORDS


def _is_furniture(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    if name in FURNITURE:
        # A header in an article holds its title.
        return not (name == "header" and in_article)
    if _is_hidden(attributes) or attributes.get("role", "").lower() in FURNITURE_ROLES:
        return True
    if name in UNNAMED or name in ("body", "html", "article", "main"):
        return False
    return any(map(_names_furniture, f"{attributes.get('class', '')} {attributes.get('id', '')}".split()))


class Tree:
    """Nodes with their parents, which come before them; node 0 is the root."""

    def __init__(self):
        self.parent = [0]
        self.name = [""]

    def add(self, parent: int, name: str) -> int:
        self.parent.append(parent)
        self.name.append(name)
        return len(self.parent) - 1

    def sums(self, own: list) -> list:
        """Of each node and all below it."""
        out = list(own)
        for node in range(len(out) - 1, 0, -1):
            out[self.parent[node]] += out[node]
        return out


class Block:
    __slots__ = ("element", "linked", "path", "text")

    def __init__(self, element: int, path: int, text: str, linked: int):
        self.element, self.path, self.text, self.linked = element, path, text, linked


class Page:
    """Elements, paths (those of the tags and classes, shared by elements alike), and blocks of text in page order."""

    def __init__(self):
        self.elements, self.paths = Tree(), Tree()
        self.path_of = [0]
        self.furniture = [False]
        self.hidden = [False]
        self.blocks: list[Block] = []
        self._known: dict[tuple[int, str], int] = {}

    def open(self, parent: int, name: str, label: str, furniture: bool, hidden: bool) -> int:
        above = self.path_of[parent]
        path = self._known.get((above, label))
        if path is None:
            path = self._known[above, label] = self.paths.add(above, name)
        self.path_of.append(path)
        self.furniture.append(furniture)
        self.hidden.append(hidden)
        return self.elements.add(parent, name)


def blocks(page: Page) -> list[Block]:
    """Blocks outside furniture, in page order.

    Furniture is opened from outside in: an element that holds the article is
    spared, and what is furniture in it is judged in its turn.
    """
    tree, count = page.elements, len(page.elements.parent)
    own = [0] * count
    for b in page.blocks:
        own[b.element] += len(b.text)
    size = tree.sums(own)
    inside = [[0] * count for _ in MARKS]
    for node, name in enumerate(tree.name):
        if name in MARKS:
            inside[MARKS.index(name)][node] = 1
    inside = [tree.sums(x) for x in inside]
    below: list[list[int]] = [[] for _ in range(count)]
    for node in range(1, count):
        below[tree.parent[node]].append(node)

    shown = [False] * count
    marks: set[str] = set()
    frontier: list[int] = []

    def enter(root: int) -> None:
        """Show a node and all below it but for furniture, which goes to the frontier."""
        stack = [root]
        while stack:
            node = stack.pop()
            shown[node] = True
            if tree.name[node] in MARKS:
                marks.add(tree.name[node])
            for child in below[node]:
                if not page.furniture[child]:
                    stack.append(child)
                elif not page.hidden[child]:
                    frontier.append(child)

    def is_spared(node: int, seen: set[str]) -> bool:
        article, main, heading = (x[node] > 0 for x in inside)
        name = tree.name[node]
        if (article or main) and not seen & {"article", "main"}:
            return True
        if heading and "h1" not in seen and name not in ("nav", "footer", "aside"):
            return True
        return not seen and size[node] > 0.5 * size[0] and name not in FURNITURE - {"form", "fieldset"}

    enter(0)
    while frontier:
        waiting, seen = frontier[:], set(marks)
        frontier.clear()
        for node in waiting:
            if is_spared(node, seen):
                enter(node)
    return [b for b in page.blocks if shown[b.element]]


def parse(text: str) -> Page:
    page = Page()
    open_tags: list[int] = [0]
    places: dict[str, list[int]] = {}  # depths at which elements of a name are open
    links = 0
    pieces: list[str] = []
    linked = 0
    unclosed: set[str] = set()  # inline elements without an end from here on

    def last(name: str) -> int:
        """Depth of the innermost open element of that name, or 0."""
        found = places.get(name)
        return found[-1] if found else 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            shown = " ".join(html.unescape("".join(pieces)).split())
            if shown:
                element = open_tags[-1]
                page.blocks.append(Block(element, page.path_of[element], shown, linked))
            pieces.clear()
        linked = 0

    def close_to(depth: int) -> None:
        flush()
        while len(open_tags) > depth:
            places[page.elements.name[open_tags.pop()]].pop()

    def say(said: str) -> None:
        nonlocal linked
        if said:
            pieces.append(said)
            if links:
                linked += len(said.strip())

    at, size = 0, len(text)
    while at < size:
        m = _TOKEN.search(text, at)
        if m is None:
            say(text[at:])
            break
        say(text[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            if m[0].startswith("<![CDATA["):
                say(m[0][9:-3])
            continue
        name = name.lower()
        if m[1]:
            if name in INLINE:
                if name == "a":
                    links = 0
            elif depth := last(name):
                close_to(depth)
            continue
        if name in RAW:
            end = _RAW_END[name].search(text, at)
            at = end.end() if end else size
            continue
        if name in INLINE:
            if name == "br":
                say("\n")
            elif name == "a":
                links = 1
            if m[3] and name not in unclosed and name not in VOID and _is_hidden(_attributes(m[3])):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(text, at)
                if end:
                    at, links = end.end(), 0
                else:
                    unclosed.add(name)
            continue
        links = 0
        if name in CLOSES_P and last("p"):
            close_to(last("p"))
        if name in ALONE and (depth := last(name)) and not any(last(x) > depth for x in ALONE[name]):
            close_to(depth)
        flush()
        if name in VOID:
            continue
        if not m[3].rstrip().endswith("/") or name in CLOSES_P:
            attributes = _attributes(m[3]) if m[3] else {}
            furniture = _is_furniture(name, attributes, bool(last("article") or last("main")))
            kind = attributes.get("class", "").split()
            element = page.open(open_tags[-1], name, f"{name}.{kind[0]}" if kind else name, furniture, _is_hidden(attributes))
            places.setdefault(name, []).append(len(open_tags))
            open_tags.append(element)
    flush()
    return page


def _smooth(values: list[float]) -> list[float]:
    """Each with its neighbours, weighed 1, 2, 1."""
    padded = [values[0], *values, values[-1]]
    return [(a + 2 * b + c) / 4 for a, b, c in zip(padded, padded[1:], padded[2:], strict=False)]


def content(page: Page) -> list[Block]:
    """The content blocks of a page."""
    found, tree = blocks(page), page.paths
    sums: dict[int, list[float]] = {}
    for b in found:
        entry = sums.setdefault(b.path, [0, 0, 0])
        plain = max(0, len(b.text) - b.linked)
        entry[0] += plain
        entry[1] += len(_PUNCTUATION.findall(b.text)) * plain / len(b.text)
        entry[2] += 1
    weight = sum(s[0] for s in sums.values())
    if not weight:
        return []
    paths = list(sums)
    lengths = _smooth([math.log1p(sums[p][0] / sums[p][2]) for p in paths])
    marks = _smooth([math.log1p(sums[p][1] / sums[p][2]) for p in paths])
    fused = {p: n * (1 + m) for p, n, m in zip(paths, lengths, marks, strict=True)}
    mean = sum(fused[p] * sums[p][0] for p in paths) / weight
    spread = math.sqrt(sum((fused[p] - mean) ** 2 * sums[p][0] for p in paths) / weight)
    chosen = [p for p in paths if sums[p][0] and fused[p] >= mean - spread]
    around = _container(tree, chosen, sums)
    inside = [False] * len(tree.parent)
    if _is_inner(tree, around):
        for node in range(around, len(inside)):
            inside[node] = node == around or inside[tree.parent[node]]
    else:
        around = 0
    of_content = set(chosen)
    beside = {parent for p in chosen if _is_inner(tree, parent := tree.parent[p])}

    def stays(b: Block) -> bool:
        if inside[b.path]:
            return True
        return b.linked <= 0.5 * len(b.text) and (b.path in of_content or tree.parent[b.path] in beside or not around)

    return [b for b in found if stays(b)]


def _is_inner(tree: Tree, path: int) -> bool:
    return path > 0 and tree.name[path] not in ("html", "body")


def _container(tree: Tree, chosen: list[int], sums: dict[int, list[float]]) -> int:
    """The article or main element with most of the chosen text; else the innermost element with all of it, or with most and a first heading."""
    count = len(tree.parent)
    own, many, headings = [0.0] * count, [0] * count, [0] * count
    for p in chosen:
        own[p], many[p] = sums[p][0], 1
    for p in sums:
        headings[p] = int(tree.name[p] == "h1")
    size, many, headings = tree.sums(own), tree.sums(many), tree.sums(headings)
    # The child that has the most text below it; the first of equals.
    largest = [0] * count
    for node in range(count - 1, 0, -1):
        strictly = size[node] - own[node]
        best = largest[tree.parent[node]]
        if strictly > 0 and (not best or strictly >= size[best] - own[best]):
            largest[tree.parent[node]] = node
    around = 0
    while (inner := largest[around]) and size[inner] - own[inner] >= 0.6 * size[0]:
        around = inner
        if tree.name[around] in ("article", "main"):
            return around
    common = around
    while many[common] < len(chosen):
        common = tree.parent[common]
    if _is_inner(tree, common):
        around = common
    outer = around
    while _is_inner(tree, outer):
        if headings[outer]:
            return outer
        outer = tree.parent[outer]
    return around


def main_text(page: str | None) -> str:
    return "\n\n".join(b.text for b in content(parse(page))) if page else ""


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep``, text, and n_chars (code points) of every row."""
    schema = StructType([*[pages.schema[c] for c in keep], StructField("text", StringType()), StructField("n_chars", LongType())])

    def start():
        def work(*columns):
            texts = [main_text(p) for p in columns[-1]]
            return dict(zip(keep, columns[:-1], strict=True)) | {"text": texts, "n_chars": [len(t) for t in texts]}

        return work

    return map_rows(pages.select(*[F.col(c) for c in (*keep, html_col)]), schema, start)
