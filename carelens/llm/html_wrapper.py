"""Main text of web pages by wrapper induction: pages of a host are aligned, and what varies between them is content.

The trees of a bounded group of pages of one host are aligned with one of them by simple tree matching.  A node whose text
is the same wherever it aligns is template, a varying one is a slot.  The content region is the deepest node that holds
nearly all text of the slots; pages without others to align with fall back on their own structure.

Inside the region template goes too: a node that aligns in ``LEAST`` pages with different articles at least, and in half of
the group, and has the same text in all of them.  Where such nodes hold more than ``MOST_TEMPLATE`` of the region's text,
the pages are versions of one article, which say nothing about the template, and all of it stays.  What markup names as no
part of an article (menus, adverts, forms, comments ...) goes as well.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages aligned with one another.
GROUP = 24
#: Pages with different articles that a node must align in, to be called template by its text.
LEAST = 3
#: The largest share of a region's text that is taken for template.
MOST_TEMPLATE = 0.4
#: The broadcast table of hosts with more than a group of pages has this many rows at most; else it is joined by shuffle.
BROADCAST_HOSTS = 500_000
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S
)
_NAMED = re.compile(r"""(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img",
}
#: Elements that are no part of an article, wherever they stand.
_APART = {
    "nav", "footer", "aside", "form", "head", "button", "select", "option", "input", "menu", "dialog", "svg", "canvas", "object", "embed", "audio",
    "video", "map", *_RAW,
}
#: Words in class, id or role that name such parts, wherever they occur in a name.
_APART_NAMES = re.compile(
    r"(?:^|[^a-z])(?:ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|sidebar|side-bar|nav|navbar|navigation|menu\w*|breadcrumbs?|footer|masthead|site-header|page-header"
    r"|cookies?|consent|popup|modal|newsletter|subscribe|signup|comments?|pagination|pager|complementary|contentinfo)(?:$|[^a-z])"
)
#: Words that name such parts only if the rest of the name says no more than what kind of box it is.
_APART_WORDS = set("ad aside notice login search share sharing social related recommended respond replies".split())
_BOX_WORDS = set(
    "area articles bar block box button buttons container content element form group icons inner item items left links list module panel posts right row section"
    " site slot strip text this top bottom unit us widget wrap wrapper x".split()
)


def _named_apart(names: str) -> bool:
    """Whether class, id or role name a part that is none of the article: ``related-posts`` does, ``related-work`` does not."""
    if _APART_NAMES.search(names):
        return True
    for name in names.split():
        found = [w for w in re.split(r"[^a-z]+", name) if w]
        if found and any(w in _APART_WORDS for w in found) and all(w in _APART_WORDS or w in _BOX_WORDS for w in found):
            return True
    return False


#: A closing tag is implied: an open p or li ends before these.
_CLOSES = {
    "p": {"p", "div", "ul", "ol", "dl", "table", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "blockquote", "pre", "form", "hr", "footer", "header", "nav", "aside", "main", "figure", "address", "fieldset", "details"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"},
}


class Node:
    __slots__ = ("kids", "label", "size", "tag", "text", "up")

    def __init__(self, tag: str, names: str, up: Node | None) -> None:
        self.tag, self.up = tag, up
        self.label = f"{tag}.{re.sub(r'[0-9]+', '', names)}" if names else tag
        self.kids: list[Node | str] = []  # nodes, and text between them
        self.text: str | None = None
        self.size = 1


def parse(page: str) -> Node:
    """The tree of block elements; inline elements leave their text.  Malformed markup never fails."""
    root = at = Node("html", "", None)
    upto, n = 0, len(page)
    while upto < n:
        token = _TOKEN.match(page, upto)
        upto = token.end()
        tag = token[2]
        if tag is None:
            text = token[0]
            if text == "<" and re.match("[a-zA-Z/]", page[upto : upto + 1]):  # a tag that never ends rightly
                close = page.find(">", upto)
                upto = n if close < 0 else close + 1
            elif text[0] != "<" or text == "<":
                at.kids.append(html.unescape(text))
            continue
        tag = tag.lower()
        if token[1]:
            if tag in _INLINE or tag == "br":
                continue
            node = at
            while node is not None and node.tag != tag:
                node = node.up
            if node is not None and node.up is not None:
                at = node.up
            continue
        if tag in _INLINE:
            names = _names(token[3])
            if not names or not _named_apart(names):
                continue
        if tag == "br":
            at.kids.append("\n")
            continue
        if tag in ("html", "body") and at is root:
            continue
        while at.tag in _CLOSES and tag in _CLOSES[at.tag] and at.up is not None:
            at = at.up
        node = Node(tag, _names(token[3]), at)
        at.kids.append(node)
        if tag in _RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, upto)
            upto = close.end() if close else n
        elif tag in _INLINE:  # named as a part of its own: it ends with its own tag
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, upto)
            upto = close.end() if close else upto
        elif tag not in _VOID and not token[3].rstrip().endswith("/"):
            at = node
    return root


def _names(attributes: str) -> str:
    return " ".join(m[2].strip("\"'").lower() for m in _NAMED.finditer(attributes)) if attributes else ""


def apart(node: Node, inside: bool) -> bool:
    """Whether the node is no part of an article.  A header inside the content region belongs to it."""
    if node.tag in _APART or (node.tag == "header" and not inside):
        return True
    names = node.label[len(node.tag) + 1 :]
    return bool(names) and node.tag not in ("html", "body", "article", "main") and _named_apart(names)


def _own(node: Node) -> str:
    return " ".join("".join(k if isinstance(k, str) else "\0" for k in node.kids).replace("\0", " ").split())


def blocks(node: Node, inside: bool, template: set[int] = frozenset()) -> Iterator[str]:
    """The text blocks of a region in page order, each with single spaces; own text of ``template`` nodes (by id) is left out."""
    within = [node]
    stack: list = [iter(node.kids)]
    piece: list[str] = []

    def done() -> Iterator[str]:
        text = " ".join("".join(piece).split())
        piece.clear()
        if text:
            yield text

    while stack:
        kid = next(stack[-1], None)
        if kid is None:
            stack.pop()
            within.pop()
            yield from done()
        elif isinstance(kid, str):
            if id(within[-1]) not in template:
                piece.append(kid)
        else:
            yield from done()
            if not apart(kid, inside):
                stack.append(iter(kid.kids))
                within.append(kid)
    yield from done()


def _elements(node: Node) -> list[Node]:
    return [k for k in node.kids if isinstance(k, Node) and not apart(k, False)]


def _rows(gains: np.ndarray, x: np.ndarray, y: np.ndarray, above: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of the alignment table of two child lists, from the one ``above`` them on."""
    for i in x:
        row = above.copy()
        np.maximum(above[1:], above[:-1] + gains[i][y], out=row[1:])
        above = np.maximum.accumulate(row)
        yield above


def _aligned(gains: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """Places in two child lists that pair, the last first.  Every so many rows of the table are held, those between are
    made again, so memory grows with the lists and not with their product."""
    step = max(1, isqrt(len(x)))
    held = [np.zeros(len(y) + 1, np.int64)]
    for i, row in enumerate(_rows(gains, x, y, held[0]), 1):
        if i % step == 0:
            held.append(row)
    pairs, j = [], len(y)
    for first in range((len(x) - 1) // step * step, -1, -step):
        above = held[first // step]
        table = [above, *_rows(gains, x[first : first + step], y, above)]
        i = len(table) - 1
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((first + i, j))
    return pairs


class Shapes:
    """Shapes of trees (label, and shapes of the elements) by number, and the scores of pairs of them: equal shapes have
    equal numbers, and a pair is scored once however many nodes have it."""

    def __init__(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.all: list[tuple[str, list[int], np.ndarray]] = []  # label, distinct shapes of the elements, places in them
        self.scores: dict[tuple[int, int], int] = {}
        self.of: dict[int, int] = {}
        self.kids: dict[int, list[Node]] = {}

    def add(self, root: Node) -> None:
        if id(root) in self.of:
            return
        order, stack = [], [root]
        while stack:
            node = stack.pop()
            order.append(node)
            self.kids[id(node)] = kids = _elements(node)
            stack += kids
        for node in reversed(order):
            inner = tuple([self.of[id(k)] for k in self.kids[id(node)]])
            number = self.numbers.setdefault((node.label, inner), len(self.numbers))
            if number == len(self.all):
                distinct = {shape: i for i, shape in enumerate(dict.fromkeys(inner))}
                self.all.append((node.label, list(distinct), np.array([distinct[k] for k in inner], np.int64)))
            self.of[id(node)] = number

    def gains(self, s: int, t: int) -> np.ndarray:
        """What pairing an element of one shape with one of another counts."""
        return np.array([[self.scores.get((u, v), 0) for v in self.all[t][1]] for u in self.all[s][1]], np.int64)

    def score(self, s: int, t: int) -> int:
        scores, shapes, stack = self.scores, self.all, [(s, t)]
        while stack:
            pair = stack[-1]
            if pair in scores:
                stack.pop()
                continue
            (_, us, x), (_, vs, y) = shapes[pair[0]], shapes[pair[1]]
            labels: dict[str, list[int]] = {}
            for v in vs:
                labels.setdefault(shapes[v][0], []).append(v)
            asked = [(u, v) for u in us for v in labels.get(shapes[u][0], ()) if (u, v) not in scores]
            if asked:
                stack += asked
                continue
            stack.pop()
            last = np.zeros(len(y) + 1, np.int64)
            if us and vs:
                for last in _rows(self.gains(*pair), x, y, last):
                    pass
            scores[pair] = 1 + int(last[-1])
        return scores[s, t]


def match(a: Node, b: Node, found: list[tuple[Node, Node]], shapes: Shapes | None = None) -> int:
    """Simple tree matching: the most nodes that pair with equal labels, order and ancestry kept; ``found`` gets the pairs.

    Child lists of any length and trees of any depth are matched best.  ``shapes`` keeps what matches have in common; the
    trees must live as long.
    """
    if a.label != b.label:
        return 0
    shapes = shapes or Shapes()
    shapes.add(a)
    shapes.add(b)
    score = shapes.score(shapes.of[id(a)], shapes.of[id(b)])
    places: dict[tuple[int, int], list[tuple[int, int]]] = {}
    stack = [(a, b)]
    while stack:
        p, q = stack.pop()
        found.append((p, q))
        s, t = pair = shapes.of[id(p)], shapes.of[id(q)]
        x, y = shapes.all[s][2], shapes.all[t][2]
        if not len(x) or not len(y):
            continue
        if pair not in places:
            places[pair] = _aligned(shapes.gains(s, t), x, y)
        mine, other = shapes.kids[id(p)], shapes.kids[id(q)]
        stack += [(mine[i], other[j]) for i, j in reversed(places[pair])]
    return score


class Wrapper:
    """What the pages of a group share: the path of labels of the content region (empty: none was found) and, of every
    node of the page that all were aligned with, the nodes that it pairs with."""

    def __init__(self, trees: list[Node]) -> None:
        self.path: list[str] = []
        self.pairs: dict[int, list[tuple[int, Node]]] = {}
        self.n = len(trees)
        if len(trees) >= 2:
            self._align(trees)

    def _align(self, trees: list[Node]) -> None:
        pick = max(trees, key=lambda t: len(_elements(t)) and sum(1 for _ in _walk(t)))
        nodes: dict[int, Node] = {}
        shapes = Shapes()
        for k, tree in enumerate(trees):
            pairs: list[tuple[Node, Node]] = []
            match(pick, tree, pairs, shapes)
            for p, q in pairs:
                nodes[id(p)] = p
                self.pairs.setdefault(id(p), []).append((k, q))
        # Slots: nodes whose own text differs from page to page.
        mass: dict[int, int] = {}
        total = 0
        for key, held in self.pairs.items():
            if len({_own(q) for _, q in held}) > 1:
                chars = len(_own(nodes[key]))
                total += chars
                node: Node | None = nodes[key]
                while node is not None:
                    mass[id(node)] = mass.get(id(node), 0) + chars
                    node = node.up
        at = pick
        while total:
            down = [k for k in _elements(at) if mass.get(id(k), 0) >= 0.9 * total and _elements(k)]
            if not down:
                break
            at = down[0]
            self.path.append(at.label)

    def template(self, articles: list[str]) -> set[int]:
        """Ids of the nodes, of all pages, whose text is template; ``articles`` are the pages' whole region texts."""
        found: set[int] = set()
        for held in self.pairs.values():
            own = {_own(q) for _, q in held}
            if len(own) == 1 and "" not in own and 2 * len(held) >= self.n and len({articles[k] for k, _ in held}) >= LEAST:
                found |= {id(q) for _, q in held}
        return found


def _walk(node: Node) -> Iterator[Node]:
    stack = [node]
    while stack:
        node = stack.pop()
        yield node
        stack += _elements(node)


def region(tree: Node, path: list[str]) -> Node:
    """The page's content region: along the wrapper's path, widened or narrowed to an article if the page names one."""
    at = tree
    for label in path:
        at = next((k for k in _elements(at) if k.label == label), None)
        if at is None:
            at = tree
            break
    up: Node | None = at
    while up is not None:
        if up.tag in ("article", "main"):
            return up
        up = up.up
    named = [n for n in _walk(at) if n.tag in ("article", "main") or n.label.endswith(".main")]
    if named:
        # Several articles on one page: what holds them all.
        return named[0] if len([n for n in named if n.tag == "article"]) <= 1 or named[0].tag == "main" else at
    return at


def extract(pages: list[str]) -> list[str]:
    """The main texts of pages of one host."""
    trees = [parse(p) for p in dict.fromkeys(pages)]
    place = {p: k for k, p in enumerate(dict.fromkeys(pages))}
    aligned = [k for p, k in place.items() if p]
    wrapper = Wrapper([trees[k] for k in aligned])
    regions = [region(t, wrapper.path) for t in trees]
    inside = [r.tag in ("article", "main") for r in regions]
    whole = [" ".join(blocks(r, i)) for r, i in zip(regions, inside, strict=True)]
    template = wrapper.template([whole[k] for k in aligned])
    rest = [" ".join(blocks(r, i, template)) for r, i in zip(regions, inside, strict=True)] if template else whole
    out = [kept if len(kept) >= (1 - MOST_TEMPLATE) * len(text) else text for kept, text in zip(rest, whole, strict=True)]
    return [out[place[p]] for p in pages]


def _extracted(rows: pd.DataFrame) -> pd.DataFrame:
    texts = extract(rows["html"].tolist())
    return pd.DataFrame({"page_id": rows["page_id"].to_numpy(), "url": rows["url"].to_numpy(), "text": texts}).astype({"page_id": "Int64"})


def main_texts(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    A NULL or empty html has an empty text.  Pages without a host (NULL or odd urls) are grouped like those of one host;
    hosts with many pages are dealt over groups of about ``group`` pages by hash, so no task holds a host.  Rows may
    repeat; other columns are ignored; an empty table gives no rows.
    """
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("host", host)
    large = rows.groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") > 2 * group)
    large = large.select("host", F.ceil(F.col("n") / group).alias("parts"))
    if large.count() <= BROADCAST_HOSTS:
        large = F.broadcast(large)
    rows = rows.join(large, "host", "left")
    part = F.coalesce(F.pmod(F.xxhash64("page_id", "url", "html"), F.col("parts")), F.lit(0))
    texts = rows.withColumn("part", part).groupBy("host", "part").applyInPandas(_extracted, "page_id bigint, url string, text string")
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))
