"""HTML main-text extraction by tag-path ratios.

Text length and punctuation are aggregated per root-to-leaf tag path, smoothed over the
page's sequence of text nodes, fused by multiplication and held against their standard
deviation.  The nodes of the paths above it are content; the smallest element that holds them
all, with the title and the text that stand beside it, is the article.

Element names, roles and words of class and id mark suspects: menus, notices, adverts, forms,
comments.  Names only raise the bar: a suspect stays if a path inside stands out from the page
by several standard deviations, or if there is too little content outside of it, so a page, an
article or a form that wraps the text stays whatever it is called.  Comments and cards without
a telling name are known by the tag paths that they repeat.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.bpe import slices, text_sizes

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*+)>")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>")
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp small "
    "span strike strong sub sup time tt u var wbr object math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded "
    "mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics "
    "annotation annotation-xml".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose text is never part of the page's text.
UNSEEN = frozenset("head button select option template svg canvas audio video applet annotation annotation-xml".split()) | RAW
BY_ELEMENT, BY_NAME = 1, 2
SUSPECTS = frozenset("nav footer aside form dialog menu".split())
SUSPECT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Words of class and id attributes that mark what is often not article text.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer comment comments disqus cookie cookies consent gdpr notice notices notification popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social related recommended widget toolbar pagination "
    "pager masthead topbar".split()
)
#: Words that turn a name with a hint into a statement about the page, as in "no-sidebar" or "comments-open".
STATES = frozenset("no not without with has have is count open opened closed on off enabled disabled content container wrapper layout".split())
CONTAINERS = frozenset("html body div section article main center form table tbody tr td".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section table ul".split()
)
SIBLING = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
PUNCTUATION = re.compile(r"[,.;:!?，。；：！？、]")


class Path(dict):
    """One root-to-leaf tag path, by identity."""

    __hash__ = object.__hash__
    __eq__ = object.__eq__


class Node:
    __slots__ = ("tag", "parent", "index", "path", "block", "unseen", "heading_only", "main", "has_title", "suspect")

    def __init__(self, tag: str, parent: Node | None, index: int):
        self.tag, self.parent, self.index = tag, parent, index
        # Elements of one tag path share one `path` object, which also maps a tag to the path below.
        self.path = parent.path.setdefault(tag, Path()) if parent else Path()
        self.block = parent.block if parent and tag in INLINE else self
        self.unseen = parent.unseen if parent else False
        self.heading_only = parent.heading_only if parent else False
        self.main = parent.main if parent else False
        self.has_title = False
        self.suspect = 0


def _hinted(value: str) -> bool:
    """Whether a name of a class or id holds a hint, and no word that makes it a statement about the page."""
    for name in value.split():
        words = {w.lower() for w in WORD.findall(name)}
        if not HINTS.isdisjoint(words) and STATES.isdisjoint(words):
            return True
    return False


def _opened(tag: str, attributes: str, parent: Node, index: int) -> Node:
    node = Node(tag, parent, index)
    if tag in UNSEEN:
        node.unseen = True
    elif tag in SUSPECTS:
        node.suspect = BY_ELEMENT
    elif tag in ("article", "main"):
        node.main = True
    elif tag == "header":
        # Inside the article, a header holds its title and first paragraph.
        node.heading_only, node.suspect = node.main, 0 if node.main else BY_ELEMENT
    elif tag == "h1":
        parent.has_title = True
    if node.heading_only and (tag in HEADINGS or tag == "p"):
        node.heading_only = False
    if attributes.strip() and tag not in ("html", "body"):
        for name, a, b, c in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), a or b or c
            if name == "role" and value.lower() in SUSPECT_ROLES or name == "hidden":
                node.suspect = BY_ELEMENT
            elif name in ("class", "id") and not node.suspect and _hinted(value):
                node.suspect = BY_NAME
    return node


def blocks_of(page: str) -> tuple[list[Node], list[tuple[Node, str, int]]]:
    """The page's elements and its text blocks in order: element, text, characters inside links."""
    root = Node("", None, 0)
    nodes, stack, out, at, n = [root], [root], [], 0, len(page)
    parts: list[str] = []
    linked, owner = 0, root
    depths: dict[str, list[int]] = {}  # places of the open elements on the stack, by tag

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            depths[stack.pop().tag].pop()

    def deepest(tags: str) -> int:
        return max((depths[x][-1] for x in tags.split() if depths.get(x)), default=0)

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((owner, text, linked))
        parts, linked = [], 0

    def say(raw: str) -> None:
        nonlocal linked, owner
        top = stack[-1]
        if raw and not top.unseen and not top.heading_only:
            text = html.unescape(raw)
            if not parts:
                owner = top.block
            parts.append(text)
            linked += len(text) if depths.get("a") else 0

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            say(page[at:])
            break
        if lt > at:
            say(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        nxt = page[lt + 1 : lt + 2]
        if nxt in ("!", "?"):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        found = TAG.match(page, lt) or LOOSE_TAG.match(page, lt)
        if not found:
            if nxt == "/" or nxt.isalpha():
                # A tag cut off by the end of the page, or "</" without a name.
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                say("<")
                at = lt + 1
            continue
        at = found.end()
        closing, tag, attributes = found[1], found[2].lower(), found[3]
        if tag == "br":
            say(" ")
            continue
        if tag not in INLINE:
            flush()
        if closing:
            if depths.get(tag):
                pop_to(depths[tag][-1])
            continue
        if tag in CLOSES_P and depths.get("p"):
            pop_to(depths["p"][-1])
        if tag in SIBLING:
            same, scope = (deepest(x) for x in SIBLING[tag])
            if same > scope:
                pop_to(same)
        if tag in VOID or attributes.endswith("/") and tag not in RAW and tag not in CONTAINERS and tag != "p":
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
            continue
        nodes.append(_opened(tag, attributes, stack[-1], len(nodes)))
        depths.setdefault(tag, []).append(len(stack))
        stack.append(nodes[-1])
    flush()
    return nodes, out


def path_ratios(blocks: list[tuple[Node, str, int]], radius: int = 1) -> np.ndarray:
    """The fused, smoothed ratio of each block's tag path."""
    sums: dict[Path, list[float]] = {}
    for node, text, linked in blocks:
        s = sums.setdefault(node.path, [0.0, 0.0, 0.0])
        s[0] += len(text) - min(linked, len(text))
        s[1] += len(PUNCTUATION.findall(text))
        s[2] += 1
    length = np.array([sums[b[0].path][0] / sums[b[0].path][2] for b in blocks])
    marks = np.array([sums[b[0].path][1] / sums[b[0].path][2] for b in blocks])
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / max(radius, 1)) ** 2)
    kernel /= kernel.sum()

    def smooth(x: np.ndarray) -> np.ndarray:
        return np.convolve(np.pad(x, radius, mode="edge"), kernel, mode="valid")

    return smooth(length) * (smooth(marks) + 1)


def _sums(nodes: list[Node], blocks: list[tuple[Node, str, int]], values) -> list[float]:
    """By element, the sum of the values of the blocks inside; parents come before their children in `nodes`."""
    out = [0.0] * len(nodes)
    for (node, _, _), value in zip(blocks, values, strict=True):
        out[node.index] += value
    for node in reversed(nodes):
        if node.parent:
            out[node.parent.index] += out[node.index]
    return out


def _down(nodes: list[Node], rule) -> list[bool]:
    """By element, rule(element, what the rule said of its parent)."""
    out = [False] * len(nodes)
    for node in nodes:
        out[node.index] = rule(node, node.parent is not None and out[node.parent.index])
    return out


#: Suspects go where at least this share of the text that is no link, or an article element's text, stands outside of them.
OUTSIDE = 0.05
#: Standard deviations above the mean ratio that a path inside a suspect by class or id needs to be content.
STANDS_OUT = 3.0


def without_suspects(nodes: list[Node], blocks: list[tuple[Node, str, int]]) -> list[tuple[Node, str, int]]:
    """The blocks outside suspects; those that stand out, or hold most of the content, are none."""
    if not any(node.suspect for node in nodes):
        return blocks
    ratio = path_ratios(blocks)
    high = float(ratio.mean() + STANDS_OUT * ratio.std())
    weight = [max(len(text) - linked, 0) for _, text, linked in blocks]
    inside = _sums(nodes, blocks, weight)
    standing = _sums(nodes, blocks, [r >= high for r in ratio])
    for least in (1.0, 0.5, 0.0):
        # First every suspect counts that holds less than all, then those that hold less than half, then none.
        def rule(node: Node, above: bool, least: float = least) -> bool:
            stays = inside[node.index] >= least * inside[0] or node.suspect == BY_NAME and standing[node.index]
            return above or bool(node.suspect) and not stays

        in_suspect = _down(nodes, rule)
        left = [i for i, (node, _, _) in enumerate(blocks) if not in_suspect[node.index]]
        if left and (any(blocks[i][0].main for i in left) or sum(weight[i] for i in left) >= OUTSIDE * inside[0]):
            return [blocks[i] for i in left]
    return blocks


#: Elements that repeat alike after the text are records - comments, cards - from this number on.
RECORDS = 3
TABULAR = frozenset("table thead tbody tfoot tr dl".split())


def without_records(nodes: list[Node], blocks: list[tuple[Node, str, int]]) -> list[tuple[Node, str, int]]:
    """The blocks without records that follow the text: what readers or other pages say, whatever it is called.

    Records are siblings of one tag that share two tag paths or more, such as a name and a
    text, seen from three levels above; a paragraph or an item of a list has one.  Rows of
    tables are none, nor are elements with a heading, as sections have.  They go only if no
    other text stands after them and if they hold less text than all the rest.
    """
    kids: dict[int, dict[int, set[tuple[str, ...]]]] = {}
    headed: set[int] = set()
    for node, _, _ in blocks:
        child, seen = node, (node.tag,)
        for _ in range(3):
            above = child.parent
            if above is None:
                break
            if above.tag not in TABULAR:
                kids.setdefault(above.index, {}).setdefault(child.index, set()).add(seen)
            if node.tag in HEADINGS:
                headed.add(child.index)
            child, seen = above, (above.tag, *seen)
    records: set[int] = set()
    for children in kids.values():
        by_tag: dict[str, list[int]] = {}
        for c, paths in children.items():
            if len(paths) > 1:
                by_tag.setdefault(nodes[c].tag, []).append(c)
        for alike in by_tag.values():
            if len(alike) >= RECORDS and not headed.intersection(alike) and len(set.intersection(*(children[c] for c in alike))) > 1:
                records.update(alike)
    if not records:
        return blocks
    inside = _down(nodes, lambda node, above: above or node.index in records)
    rest = [i for i, (node, _, _) in enumerate(blocks) if not inside[node.index]]
    first = next(i for i, (node, _, _) in enumerate(blocks) if inside[node.index])
    weight = [max(len(text) - linked, 0) for _, text, linked in blocks]
    held = sum(weight[i] for i in rest)
    after = [i for i in rest if i > first and PUNCTUATION.search(blocks[i][1]) and weight[i]]
    return [blocks[i] for i in rest] if not after and 2 * held > sum(weight) else blocks


def _bar(ratio: np.ndarray) -> float:
    return min(float(ratio.std()), float(ratio.max()))


def main_text(page: str | None) -> str:
    """The article of one page; "" if there is none."""
    if not page:
        return ""
    nodes, blocks = blocks_of(page)
    if not blocks:
        return ""
    blocks = without_records(nodes, without_suspects(nodes, blocks))
    ratio = path_ratios(blocks)
    bar = _bar(ratio)
    best: dict[Path, float] = {}
    for (node, _, _), r in zip(blocks, ratio, strict=True):
        best[node.path] = max(best.get(node.path, 0.0), r)
    content = [i for i, (node, _, _) in enumerate(blocks) if best[node.path] >= bar]
    is_content = set(content)
    held = _sums(nodes, [blocks[i] for i in content], [1] * len(content))
    # The smallest element that holds all of the content, but not one paragraph of it.
    root = nodes[0]
    passed: set[int] = set()
    for node in nodes[1:]:
        if root.tag in ("article", "main") or root.has_title:
            break
        if node.parent is root and node.tag in CONTAINERS and held[node.index] == len(content):
            passed.add(root.index)
            root = node
    if root.tag in ("tbody", "tr"):  # cells of one table: its head and caption belong to them
        while root.parent and root.tag != "table":
            root = root.parent
            passed.discard(root.index)
    belongs = _down(nodes, lambda node, above: above or node is root)
    # Whether a block stands in an element around the article without a container of its own.
    beside = _down(nodes, lambda node, above: node.index in passed or above and node.tag not in CONTAINERS)

    # Around a text without an element of its own, lists of links are menus, and blocks of other paths are none of it.
    own = root.tag not in ("", "html", "body")
    last = next((i for i in range(content[-1] + 1, len(blocks)) if blocks[i][0].tag in HEADINGS), None)

    def is_menu(i: int) -> bool:
        node, text, linked = blocks[i]
        if own or best[node.path] >= bar or content[0] < i < content[-1]:
            return False
        if node.tag in ("li", "td", "dd"):
            return linked >= len(text) and (i < content[0] or last is None or i < last)
        return node.tag in CONTAINERS and node is not root

    kept = {
        i
        for i, (node, text, linked) in enumerate(blocks)
        if (not is_menu(i) if belongs[node.index] else beside[node.index] and (linked < len(text) or node.tag in HEADINGS))
    }
    start = min(i for i in kept if blocks[i][0].tag not in HEADINGS or i in is_content)
    if not any(blocks[i][0].tag in HEADINGS for i in kept if i <= start):
        # The title is the last h1, else h2, before the text.
        for tag in ("h1", "h2"):
            title = next((i for i in range(start - 1, -1, -1) if blocks[i][0].tag == tag), None)
            if title is not None:
                kept.add(title)
                break
    return "\n\n".join(blocks[i][1] for i in sorted(kept))


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """`pages` without `html_col`, plus `text_col`: the main text of each whole page ("" for null or none).

    White space inside a block is one space; blocks stand in page order, two line ends
    between them.  Broken and cut-off markup is read as far as it goes.  Each row is read by
    itself, so rows that repeat give the same text; an empty table gives no rows.  A column of
    the name `text_col` is replaced; all others pass unchanged.
    """
    kept = [c for c in pages.columns if c not in (html_col, text_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text_sizes(whole.column(html_col))):
                texts = pa.array([main_text(x) for x in batch.column(html_col).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), texts], names=[*kept, text_col])

    source = pages.select(*kept, html_col)
    return source.mapInArrow(run, source.select(*kept, F.lit("").alias(text_col)).schema)
