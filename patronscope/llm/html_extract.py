"""Main text of web pages by scoring the tree of blocks.

A page becomes a tree of blocks (inline markup only adds text to its block). Parts that
are never article text are left out while the tree is built: scripts, styles, forms,
menus, footers, adverts, notices, reader comments and the like, by element name, ARIA role
or a word of ``class`` and ``id``. Each paragraph passes points for its length and commas
to its ancestors: all to the parent, half to the grandparent, less further up. A
container's points are discounted by its share of linked text. The best container
and those siblings that look like part of it give the text, in page order.

A class name of several words, such as ``related-work``, may name a topic of the article: its part
goes only if a good share of its text is linked. Lists and boxes made of links go too, but
not within an ``article`` or ``main`` element, where they are sources and the like.

Pages are handled one by one in Arrow batches; nothing is shuffled.

Defined cases: NULL or blank html gives ''; markup that is cut off or not closed is closed at
the end; NULL page_id and url stay NULL; repeated rows are repeated; other columns are
ignored; no rows give no rows.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronscope.llm.common import batch

#: Element names (fixed values).
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title iframe noframes noembed xmp template svg".split())
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html li main menu nav
    ol p pre section summary table tbody td tfoot th thead tr ul""".split()
)
DROPPED = frozenset(
    """nav footer aside form button select option input label fieldset dialog menu head noscript
    object canvas audio video annotation annotation-xml""".split()
)
PARAGRAPH = frozenset("p pre td blockquote dd li".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An opening tag closes these open elements (fixed values of the HTML standard).
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
BAD_ROLES = frozenset(
    """navigation banner complementary contentinfo search alert alertdialog dialog menu menubar
    form""".split()
)
BAD_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense banner banners breadcrumb
    breadcrumbs comment comments commentlist consent cookie cookies disclaimer discussion disqus
    footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice
    notices notification pager pagination paywall popup promo promoted promotion recommended
    related replies reply respond responses rail search share sharing shoutbox sidebar signup
    skip social sponsor sponsored sponsors subscribe subscription tagcloud toolbar topbar tracking
    widget widgets""".split()
)
#: Bad words that may as well name a topic, and the words that make them name a part of the page.
TOPIC_WORDS = frozenset(
    """disclaimer discussion header login notice notices notification promotion recommended related
    respond responses search skip social sponsor sponsors subscription tracking""".split()
)
PART_WORDS = frozenset(
    """area article articles bar block box button buttons container content entries feed form icon icons
    inner item items link links list media menu module nav news outer panel popup post posts row
    section stories story strip top topics videos wrap wrapper""".split()
)
#: A class name with one of these words says what is beside the part, not what it is.
BESIDE_WORDS = frozenset("has no with without".split())
#: Ancestors that a paragraph passes points to.
REACH = 12
KEPT_ALWAYS = frozenset("html body article main".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"\b(class|id|role|hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I
)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_SPACE = re.compile(r"\s+")


class Block:
    __slots__ = ("tag", "parent", "parts", "linked", "points", "doubtful")

    def __init__(self, tag: str, parent: Block | None) -> None:
        self.tag, self.parent = tag, parent
        self.parts: list[str | Block] = []
        self.linked = 0
        self.points = 0.0
        self.doubtful = False


def _left_out(tag: str, attributes: str, inside_article: bool) -> bool | None:
    """Whether an element is no article text; None if only its links can tell."""
    if tag in DROPPED or tag in RAW:
        return True
    if tag == "header":
        return not inside_article
    if not attributes or tag in KEPT_ALWAYS or tag in HEADING:
        return False
    doubtful = False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden":
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        elif name == "role":
            if value.strip().lower() in BAD_ROLES:
                return True
        else:
            for one in value.split():
                words = {w.lower() for w in _PART.findall(one)} - ({"header"} if inside_article else set())
                bad = BAD_WORDS & words
                if not bad or BESIDE_WORDS & words:
                    continue
                if not bad <= TOPIC_WORDS or bad == words or PART_WORDS & words:
                    return True
                doubtful = True
    return None if doubtful else False


def parse(page: str) -> Block:
    """The tree of blocks of a page, without the parts that are never article text."""
    root = Block("html", None)
    stack: list[tuple[str, Block, bool]] = [("html", root, False)]  # name, its block, is left out
    opened: Counter[str] = Counter()
    at, in_link, in_article, size = 0, 0, 0, len(page)

    def text(raw: str) -> None:
        _, block, out = stack[-1]
        if raw and not out:
            raw = htmllib.unescape(raw) if "&" in raw else raw
            block.parts.append(raw)
            if in_link:
                block.linked += len(raw.strip())

    def pop() -> None:
        nonlocal in_link, in_article
        name = stack.pop()[0]
        opened[name] -= 1
        in_link -= name == "a"
        in_article -= name in ("article", "main")

    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        closing, tag, attributes = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        if not tag:
            if m.group().startswith("<![CDATA["):
                text(htmllib.escape(m.group()[9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if tag == "br" or tag == "hr":
            text(" ")
        elif closing:
            if not opened[tag]:
                continue
            # an inline end tag doesn't close blocks, a block's end tag closes all within
            depth = len(stack) - 1
            while stack[depth][0] != tag and (tag in BLOCK or stack[depth][0] not in BLOCK):
                depth -= 1
            if stack[depth][0] == tag:
                while len(stack) > depth:
                    pop()
        elif tag in VOID:
            continue
        elif tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
        else:
            if tag in BLOCK:
                closes = CLOSES.get(tag, ())
                for i in range(len(stack) - 1, 0, -1):
                    name = stack[i][0]
                    if name == "p" or name in closes:
                        while len(stack) > i:
                            pop()
                        if name != "p" or not closes:
                            break
                    elif name in BLOCK:
                        break
            _, block, out = stack[-1]
            found = _left_out(tag, attributes, in_article > 0)
            out = out or found is True
            if tag in BLOCK and not out:
                child = Block(tag, block)
                child.doubtful = found is None
                block.parts.append(child)
                block = child
            if not attributes.endswith("/") or tag in BLOCK:
                stack.append((tag, block, out))
                opened[tag] += 1
                in_link += tag == "a"
                in_article += tag in ("article", "main")
    return root


def _measure(block: Block, sizes: dict[int, tuple[int, int]]) -> tuple[int, int]:
    """Characters and linked characters of a block with all below; passes points up."""
    order, todo = [], [block]
    while todo:
        b = todo.pop()
        order.append(b)
        todo += [x for x in b.parts if isinstance(x, Block)]
    for b in reversed(order):
        own = "".join(x for x in b.parts if isinstance(x, str)).strip()
        inner = [sizes[id(x)] for x in b.parts if isinstance(x, Block)]
        n, linked = len(own), min(b.linked, len(own))
        if own and b.tag not in HEADING:
            points = 1 + own.count(",") + min(n / 100, 3)
            points *= 1 - linked / n
            # text straight inside a container counts as a paragraph of it
            up, share = (b.parent, 1.0) if b.tag in PARAGRAPH else (b, 1.0)
            level = 0
            while up is not None and level < REACH:
                up.points += points * share
                level += 1
                share = 0.5 if level == 1 else 1 / (3 * level)
                up = up.parent
        sizes[id(b)] = (n + sum(x[0] for x in inner), linked + sum(x[1] for x in inner))
    return sizes[id(block)]


def _pieces(block: Block, sizes: dict[int, tuple[int, int]], links: bool, out: list[str]) -> None:
    """Texts of the blocks in page order; without ``links``, lists and boxes made of links are left out."""
    run: list[str] = []
    todo: list[Block | str | None] = [block]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            run.append(x)
            continue
        out.append("".join(run))
        run.clear()
        if x is None:
            continue
        n, linked = sizes[id(x)]
        menu = not links and x.tag in ("ul", "ol", "dl", "div", "section", "table") and linked > 0.5 * n
        if x is block or not (menu or x.doubtful and linked > 0.25 * n):
            todo.append(None)
            todo += reversed(x.parts)
    out.append("".join(run))


def main_text(page: str | None) -> str:
    """The article of a page: texts of its blocks, joined by single spaces."""
    if not page or not page.strip():
        return ""
    root = parse(page)
    sizes: dict[int, tuple[int, int]] = {}
    _measure(root, sizes)

    def score(b: Block) -> float:
        n, linked = sizes[id(b)]
        return b.points * (1 - linked / n) if n else 0.0

    best, todo, depth = root, [(root, 0)], {}
    while todo:
        b, d = todo.pop()
        depth[id(b)] = d
        if b.tag not in PARAGRAPH and b.tag not in HEADING:
            if score(b) > score(best) or score(b) == score(best) and d < depth[id(best)]:
                best = b
        todo += [(x, d + 1) for x in b.parts if isinstance(x, Block)]
    up = best
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    if up is not None:
        best = up
    chosen = [best]
    if best.parent is not None:
        least = max(1.0, 0.2 * score(best))

        def belongs(x: Block) -> bool:
            n, linked = sizes[id(x)]
            if x is best or not n or linked > 0.25 * n:
                return x is best
            return x.tag in HEADING or x.tag in PARAGRAPH or score(x) >= least

        chosen = [x for x in best.parent.parts if isinstance(x, Block) and belongs(x)]
    out: list[str] = []
    for b in chosen:
        _pieces(b, sizes, up is not None and b is best, out)
    return " ".join(t for t in (_SPACE.sub(" ", x).strip() for x in out) if t)


SCHEMA = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())]
)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # surrogates that a character reference may name have no UTF-8 form
            found = [
                main_text(x.as_py()).encode("utf-8", "replace").decode() for x in b.column(2)
            ]
            columns = [b.column(0).to_pylist(), b.column(1).to_pylist(), found, map(len, found)]
            yield batch(SCHEMA, [list(c) for c in columns])

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
