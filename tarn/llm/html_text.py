"""The main text of HTML pages, by scoring the tree.

Boilerplate subtrees go first, by tag, role and class names. Then paragraphs
pass points, for their length and their commas, to their ancestors; a
container's sum is discounted by the share of its text that lies in links. The
best container stays, with those of its siblings that score well or read like
text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import body, picked, values

# Element names by their role in a page.
VOID = frozenset(
    "area base br col embed hr img input keygen link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol p pre search section summary table tbody td tfoot th thead title tr "
    "ul".split()
)
DROPPED = frozenset(
    "applet aside audio button canvas datalist dialog embed footer form frame frameset head "
    "iframe input map menu nav noembed noframes noscript object optgroup option script search "
    "select style svg template textarea title video xmp".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd figcaption".split())
# What an opening tag closes if it is open, and the tags that stop the search.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
PARAGRAPH_LIMITS = frozenset("table td th caption button object html body".split())
# Words of class, id and role attributes that mark what is not the article.
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adverts adsense banner breadcrumb breadcrumbs "
    "captcha comment comments complementary consent contentinfo cookie cookies copyright "
    "dialog disclaimer discussion disqus feedback footer footnav form gdpr hidden login masthead "
    "menu menubar modal nav navbar navigation newsletter notice notices notification outbrain "
    "overlay pager pagination paywall popup promo promoted promotion recommended related replies "
    "reply respond search share sharing shoutbox sidebar signup skip skyscraper social sponsor "
    "sponsored subscribe subscription taboola toolbar topbar tracking widget widgets".split()
)
ARTICLE_WORDS = frozenset("article blog body content entry main page post story text".split())
CONTAINER_POINTS = {
    "article": 25, "main": 15, "section": 5, "div": 5, "blockquote": 3, "pre": 3, "td": 3,
    "ul": -3, "ol": -3, "dl": -3, "li": -3, "dd": -3, "address": -3, "th": -5,
}
HINT_POINTS = 10
# Ancestors that a paragraph passes points to: all of them, a half, a sixth...
LEVELS = 5

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
INSIDE = re.compile(r"(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+")
ATTRIBUTE = re.compile(
    r"(class|id|role|style|hidden|aria-hidden)\b"
    r"(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?",
    re.IGNORECASE,
)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class Node:
    __slots__ = (
        "tag", "parent", "kids", "words", "unseen", "score", "chars", "linked", "in_article",
        "holds",
    )

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent = tag, parent
        self.kids: list[Node | str] = []
        self.words: frozenset[str] = frozenset()
        self.unseen = False
        self.score: float | None = None
        self.chars = self.linked = 0
        self.in_article = tag in ("article", "main") or (parent is not None and parent.in_article)
        self.holds = False


def parse(page: str) -> Node:
    """The page as a tree; unclosed and stray tags are tolerated."""
    root = Node("#root", None)
    stack, open_tags = [root], {}

    def pop() -> None:
        tag = stack.pop().tag
        open_tags[tag] -= 1

    def close_until(names: set[str], limits: frozenset[str] | set[str]) -> None:
        """Close the nearest open element named so, unless a limit is nearer."""
        if not any(open_tags.get(name) for name in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            tag = stack[depth].tag
            if tag in names:
                while len(stack) > depth:
                    pop()
                return
            if tag in limits:
                return

    def text(content: str) -> None:
        if content:
            stack[-1].kids.append(html.unescape(content) if "&" in content else content)

    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            text(page[at:])
            break
        following = page[start + 1 : start + 2]
        if following in ("!", "?"):
            text(page[at:start])
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                at = size if end < 0 else end + 3
            elif page.startswith("<![CDATA[", start):
                end = page.find("]]>", start + 9)
                stack[-1].kids.append(page[start + 9 : size if end < 0 else end])
                at = size if end < 0 else end + 3
            else:
                end = page.find(">", start)
                at = size if end < 0 else end + 1
            continue
        closing = following == "/"
        name = NAME.match(page, start + 1 + closing)
        if name is None:
            if closing and page.startswith("</>", start):
                text(page[at:start])
                at = start + 3
                continue
            text(page[at : start + 1])
            at = start + 1
            continue
        text(page[at:start])
        tag = name.group().lower()
        end = INSIDE.match(page, name.end()).end()
        if end >= size or page[end] != ">":  # an attribute's quote is not closed
            end = page.find(">", name.end())
            if end < 0:
                break
        inside = page[name.end() : end]
        at = end + 1
        if closing:
            if open_tags.get(tag):
                while stack[-1].tag != tag:
                    pop()
                pop()
            continue
        if tag in BLOCKS:
            close_until({"p"}, PARAGRAPH_LIMITS)
        if tag in HEADINGS and stack[-1].tag in HEADINGS:
            pop()
        if tag in CLOSES:
            close_until(*CLOSES[tag])
        node = Node(tag, stack[-1])
        if inside:
            _read_attributes(node, inside)
        stack[-1].kids.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            found = re.compile(f"</{re.escape(tag)}[\\s/>]", re.IGNORECASE).search(page, at)
            at = found.start() if found else size
            if found:
                end = page.find(">", at)
                at = size if end < 0 else end + 1
            continue
        stack.append(node)
        open_tags[tag] = open_tags.get(tag, 0) + 1
    return root


def _read_attributes(node: Node, inside: str) -> None:
    words: set[str] = set()
    for found in ATTRIBUTE.finditer(inside):
        key = found.group(1).lower()
        value = found.group(2) or found.group(3) or found.group(4) or ""
        if key in ("class", "id", "role"):
            words.update(word.lower() for word in WORD.findall(value))
        elif key == "style":
            node.unseen |= bool(INVISIBLE.search(value))
        elif key == "hidden":
            node.unseen |= inside[: found.start()].endswith((" ", "\t", "\n", "\r", "\f"))
        elif value.lower() == "true":
            node.unseen = True
    node.words = frozenset(words)


def _in_order(root: Node) -> list[Node]:
    """All elements, parents before children, in page order."""
    found, left = [], [root]
    while left:
        node = left.pop()
        found.append(node)
        left.extend(kid for kid in reversed(node.kids) if isinstance(kid, Node))
    return found


def _is_boilerplate(node: Node, by_words: bool) -> bool:
    if node.unseen or (node.tag in DROPPED and not (node.tag == "form" and node.holds)):
        return True
    if node.tag in ("html", "body", "main", "#root"):
        return False
    if node.tag == "header":
        return not node.parent.in_article
    return by_words and not node.holds and not node.words.isdisjoint(BOILERPLATE_WORDS)


def _article_marks(nodes: list[Node]) -> list[Node]:
    """What says where the article is: ``article`` and ``main``, or else the first ``h1``.

    Elements named like boilerplate don't count: comments are articles, too.
    """
    plain = [node for node in nodes if node.words.isdisjoint(BOILERPLATE_WORDS)]
    marks = [node for node in plain if node.tag in ("article", "main")]
    return marks or [node for node in plain if node.tag == "h1"][:1]


def _prune(root: Node, by_words: bool = True) -> None:
    """Cut off boilerplate, but by its names only what doesn't hold the article.

    A form that holds it stays, as server-side frameworks wrap whole pages in
    one; its controls go like others.
    """
    nodes = _in_order(root)
    marks = set(map(id, _article_marks(nodes)))
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.holds |= node.holds or id(node) in marks
    for node in nodes:
        node.kids = [
            kid for kid in node.kids if isinstance(kid, str) or not _is_boilerplate(kid, by_words)
        ]


def _measure(nodes: list[Node]) -> None:
    """Characters of text, and of text in links, below every element."""
    for node in reversed(nodes):
        node.chars += sum(len(" ".join(kid.split())) for kid in node.kids if isinstance(kid, str))
        if node.tag == "a":
            node.linked = node.chars
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked


def _link_density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def _paragraphs(nodes: list[Node]) -> Iterator[tuple[Node, str]]:
    for node in nodes:
        if node.tag in PARAGRAPHS:
            if not any(isinstance(kid, Node) and kid.tag in BLOCKS for kid in node.kids):
                yield node, " ".join(_blocks(node))
        elif node.tag in BLOCKS:
            own = " ".join(kid for kid in node.kids if isinstance(kid, str)).strip()
            if own and node.tag not in HEADINGS:
                yield node, own


def _score(nodes: list[Node]) -> None:
    for paragraph, content in _paragraphs(nodes):
        points = (1 + content.count(",") + min(len(content) / 100, 3.0)) * (
            1 - _link_density(paragraph)
        )
        # Text of its own counts for an element that is no paragraph.
        node = paragraph.parent if paragraph.tag in PARAGRAPHS else paragraph
        for level in range(LEVELS):
            if node is None:
                break
            if node.score is None:
                node.score = float(CONTAINER_POINTS.get(node.tag, 0))
                if not node.words.isdisjoint(ARTICLE_WORDS):
                    node.score += HINT_POINTS
                if not node.words.isdisjoint(BOILERPLATE_WORDS):
                    node.score -= HINT_POINTS
            node.score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            node = node.parent


def _reads_like_text(node: Node) -> bool:
    if node.tag in HEADINGS:
        return _link_density(node) < 0.5
    if node.tag not in PARAGRAPHS and node.tag not in ("ul", "ol", "dl", "table", "figure"):
        return False
    return node.chars > 0 and _link_density(node) < 0.25


def _kept(nodes: list[Node]) -> list[Node]:
    """The best container and its siblings, or the whole page if nothing scores."""
    scored = [node for node in nodes if node.score is not None]
    if not scored:
        return nodes[:1]
    best = max(scored, key=lambda node: node.score * (1 - _link_density(node)))
    outer = best
    while outer is not None and outer.tag not in ("article", "main"):
        outer = outer.parent
    best = outer or best
    if best.parent is None:
        return [best]
    top = (best.score or 0.0) * (1 - _link_density(best))
    least = max(10.0, 0.2 * top)
    return [
        kid
        for kid in best.parent.kids
        if isinstance(kid, Node)
        and (
            kid is best
            or (kid.score is not None and kid.score * (1 - _link_density(kid)) >= least)
            or _reads_like_text(kid)
        )
    ]


def _blocks(top: Node) -> list[str]:
    """Texts between the borders of block elements, white space made single."""
    found: list[str] = []
    run: list[str] = []

    def flush() -> None:
        content = " ".join("".join(run).split())
        if content:
            found.append(content)
        run.clear()

    left: list[Node | str | None] = [top]
    while left:
        item = left.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            run.append(item)
        elif item.tag == "br":
            run.append("\n")
        else:
            block = item.tag in BLOCKS
            if block:
                flush()
                left.append(None)
            left.extend(reversed(item.kids))
    flush()
    return found


def main_text(page: str) -> str:
    """The article of a page: its blocks in page order, joined by empty lines.

    Where names leave nothing of a page, they are not gone by: an article may
    lie in a box that is named like boilerplate.
    """
    return _main_text(page, True) or _main_text(page, False)


def _main_text(page: str, by_words: bool) -> str:
    root = parse(page)
    _prune(root, by_words)
    nodes = _in_order(root)
    _measure(nodes)
    _score(nodes)
    return "\n\n".join(block for node in _kept(nodes) for block in _blocks(node))


def extract_text(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", markup: str = "html"
) -> DataFrame:
    """One row per row of ``pages``: the id, the url, ``text`` and ``n_chars``.

    A null page is an empty one, whose text is empty. Null ids and urls are
    carried as they are, and repeated rows are rows of their own. An empty
    table gives no rows; further columns do not matter.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in values(batch.column("page"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(text) for text in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = picked(pages, page_id=page_id, url=url, page=markup).select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"), body("page").alias("page")
    )
    return rows.mapInArrow(extract, "page_id bigint, url string, text string, n_chars bigint")
