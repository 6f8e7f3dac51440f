"""Main text of web pages by tree scoring.

Every paragraph-like block passes points for its length and its commas to its parent and,
halved, to its grandparent and on; ``article`` and ``main`` get them unhalved.  A container's points
are discounted by the share of its text that lies in links; the best container is kept, and of its siblings those
with enough points of their own.  Blocks of text inside the kept trees are the result,
in page order.

Defined cases: a null or empty page, and one without text, gives an empty text; a page
of any length is read whole; unclosed, crossed and stray tags are closed as browsers do in
the cases that matter (paragraphs, list items, cells); a tag that never ends is text;
repeated pages give the same text; rows with a null id are kept; other columns pass through.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeflow.llm.columns import beside

# how a tag, a comment or a declaration begins, and what ends or quotes inside a tag
_OPENS = re.compile(r"<(?:(?P<comment>!--)|(?P<cdata>!\[CDATA\[)|(?P<declared>[!?])|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*))")
_SPECIAL = re.compile(r"[\"'>]")
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
_SKIPPED = frozenset(
    "script style noscript template head title nav menu footer aside form button select option textarea input label "
    "fieldset dialog iframe object embed svg canvas math audio video map noembed noframes xmp datalist".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
_CONTAINER = frozenset("article blockquote body center dd details div dl figure header html li main ol section table tbody td tr ul".split())
_NAMED_TEXT = frozenset(["article", "main"])
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
_SCOPE = frozenset("ul ol dl table tbody thead tfoot".split())

# words of class, id and role values that mark what is not the article
_BOILER = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|banner|breadcrumbs?|byline-share|comments?|commentlist|complementary|"
    r"contentinfo|cookies?|consent|disqus|disclaimer|footer|footnav|header|masthead|menu|menubar|modal|nav|navbar|navigation|newsletter|"
    r"notice|notices|notification|outbrain|pager|pagination|popup|promo|promoted|promotion|related|recommended|replies|reply|responses|"
    r"search|share|sharing|shout|sidebar|skip|social|sponsor|sponsored|subscribe|subscription|taboola|teaser|toolbar|widget|alert|"
    r"alertdialog|dialog)(?=$|[\s_-]|\d)",
    re.IGNORECASE,
)
_MAYBE = re.compile(r"(?:^|[\s_-])(?:article|body|column|content|entry|main|post|story|text)(?=$|[\s_-])", re.IGNORECASE)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class Node:
    __slots__ = ("name", "parent", "children", "skipped", "points", "chars", "linked", "weight")

    def __init__(self, name: str, parent: Node | None, skipped: bool, weight: float = 0.0):
        self.name, self.parent, self.skipped, self.weight = name, parent, skipped, weight
        self.children: list = []  # nodes and strings
        self.points = 0.0
        self.chars = 0
        self.linked = 0


class Stack(list):
    """Open elements, with how many there are of each name."""

    def __init__(self, root: Node):
        super().__init__([root])
        self.open: Counter[str] = Counter()

    def push(self, node: Node) -> None:
        self.append(node)
        self.open[node.name] += 1

    def cut(self, i: int) -> None:
        self.open.subtract(node.name for node in self[i:])
        del self[i:]


class Tags:
    """Where tags end, each part of the page looked at a bounded number of times.

    A tag ends at the first ``>`` outside quotes.  What follows depends only on the first quote or
    ``>`` from a place on, so the answer is kept for each of these; most fail together.
    """

    def __init__(self, page: str):
        self.page = page
        self.fate: dict[int, int] = {}  # of a quote or ">" outside quotes: the tag's end, or -1
        self.low = self.high = -1  # no special character from low on before high

    def _special(self, at: int) -> int:
        if not self.low <= at <= self.high:
            found = _SPECIAL.search(self.page, at)
            self.low, self.high = at, found.start() if found else len(self.page)
        return self.high

    def end(self, at: int) -> int:
        """Past the ``>`` of the tag whose attributes begin at ``at``, or -1."""
        page, passed, special = self.page, [], self._special(at)
        while special not in self.fate:
            passed.append(special)
            if special == len(page):
                self.fate[special] = -1
            elif page[special] == ">":
                self.fate[special] = special + 1
            else:
                close = page.find(page[special], special + 1)
                if close < 0:
                    self.fate[special] = -1
                else:
                    found = _SPECIAL.search(page, close + 1)
                    special = found.start() if found else len(page)
        for place in passed:
            self.fate[place] = self.fate[special]
        return self.fate[special]


def _markup(page: str, tags: Tags, last: int, at: int) -> tuple[re.Match | None, int]:
    """The next tag, comment or declaration from ``at`` on and its end; ``last``: of the page's ``>``."""
    found = _OPENS.search(page, at)
    while found:
        if found["comment"] or found["cdata"]:
            close = "-->" if found["comment"] else "]]>"
            stop = page.find(close, found.end())
            return found, stop + 3 if stop >= 0 else len(page)
        if found.end() > last:
            break  # nothing after it ends a tag; a comment may still come
        if page[found.end()] == ">":
            return found, found.end() + 1
        stop = page.find(">", found.end()) + 1 if found["declared"] else tags.end(found.end())
        if stop > 0:
            return found, stop
        found = _OPENS.search(page, found.start() + 1)
    if found:
        begins = [i for i in (page.find("<!--", found.start()), page.find("<![CDATA[", found.start())) if i >= 0]
        if begins:
            return _OPENS.match(page, min(begins)), len(page)
    return None, len(page)


def _named(attrs: str) -> tuple[str, bool]:
    """The class, id and role values, and whether the element is hidden."""
    names, hidden = [], False
    for key, *values in _ATTR.findall(attrs):
        key, value = key.lower(), next((v for v in values if v), "")
        if key in ("class", "id", "role"):
            names.append(entities.unescape(value))
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value):
            hidden = True
    return " ".join(names), hidden


def _boiler(name: str, names: str) -> bool:
    if name in ("html", "body", "article", "main"):
        return False
    return bool(_BOILER.search(names)) and not (name in ("p", "span", "b", "i", "em", "strong", "a") and _MAYBE.search(names))


def parse(page: str) -> Node:
    root = Node("html", None, False)
    stack = Stack(root)
    at, end = 0, len(page)
    tags, last = Tags(page), page.rfind(">")
    while at < end:
        found, stop = _markup(page, tags, last, at)
        text = page[at : found.start()] if found else page[at:]
        top = stack[-1]
        if text and not top.skipped:
            top.children.append(entities.unescape(text) if "&" in text else text)
        if not found:
            break
        at = stop
        if found["cdata"]:
            if not top.skipped:
                top.children.append(page[found.end() : stop].removesuffix("]]>"))
            continue
        if found["name"] is None:
            continue
        name = found["name"].lower()
        if found["close"]:
            _close(stack, name)
            continue
        if name in _BLOCK:
            _close_paragraph(stack)
        if name in _CLOSED_BY:
            _close_until(stack, _CLOSED_BY[name])
        if name in ("html", "body") and len(stack) == 1:
            continue
        top = stack[-1]
        attrs = page[found.end() : stop - 1]
        names, hidden = _named(attrs) if attrs.strip(" /") else ("", False)
        skipped = top.skipped or hidden or name in _SKIPPED or _boiler(name, names)
        if name == "header" and not any(n.name in ("article", "main") for n in stack):
            skipped = True
        weight = 25.0 if names and _MAYBE.search(names) else 0.0
        node = Node(name, top, skipped, weight)
        top.children.append(node)
        if name in _VOID or attrs.endswith("/") and name not in _BLOCK and name not in _RAW:
            continue
        if name in _RAW:
            close = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at)
            raw = page[at : close.start()] if close else page[at:]
            if not skipped:
                node.children.append(raw)
            at = close.end() if close else end
            continue
        stack.push(node)
    return root


def _close(stack: Stack, name: str) -> None:
    if not stack.open[name]:
        return
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].name == name:
            stack.cut(i)
            return
        if name not in _BLOCK and stack[i].name in _BLOCK:
            return  # an inline end tag does not close blocks


def _close_paragraph(stack: Stack) -> None:
    if not stack.open["p"]:
        return
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].name == "p":
            stack.cut(i)
            return
        if stack[i].name in _BLOCK:
            return


def _close_until(stack: Stack, names: frozenset[str]) -> None:
    if not any(stack.open[name] for name in names):
        return
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].name in names:
            stack.cut(i)
            return
        if stack[i].name in _SCOPE:
            return


def _blocks(node: Node) -> Iterator[tuple[Node, str, int]]:
    """(element, text, characters in links) of each block of text below a node, in order.

    Walks without recursion, as pages may nest deeply.
    """
    pieces: list[str] = []
    linked = 0
    holder = node

    def flush() -> Iterator[tuple[Node, str, int]]:
        nonlocal pieces, linked
        text = _SPACE.sub(" ", "".join(pieces)).strip()
        if text:
            yield holder, text, linked
        pieces, linked = [], 0

    todo: list = [(node, 0, False)]
    while todo:
        item, links, leaving = todo.pop()
        if isinstance(item, str):
            pieces.append(item)
            if links:
                linked += len(item.strip())
            continue
        if leaving:
            yield from flush()
            holder = item.parent or item
            continue
        if item.skipped:
            if item.name in _BLOCK:
                yield from flush()
            continue
        if item.name == "br":
            pieces.append(" ")
            continue
        inner = links + (item.name == "a")
        if item.name in _BLOCK:
            yield from flush()
            holder = item
            todo.append((item, links, True))
        todo.extend((child, inner, False) for child in reversed(item.children))
    yield from flush()


def _block_parent(node: Node) -> Node:
    while node.parent is not None and node.name not in _CONTAINER:
        node = node.parent
    return node


def main_text(page: str) -> str:
    """The main text of a page, blocks joined by line ends."""
    root = parse(page)
    blocks = list(_blocks(root))
    if not blocks:
        return ""
    scored: dict[int, Node] = {}
    for holder, text, linked in blocks:
        holder.chars += len(text)
        holder.linked += linked
        if holder.name in _HEADING:
            continue
        points = 1.0 + text.count(",") + text.count("，") + len(text) / 100
        points *= 1.0 - min(1.0, linked / len(text))
        share, up = 1.0, _block_parent(holder)
        while up is not None and share > 0.01:
            if id(up) not in scored:
                scored[id(up)] = up
                up.points += up.weight / 25 + (1.0 if up.name in _NAMED_TEXT else 0.0)
            # an element that is named as the text gains all of a block's points at any depth
            up.points += points * (1.0 if up.name in _NAMED_TEXT else share)
            share /= 2 if up is not holder or holder.name in ("p", "pre", "blockquote") else 1.25
            up = up.parent

    nodes, todo = [], [root]  # parents before children
    while todo:
        nodes.append(todo.pop())
        todo.extend(child for child in nodes[-1].children if not isinstance(child, str))
    for node in reversed(nodes[1:]):
        node.parent.chars += node.chars
        node.parent.linked += node.linked

    def worth(node: Node) -> float:
        return node.points * (1.0 - min(1.0, node.linked / max(1, node.chars)))

    best = max(scored.values(), key=worth, default=None)
    if best is None:
        return "\n".join(text for _, text, _ in blocks)
    kept = {id(best)}
    if best.parent is not None and best.name != "main":
        least = max(5.0, worth(best) * 0.2)
        for sibling in best.parent.children:
            if isinstance(sibling, str) or sibling.skipped or sibling is best:
                continue
            share = sibling.linked / max(1, sibling.chars)
            if (
                id(sibling) in scored and worth(sibling) >= least and share < 0.33
                or sibling.name == "article" and best.name == "article"
                or sibling.name in ("p", "pre", "blockquote", *_HEADING) and sibling.chars > 0 and share < 0.25
            ):
                kept.add(id(sibling))
    for node in nodes:
        if node.parent is not None and id(node.parent) in kept:
            kept.add(id(node))
    return "\n".join(text for holder, text, _ in blocks if id(holder) in kept)


def extract(pages: DataFrame, html: str = "html", keep_html: bool = True) -> DataFrame:
    """``pages`` with a column ``main_text``, which replaces one of that name."""
    return beside(pages, lambda rows: _extract(rows, html, keep_html), added=["main_text"])


def _extract(pages: DataFrame, html: str, keep_html: bool) -> DataFrame:
    place = pages.columns.index(html)
    fields = [f for f in pages.schema.fields if keep_html or f.name != html]
    kept = [i for i, f in enumerate(pages.schema.fields) if keep_html or f.name != html]
    names = [*(f.name for f in fields), "main_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "") for page in batch.column(place)]
            columns = [batch.column(i) for i in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names)

    return pages.mapInArrow(run, T.StructType([*fields, T.StructField("main_text", T.StringType())]))


def op10_html_extraction(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = extract(pages, keep_html=False)
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
