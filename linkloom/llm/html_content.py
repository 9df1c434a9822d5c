"""Main text of web pages by minimum cut.

A page becomes blocks of text. A classifier prices each block as content or as boilerplate; the prices are the
capacities from the source and to the sink. Blocks that follow each other, or are neighbours in one container,
are tied by edges that cost something to cut. The minimum cut is the cheapest labelling; what stays with
the source is the page's text.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import map_batches, named

#: Elements whose text is never shown as text.
HIDDEN = frozenset("script style noscript template title svg iframe canvas audio video select option datalist textarea button xmp noembed noframes annotation annotation-xml".split())
#: Roots of foreign content, where a slash before the ``>`` closes an element. HTML's own elements ignore the slash.
FOREIGN = frozenset("svg math".split())
#: Elements inside a line; every other element begins and ends a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meta q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr input object "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle mpadded mphantom menclose msub msup msubsup munder mover munderover mspace semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold something other than the article.
CHROME = frozenset("nav header footer aside form menu dialog address fieldset".split())
ARTICLE = frozenset("article main".split())
#: Parts of class, id and role names, split at anything but letters and digits.
CHROME_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright dialog disclaimer disqus footer form gdpr "
    "header login masthead menu modal nav navbar navigation newsletter notice overlay pagination pager popup promo promoted promotion related reply "
    "replies respond search share sharing sidebar signup social sponsor sponsored subscribe subscription tags toolbar widget widgets "
    "contentinfo complementary alert skip".split())
ARTICLE_NAMES = frozenset("article body content entry main post story text".split())
#: Elements that end an open paragraph, and those that end an open one of their own kind.
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES_ITSELF = frozenset("li dd dt td th tr".split())
_NAME = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")
_ABOUT = ("has-", "with-", "no-", "is-")  # class names that speak about other elements


@dataclass
class Block:
    text: str
    tag: str
    container: int               # number of the element that holds the block's element
    depth: int
    linked: int = 0              # characters in links
    chrome: int = 0              # elements around it that are something else by tag
    named_chrome: int = 0        # ... or by name
    article: int = 0
    named_article: int = 0
    element: int = 0             # number of its own element


@dataclass
class _Element:
    tag: str
    number: int
    chrome: int
    named_chrome: int
    article: int
    named_article: int


_TAG_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_BEFORE_ATTRIBUTE = re.compile(r"[\s/]*")
_ATTRIBUTE = re.compile(r"[^\s/>][^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_UNQUOTED = re.compile(r"[^\s>]*")
#: Elements whose content is not markup, up to their end tag.
_RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in ("script", "style", "title", "textarea", "noscript", "iframe", "xmp", "noembed", "noframes")}


def tokenize(html: str) -> Iterator[tuple[str, str, dict]]:
    """("start", "single" or "end", tag, attributes) and ("text", text, {}) in page order, each character looked at once.

    A single element is one of foreign content that closes itself. What is left open (a tag, a comment, an
    attribute's quote, a script) goes on to the end of the page.
    """
    at, n = 0, len(html)
    foreign: Counter = Counter()  # roots of foreign content that are open
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            yield "text", unescape(html[at:lt]), {}
        if lt == n:
            return
        name = _TAG_NAME.match(html, lt + 1)
        if name:
            tag, at = name[0].lower(), name.end()
            attributes: dict[str, str] = {}
            while True:
                before = _BEFORE_ATTRIBUTE.match(html, at)
                at = before.end()
                if at >= n:
                    return
                if html[at] == ">":
                    break
                key = _ATTRIBUTE.match(html, at)
                at, value = key.end(), ""
                equals = _EQUALS.match(html, at)
                if equals:
                    at = equals.end()
                    quote = html[at:at + 1]
                    if quote in ('"', "'"):
                        end = html.find(quote, at + 1)
                        if end < 0:
                            return
                        value, at = html[at + 1:end], end + 1
                    else:
                        unquoted = _UNQUOTED.match(html, at)
                        value, at = unquoted[0], unquoted.end()
                attributes.setdefault(key[0].lower(), value)
            at += 1
            if before[0].endswith("/") and (tag in FOREIGN or foreign.total()):
                yield "single", tag, attributes
                continue
            if tag in FOREIGN:
                foreign[tag] += 1
            yield "start", tag, attributes
            if tag in _RAW:
                end = _RAW[tag].search(html, at)
                if not end:
                    return
                at = end.start()
        elif html.startswith("<!--", lt):
            end = lt + 4 if html.startswith((">", "->"), lt + 4) else html.find("-->", lt + 4)
            if end < 0:
                return
            at = html.find(">", end) + 1
        elif html[lt + 1:lt + 2] in ("!", "?", "/"):
            end = html.find(">", lt + 1)
            if end < 0:
                return
            name, at = _TAG_NAME.match(html, lt + 2), end + 1
            if name and html[lt + 1] == "/":
                tag = name[0].lower()
                if foreign[tag]:  # looking up adds nothing
                    foreign[tag] -= 1
                yield "end", tag, {}
        else:
            yield "text", "<", {}
            at = lt + 1


class _Blocks:
    """Blocks of a page in order. Elements left open end with the page."""

    def __init__(self) -> None:
        self.open = [_Element("", 0, 0, 0, 0, 0)]
        self.depth_of: Counter = Counter()
        self.hidden, self.nested = "", 0
        self.made: list[Block] = []
        self.parts: list[str] = []
        self.linked = self.links = self.count = 0
        self.above, self.named_in_part = [0], [False]  # of every element: who holds it; is a part of a name something else
        self.is_article = [False]

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            here = self.open[-1]
            holder = self.open[-2].number if len(self.open) > 1 else 0
            self.made.append(Block(text, here.tag, holder, len(self.open), min(self.linked, len(text)), here.chrome, here.named_chrome,
                                   here.article, here.named_article, here.number))
        self.parts, self.linked = [], 0

    def close(self, to: int) -> None:
        for element in self.open[to:]:
            self.depth_of[element.tag] -= 1
        del self.open[to:]

    def start(self, tag: str, attributes: dict) -> None:
        if self.hidden:
            self.nested += tag == self.hidden
        elif tag in HIDDEN:
            if tag not in VOID:
                self.hidden, self.nested = tag, 1
        elif tag == "br":
            self.parts.append(" ")
        elif tag in INLINE:
            self.links += tag == "a"
        else:
            self.flush()
            last = self.open[-1].tag
            if last == "p" and tag in CLOSES_P or last == tag and tag in CLOSES_ITSELF:
                self.close(len(self.open) - 1)
            if tag not in VOID:
                self.enter(tag, attributes)

    def enter(self, tag: str, attributes: dict) -> None:
        above = self.open[-1]
        names, whole = set(), set()
        if tag not in ("html", "body"):
            given = " ".join(unescape(attributes[k]) for k in ("class", "id", "role") if k in attributes).lower()
            whole = {token for token in given.split() if not token.startswith(_ABOUT)}
            names = {n for token in whole for n in _NAME.findall(token)}
        chrome = tag in CHROME and not (tag in ("header", "address") and above.article)  # an article's own title and author
        named_chrome = bool(whole & CHROME_NAMES)
        in_part = bool(names & CHROME_NAMES) and not named_chrome
        self.above.append(above.number)
        self.named_in_part.append(in_part)
        self.is_article.append(tag in ARTICLE)
        self.count += 1
        self.depth_of[tag] += 1
        self.open.append(_Element(
            tag, self.count, above.chrome + chrome, above.named_chrome + named_chrome, above.article + (tag in ARTICLE),
            above.named_article + (bool(names & ARTICLE_NAMES) and not named_chrome and not in_part)))

    def judge_parts_of_names(self) -> None:
        """Count elements that only a part of a name calls something else, such as ``site-footer`` or ``sidebar-right``.

        Such a name may as well speak of the page's layout: an element that holds over half of the text outside
        menus, footers and the like is none, nor is anything around an article or main element, or its own name.
        """
        text = [0] * len(self.above)
        for block in self.made:
            if not block.chrome and not block.named_chrome:
                text[block.element] += len(block.text)
        for number in range(len(text) - 1, 0, -1):  # an element's number is greater than its holder's
            text[self.above[number]] += text[number]
        parts = [0] * len(self.above)
        for number in range(1, len(parts)):
            if not self.is_article[number]:
                other = self.named_in_part[number] and 2 * text[number] <= text[0]
                parts[number] = parts[self.above[number]] + other
        for block in self.made:
            block.named_chrome += parts[block.element]

    def end(self, tag: str) -> None:
        if self.hidden:
            if tag == self.hidden:
                self.nested -= 1
                self.hidden = self.hidden if self.nested else ""
        elif tag in INLINE:
            if tag == "a":
                self.links = max(0, self.links - 1)
        elif self.depth_of[tag] > 0:
            self.flush()
            self.links = 0
            at = len(self.open) - 1
            while self.open[at].tag != tag:
                at -= 1
            self.close(at)

    def text(self, text: str) -> None:
        if not self.hidden:
            self.parts.append(text)
            if self.links:
                self.linked += len(text.strip())


def blocks(html: str) -> list[Block]:
    page = _Blocks()
    for kind, what, attributes in tokenize(html):
        if kind == "text":
            page.text(what)
        elif kind == "start":
            page.start(what, attributes)
        elif kind == "end":
            page.end(what)
    page.flush()
    page.judge_parts_of_names()
    return page.made


def content_odds(block: Block) -> float:
    """Log odds that a block is content: a linear classifier of where the block stands and what it looks like."""
    words = block.text.count(" ") + 1
    odds = -0.5 + 0.8 * math.log1p(words) - 3.0 * block.linked / len(block.text)
    odds -= 16.0 * min(block.chrome, 2) + 14.0 * min(block.named_chrome, 2)
    odds += 4.0 * min(block.article, 1) + 1.5 * min(block.named_article, 1)
    if block.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figcaption"):
        odds += 1.0
    if block.text[-1] in ".!?…\"”»:;":
        odds += 0.5
    return odds


class Flow:
    """Maximum flow with levels (Dinic). Node 0 is the source, 1 the sink."""

    def __init__(self, nodes: int):
        self.edges: list[list] = [[] for _ in range(nodes)]  # of each node: [to, capacity left, place of the reverse edge]

    def add(self, a: int, b: int, there: float, back: float = 0.0) -> None:
        self.edges[a].append([b, there, len(self.edges[b])])
        self.edges[b].append([a, back, len(self.edges[a]) - 1])

    def levels(self) -> list[int]:
        level = [-1] * len(self.edges)
        level[0] = 0
        queue = deque([0])
        while queue:
            a = queue.popleft()
            for b, left, _ in self.edges[a]:
                if left > 1e-9 and level[b] < 0:
                    level[b] = level[a] + 1
                    queue.append(b)
        return level

    def run(self) -> list[bool]:
        """Saturate the network; which nodes stay with the source."""
        while (level := self.levels())[1] >= 0:
            at = [0] * len(self.edges)
            path: list[tuple[int, int]] = []
            node = 0
            while True:
                if node == 1:
                    least = min(self.edges[a][k][1] for a, k in path)
                    cut = len(path)
                    for n, (a, k) in enumerate(path):
                        edge = self.edges[a][k]
                        edge[1] -= least
                        self.edges[edge[0]][edge[2]][1] += least
                        if edge[1] <= 1e-9:
                            cut = min(cut, n)
                    node = path[cut][0]
                    del path[cut:]
                    continue
                own = self.edges[node]
                while at[node] < len(own):
                    b, left, _ = own[at[node]]
                    if left > 1e-9 and level[b] == level[node] + 1:
                        break
                    at[node] += 1
                if at[node] < len(own):
                    path.append((node, at[node]))
                    node = own[at[node]][0]
                elif path:
                    level[node] = -1
                    node = path.pop()[0]
                    at[node] += 1
                else:
                    break
        return [n >= 0 for n in level]


def content(made: list[Block], follow: float = 1.0, near: float = 1.0) -> list[bool]:
    """Which blocks are content: the minimum cut.

    ``follow`` is the price of parting blocks that follow each other, less the deeper the step between
    them in the page's tree; ``near`` that of parting neighbours in one container.
    """
    flow = Flow(len(made) + 2)
    in_container: dict[int, int] = {}
    for k, block in enumerate(made):
        odds = content_odds(block)
        if odds > 0:
            flow.add(0, k + 2, odds)
        else:
            flow.add(k + 2, 1, -odds)
        if k:
            price = follow / (1 + abs(block.depth - made[k - 1].depth))
            flow.add(k + 1, k + 2, price, price)
        before = in_container.get(block.container)
        if before is not None:
            flow.add(before + 2, k + 2, near, near)
        in_container[block.container] = k
    return flow.run()[2:]


def main_text(html: str | None) -> str:
    """The page's main text: content blocks in page order, parted by empty lines; empty if there are none."""
    made = blocks(html) if html else []
    return "\n\n".join(b.text for b, kept in zip(made, content(made)) if kept)


def extract(df: DataFrame, html_column: str = "html", carry: dict[str, Column] | None = None) -> DataFrame:
    """``text`` and ``n_chars`` (code points) of every page, with what ``carry`` names. Null html is empty.

    A page is parsed and cut where it lies; nothing is shuffled.
    """
    carry = carry or {}
    rows = df.select(named(html_column).cast("string").alias("html"), F.struct(F.lit(0).alias("_"), *[v.alias(k) for k, v in carry.items()]).alias("carried"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            found = [main_text(html) for html in batch.column(0).to_pylist()]
            yield {"carried": batch.column(1), "text": found, "n_chars": [len(t) for t in found]}

    made = map_batches(rows, run, f"carried {rows.schema['carried'].dataType.simpleString()}, text string, n_chars long")
    return made.select(*[F.col(f"carried.{k}").alias(k) for k in carry], "text", "n_chars")
