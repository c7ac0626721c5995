"""Operator 3: main text of web pages by minimum-cut labelling.

A page is parsed into text blocks. A linear classifier over a block's containers, class
names, length and links gives each block a score; the score's two signs become capacities
to the terminals "content" and "boilerplate". Neighbouring blocks, and consecutive blocks of
one container, are tied by smoothness edges that weigh more the closer they stand in the
element tree. The minimum cut between the terminals is the labelling with the least cost;
the content blocks, in page order, are the text.

Noise names (``sidebar``, ``social``) count as a name's parts, but not after a word of state
(``has-sidebar``, ``tag-news``) and not on html, body, main or an outer article. A noise name or
form that is page-wide costs nothing: it holds most of the page's unlinked text and all of its
main (or article) elements; where there are none, four fifths of the text.

A block whose score outweighs all its edges keeps its sign in every minimum cut, so such
blocks are fixed first and only the rest goes through max-flow.

Null or empty html, or a page without content: empty text and 0 characters. White space
inside a block is one space, line breaks (``br``) included. Rows repeat as in the input;
further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traveltiers.llm.common import map_batches, table

# Element kinds and class names that the classifier looks at.
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav noscript object ol
optgroup option p pre section select summary table tbody td template textarea tfoot th thead title tr ul svg video audio canvas""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER = frozenset("head title script style noscript template select option optgroup button textarea iframe object svg video audio canvas dialog menu".split())
AROUND = frozenset("nav footer aside form".split())
BODY_NAMES = frozenset("article articlebody content entry main maincontent post postbody story storybody text".split())
NOISE_NAMES = frozenset("""ad ads adbox adsense advert advertisement adverts alert banner breadcrumb breadcrumbs byline-share
captcha comment comments commentlist consent cookie cookies copyright cta dialog discussion disqus feedback footer form gdpr
header hidden legal login masthead menu modal nav navbar navigation newsletter notice notification overlay pager pagination
popup privacy promo promoted promotion recommended related replies reply respond search share sharing sidebar signup site-header
social sponsor sponsored subscribe subscription tags teaser toolbar topbar warning widget widgets""".split())
#: First parts of a class or id that say something of the element and don't name it.
STATES = frozenset("has with without no not is tag category cat layout enable enabled".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())

# Classifier weights, in thousandths (capacities are whole numbers).
BIAS, IN_BODY, NEVER_COST, AROUND_COST, NOISE_COST, HEADER_COST = -500, 4000, -60000, -9000, -13000, -5000
PARAGRAPH, HEADING, PER_WORD, MOST_WORDS, SENTENCE, LINKS = 1000, 300, 60, 2500, 400, -5000
# Smoothness: base of neighbours, its part that fades with tree distance, and of a container's consecutive blocks.
NEAR, CLOSE, SAME = 150, 900, 500

_NAME = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")


class Element:
    """An open element. What its ancestors say of it is told once, when it opens, so a page costs the same at any depth."""

    __slots__ = ("tag", "parent", "depth", "mark", "wide", "never", "aside", "main", "article", "own", "outer", "most", "least")

    def __init__(self, tag: str, parent: Element | None, attrs: list):
        self.tag, self.parent = tag, parent
        self.mark, self.wide = marks(tag, attrs, tag == "article" and parent is not None and parent.article is not None)
        self.never = self.mark <= NEVER_COST  # something around it is never text
        self.aside = tag in ("nav", "aside", "footer")
        self.main = self.article = None  # the outermost ones around it, itself included
        self.depth, self.own, self.outer = 1, 0, 0
        if parent:
            self.depth = parent.depth + 1
            self.never, self.aside = self.never or parent.never, self.aside or parent.aside
            self.main, self.article = parent.main, parent.article
        if tag == "main" and not self.main:
            self.main = self
        elif tag == "article" and not self.article:
            self.article = self


class Block:
    __slots__ = ("text", "at", "words", "linked")

    def __init__(self, text: str, at: Element | None, linked: int):
        self.text, self.at, self.linked = text, at, linked
        self.words = text.count(" ") + 1


class Parser(HTMLParser):
    """Blocks of text, each with the innermost open element around it, and all elements, parents first."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.elements: list[Element] = []
        self.at: Element | None = None
        self.open: Counter = Counter()
        self.parts: list[str] = []
        self.link = self.linked = 0
        self.raw = ""

    def flush(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                self.blocks.append(Block(text, self.at, self.linked))
            self.parts, self.linked = [], 0

    def close_one(self) -> None:
        self.open[self.at.tag] -= 1
        self.at = self.at.parent

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.parts.append(" ")
        elif tag == "a":
            self.link += 1
        elif tag in ("script", "style"):
            self.raw = tag
        elif tag in BLOCKS:
            self.flush()
            self.link = 0
            inside = self.at.tag if self.at else ""
            if inside == "p" or inside in HEADINGS and tag in HEADINGS or tag == inside and tag in ("li", "dt", "dd", "td", "th", "tr", "option"):
                self.close_one()
            if tag not in VOID:
                self.at = Element(tag, self.at, attrs)
                self.elements.append(self.at)
                self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag not in ("a", "script", "style"):
            self.handle_starttag(tag, attrs)
            if tag in BLOCKS and tag not in VOID:
                self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.link = max(0, self.link - 1)
        elif tag in ("script", "style"):
            self.raw = ""
        elif tag in BLOCKS:
            self.flush()
            if self.open[tag]:
                while self.at.tag != tag:
                    self.close_one()
                self.close_one()

    def handle_data(self, data: str) -> None:
        if not self.raw:
            self.parts.append(data)
            if self.link:
                self.linked += len(data)


def marks(tag: str, attrs: list, nested: bool = False) -> tuple[int, int]:
    """The classifier's weight of one open element, and its weight where it is page-wide."""
    at = {k: v or "" for k, v in attrs if k in ("class", "id", "role", "hidden", "style", "aria-hidden", "itemprop")} if attrs else {}
    score = NEVER_COST if tag in NEVER else AROUND_COST if tag in AROUND else HEADER_COST if tag == "header" else IN_BODY if tag in ("article", "main") else 0
    wide = 0 if tag == "form" else score
    if at:
        names, parts = set(), set()
        for k in ("class", "id", "itemprop"):
            for name in at.get(k, "").lower().split():
                own = _NAME.split(name)
                names.add(name)
                names.update(own)
                parts.update([name] if own[0] in STATES else [name, *own])
        if at.get("role", "").lower() in NOISE_ROLES or "hidden" in at or at.get("aria-hidden") == "true" or "display:none" in at.get("style", "").replace(" ", ""):
            return score + NOISE_COST, score + NOISE_COST
        noise = parts & NOISE_NAMES and (nested or tag not in ("html", "body", "main", "article"))
        if tag not in ("html", "body") and (names & BODY_NAMES or at.get("role", "").lower() in ("main", "article")):
            wide = max(wide, IN_BODY)
            score = score if noise else max(score, IN_BODY)
        if noise:
            score += NOISE_COST
    return score, wide


def page_wide(blocks: list[Block], elements: list[Element]) -> set[Element]:
    """The page-wide elements among those whose noise name or form would cost; one pass from the leaves up."""
    asked = [e for e in elements if e.mark < e.wide]
    if not asked:
        return set()
    total, outer = 0, {"main": set(), "article": set()}
    for b in blocks:
        at = b.at
        if at and at.never:
            continue
        own = len(b.text) - min(b.linked, len(b.text))
        total += own
        if at:
            at.own += own
            if not at.aside:
                outer["main"].add(at.main)
                outer["article"].add(at.article)
    around = outer["main"] - {None} or outer["article"] - {None}
    for e in reversed(elements):  # then ``own`` is an element's text and ``outer`` the number of ``around`` below it
        if e.parent:
            e.parent.own += e.own
            e.parent.outer += e.outer + (e in around)
    if around:
        return {e for e in asked if e.outer == len(around) and 2 * e.own > total}
    return {e for e in asked if 5 * e.own >= 4 * total}


def weigh(elements: list[Element], wide: set[Element]) -> None:
    """The greatest and the least mark around each element, 0 included."""
    for e in elements:
        own = e.wide if e in wide else e.mark
        e.most = max(e.parent.most if e.parent else 0, own)
        e.least = min(e.parent.least if e.parent else 0, own)


def classify(b: Block) -> int:
    """The block's score, once its elements are weighed: above 0 for content."""
    score, tag = BIAS, ""
    if b.at:
        score, tag = BIAS + b.at.most + b.at.least, b.at.tag
    score += PARAGRAPH if tag in ("p", "blockquote", "pre") else HEADING if tag in HEADINGS else 0
    score += min(MOST_WORDS, PER_WORD * b.words) + SENTENCE * (b.text[-1] in ".!?…”\"")
    return score + LINKS * min(b.linked, len(b.text)) // len(b.text)


def steps(a: Element | None, b: Element | None) -> int:
    """Elements that are around one of two places and not around the other."""
    n = 0
    while a is not b:
        n += 1
        if (a.depth if a else 0) >= (b.depth if b else 0):
            a = a.parent
        else:
            b = b.parent
    return n


def edges(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """Smoothness edges (block, later block, weight)."""
    out, last = [], {}
    for i, b in enumerate(blocks):
        home = b.at.parent if b.at else None
        if i:
            out.append((i - 1, i, NEAR + CLOSE // (1 + max(0, steps(blocks[i - 1].at, b.at) - 2))))
        if home in last and last[home] != i - 1:
            out.append((last[home], i, SAME))
        last[home] = i
    return out


def cut_labels(scores: list[int], ties: list[tuple[int, int, int]]) -> list[bool]:
    """Labels of the minimum cut (True: content); of equal cuts, the one with the most boilerplate."""
    n = len(scores)
    near: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for a, b, w in ties:
        near[a].append((b, w))
        near[b].append((a, w))
    score, free = list(scores), [True] * n
    todo = deque(range(n))
    while todo:  # a block that outweighs its free neighbours is settled, and pulls them
        i = todo.popleft()
        if free[i] and abs(score[i]) > sum(w for j, w in near[i] if free[j]):
            free[i] = False
            for j, w in near[i]:
                if free[j]:
                    score[j] += w if score[i] > 0 else -w
                    todo.append(j)
    rest = [i for i in range(n) if free[i]]
    label = [s > 0 for s in score]
    if rest:
        at = {i: k for k, i in enumerate(rest)}
        inside = max_flow_side([score[i] for i in rest], [(at[a], at[b], w) for a, b, w in ties if free[a] and free[b]])
        for i, x in zip(rest, inside):
            label[i] = x
    return label


def max_flow_side(scores: list[int], ties: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay on the source's side once shortest augmenting paths saturate the cut."""
    n = len(scores)
    source, sink = n, n + 1
    to, left, out = [], [], [[] for _ in range(n + 2)]

    def arc(a: int, b: int, there: int, back: int) -> None:
        out[a].append(len(to)); to.append(b); left.append(there)  # noqa: E702
        out[b].append(len(to)); to.append(a); left.append(back)  # noqa: E702

    for i, s in enumerate(scores):
        arc(source, i, max(s, 0), 0)
        arc(i, sink, max(-s, 0), 0)
    for a, b, w in ties:
        arc(a, b, w, w)
    while True:
        depth = [-1] * (n + 2)
        depth[source], queue = 0, deque([source])
        while queue:
            x = queue.popleft()
            for e in out[x]:
                if left[e] and depth[to[e]] < 0:
                    depth[to[e]] = depth[x] + 1
                    queue.append(to[e])
        if depth[sink] < 0:
            return [d >= 0 for d in depth[:n]]
        nxt, path, x = [0] * (n + 2), [], source
        while True:  # one blocking flow over the layers, without recursion
            if x == sink:
                push = min(left[e] for e in path)
                for e in path:
                    left[e] -= push
                    left[e ^ 1] += push
                k = next(k for k, e in enumerate(path) if not left[e])
                x, path = to[path[k] ^ 1], path[:k]
            while nxt[x] < len(out[x]) and not (left[e := out[x][nxt[x]]] and depth[to[e]] == depth[x] + 1):
                nxt[x] += 1
            if nxt[x] < len(out[x]):
                path.append(e)
                x = to[e]
            elif x == source:
                break
            else:
                x = to[path.pop() ^ 1]
                nxt[x] += 1


def main_text(html: str | None) -> str:
    if not html:
        return ""
    parser = Parser()
    parser.feed(html)
    parser.close()
    parser.flush()
    blocks = parser.blocks
    weigh(parser.elements, page_wide(blocks, parser.elements))
    label = cut_labels([classify(b) for b in blocks], edges(blocks))
    return "\n\n".join(b.text for b, x in zip(blocks, label) if x)


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns with ``text`` and ``n_chars`` of every row."""
    named = pages.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{html}`").alias("__html"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema.fields[:-1])

    def run(cols: dict) -> dict:
        texts = [main_text(x) for x in cols["__html"]]
        return cols | {"__text": texts, "__n": [len(t) for t in texts]}

    out = map_batches(named, run, f"{kinds}, __text string, __n long")
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], F.col("__text").alias("text"), F.col("__n").alias("n_chars"))


def query(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
