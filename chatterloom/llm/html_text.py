"""Main text of web pages by a tree-structured graphical model over the DOM.

A page becomes a tree of its block elements (inline elements belong to the block around them). Every node is content or
not. A node's own potential comes from its tag, the words of its class, id and role, and measures of its text; an edge's
from the labels of parent and child and the kind of the child. The tree makes sum-product message passing exact: one
pass of messages from the leaves to the root, one back, and every node has its marginal. Blocks of nodes with a marginal
of a half or more are the text.

The weights are trained by gradient ascent on the conditional likelihood, whose gradient is the labels' feature counts
less those expected under the marginals. Labelled pages are laid out here in many ways, with known labels, around texts
of a bounded sample of the pages (``SAMPLE_PAGES``, by hash of the id).

Text is decoded, white space inside a block becomes one space, blocks are joined by a line feed; scripts, styles,
titles, comments and other unrendered parts are no text at all. A null html is empty, a page without text gives "".
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterloom.llm.common import map_arrow

SAMPLE_PAGES = 48

# Elements of HTML by their rendering.
BLOCK_TAGS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNRENDERED_TAGS = frozenset(
    "script style template title textarea iframe xmp noembed noframes select option button datalist".split()
)
RAW_TAGS = frozenset("script style title textarea iframe xmp noembed noframes".split())
# An open element of the key is closed by the start of one of the values.
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"},
}
TEXT_TAGS = ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "td", "th", "dd", "dt", "figcaption")
_TAGS = (*TEXT_TAGS, *"html body div section article main header footer nav aside form fieldset ul ol dl table tr figure address details dialog".split())
_TAG_AT = {t: i for i, t in enumerate(_TAGS)}
KEYWORDS = {
    "content": "article content post entry story main body text prose",
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager toc tabs skip links",
    "header": "header masthead top logo brand hero branding",
    "footer": "footer bottom copyright legal colophon",
    "side": "side sidebar aside rail widget widgets related recommend recommended popular trending more secondary",
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay message warning banner paywall toast privacy",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promoted promotion dfp adsense adslot commercial",
    "comment": "comment comments reply replies discussion disqus respond responses reader readers thread feedback",
    "form": "form search login signup subscribe newsletter register contact input",
    "social": "share sharing social follow like tweet tags meta byline author bio",
}
_KEYWORD_AT = {w: i for i, words in enumerate(KEYWORDS.values()) for w in words.split()}
_NUMBERS = 16
N_FEATURES = len(_TAGS) + 1 + len(KEYWORDS) + _NUMBERS
N_KINDS = 3  # of edges, by child: text block, item or cell, container
_KIND = {t: 0 for t in TEXT_TAGS} | {t: 1 for t in ("li", "td", "th", "dd", "dt")}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(?=/?[a-zA-Z])[^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|data-y)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.I) for t in RAW_TAGS}


@dataclass
class Page:
    """Nodes in page order (parents first) and blocks of text with the node each belongs to."""

    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    attributes: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)


def parse(source: str) -> Page:
    """Tolerant of unclosed and stray tags, in one scan."""
    page = Page()
    stack: list[tuple[str, int]] = []  # open elements with their node (that of the block around, for inline ones)
    pieces: list[str] = []
    links, hidden, at = 0, 0, 0

    def node(tag: str, attributes: str) -> int:
        above = stack[-1][1] if stack else -1
        page.parent.append(above)
        page.depth.append(page.depth[above] + 1 if above >= 0 else 0)
        page.tag.append(tag)
        page.attributes.append(attributes)
        page.linked.append(0)
        return len(page.parent) - 1

    stack.append(("", node("html", "")))

    def flush() -> None:
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                page.blocks.append((stack[-1][1], text))
            pieces.clear()

    def close(count: int) -> None:
        nonlocal links, hidden
        for _ in range(count):
            tag = stack[-1][0]
            if tag in BLOCK_TAGS:
                flush()
            links -= tag == "a"
            hidden -= tag in UNRENDERED_TAGS or tag == "head"
            stack.pop()

    def text(raw: str) -> None:
        if hidden:
            return
        pieces.append(raw)
        if links:
            page.linked[stack[-1][1]] += len(raw)

    n = len(source)
    while at < n:
        found = _MARKUP.search(source, at)
        if not found:
            text(source[at:])
            break
        if found.start() > at:
            text(source[at : found.start()])
        at = found.end()
        end, name, attributes = found.group(1, 2, 3)
        if name is None:
            continue
        tag = name.lower()
        if end:
            for back in range(len(stack) - 1, 0, -1):
                if stack[back][0] == tag:
                    close(len(stack) - back)
                    break
            continue
        if tag in VOID_TAGS:
            if tag == "br":
                text(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in RAW_TAGS:
            stop = _RAW_END[tag].search(source, at)
            at = stop.end() if stop else n
            continue
        if tag in BLOCK_TAGS:
            if tag in ("html", "body") and len(stack) == 1 and tag == "html":
                page.attributes[0] = attributes
                continue
            for back in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                open_tag = stack[back][0]
                if open_tag == "p" or tag in CLOSED_BY.get(open_tag, ()):
                    close(len(stack) - back)
                    break
                if open_tag in BLOCK_TAGS and not (tag in ("tr", "tbody", "tfoot") and open_tag in ("td", "th", "tr", "tbody", "thead")):
                    break
            if tag == "body":
                for back in range(len(stack) - 1, 0, -1):
                    if stack[back][0] == "head":
                        close(len(stack) - back)
                        break
            flush()
            stack.append((tag, node(tag, attributes)))
            continue
        if attributes.endswith("/") and tag not in UNRENDERED_TAGS:
            continue
        stack.append((tag, stack[-1][1]))
        links += tag == "a"
        hidden += tag in UNRENDERED_TAGS or tag == "head"
    close(len(stack) - 1)
    flush()
    return page


def features(page: Page) -> np.ndarray:
    """Nodes x features."""
    n = len(page.parent)
    size, words, sentences, commas, count = ([0] * n for _ in range(5))
    digits, marks = [0] * n, [0] * n
    for at, text in page.blocks:
        size[at] += len(text)
        words[at] += text.count(" ") + 1
        sentences[at] += text[-1] in ".!?…:;\"”»"
        commas[at] += text.count(",")
        digits[at] += sum(map(str.isdigit, text))
        marks[at] += "©" in text or "|" in text or "»" in text
        count[at] += 1
    below, linked_below, blocks_below = list(size), list(page.linked), list(count)
    children, paragraphs = [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        above = page.parent[i]
        below[above] += below[i]
        linked_below[above] += linked_below[i]
        blocks_below[above] += blocks_below[i]
        children[above] += 1
        paragraphs[above] += page.tag[i] == "p"
    grid = np.zeros((n, N_FEATURES), np.float32)
    for i in range(n):
        grid[i, _TAG_AT.get(page.tag[i], len(_TAGS))] = 1
        if page.attributes[i]:
            for found in _ATTRIBUTE.finditer(page.attributes[i]):
                if found.group(1).lower() != "data-y":
                    value = found.group(2) or found.group(3) or found.group(4) or ""
                    for word in _WORDS.findall(value):
                        at = _KEYWORD_AT.get(word.lower())
                        if at is not None:
                            grid[i, len(_TAGS) + 1 + at] = 1
    s, w, b, lb = (np.array(x, np.float32) for x in (size, words, below, linked_below))
    one = lambda x: np.array(x, np.float32)
    at = len(_TAGS) + 1 + len(KEYWORDS)
    grid[:, at:] = np.stack(
        [
            np.ones(n), np.log1p(s) / 5, np.minimum(one(page.linked) / np.maximum(s, 1), 1), np.log1p(w) / 4, one(sentences) > 0,
            np.minimum(one(commas) / np.maximum(w, 1) * 5, 1), np.minimum(one(digits) / np.maximum(s, 1) * 3, 1),
            one(marks) > 0, np.minimum(lb / np.maximum(b, 1), 1), np.log1p(b) / 8, b / max(float(b[0]) if n else 1, 1),
            np.minimum(one(page.depth) / 10, 1), np.log1p(one(children)) / 3, np.log1p(one(paragraphs)) / 3, (w > 0) & (w < 6),
            np.log1p(b / np.maximum(one(blocks_below), 1)) / 6,
        ],
        axis=1,
    )
    return grid


# Graphical model


@dataclass
class Forest:
    """Nodes of many pages: features, parents (-1 for roots), kinds of edges, and nodes by depth."""

    grid: np.ndarray
    parent: np.ndarray
    kind: np.ndarray
    levels: list[np.ndarray]


def forest(pages: list[Page]) -> Forest:
    sizes = [len(p.parent) for p in pages]
    first = np.cumsum(sizes) - sizes
    parent = np.concatenate([np.array(p.parent) + f if len(p.parent) else np.empty(0, np.int64) for p, f in zip(pages, first, strict=True)])
    depth = np.concatenate([np.array(p.depth) for p in pages])
    parent[depth == 0] = -1
    kind = np.array([_KIND.get(t, 2) for p in pages for t in p.tag])
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.nonzero(np.diff(depth[order]))[0] + 1)
    return Forest(np.concatenate([features(p) for p in pages]), parent, kind, levels)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    return np.logaddexp(np.take(x, 0, axis), np.take(x, 1, axis))


@dataclass
class Weights:
    node: np.ndarray  # features: score of content over not
    edge: np.ndarray  # kinds x label of parent x label of child


def sum_product(trees: Forest, weights: Weights) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of nodes (x 2) and of edges to the parents (x 2 x 2), and the log partition function."""
    n = len(trees.parent)
    own = np.zeros((n, 2))
    own[:, 1] = trees.grid @ weights.node
    edge = weights.edge[trees.kind]
    inside, up, down = own.copy(), np.zeros((n, 2)), np.zeros((n, 2))
    for level in reversed(trees.levels[1:]):  # children to parents
        up[level] = _log_sum(edge[level] + inside[level][:, None, :], axis=2)
        np.add.at(inside, trees.parent[level], up[level])
    total = inside.copy()
    for level in trees.levels[1:]:  # parents to children
        rest = total[trees.parent[level]] - up[level]
        down[level] = _log_sum(edge[level] + rest[:, :, None], axis=1)
        total[level] = inside[level] + down[level]
    log_z = _log_sum(total, axis=1)
    nodes = np.exp(total - log_z[:, None])
    child = trees.parent >= 0
    rest = total[trees.parent[child]] - up[child]
    pairs = np.exp(rest[:, :, None] + edge[child] + inside[child][:, None, :] - log_z[child][:, None, None])
    return nodes, pairs, float(log_z[~child].sum())


def train(pages: list[Page], labels: list[list[int]], *, steps: int = 200, rate: float = 0.15, decay: float = 1e-4) -> Weights:
    """Maximum conditional likelihood by Adam."""
    trees, truth = forest(pages), np.array([y for page in labels for y in page])
    child = trees.parent >= 0
    kind, above = trees.kind[child], truth[trees.parent[child]]
    seen_edges = np.zeros((N_KINDS, 2, 2))
    np.add.at(seen_edges, (kind, above, truth[child]), 1)
    seen_nodes = trees.grid.T @ truth
    weights, n = Weights(np.zeros(N_FEATURES), np.zeros((N_KINDS, 2, 2))), len(truth)
    state = [[np.zeros(N_FEATURES), np.zeros(N_FEATURES)], [np.zeros((N_KINDS, 2, 2)), np.zeros((N_KINDS, 2, 2))]]
    for step in range(1, steps + 1):
        nodes, pairs, _ = sum_product(trees, weights)
        expected = np.zeros((N_KINDS, 2, 2))
        np.add.at(expected, kind, pairs)
        slopes = [(seen_nodes - trees.grid.T @ nodes[:, 1]) / n - decay * weights.node, (seen_edges - expected) / n - decay * weights.edge]
        for value, slope, (mean, square) in zip((weights.node, weights.edge), slopes, state, strict=True):
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope * slope - square)
            value += rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return weights


# Labelled pages


class _Layouts:
    """Pages laid out around given sentences; every block element carries its label in ``data-y``."""

    def __init__(self, sentences: list[str], seed: int):
        self.rng, self.sentences = np.random.default_rng(seed), sentences or ["Some words of a sentence, and more of them."]

    def pick(self, *options: str) -> str:
        return options[self.rng.integers(len(options))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def words(self, low: int, high: int) -> str:
        many = self.pick(*self.sentences).split()
        return entities.escape(" ".join(many[: self.rng.integers(low, high + 1)]))

    def prose(self, low: int, high: int) -> str:
        return entities.escape(" ".join(self.pick(*self.sentences) for _ in range(self.rng.integers(low, high + 1))))

    def tag(self, name: str, y: int, inner: str, names: str = "") -> str:
        mark = f' {self.pick("class", "class", "id")}="{names}"' if names else ""
        return f'<{name}{mark} data-y="{y}">{inner}</{name}>'

    def named(self, group: str) -> str:
        word = self.pick(*KEYWORDS[group].split())
        return self.pick(word, f"{word}-{self.pick('box', 'wrap', 'inner', 'area', 'block')}", f"site-{word}", f"{word}{self.rng.integers(9)}")

    def box(self, tags: tuple[str, ...], group: str, inner: str) -> str:
        """Boilerplate: a telling tag, a telling name, or both."""
        tag = self.pick("div", "section", *tags)
        name = self.named(group) if tag in ("div", "section") or self.chance(0.5) else ""
        return self.tag(tag, 0, inner, name)

    def links(self, many: int, y: int = 0) -> str:
        return self.tag("ul", y, "".join(self.tag("li", y, f'<a href="/x">{self.words(1, 4)}</a>') for _ in range(many)))

    def paragraphs(self, y: int, low: int, high: int) -> str:
        return "".join(self.tag("p", y, self.prose(1, 6)) for _ in range(self.rng.integers(low, high + 1)))

    def menu(self) -> str:
        return self.box(("nav", "nav", "nav"), "menu", self.links(self.rng.integers(3, 9)))

    def header(self) -> str:
        inner = self.pick(self.tag("h1", 0, self.words(1, 4)), self.tag("p", 0, self.words(2, 8)), self.tag("div", 0, self.words(1, 4), "logo"))
        return self.box(("header", "header"), "header", inner + (self.menu() if self.chance(0.4) else ""))

    def footer(self) -> str:
        inner = self.pick("&copy; " + self.words(2, 8), self.tag("p", 0, "&copy; 2024 " + self.words(2, 10)), self.links(4), self.paragraphs(0, 1, 2))
        return self.box(("footer", "footer"), "footer", inner)

    def sidebar(self) -> str:
        inner = self.tag(self.pick("h2", "h3", "h4"), 0, self.words(1, 4)) + self.pick(self.links(4), self.paragraphs(0, 1, 2), self.tag("p", 0, self.words(4, 14)))
        return self.box(("aside", "aside"), "side", inner)

    def notice(self) -> str:
        inner = self.pick(self.tag("p", 0, self.prose(1, 2)), self.prose(1, 2))
        return self.box(("dialog",), "notice", inner + self.pick("", "<button>OK</button>", '<a href="#">' + self.words(1, 2) + "</a>"))

    def advert(self) -> str:
        return self.box((), "advert", self.pick(self.prose(1, 2), self.tag("p", 0, self.prose(1, 2)), f'<a href="/b">{self.words(2, 9)}</a>'))

    def form(self) -> str:
        inner = self.tag("p", 0, self.words(3, 12)) + f"<label>{self.words(1, 3)}</label><input name=q><button>{self.words(1, 2)}</button>"
        return self.tag("form", 0, inner, self.named("form")) if self.chance(0.7) else self.box(("fieldset",), "form", self.tag("form", 0, inner))

    def social(self) -> str:
        return self.box((), "social", self.pick(self.links(3), self.tag("p", 0, self.words(2, 6))))

    def comments(self) -> str:
        each = lambda: self.tag(self.pick("div", "li", "article"), 0, self.tag("p", 0, self.prose(1, 4)), self.pick("comment", "reply", "comment-body"))
        inner = self.tag(self.pick("h2", "h3"), 0, self.words(1, 3)) + "".join(each() for _ in range(self.rng.integers(1, 6)))
        if self.chance(0.3):
            inner = self.tag(self.pick("h2", "h3"), 0, self.words(1, 3)) + self.paragraphs(0, 1, 4)
        return self.box(("ol",) if self.chance(0.2) else (), "comment", inner)

    def article(self) -> str:
        parts = [self.tag(self.pick("h1", "h1", "h2"), 1, self.words(3, 14))]
        for _ in range(self.rng.integers(1, 9)):
            kind = self.rng.random()
            if kind < 0.66:
                parts.append(self.tag("p", 1, self.prose(1, 8) if self.chance(0.8) else self.words(1, 6)))
            elif kind < 0.76:
                parts.append(self.tag(self.pick("h2", "h3"), 1, self.words(2, 8)))
            elif kind < 0.83:
                parts.append(self.tag(self.pick("ul", "ol"), 1, "".join(self.tag("li", 1, self.words(3, 20)) for _ in range(4))))
            elif kind < 0.88:
                parts.append(self.tag("blockquote", 1, self.tag("p", 1, self.prose(1, 2)) if self.chance(0.5) else self.prose(1, 2)))
            elif kind < 0.92:
                rows = "".join(self.tag("tr", 1, self.tag("td", 1, self.words(1, 4)) + self.tag("td", 1, self.words(1, 4))) for _ in range(3))
                parts.append(self.tag("table", 1, rows))
            else:
                parts.append(self.pick(self.advert(), self.advert(), self.sidebar(), self.social(), self.form(), self.tag("pre", 1, self.prose(1, 1))))
        inner = "".join(parts)
        name = self.named("content") if self.chance(0.7) else ""
        root = self.rng.random()
        if root < 0.45:
            inner = self.tag("article", 1, inner, name if self.chance(0.4) else "")
        elif root < 0.6:
            inner = self.tag("main", 1, inner, name if self.chance(0.4) else "")
        elif root < 0.7:
            inner = self.tag("main", 1, self.tag("article", 1, inner))
        else:
            inner = self.tag(self.pick("div", "div", "section"), 1, inner, name or "content")
        return inner

    def page(self) -> str:
        maybe = lambda p, part: part() if self.chance(p) else ""
        before = [maybe(0.5, self.header), maybe(0.8, self.menu), maybe(0.4, self.advert), maybe(0.3, self.notice), maybe(0.2, self.form)]
        after = [maybe(0.4, self.sidebar), maybe(0.35, self.comments), maybe(0.25, self.advert), maybe(0.25, self.form), maybe(0.2, self.social), maybe(0.2, self.notice), maybe(0.8, self.footer)]
        middle = self.article()
        if self.chance(0.3):
            middle = self.tag("div", 0, middle + self.sidebar(), self.pick("container", "row", "layout", "columns"))
        inner = "".join(before) + middle + "".join(after)
        if self.chance(0.3):
            inner = self.tag("div", 0, inner, self.pick("page", "wrapper", "container", "outer", "site"))
        return f'<!DOCTYPE html><html><head><title>{self.words(2, 9)}</title><style>p{{}}</style></head><body data-y="0">{inner}</body></html>'


def labelled_pages(sentences: list[str], count: int = 320, seed: int = 3) -> tuple[list[Page], list[list[int]]]:
    layouts = _Layouts(sentences, seed)
    pages = [parse(layouts.page()) for _ in range(count)]
    marks = [[(m := re.search(r'data-y="(\d)"', a)) and int(m[1]) or 0 for a in p.attributes] for p in pages]
    return pages, marks


# Spark


def main_text(pages: list[Page], weights: Weights) -> list[str]:
    """The content blocks of each page."""
    if not pages:
        return []
    nodes, _, _ = sum_product(forest(pages), weights)
    texts, first = [], 0
    for page in pages:
        texts.append("\n".join(text for at, text in page.blocks if nodes[first + at, 1] >= 0.5))
        first += len(page.parent)
    return texts


def sentences_of(pages: DataFrame, id_col: str, html_col: str, sample: int) -> list[str]:
    """Sentences of a bounded sample: the pages of ``sample`` ids (twice as many pages at most, where ids repeat).

    The first 400 sentences of a block are taken. They are trained on, never a result.
    """
    known = pages.filter(F.col(html_col).isNotNull() & F.col(id_col).isNotNull())
    # The ids first, so that a task sends the driver numbers and not pages.
    picked = known.select(id_col).orderBy(F.xxhash64(id_col), id_col).limit(sample).collect()
    chosen = known.filter(F.col(id_col).isin([r[0] for r in picked])).select(id_col, html_col)
    rows = sorted(chosen.limit(2 * sample).collect(), key=lambda r: (r[0], r[1]))
    texts = [text for row in rows for _, text in parse(row[1]).blocks]
    return [s for text in texts for s in re.split(r"(?<=[.!?])\s+", text)[:400] if s.count(" ") >= 3]


def fit(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE_PAGES, **options) -> Weights:
    return train(*labelled_pages(sentences_of(pages, id_col, html_col, sample)), **options)


def extract(pages: DataFrame, weights: Weights, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` for every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = main_text([parse(h or "") for h in part.column("html").to_pylist()], weights)
                arrays = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars"])

    narrow = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = narrow.schema["page_id"].dataType.simpleString()
    return map_arrow(narrow, work, f"page_id {kind}, url string, text string, n_chars bigint")
