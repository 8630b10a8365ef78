"""Main text of web pages by a tree-structured graphical model.

Every block element of a page is a node with two states, content or not. Node potentials come from the
element's tag and names and from the text in and below it; edge potentials tie child to parent.
Sum-product message passing, up the tree and down again, gives each node its exact marginal, and text
stays where content is likelier than not. The weights are trained by gradient ascent on the
likelihood of labelled pages, whose expected counts come from the same message passing.

Labelled pages are made from a bounded sample of the pages themselves: those whose markup says what the
article is, and pages laid out anew from their texts in many ways, whose labels are known by construction.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.llm.columns import text_of

# How the elements of HTML behave.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr br object math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded"
    " mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style noscript template title textarea svg iframe select option datalist annotation annotation-xml".split())
RAW = frozenset("script style textarea title noscript iframe".split())
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section"
    " table ul".split()
)
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("ul ol dl table body html".split())
P_SCOPES = frozenset("#root html table td th caption button object template applet marquee".split())
TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>"
    r"|<([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*|[^>]*)>",
    re.DOTALL,
)
OPEN_COMMENT = re.compile(r"()()<!--.*\Z", re.DOTALL)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
PIECE = re.compile(r"[a-z]+")
WHITE = re.compile(r"[\x20\x09-\x0D]+")
SECTION = frozenset("nav header footer aside form article main section".split())
BITS, TURNS = 14, 2
SAYS, LEAST_WORDS = r"(?i)<(article|main)[\s/>]", 8


@dataclass
class Page:
    """Nodes in page order (a parent before its children) and text blocks with the node each belongs to."""

    tags: list[str] = field(default_factory=list)
    names: list[list[str]] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    words: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    marks: list[int] = field(default_factory=list)
    hidden: list[bool] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)

    def open(self, tag: str, attributes: str, parent: int) -> int:
        names = [] if not attributes else [
            w for m in NAMES.findall(attributes) for w in PIECE.findall("".join(m).lower())
        ]
        self.tags.append(tag)
        self.names.append(names)
        self.parents.append(parent)
        self.hidden.append(tag in HIDDEN or parent >= 0 and self.hidden[parent])
        for counts in (self.words, self.linked, self.marks):
            counts.append(0)
        return len(self.tags) - 1


def parsed(html: str) -> Page:
    """The page as a tree of block elements; inline elements only tell which words are links.

    Each step takes time by what it reads or closes, so that broken markup of any kind is read in linear time.
    """
    page = Page()
    stack = [page.open("#root", "", -1)]
    # where in the stack each tag is open, lowest first; and where a search for an open p, or for an item, stops
    at_tag: dict[str, list[int]] = defaultdict(list)
    p_scopes, scopes = [0], [0]
    texts: list[str] = []
    links, linked_words = 0, 0

    def flush() -> None:
        nonlocal linked_words
        text = WHITE.sub(" ", "".join(texts)).strip(" ")
        texts.clear()
        node = stack[-1]
        if text and not page.hidden[node]:
            page.blocks.append((node, text))
            n = text.count(" ") + 1
            page.words[node] += n
            page.linked[node] += min(linked_words, n)
            page.marks[node] += sum(map(text.count, ",.;!?"))
        linked_words = 0

    def close(upto: int) -> None:
        nonlocal links
        flush()
        links = 0
        while len(stack) > upto:
            tag = page.tags[stack.pop()]
            at_tag[tag].pop()
            for held, kinds in ((p_scopes, P_SCOPES), (scopes, SCOPES)):
                if tag in kinds:
                    held.pop()

    def add(text: str) -> None:
        nonlocal linked_words
        if text:
            text = unescape(text) if "&" in text else text
            texts.append(text)
            if links:
                linked_words += len(text.split())

    # behind the last > no tag can end, and a comment without an end runs to the end of the page
    at, last, raw_end = 0, html.rfind(">"), None
    while (m := TAG.search(html, at, last + 1)) or (m := OPEN_COMMENT.search(html, max(at, last))):
        add(html[at : m.start()])
        at = m.end()
        end, tag = m[1], m[2]
        if html.startswith("<!--", m.start()) and not html.endswith("-->", m.start() + 4, at):
            at = len(html)
        if end:
            end = end.lower()
            if end == "a":
                links = max(links - 1, 0)
            elif end not in INLINE:
                if at_tag[end]:
                    close(at_tag[end][-1])
                else:
                    flush()
        elif tag:
            tag = tag.lower()
            if tag == "br":
                texts.append(" ")
            elif tag == "a":
                links = 1
            elif tag not in INLINE:
                if tag in CLOSES_P and at_tag["p"] and at_tag["p"][-1] > p_scopes[-1]:
                    close(at_tag["p"][-1])
                # all open items of its kind that no list or table shields
                found = [k for x in ENDED_BY.get(tag, ()) for k in at_tag[x][bisect_right(at_tag[x], scopes[-1]) :]]
                if found:
                    close(min(found))
                flush()
                node = page.open(tag, m[3] or "", stack[-1])
                if tag not in VOID:
                    at_tag[tag].append(len(stack))
                    for held, kinds in ((p_scopes, P_SCOPES), (scopes, SCOPES)):
                        if tag in kinds:
                            held.append(len(stack))
                    stack.append(node)
                if tag in RAW and (raw_end := re.compile(rf"</{tag}", re.IGNORECASE).search(html, at)):
                    at = raw_end.start()
                elif tag in RAW:
                    at = len(html)
    add(html[at:])
    close(1)
    return page


def _slot(kind: str, value: object) -> int:
    return _slots_memory(f"{kind} {value}")


@lru_cache(maxsize=100_000)
def _slots_memory(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) >> (32 - BITS)


def _size(n: int) -> int:
    return n.bit_length()


def node_slots(page: Page) -> tuple[list[list[int]], list[list[int]]]:
    """Features of every node, and those that a node gives to all nodes below it.

    What a node lies in, the names of all elements around it, is said once where a name first occurs on the way down.
    """
    n = len(page.tags)
    words, linked, paragraphs = page.words[:], page.linked[:], [int(t == "p") for t in page.tags]
    for i in range(n - 1, 0, -1):
        p = page.parents[i]
        words[p] += words[i]
        linked[p] += linked[i]
        paragraphs[p] += paragraphs[i]
    whole, depth, own_slots, given = max(words[0], 1), [0] * n, [], []
    way: list[tuple[int, set[str]]] = []  # the open nodes and the names that each has added
    around: set[str] = set()
    for i in range(n):
        p, tag = page.parents[i], page.tags[i]
        while way and way[-1][0] != p:
            around -= way.pop()[1]
        if i:
            depth[i] = depth[p] + 1
        more = ({*page.names[i], *((tag,) if tag in SECTION else ())} if i else set()) - around
        around |= more
        way.append((i, more))
        given.append([_slot("inside", w) for w in sorted(more)])
        own, links = page.words[i], 4 * linked[i] // max(words[i], 1)
        slots = [
            _slot("tag", tag), _slot("own", _size(own)), _slot("words", _size(words[i])), _slot("links", (links, words[i] > 0)),
            _slot("share", 8 * words[i] // whole), _slot("paragraphs", min(paragraphs[i], 6)), _slot("depth", min(depth[i], 8)),
            _slot("place", 6 * i // n), _slot("marks", min(8 * page.marks[i] // max(own, 1), 6) if own else "none"),
            _slot("tag own", (tag, _size(own) // 2)), _slot("tag links", (tag, links)),
        ]
        own_slots.append(slots + [_slot("name", w) for w in page.names[i]])
    return own_slots, given


def _flat(slots: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All slots in one array, and the node of each."""
    return np.array([s for row in slots for s in row], int), np.repeat(np.arange(len(slots)), [len(row) for row in slots])


@dataclass(frozen=True)
class Model:
    weights: bytes = b""
    edges: tuple = ()


class Forest:
    """Nodes of many pages in one set of arrays, ordered for message passing level by level."""

    def __init__(self, pages: list[Page]):
        slots, given, parents, kinds, offset = [], [], [], [], 0
        for page in pages:
            for all_, own in zip((slots, given), node_slots(page)):
                all_ += own
            parents += [p + offset if p >= 0 else -1 for p in page.parents]
            kinds += [int(t in SECTION) for t in page.tags]
            offset += len(page.tags)
        self.n = offset
        self.parents, self.kinds = np.array(parents, int), np.array(kinds, int)
        (self.flat, self.owner), (self.given, self.giver) = _flat(slots), _flat(given)
        depth = np.zeros(self.n, int)
        for i in range(self.n):
            if parents[i] >= 0:
                depth[i] = depth[parents[i]] + 1
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if self.n else []

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Sum of the weights of each node's features, those given by the nodes around it included."""
        passed = np.bincount(self.giver, weights[self.given], self.n)
        around = np.zeros(self.n)
        for level in self.levels[1:]:
            parents = self.parents[level]
            around[level] = around[parents] + passed[parents]
        return np.bincount(self.owner, weights[self.flat], self.n) + around

    def summed(self, x: np.ndarray) -> np.ndarray:
        """By slot, the sum of ``x`` over the nodes that have it: the transpose of ``scores``."""
        below = np.zeros(self.n)
        for level in self.levels[:0:-1]:
            np.add.at(below, self.parents[level], below[level] + x[level])
        return np.bincount(self.flat, x[self.owner], 1 << BITS) + np.bincount(self.given, below[self.giver], 1 << BITS)

    def marginals(self, weights: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of node states, and of (parent, child) states; messages as log potentials."""
        unary = np.zeros((self.n, 2))
        unary[:, 1] = self.scores(weights)
        up, sent = unary.copy(), np.zeros((self.n, 2))
        for level in self.levels[:0:-1]:
            x = edges[self.kinds[level]] + up[level][:, None, :]  # parent state, child state
            sent[level] = np.logaddexp(x[:, :, 0], x[:, :, 1])
            np.add.at(up, self.parents[level], sent[level])
        whole = up.copy()
        pair = np.zeros((self.n, 2, 2))
        for level in self.levels[1:]:
            rest = whole[self.parents[level]] - sent[level]  # what the parent knows apart from this child
            x = edges[self.kinds[level]] + rest[:, :, None]
            joint = x + up[level][:, None, :]
            whole[level] = np.logaddexp(x[:, 0], x[:, 1]) + up[level]
            joint -= joint.max((1, 2), keepdims=True)
            pair[level] = np.exp(joint) / np.exp(joint).sum((1, 2), keepdims=True)
            # kept small: only differences matter
            whole[level] -= whole[level].max(1, keepdims=True)
        one = 1 / (1 + np.exp(np.clip(whole[:, 0] - whole[:, 1], -50, 50)))
        return one, pair


def train_model(pages: list[Page], labels: list[list[int]], epochs: int = 150) -> Model:
    forest = Forest(pages)
    y = np.array([v for page in labels for v in page], float)
    weights, edges = np.zeros(1 << BITS), np.zeros((TURNS, 2, 2))
    past, past_edges = np.full_like(weights, 1e-3), np.full_like(edges, 1e-3)
    child = np.flatnonzero(forest.parents >= 0)
    truth = np.zeros_like(edges)
    np.add.at(truth, (forest.kinds[child], y[forest.parents[child]].astype(int), y[child].astype(int)), 1.0)
    for _ in range(epochs):
        one, pair = forest.marginals(weights, edges)
        gradient = forest.summed(y - one) / len(pages) - 1e-3 * weights
        expected = np.zeros_like(edges)
        np.add.at(expected, forest.kinds[child], pair[child])
        edge_gradient = (truth - expected) / len(pages) - 1e-3 * edges
        past += gradient**2
        past_edges += edge_gradient**2
        weights += 0.2 * gradient / np.sqrt(past)
        edges += 0.2 * edge_gradient / np.sqrt(past_edges)
    return Model(weights.astype(np.float32).tobytes(), tuple(edges.ravel().tolist()))


# What stands beside an article, by element and by names; fixed values that the labelled layouts draw from.
CONTENT_NAMES = (
    "article post entry content story main body text entry-content post-body article-body page-content article__text"
).split()
BESIDE = {
    "nav": "nav menu navbar navigation topnav main-menu breadcrumbs toc pagination pager tabs".split(),
    "header": "header masthead site-header page-header topbar branding logo banner".split(),
    "footer": "footer site-footer page-footer copyright bottom legal colophon credits".split(),
    "aside": "sidebar side widget related recommended popular trending rail more-stories".split(),
    "div.ad": "ad ads advert advertisement sponsor sponsored promo ad-slot adsbygoogle banner-ad".split(),
    "div.notice": "notice cookie cookies consent gdpr alert warning message announcement popup modal paywall".split(),
    "form": "form search login signup subscribe newsletter contact".split(),
    "section.comments": "comments comment responses replies discussion disqus comment-list reader-comments".split(),
    "div.share": "share social sharing tags meta byline toolbar author-bio follow".split(),
}


def layout(draw: random.Random, paragraphs: list[str], title: str, phrases: list[str]) -> str:
    """A page made from given texts; content elements carry the attribute ``data-y`` that labels are read from."""

    def some(n: int) -> list[str]:
        return [draw.choice(phrases) for _ in range(n)]

    def named(tag: str, names: list[str], inner: str, y: int = 0) -> str:
        name = draw.choice(names)
        how = draw.choice([f' class="{name}"', f' id="{name}"', f' class="{name} {draw.choice("abcxyz")}{draw.randint(1, 9)}"', ""])
        if not how and tag in ("div", "section"):
            how = f' class="{name}"'
        return f"<{tag}{how}{' data-y' if y else ''}>{inner}</{tag}>"

    def beside(kind: str) -> str:
        tag, names = kind.partition(".")[0], BESIDE[kind]
        tag = tag if tag != "div" and draw.random() < 0.5 else "div"
        if kind in ("nav", "aside", "div.share", "footer", "header") and draw.random() < 0.7:
            inner = "<ul>" + "".join(f'<li><a href="/{i}">{x}</a></li>' for i, x in enumerate(some(draw.randint(2, 8)))) + "</ul>"
            inner += draw.choice(["", f"<p>{draw.choice(phrases)}</p>"])
        elif kind == "form":
            inner = f'<label>{draw.choice(phrases)}</label><input type="text"><button>{draw.choice(phrases)}</button>'
        elif kind == "section.comments":
            item = draw.choice(["li", "div", "article"])
            body = "".join(
                f'<{item} class="{draw.choice(["comment", "reply", "comment-body"])}"><p>{draw.choice(paragraphs)[: draw.randint(30, 300)]}</p></{item}>'
                for _ in range(draw.randint(1, 5))
            )
            inner = f"<h3>{draw.choice(phrases)}</h3>" + (f"<ul>{body}</ul>" if item == "li" else body)
        else:
            inner = draw.choice(["{}", "<p>{}</p>", "<div>{}</div>"]).format(draw.choice([*some(2), draw.choice(paragraphs)[:160]]))
        return named(tag, names, inner)

    body = []
    for x in paragraphs:
        kind = draw.random()
        if kind < 0.78:
            body.append(f"<p data-y>{x}</p>")
        elif kind < 0.84:
            body.append("<ul data-y>" + "".join(f"<li data-y>{w}</li>" for w in x.split(". ")[:6]) + "</ul>")
        elif kind < 0.9:
            body.append(f"<blockquote data-y><p data-y>{x}</p></blockquote>")
        else:
            body.append(f"<div data-y>{x}</div>")
        if draw.random() < 0.08:
            body.append(f"<h2 data-y>{draw.choice(phrases)}</h2>")
        if draw.random() < 0.05:
            body.append(beside(draw.choice(["div.ad", "div.share", "aside"])))
    head = f"<h1 data-y>{title}</h1>"
    content = draw.choice(["article", "main", "div", "div", "section"])
    inner = draw.choice(["", beside("div.share")]) + "".join(body)
    if draw.random() < 0.4:
        inner = named("div", CONTENT_NAMES, inner, 1)
    core = named(content, CONTENT_NAMES, head + inner, 1)
    before = [beside(k) for k in draw.sample(["nav", "header", "div.ad", "div.notice", "form", "aside"], draw.randint(1, 5))]
    after = [beside(k) for k in draw.sample(["footer", "aside", "section.comments", "div.ad", "form", "div.notice", "nav"], draw.randint(1, 5))]
    middle = core + draw.choice(["", beside("aside")])
    if draw.random() < 0.5:
        middle = f'<div class="{draw.choice(["container", "wrapper", "row", "page", "layout"])}" data-y>{middle}</div>'
    return f"<html data-y><head><title>{title}</title></head><body data-y>{''.join(before)}{middle}{''.join(after)}</body></html>"


def labels_by_mark(html: str) -> tuple[Page, list[int]]:
    page, marked = parsed(html.replace(" data-y", ' class="zzlabelzz"')), []
    for i, names in enumerate(page.names):
        marked.append(int(i == 0 or "zzlabelzz" in names))
        page.names[i] = [w for w in names if w != "zzlabelzz"]
    return page, marked


def labels_by_markup(page: Page) -> list[int] | None:
    """Content is what lies in the page's article or main element, without what is marked as standing beside it."""
    core = "main" if "main" in page.tags else "article"
    if core not in page.tags:
        return None
    beside = {w for names in BESIDE.values() for w in names}
    inside, out = [], []
    for i, tag in enumerate(page.tags):
        p = page.parents[i]
        within = tag == core or p >= 0 and inside[p]
        within = within and tag not in ("nav", "footer", "aside", "form") and not beside & set(page.names[i]) and not page.hidden[i]
        inside.append(within)
        out.append(int(within))
    for i in range(len(out) - 1, 0, -1):  # what holds content is content
        out[page.parents[i]] |= out[i]
    return out


def not_beside(page: Page) -> list[bool]:
    """Whether a node lies in no element that is named or made for what stands beside an article."""
    beside, out = {w for names in BESIDE.values() for w in names}, []
    for i, tag in enumerate(page.tags):
        p = page.parents[i]
        out.append((p < 0 or out[p]) and tag not in ("nav", "header", "footer", "aside", "form") and not beside & set(page.names[i]))
    return out


def train(htmls: list[str], layouts: int = 3) -> Model:
    """Fit on pages that say by their markup what their article is, and on pages laid out anew from the texts of all."""
    pages, labels = [], []
    drawn = random.Random(7)
    for html in htmls:
        page = parsed(html)
        y = labels_by_markup(page)
        if y is not None:
            pages.append(page)
            labels.append(y)
            paragraphs = [t for i, t in page.blocks if y[i]]
            phrases = [t[:60] for i, t in page.blocks if not y[i]] or ["more"]
        else:  # which texts are the article's isn't known, and needn't be: their labels come with the layout
            free = not_beside(page)
            like = [free[i] and (page.tags[i] == "p" or len(t.split()) >= LEAST_WORDS) for i, t in page.blocks]
            paragraphs = [t for (_, t), x in zip(page.blocks, like) if x] or [t for _, t in page.blocks]
            phrases = [t[:60] for (_, t), x in zip(page.blocks, like) if not x] or ["more"]
        if not paragraphs:
            continue
        escaped = [t.replace("&", "&amp;").replace("<", "&lt;") for t in paragraphs]
        phrases = [t.replace("&", "&amp;").replace("<", "&lt;") for t in phrases]
        for _ in range(layouts):
            page, y = labels_by_mark(layout(drawn, escaped[:30], escaped[0][:80], phrases))
            pages.append(page)
            labels.append(y)
    return train_model(pages, labels) if pages else Model()


@lru_cache(maxsize=2)
def _arrays(model: Model) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(model.weights, np.float32).astype(float), np.array(model.edges).reshape(TURNS, 2, 2)


def main_texts(htmls: list[str], model: Model) -> list[str]:
    """Text of the content blocks of each page, blocks joined by an empty line."""
    pages = [parsed(x) for x in htmls]
    if not model.weights:
        return ["\n\n".join(t for _, t in page.blocks) for page in pages]
    one, _ = Forest(pages).marginals(*_arrays(model))
    out, offset = [], 0
    for page in pages:
        out.append("\n\n".join(t for i, t in page.blocks if one[offset + i] >= 0.5))
        offset += len(page.tags)
    return out


def sample(pages: DataFrame, most: int = 300, longest: int = 100_000) -> list[str]:
    """At most ``most`` pages of up to ``longest`` code points, drawn by a hash of id and html.

    Pages with an article or main element come first, as they have labels; others fill up what these leave.
    """
    plain = pages.select(F.xxhash64(F.col("page_id").cast("long"), "html").alias("h"), text_of("html").alias("html"))
    plain = plain.where((F.length("html") <= longest) & (F.length("html") > 0)).withColumn("says", F.col("html").rlike(SAYS))
    out: list[str] = []
    for says in (True, False):
        side, left = plain.where(F.col("says") == says), most - len(out)
        last = side.select("h").orderBy("h").limit(left).agg(F.max("h")).first()[0] if left > 0 else None
        if last is not None:
            out += [r.html for r in side.where(F.col("h") <= last).select("html").limit(left).toLocalIterator()]
    return sorted(out)


def main_text(pages: DataFrame, **bounds: int) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars.

    Needs ``page_id`` and ``html``, and ``url`` if there is one; other columns are ignored. A page without any text,
    null html included, has an empty text. Markup that doesn't nest is read as browsers read it, as far as
    blocks go. Null ids and repeated rows are treated like all others; an empty table gives no rows. If no page
    says by its markup what its article is, the model learns from pages laid out anew from the texts alone.
    """
    model = train(sample(pages, **bounds))
    names = ["page_id", "url", "text", "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 200):
                part = batch.slice(i, 200)
                texts = main_texts(part.column(2).to_pylist(), model)
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names)

    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), text_of("html").alias("html"))
    return plain.mapInArrow(run, "page_id long, url string, text string, n_chars long")
