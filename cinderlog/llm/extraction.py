"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its text blocks. A bidirectional LSTM reads, for each block, vectors of its tag
path, its words and its shape, and labels it as article or not with the whole page in view. The network is
plain numpy and trained here, on a bounded sample of pages: their own semantic tags, or else names and shapes, label
their blocks, and variants of each page, with its parts put into other containers, teach it other layouts.
"""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cinderlog.llm.common import Batches, least_hashed, mapped

#: Pages that training uses at most.
TRAINING_PAGES = 300
VARIANTS = 4
#: Shares of variants with the article in a cell of a table, without a name, and with a list in it.
CELLS, BARE, LISTS = 0.15, 0.2, 0.4
EPOCHS = 12
HIDDEN = 24
#: Dimensions that tag paths and words are hashed into.
PATH_DIMENSIONS = 96
WORD_DIMENSIONS = 16
SHAPE_DIMENSIONS = 5
INPUT = PATH_DIMENSIONS + WORD_DIMENSIONS + SHAPE_DIMENSIONS
#: Pages that are labelled together, and blocks after which a training sequence is cut.
PAGES = 64
TRAINING_BLOCKS = 80

#: Elements that start and end a block, that have no end tag, and whose content is no text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary table tbody "
    "td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no article text, closed by an end tag of theirs; and what may stand in a head.
HIDDEN_TAGS = frozenset("noscript template iframe svg annotation annotation-xml".split())
HEAD_TAGS = frozenset("html head title base link meta script style noscript template".split())
#: An open element of the key is closed by the start of one of these.
CLOSED_BY = {
    "p": BLOCK_TAGS - {"html", "body", "button", "option"}, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}), "option": frozenset({"option"}), "tr": frozenset({"tr"}),
    "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}),
}
#: Parts of class and id names and tags that mark what is not the article, and those that mark it.
ASIDE = (
    "nav menu header footer sidebar aside notice cookie consent banner ad ads advert advertisement promo sponsor form "
    "comment comments reply share social related newsletter subscribe breadcrumb copyright popup modal widget login search"
).split()
MAIN = "article main content post entry story body-text article-body post-content entry-content main-content".split()
_MAIN_PARTS = frozenset("article main content post entry story".split())

# only raw text, where no other element can be, runs to the end of the page if its end tag is missing
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*(>|\Z)",
    re.S | re.I,
)
_HIDDEN_END = re.compile(r"</(noscript|template|iframe|svg|annotation-xml|annotation)(?=[\s/>])", re.I)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_NAMING = frozenset(("class", "id", "role"))
_PART = re.compile(r"[a-z0-9]+")


@dataclass
class Block:
    """A run of text with the elements around it, each as its tag and the parts of its class, id and role."""

    text: str
    path: tuple[tuple[str, ...], ...]
    links: int = 0
    tag: str = ""


@dataclass
class _Reader:
    blocks: list[Block] = field(default_factory=list)
    open: list[tuple[str, tuple[str, ...]]] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    links: int = 0
    path: tuple = ()

    def text(self, raw: str) -> None:
        if not self.parts:
            self.path = tuple(x for _, x in self.open)
        self.parts.append(raw)
        if any(tag == "a" for tag, _ in self.open) and raw.strip():
            self.links += len(raw)

    def end_block(self) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                self.blocks.append(Block(text, self.path, self.links, self.path[-1][0] if self.path else ""))
            self.parts, self.links = [], 0

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCK_TAGS:
            self.end_block()
            for i in range(len(self.open) - 1, -1, -1):
                name = self.open[i][0]
                if tag in CLOSED_BY.get(name, ()):
                    del self.open[i:]
                    break
                if name in BLOCK_TAGS and name not in CLOSED_BY:
                    break
        elif tag == "br":
            self.parts and self.parts.append(" ")
        if tag not in VOID_TAGS:
            names = tuple(
                p for m in _ATTRIBUTE.finditer(attributes) if m[1].lower() in _NAMING
                for p in _PART.findall((m[2] or m[3] or m[4] or "").lower())
            )
            self.open.append((tag, (tag, *names)))

    def end(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.end_block()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return
            if self.open[i][0] in BLOCK_TAGS and tag not in BLOCK_TAGS:
                return


def blocks_of(page: str | None) -> list[Block]:
    """The text blocks of a page in order, without scripts, styles, comments, the head and hidden elements.

    A head ends at its end tag, or else at the first text or element that can't stand in it. A hidden element that is empty
    (`<svg/>`) or has no end tag hides nothing; an svg also ends where a block begins. Formulas and the content of objects
    are text like any other.
    """
    page, reader, at, head = page or "", _Reader(), 0, False
    last_end = {m[1].lower(): m.start() for m in _HIDDEN_END.finditer(page)}
    hidden, depth = "", 0
    for m in _TOKEN.finditer(page):
        if m.start() > at and not hidden:
            raw = page[at:m.start()]
            head = head and not raw.strip()
            if not head:
                reader.text(raw)
        at = m.end()
        if not m[3]:
            continue
        tag, ends, attributes = m[3].lower(), bool(m[2]), m[4] or ""
        empty = attributes.endswith("/")
        if hidden == "svg" and not ends and tag in BLOCK_TAGS:
            hidden = ""
        if hidden:
            if tag == hidden and not (empty and not ends):
                depth += -1 if ends else hidden in ("svg", "template")
                hidden = hidden if depth else ""
            continue
        if tag == "head":
            head = not ends
        elif not ends and tag not in HEAD_TAGS:
            head = False
        if tag in HIDDEN_TAGS:
            if not ends and not empty and last_end.get(tag, -1) > at - 1:
                hidden, depth = tag, 1
        elif head or tag == "head":
            continue
        elif ends:
            reader.end(tag)
        else:
            reader.start(tag, attributes)
            if empty and tag not in BLOCK_TAGS and tag not in VOID_TAGS:
                reader.open.pop()
    if not hidden and not (head and not page[at:].strip()):
        reader.text(page[at:])
    reader.end_block()
    return reader.blocks


def _apart(block: Block) -> bool:
    return any(set(names) & set(ASIDE) for names in block.path)


def semantic_label(block: Block) -> int:
    """1 for a block inside an article or main element and not inside one that is set apart, else 0."""
    return int(any(set(names) & {"article", "main"} for names in block.path) and not _apart(block))


#: Words that a block has at least, and the share of them that links have at most, where only its shape tells.
SHAPE_WORDS, SHAPE_LINKS = 10, 0.3


def teaching_labels(blocks: list[Block]) -> list[int]:
    """What a page teaches: its semantic tags; without any, the names of its containers; without those, blocks shaped like
    sentences. Each time, what is named as set apart is none of it."""
    found = [semantic_label(b) for b in blocks]
    if not any(found):
        found = [int(any(set(names[1:]) & _MAIN_PARTS for names in b.path) and not _apart(b)) for b in blocks]
    if not any(found):
        found = [int(len(b.text.split()) >= SHAPE_WORDS and b.links <= SHAPE_LINKS * len(b.text) and not _apart(b)) for b in blocks]
    return found


def _place(text: str, dimensions: int) -> tuple[int, float]:
    h = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    return h % dimensions, 1.0 if h >> 31 else -1.0


class Vectors:
    """Input vectors of blocks; remembers where names and words are hashed to."""

    def __init__(self):
        self.names: dict[str, tuple[int, float]] = {}
        self.words: dict[str, tuple[int, float]] = {}

    def _spot(self, memory: dict, text: str, dimensions: int) -> tuple[int, float]:
        spot = memory.get(text)
        if spot is None:
            if len(memory) > 200_000:
                memory.clear()
            spot = memory[text] = _place(text, dimensions)
        return spot

    def of(self, blocks: list[Block]) -> np.ndarray:
        found = np.zeros((len(blocks), INPUT), np.float32)
        for i, block in enumerate(blocks):
            row = found[i]
            for names in block.path:
                for j, name in enumerate(names):
                    at, sign = self._spot(self.names, name if j else f"<{name}>", PATH_DIMENSIONS)
                    row[at] += sign
            words = block.text.lower().split()
            spots = [self._spot(self.words, w, WORD_DIMENSIONS) for w in words]
            size = 1 / np.sqrt(len(words))
            own = np.bincount([s[0] for s in spots], [s[1] for s in spots], WORD_DIMENSIONS) * size
            row[PATH_DIMENSIONS:PATH_DIMENSIONS + WORD_DIMENSIONS] = own
            row[-SHAPE_DIMENSIONS:] = (
                np.log1p(len(words)) / 3, min(1.0, block.links / max(1, len(block.text))), block.text[-1] in ".!?",
                i / len(blocks), (len(blocks) - i) / len(blocks),
            )
        return np.clip(found, -3, 3)


@dataclass(frozen=True)
class Network:
    """Weights of the two directions (input and state to four gates) and of the label."""

    forward: tuple[np.ndarray, np.ndarray]
    backward: tuple[np.ndarray, np.ndarray]
    out: np.ndarray

    def scores(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """The probability of article for each block of each page; pages are read whole."""
        found: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        for at in range(0, len(order), PAGES):
            own = order[at:at + PAGES]
            x, mask = _padded([pages[i] for i in own])
            h = np.concatenate([_run(x, mask, self.forward)[0], _run(x, mask, self.backward, True)[0]], 2)
            p = _sigmoid(h @ self.out[:-1] + self.out[-1])
            for j, i in enumerate(own):
                found[i] = p[:len(pages[i]), j]
        return found


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Blocks by pages by inputs, and which of them are there."""
    longest = max(len(p) for p in pages)
    x, mask = np.zeros((longest, len(pages), INPUT), np.float32), np.zeros((longest, len(pages), 1), np.float32)
    for j, p in enumerate(pages):
        x[:len(p), j], mask[:len(p), j] = p, 1
    return x, mask


def _run(x: np.ndarray, mask: np.ndarray, weights, reverse: bool = False, keep: bool = False):
    """States after each block; where a page has no block the state stays. With `keep`, also what learning needs."""
    w, u = weights
    drive = x @ w[:-1] + w[-1]
    steps, n = x.shape[:2]
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    states, tape = np.zeros((steps, n, HIDDEN), np.float32), {}
    for t in range(steps - 1, -1, -1) if reverse else range(steps):
        gates = drive[t] + h @ u
        i, f, o = (_sigmoid(gates[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN:])
        new = f * c + i * g
        squashed = np.tanh(new)
        if keep:
            tape[t] = (h, c, i, f, o, g, squashed)
        c, h = np.where(mask[t], new, c), np.where(mask[t], o * squashed, h)
        states[t] = h
    return states, tape


def _learn(x: np.ndarray, mask: np.ndarray, weights, tape: dict, d_states: np.ndarray, reverse: bool):
    """Gradients of the weights, back through the blocks."""
    w, u = weights
    dw, du = np.zeros_like(w), np.zeros_like(u)
    steps = x.shape[0]
    dh = np.zeros_like(d_states[0])
    dc = np.zeros_like(dh)
    for t in range(steps) if reverse else range(steps - 1, -1, -1):
        h, c, i, f, o, g, squashed = tape[t]
        total = dh + d_states[t]
        inner = dc + total * o * (1 - squashed**2)
        d = np.concatenate([
            inner * g * i * (1 - i), inner * c * f * (1 - f), total * squashed * o * (1 - o), inner * i * (1 - g**2)
        ], 1) * mask[t]
        dw[:-1] += x[t].T @ d
        dw[-1] += d.sum(0)
        du += h.T @ d
        dh = d @ u.T + np.where(mask[t], 0, total)
        dc = np.where(mask[t], inner * f, dc)
    return dw, du


def fit(pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Train by Adam on sequences of at most TRAINING_BLOCKS blocks."""
    rng = np.random.default_rng(seed)

    def start(rows: int, columns: int) -> np.ndarray:
        return (rng.standard_normal((rows, columns)) / np.sqrt(rows)).astype(np.float32)

    params = [start(INPUT + 1, 4 * HIDDEN), start(HIDDEN, 4 * HIDDEN), start(INPUT + 1, 4 * HIDDEN),
              start(HIDDEN, 4 * HIDDEN), np.zeros(2 * HIDDEN + 1, np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    cut = [(p[a:a + TRAINING_BLOCKS], y[a:a + TRAINING_BLOCKS]) for p, y in zip(pages, labels, strict=True)
           for a in range(0, len(p), TRAINING_BLOCKS)]
    step = 0
    for _ in range(epochs if cut else 0):
        order = sorted(range(len(cut)), key=lambda i: (len(cut[i][0]) // 8, rng.random()))
        batches = [order[a:a + PAGES] for a in range(0, len(order), PAGES)]
        for b in rng.permutation(len(batches)):
            own = [cut[i] for i in batches[b]]
            x, mask = _padded([p for p, _ in own])
            y = np.zeros(mask.shape[:2], np.float32)
            for j, (_, labels_of) in enumerate(own):
                y[:len(labels_of), j] = labels_of
            ahead, tape_a = _run(x, mask, params[:2], keep=True)
            back, tape_b = _run(x, mask, params[2:4], True, keep=True)
            h = np.concatenate([ahead, back], 2)
            d = (_sigmoid(h @ params[4][:-1] + params[4][-1]) - y) * mask[:, :, 0] / mask.sum()
            d_out = np.append(np.einsum("tn,tnh->h", d, h), d.sum())
            d_h = d[:, :, None] * params[4][:-1]
            grads = [*_learn(x, mask, params[:2], tape_a, d_h[:, :, :HIDDEN], False),
                     *_learn(x, mask, params[2:4], tape_b, d_h[:, :, HIDDEN:], True), d_out]
            step += 1
            for k, grad in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad**2
                params[k] = (params[k] - 0.01 * (first[k] / (1 - 0.9**step)) / (
                    np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Network((params[0], params[1]), (params[2], params[3]), params[4])


def variant(blocks: list[Block], labels: list[int], rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    """The same texts in another layout: article blocks in a container that mostly names it, or in a cell of a table, some of
    them as a list; the others in containers set apart, or bare if they are all links, some moved behind or into the article."""
    def box(name: str) -> tuple[str, ...]:
        tags = {"nav", "header", "footer", "aside", "form", "article", "main"}
        return (name,) if name in tags and rng.random() < 0.5 else (str(rng.choice(["div", "section"])), *_PART.findall(name))

    outer = [(("html",), ("body",)), (("html",), ("body",), ("div", "page")), (("html",), ("body",), ("div", "container"))]
    base = outer[rng.integers(len(outer))]
    if rng.random() < CELLS:
        base = (*base, ("table",), ("tr",))
        content = (*base, ("td", *_PART.findall(str(rng.choice(MAIN)))))
    elif rng.random() < BARE:
        content = (*base, ("div",), ("div",))
    else:
        content = (*base, *([box(str(rng.choice(MAIN)))] if rng.random() < 0.9 else []), box(str(rng.choice(MAIN))))
    main, apart = [b for b, y in zip(blocks, labels, strict=True) if y], [b for b, y in zip(blocks, labels, strict=True) if not y]
    listed = rng.integers(len(main)) if main and rng.random() < LISTS else len(main)
    own = [Block(b.text, (*content, *((("ul",), ("li",)) if listed <= i < listed + 3 else ((b.tag or "p",),))), b.links,
                 "li" if listed <= i < listed + 3 else b.tag) for i, b in enumerate(main)]
    groups: list[tuple[list[Block], int]] = [(own, 1)]
    size = max(1, len(apart) // 3)
    for at in range(0, len(apart), size):
        some = apart[at:at + size]
        bare = all(2 * b.links >= len(b.text) for b in some) and rng.random() < BARE
        around = ("div",) if bare else box(str(rng.choice(ASIDE)))
        path = (*(content if rng.random() < 0.3 else base), around)
        moved = [Block(b.text, (*path, (str(rng.choice(["p", "li", "div", "span", "a"])),)), b.links, b.tag) for b in some]
        groups.insert(int(rng.integers(len(groups) + 1)), (moved, 0))
    # readers' comments and notices are written like articles: some of the article's sentences stand in for them
    if main and rng.random() < 0.7:
        quoted = [main[int(i)] for i in rng.integers(len(main), size=min(4, len(main)))]
        around = box(str(rng.choice(["comments", "comment", "notice", "sidebar", "related", "promo"])))
        path = (*(content if rng.random() < 0.5 else base), around)
        groups.append(([Block(b.text, (*path, ("p",)), 0, "p") for b in quoted], 0))
    return [b for own, _ in groups for b in own], [y for own, y in groups for _ in own]


def train(pages: DataFrame, key: str = "page_id", page: str = "html", bound: int = TRAINING_PAGES) -> Network:
    """Fit on at most `bound` pages, those with the least hash of key and page, and variants of them.

    A network that nothing could teach, for want of any page with text, takes every block for the article.
    """
    hashed = pages.where(F.col(page).isNotNull()).select(F.xxhash64(key, page).alias("order"), F.col(page).alias("page"))
    orders = least_hashed(hashed.select("order").distinct(), "order", bound).orderBy("order").limit(bound)
    # of equal pages one counts, so that no more than the bound come to the driver
    sample = hashed.join(F.broadcast(orders), "order").groupBy("order").agg(F.min("page").alias("page"))
    texts = [r["page"] for r in sample.orderBy("order").collect()]
    rng, vectors, rows, labels = np.random.default_rng(11), Vectors(), [], []
    for text in texts:
        blocks = blocks_of(text)
        own = teaching_labels(blocks)
        for some, y in [(blocks, own), *[variant(blocks, own, rng) for _ in range(VARIANTS)]]:
            if some and any(own):
                rows.append(vectors.of(some))
                labels.append(np.array(y, np.float32))
    return fit(rows, labels)


def extract_texts(network: Network, pages: list[str | None], vectors: Vectors | None = None) -> list[str]:
    """The main text of each page: the blocks that the network takes for the article, one a line."""
    vectors = vectors or Vectors()
    found = []
    for at in range(0, len(pages), 4 * PAGES):
        blocks = [blocks_of(p) for p in pages[at:at + 4 * PAGES]]
        scores = network.scores([vectors.of(b) for b in blocks])
        found += ["\n".join(b.text for b, p in zip(own, score, strict=True) if p >= 0.5) for own, score in zip(blocks, scores, strict=True)]
    return found


def extract(pages: DataFrame, network: Network, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: key, url, text and n_chars. A null or empty page has an empty text; repeated rows each get
    their row."""
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), F.col(page).alias("page"))
    kind = rows.schema["id"].dataType.simpleString()
    held = pages.sparkSession.sparkContext.broadcast(network)

    def task(batches: Batches) -> Batches:
        vectors = Vectors()
        for batch in batches:
            texts = extract_texts(held.value, batch.column(2).to_pylist(), vectors)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[key, url, "text", "n_chars"],
            )

    return mapped(rows, task, f"`{key}` {kind}, `{url}` string, text string, n_chars bigint")
