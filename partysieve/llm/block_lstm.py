"""Main text of pages: a bidirectional LSTM in numpy labels each leaf block with the whole page as context."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partysieve.llm.html_blocks import WIDTH, Block, blocks, features
from partysieve.llm.words import small_batches

#: Pages that the labeller is fitted on, the first by a digest, and the characters they may have together.
SAMPLE, SAMPLE_CHARS = 300, 30_000_000
#: Blocks of a sequence that the labeller is fitted on; longer pages are several.
STRETCH = 2000
#: Pages of varied layout that are built from the sample's text.
VARIED = 2000
HIDDEN = 16
#: Blocks of a padded batch.
CELLS = 20_000


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Direction:
    """One LSTM over padded sequences (time, page, feature)."""

    def __init__(self, draw: np.random.Generator):
        scale = 1 / np.sqrt(HIDDEN)
        self.w = draw.uniform(-scale, scale, (WIDTH, 4 * HIDDEN)).astype(np.float32) * 0.5
        self.u = draw.uniform(-scale, scale, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        self.b = np.zeros(4 * HIDDEN, np.float32)
        self.b[HIDDEN:2 * HIDDEN] = 1  # remember at first

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: list | None = None, carried: list | None = None) -> np.ndarray:
        """The states after each block. `carried` is what a stretch before has left, and is replaced for the next."""
        t, n, _ = x.shape
        gates = (x.reshape(t * n, WIDTH) @ self.w).reshape(t, n, -1) + self.b
        h, c = carried or [np.zeros((n, HIDDEN), np.float32)] * 2
        out = np.empty((t, n, HIDDEN), np.float32)
        for k in range(t):
            a = gates[k] + h @ self.u
            s = _sigmoid(a[:, :3 * HIDDEN])
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:]
            g = np.tanh(a[:, 3 * HIDDEN:])
            new = f * c + i * g
            tanh = np.tanh(new)
            m = mask[k][:, None]
            if keep is not None:
                keep.append((h, c, i, f, o, g, tanh, m))
            c = np.where(m, new, c)
            h = np.where(m, o * tanh, h)
            out[k] = h
        if carried is not None:
            carried[:] = [h, c]
        return out

    def backward(self, x: np.ndarray, keep: list, d_out: np.ndarray) -> list[np.ndarray]:
        t, n, _ = x.shape
        d_gates = np.zeros((t, n, 4 * HIDDEN), np.float32)
        d_u = np.zeros_like(self.u)
        d_h = d_c = np.zeros((n, HIDDEN), np.float32)
        for k in range(t - 1, -1, -1):
            h, c, i, f, o, g, tanh, m = keep[k]
            d_h = d_h + d_out[k]
            own, pass_h = np.where(m, d_h, 0), np.where(m, 0, d_h)
            d_new = np.where(m, d_c, 0) + own * o * (1 - tanh * tanh)
            pass_c = np.where(m, 0, d_c)
            d = d_gates[k]
            d[:, :HIDDEN] = d_new * g * i * (1 - i)
            d[:, HIDDEN:2 * HIDDEN] = d_new * c * f * (1 - f)
            d[:, 2 * HIDDEN:3 * HIDDEN] = own * tanh * o * (1 - o)
            d[:, 3 * HIDDEN:] = d_new * i * (1 - g * g)
            d_u += h.T @ d
            d_h = d @ self.u.T + pass_h
            d_c = d_new * f + pass_c
        return [x.reshape(t * n, WIDTH).T @ d_gates.reshape(t * n, -1), d_u, d_gates.sum((0, 1))]


class Labeller:
    """Both directions and the output layer over their states and the block itself."""

    def __init__(self, seed: int = 5):
        draw = np.random.default_rng(seed)
        self.there, self.back = Direction(draw), Direction(draw)
        self.v = (draw.normal(size=2 * HIDDEN + WIDTH) * 0.05).astype(np.float32)
        self.c = np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.there.w, self.there.u, self.there.b, self.back.w, self.back.u, self.back.b, self.v, self.c]

    def scores(self, x: np.ndarray, mask: np.ndarray, keep: tuple[list, list] | None = None):
        a = self.there.forward(x, mask, keep and keep[0])
        b = self.back.forward(x[::-1], mask[::-1], keep and keep[1])[::-1]
        state = np.concatenate([a, b, x], axis=2)
        return state @ self.v + self.c, state

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 12, size: int = 32, rate: float = 0.01) -> None:
        """Logistic loss over all blocks, by Adam."""
        draw = np.random.default_rng(17)
        first = [np.zeros_like(p) for p in self.parameters()]
        second = [np.zeros_like(p) for p in self.parameters()]
        step = 0
        for epoch in range(epochs):
            order = sorted(draw.permutation(len(pages)).tolist(), key=lambda i: len(pages[i]) // 8)
            batches = [order[i:i + size] for i in range(0, len(order), size)]
            for k in draw.permutation(len(batches)):
                members = batches[k]
                x, mask = padded([pages[i] for i in members])
                y = np.zeros(mask.shape, np.float32)
                for j, i in enumerate(members):
                    y[:len(labels[i]), j] = labels[i]
                keep: tuple[list, list] = ([], [])
                score, state = self.scores(x, mask, keep)
                d = np.where(mask, _sigmoid(score) - y, 0) / np.float32(mask.sum())
                d_state = d[:, :, None] * self.v
                grads = [*self.there.backward(x, keep[0], d_state[:, :, :HIDDEN]),
                         *self.back.backward(x[::-1], keep[1], d_state[::-1, :, HIDDEN:2 * HIDDEN]),
                         np.einsum("tn,tnk->k", d, state), d.sum(keepdims=True).reshape(1)]
                step += 1
                now = rate * (0.5 ** (epoch // 4))
                for p, g, m, v in zip(self.parameters(), grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)

    def label_long(self, page: list[Block], stretch: int) -> np.ndarray:
        """Whether each block of one page is main text; only a stretch of it is features at a time, both ways."""
        n = len(page)
        score = np.zeros(n, np.float32) + self.c
        bounds = [(a, min(a + stretch, n)) for a in range(0, n, stretch)]
        for way, order, v in ((self.there, bounds, self.v[:HIDDEN]), (self.back, bounds[::-1], self.v[HIDDEN:2 * HIDDEN])):
            carried: list = []
            for a, b in order:
                x = features([page[a:b]], a, n)[0]
                if way is self.there:
                    score[a:b] += x @ self.v[2 * HIDDEN:]
                step = 1 if way is self.there else -1
                score[a:b] += way.forward(x[::step, None], np.ones((b - a, 1), bool), None, carried)[::step, 0] @ v
        return score > 0

    def label_pages(self, pages: list[list[Block]], cells: int | None = None) -> list[np.ndarray]:
        """The labels of all blocks; the features of about `cells` blocks are there at a time, however long a page is."""
        cells = cells or CELLS
        out: list = [np.zeros(0, bool)] * len(pages)
        some: list[int] = []
        for i, page in enumerate(pages):
            if len(page) > cells:
                out[i] = self.label_long(page, cells)
                continue
            if sum(len(pages[j]) for j in some) + len(page) > cells:
                for j, y in zip(some, self.label(features([pages[j] for j in some]))):
                    out[j] = y
                some = []
            some.append(i)
        for j, y in zip(some, self.label(features([pages[j] for j in some]))):
            out[j] = y
        return out

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For each page whether its blocks are main text; pages of similar length go together."""
        out: list = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        start = 0
        while start < len(order):
            end = start + 1
            while end < len(order) and len(pages[order[end]]) * (end + 1 - start) <= CELLS:
                end += 1
            x, mask = padded([pages[i] for i in order[start:end]])
            good = self.scores(x, mask)[0] > 0
            for j, i in enumerate(order[start:end]):
                out[i] = good[:len(pages[i]), j]
            start = end
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    x = np.zeros((max(len(p) for p in pages), len(pages), WIDTH), np.float32)
    mask = np.zeros(x.shape[:2], bool)
    for j, p in enumerate(pages):
        x[:len(p), j], mask[:len(p), j] = p, True
    return x, mask


#: Elements and names that tell what a block is, for the labels of training pages.
MAIN = ("article", "main")
ASIDE_TAGS = ("nav", "aside", "footer", "header", "form", "fieldset", "dialog", "menu", "search")
ASIDE_NAMES = (
    "ad ads advert advertisement adverts adbox sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert announcement "
    "popup modal overlay newsletter subscribe signup menu nav navbar navigation breadcrumb breadcrumbs pagination pager sidebar side widget "
    "widgets rail related recommended more share sharing social comment comments commentlist respond replies reply disqus discussion "
    "responses footer foot copyright legal header masthead logo topbar search login form contact tags").split()
NEUTRAL_NAMES = "wrap wrapper box list item items block section area inner container row col posts thread group top bottom left right site".split()
MAIN_NAMES = "content post entry story text body articlebody page maincontent detail".split()


def weak_label(page: list[Block]) -> np.ndarray | None:
    """Labels of a page that has an article or main element; None for others."""
    if not any(t in MAIN for b in page for t in b.path):
        return None
    return np.array([any(t in MAIN for t in b.path) and not any(t in ASIDE_TAGS for t in b.path)
                     and not any(n in ASIDE_NAMES for n in b.names) for b in page], np.float32)


def varied(good: list[str], other: list[str], n: int, seed: int = 23) -> tuple[list[list[Block]], list[np.ndarray]]:
    """Pages of many layouts, filled with main and other text of the sample, with their labels."""
    draw = np.random.default_rng(seed)

    def pick(items):
        return items[int(draw.integers(len(items)))]

    def said(mostly, rarely):
        """What stands in a block tells little: some text of the other kind, some of a word or two."""
        text = pick(rarely if draw.random() < 0.25 else mostly)
        return " ".join(text.split(" ")[:int(draw.integers(1, 4))]) if draw.random() < 0.2 else text

    def extra():
        return (pick(NEUTRAL_NAMES),) if draw.random() < 0.5 else ()

    pages, labels = [], []
    for _ in range(n):
        rows: list[tuple[Block, float]] = []

        def add(text, path, names, share, label):
            rows.append((Block(text, path, share, names), label))

        def boilerplate(path, names):
            kind = int(draw.integers(9))
            name = (pick(ASIDE_NAMES), *extra())
            if kind < 2:
                tag = pick(("nav", "div", "header", "menu", "div"))
                own = name if tag == "div" or draw.random() < 0.4 else ()
                for _ in range(int(draw.integers(2, 9))):
                    add(said(other, good).split(" ")[0], (*path, tag, "ul", "li"), (*names, *own), 1.0, 0)
            elif kind == 2:
                for _ in range(int(draw.integers(1, 4))):
                    add(said(other, good), (*path, pick(("aside", "footer", "header")), pick(("p", "div", "li", "h2", "h3"))), names, float(draw.random() < 0.5), 0)
            elif kind == 3:
                for _ in range(int(draw.integers(1, 5))):
                    add(said(other, good), (*path, "form", pick(("p", "div", "li"))), names, 0.0, 0)
            elif kind < 6:
                add(said(other, good), (*path, pick(("div", "section", "p"))), (*names, *name), float(draw.random() < 0.3), 0)
            else:
                tag, own = (pick(("section", "div", "ol", "ul")), name) if draw.random() < 0.85 else ("aside", ())
                for _ in range(int(draw.integers(1, 7))):
                    add(said(good, other), (*path, tag, pick(("p", "p", "div", "li", "article", "h2", "h3"))), (*names, *own), 0.0, 0)

        kind = draw.random()
        root = ("html", "body", "div") if kind < 0.4 else ("html", "body") if kind < 0.8 else ("body",) if kind < 0.9 else ()
        for _ in range(int(draw.integers(0, 4))):
            boilerplate(root, ())
        kind = draw.random()
        if kind < 0.4:
            place, names = (*root, pick(MAIN)), (pick(MAIN_NAMES), *extra()) if draw.random() < 0.2 else ()
        elif kind < 0.55:
            place, names = (*root, "main", pick(("article", "div", "section"))), ()
        elif kind < 0.97:
            place, names = (*root, pick(("div", "section", "td"))), (pick(MAIN_NAMES), *extra())
        else:
            place, names = (*root, "div"), ()
        if draw.random() < 0.75:
            add(said(good, other), (*place, pick(("h1", "h1", "h2"))), names, 0.0, 1)
        for _ in range(int(draw.integers(1, 16))):
            tag = (pick(("h2", "h3")),) if draw.random() < 0.08 else ("ul", "li") if draw.random() < 0.1 else (
                pick(("blockquote", "figcaption", "td", "pre", "div", "dd")),) if draw.random() < 0.1 else ("p",)
            add(said(good, other), (*place, *tag), names, float(draw.random() < 0.05), 1)
            if draw.random() < 0.2:
                boilerplate(place, names)
        if draw.random() < 0.3:
            boilerplate(place, names)
        for _ in range(int(draw.integers(0, 4))):
            boilerplate(root, ())
        pages.append([b for b, _ in rows])
        labels.append(np.array([y for _, y in rows], np.float32))
    return pages, labels


def fitted(sources: list[str]) -> Labeller:
    """A labeller fitted on pages that have an article or main element and on varied pages with their text.

    Without any such page only built-in words fill the varied ones.
    """
    own = [(p, y) for p in map(blocks, sources) if p and (y := weak_label(p)) is not None]
    good = [b.text for p, y in own for b, k in zip(p, y) if k] or ["A first sentence of some text.", "Another one, somewhat longer than that."]
    other = [b.text for p, y in own for b, k in zip(p, y) if not k] or ["Home", "About us", "All rights reserved."]
    made, labels = varied(good, other, VARIED)
    out = Labeller()
    parts = [(x[i:i + STRETCH], y[i:i + STRETCH])
             for x, y in zip(features([*(p for p, _ in own), *made]), [*(y for _, y in own), *labels]) for i in range(0, len(y), STRETCH)]
    out.fit([x for x, _ in parts], [y for _, y in parts])
    return out


def sampled(pages: DataFrame, page_id: str = "page_id", html: str = "html", sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> DataFrame:
    """Key and html of the first `sample` pages by a digest of id and html, in one partition, equal pages once.

    Of these go in, in turn, the ones that `chars` characters together leave room for, whatever their own length; if
    none fits, the shortest. Only digests and lengths reach the driver.
    """
    rows = pages.select(F.xxhash64(page_id, html).alias("key"), F.col(html).cast("string").alias("html")).where("html IS NOT NULL")
    first = rows.select("key", F.length("html").alias("n")).distinct().orderBy("key", "n").limit(sample).collect()
    taken, total = [], 0
    for key, n in first:
        if total + n <= chars:
            taken.append(key)
            total += n
    if first and not taken:
        taken = [min(first, key=lambda r: (r["n"], r["key"]))["key"]]
    return (rows.where(F.col("key").isin(taken)).groupBy("key").agg(F.min("html").alias("html"))
            .repartition(1).sortWithinPartitions("key"))


def train(pages: DataFrame, page_id: str = "page_id", html: str = "html", sample: int = SAMPLE) -> Labeller:
    """A labeller fitted on at most `sample` pages of SAMPLE_CHARS characters together, in one task.

    The pages are those of `sampled`, so any order of rows gives the same one.
    """
    small_batches(pages.sparkSession)
    rows = sampled(pages, page_id, html, sample)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sources = [x for batch in batches for x in batch.column("html").to_pylist()]
        if sources:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fitted(sources))], pa.binary())], names=["model"])

    found = rows.mapInArrow(of, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else fitted([])


def main_text(page: list[Block], good: np.ndarray) -> str:
    return "\n\n".join(b.text for b, k in zip(page, good) if k)


def extract(pages: DataFrame, labeller: Labeller, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row page_id, url, text, n_chars: the main text of the whole page, blocks joined by an empty line.

    A null or empty page has an empty text. Rows with null or repeated ids are rows like any other;
    other columns are ignored, whatever their names. One pass without a shuffle.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = [blocks(x or "") for x in batch.column("html").to_pylist()]
            texts = [main_text(p, y) for p, y in zip(parsed, labeller.label_pages(parsed))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(of, f"page_id {kind}, url string, text string, n_chars long")
