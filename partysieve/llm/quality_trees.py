"""Quality rules: boosted trees over document statistics, flattened into numpy arrays, monotone where asked."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partysieve.llm.passages import narrowed
from partysieve.llm.words import hashed, mix, small_batches, steps, utf8

#: Labelled documents that the trees are fitted on, the first by a digest of their id.
SAMPLE = 20_000
#: Statistics, and how quality may depend on each: -1 only falls with it, 0 either way.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbols_per_word": -1, "duplicate_lines": -1, "repeated_words": -1,
    "capitals": -1, "digits": 0, "marks": -1, "bars": -1, "words_per_line": 0, "distinct_words": 0, "wide_characters": 0,
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per text the five counts, and the statistics that the trees read."""
    words, bounds = hashed(texts)
    n = np.diff(bounds)
    out, wide = np.zeros((len(texts), 5), np.int64), np.zeros((len(texts), len(FEATURES)))
    text_of = np.repeat(np.arange(len(texts)), n)
    own = mix(words + mix(text_of.astype(np.uint64)))  # equal words of different texts differ
    triple = _seen_twice(own, text_of, 3)
    out[:, 4] = np.bincount(text_of[triple], minlength=len(texts))
    distinct = np.zeros(len(texts), np.int64)
    if len(own):
        order = np.argsort(own, kind="stable")
        new = np.ones(len(own), bool)
        new[1:] = own[order][1:] != own[order][:-1]
        distinct = np.bincount(text_of[order[new]], minlength=len(texts))
    for i, text in enumerate(texts):
        per = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        lines = text.split(b"\n")
        full = [x for x in lines if x.split(None, 1)]
        whole = len(text) - per[128:192].sum()
        out[i, :4] = n[i], whole - per[_WHITE].sum(), per[_SYMBOLS].sum(), len(full) - len(set(full))
        letters = per[65:91].sum() + per[97:123].sum()
        w, c = max(1, n[i]), max(1, out[i, 1])
        wide[i] = (np.log1p(n[i]), c / w, out[i, 2] / w, out[i, 3] / max(1, len(full)), out[i, 4] / w,
                   per[65:91].sum() / max(1, letters), per[48:58].sum() / c, per[[33, 63]].sum() / w, per[124] / w,
                   w / max(1, len(full)), distinct[i] / w, per[192:].sum() / c)
    return out, wide


def _seen_twice(own: np.ndarray, text_of: np.ndarray, width: int) -> np.ndarray:
    """Positions of words in runs of `width` words that their text has twice or more."""
    m = len(own) - width + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    run = own[:m].copy()
    for i in range(1, width):
        run = mix(run) + own[i:i + m]
    inside = np.flatnonzero(text_of[:m] == text_of[width - 1:])
    keys = run[inside]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    hit = np.zeros(len(own), bool)
    for i in range(width):
        hit[inside[twice] + i] = True
    return np.flatnonzero(hit)


@dataclass
class Trees:
    """All trees' nodes in flat arrays; a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log odds of good quality, for all rows and trees at once."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)


def fit(x: np.ndarray, y: np.ndarray, monotone: tuple[int, ...], trees: int = 40, depth: int = 3,
        rate: float = 0.3, bins: int = 64, least: float = 2.0, ridge: float = 1.0) -> Trees:
    """Gradient boosting with logistic loss on binned features.

    At a split of a constrained feature the children's values must be in its order, and their
    middle bounds all values below, so each tree, and so the sum, is monotone in it.
    """
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    base = float(np.log(share / (1 - share)))
    score = np.full(len(y), base)
    nodes: list[list] = []
    roots = []

    def grow(rows, g, h, low, high, level) -> int:
        me = len(nodes)
        value = float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), low, high))
        nodes.append([0, np.inf, me, me, rate * value])
        best = (1e-6, None)
        if level:
            total_g, total_h = g[rows].sum(), h[rows].sum()
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                sum_g = np.cumsum(np.bincount(binned[j, rows], g[rows], len(e) + 1))[:-1]
                sum_h = np.cumsum(np.bincount(binned[j, rows], h[rows], len(e) + 1))[:-1]
                a = np.clip(-sum_g / (sum_h + ridge), low, high)
                b = np.clip(-(total_g - sum_g) / (total_h - sum_h + ridge), low, high)

                def gain(v, gg, hh):
                    return -(gg * v + 0.5 * (hh + ridge) * v * v)

                won = gain(a, sum_g, sum_h) + gain(b, total_g - sum_g, total_h - sum_h) - gain(value, total_g, total_h)
                fine = (sum_h >= least) & (total_h - sum_h >= least) & (monotone[j] * (b - a) >= 0)
                won = np.where(fine, won, -np.inf)
                k = int(np.argmax(won))
                if won[k] > best[0]:
                    best = (won[k], (j, k, (a[k] + b[k]) / 2))
        if best[1]:
            j, k, middle = best[1]
            goes = binned[j, rows] <= k
            lows, highs = (low, low), (high, high)
            if monotone[j] > 0:
                lows, highs = (low, middle), (middle, high)
            elif monotone[j] < 0:
                lows, highs = (middle, low), (high, middle)
            nodes[me][:2] = [j, float(edges[j][k])]
            nodes[me][2] = grow(rows[goes], g, h, lows[0], highs[0], level - 1)
            nodes[me][3] = grow(rows[~goes], g, h, lows[1], highs[1], level - 1)
        return me

    def flat() -> Trees:
        columns = list(zip(*nodes))
        return Trees(np.array(columns[0]), np.array(columns[1]), np.array(columns[2]), np.array(columns[3]),
                     np.array(columns[4]), np.array(roots), depth, base)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        first = len(nodes)
        roots.append(grow(np.arange(len(y)), p - y, np.maximum(p * (1 - p), 1e-6), -4.0, 4.0, depth))
        part = Trees(*(np.array(c) for c in zip(*nodes[first:])), np.array([first]), depth, 0.0)
        part.left, part.right, part.roots = part.left - first, part.right - first, part.roots - first
        score += part.scores(x)
    return flat()


def train(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id",
          quality: str = "quality", sample: int = SAMPLE) -> Trees | None:
    """Trees fitted on at most `sample` labelled documents; None if there are not both kinds of labels.

    Only the sample's ids and statistics reach the driver. Null ids and labels are left out; an id
    with different labels counts as each of them, an id with several texts has the first by a digest.
    """
    spark = documents.sparkSession
    small_batches(spark)
    picked = (labels.select(F.col(label_id).cast("long").alias("doc_id"), F.col(quality).cast("int").alias("good")).dropna()
              .distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "good").limit(sample))
    picked = spark.createDataFrame(picked.toArrow())  # rows as tuples would start Python processes that stay
    chosen = narrowed(documents, doc_id, text).join(F.broadcast(picked), "doc_id").withColumn("digest", F.xxhash64("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text"))
            for a, b in steps(texts):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("good").slice(a, b - a), batch.column("digest").slice(a, b - a),
                     pa.array(list(counts(texts[a:b])[1]), pa.list_(pa.float64()))], names=["doc_id", "good", "digest", "x"])

    rows = chosen.mapInArrow(of, "doc_id long, good int, digest long, x array<double>")
    rows = (rows.groupBy("doc_id", "good").agg(F.min(F.struct("digest", "x")).alias("first"))
            .select("doc_id", "good", F.col("first.x").alias("x")).toPandas())
    rows = rows.assign(x=rows["x"].map(tuple)).sort_values(["doc_id", "good", "x"])
    y = (rows["good"].to_numpy() > 0).astype(float)
    if not 0 < y.sum() < len(y):
        return None
    return fit(np.array(rows["x"].tolist()), y, tuple(FEATURES.values()))


def judge(documents: DataFrame, trees: Trees | None, text: str = "text", cut: float = 0.0, prefix: str = "") -> DataFrame:
    """The documents with their columns, and the counts, base_failed, score and kept.

    base_failed: under 50 words, or more than half of them in 3-word runs that the text has twice
    or more. kept: not base_failed, and the trees' log odds of good quality are over `cut`; without
    trees the base decides alone. A null text has no words. New columns are named with `prefix`;
    columns of these names in `documents` are left out of the result.
    """
    small_batches(documents.sparkSession)
    names = [prefix + c for c in [*COUNTS, "base_failed", "score", "kept"]]
    documents = documents.select(*(F.col(f"`{c}`") for c in documents.columns if c == text or c not in names))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(text))
            for a, b in steps(texts):
                n, x = counts(texts[a:b])
                failed = (n[:, 0] < 50) | (100 * n[:, 4] > 50 * n[:, 0])
                score = trees.scores(x) if trees else np.full(b - a, np.inf)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array(c) for c in n.T), pa.array(failed), pa.array(score), pa.array(~failed & (score > cut))],
                    names=[*part.schema.names, *names])

    new = [T.StructField(c, k) for c, k in zip(names, [T.LongType()] * 5 + [T.BooleanType(), T.DoubleType(), T.BooleanType()])]
    return documents.mapInArrow(of, T.StructType([*documents.schema.fields, *new]))
