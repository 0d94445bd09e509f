"""Ranked search against every document's score, and the bounds against the scores."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from odd import DOCUMENTS, documents, rows

from partysieve.llm import bit_slices
from partysieve.sources.stages import StageArea

ITEMS = [(1, "p1 P2 p3 p3 beta"), (2, None), (3, ""), (4, "... !"), (None, "漢字 one"), (1, "line HERE"), (5, "p1 P2 p3 p3 beta"),
         (6, "missing words only"), (7, " ".join(f"w{i % 977}x{i % 13}" for i in range(3000)))]


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=20):
    found = [(d, t, terms(t)) for d, t in docs]
    found = [(d, t, Counter(x), len(x)) for d, t, x in found if x]
    docs_, all_ = len(found), sum(n for *_, n in found)
    df = Counter(t for _, _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, t, c, n in found:
            m = 75 + 25 * n * docs_ // all_
            s = sum(math.floor(1000 * math.log((2 * docs_ + 2) / (2 * df[q] + 1))) * (10 ** 9 * c[q] // (1000 * c[q] + 12 * m))
                    for q in terms(text) if q in c)
            if s > 0:
                scores.append((-s, d is None, d, s))
        out += [(item, i, d, s) for i, (_, _, d, s) in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:k], 1)]
    return sorted(out, key=repr)


def found(frame, items, k=20):
    stages = StageArea(frame.sparkSession)
    return rows(bit_slices.search(bit_slices.build(frame, stages), frame, items, stages, k))


def asked(spark, items=ITEMS):
    frame = spark.createDataFrame(items, "item_id long, text string")
    return frame.selectExpr("*", "'clash' AS query", "'clash' AS term", "'clash' AS rank", "'clash' AS doc_id")


@pytest.mark.parametrize("k", [1, 3, 20])
def test_odd_rows(spark, k):
    assert found(documents(spark), asked(spark), k) == brute(DOCUMENTS, ITEMS, k)


def test_empty(spark):
    none, items = documents(spark).where("false"), asked(spark)
    assert found(none, items) == [] and found(documents(spark).where("text IS NULL"), items) == []
    assert found(documents(spark), items.where("false")) == []


@pytest.mark.parametrize("small", [False, True])
def test_random_documents(spark, monkeypatch, small):
    """Common and rare words, copies of the best texts, ties; with many blocks, rounds and joins by shuffle too."""
    if small:
        for name, value in (("WIDTH", 8), ("QUERY_TERMS", 40), ("BROADCAST_CANDIDATES", 0), ("DICTIONARY", 50)):
            monkeypatch.setattr(bit_slices, name, value)
    draw = random.Random(7)
    vocabulary = [f"t{int(draw.paretovariate(0.6)) % 800}" for _ in range(3000)]
    docs = [(i, " ".join(draw.choices(vocabulary, k=draw.choice([1, 5, 40, 40, 400])))) for i in range(250)]
    docs += [(i + 1000, docs[3][1]) for i in range(60)] + [(i + 2000, docs[4][1] + " t1") for i in range(30)] + [(9, "t5 t5")]
    draw.shuffle(docs)
    items = [(i, " ".join(draw.choices(vocabulary, k=8))) for i in range(25)] + [(99, docs[3][1]), (98, docs[3][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert found(frame, asked(spark, items)) == brute(docs, items)


def test_bounds_are_above_scores(monkeypatch):
    monkeypatch.setattr(bit_slices, "BITS", 1)  # signatures that are nearly full
    draw = random.Random(2)
    texts = [" ".join(draw.choices([f"t{i}" for i in range(60)], k=draw.choice([3, 50, 900]))) for _ in range(300)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(300)), "copy": [0] * 300, "text": texts})
    queries = bit_slices.Queries([(q, f"t{draw.randrange(70)}", draw.randrange(1, 9000)) for q in range(12) for _ in range(5)])
    seen = 0
    for out in bit_slices._signatures(iter([batch])):
        for row in out.to_pylist():
            if row["slices"] is not None:
                for q, bound in queries.bounds(row["bits"], row["sizes"], row["levels"], row["slices"], 300, 90_000):
                    exact = np.array([queries.score(texts[d].encode(), [q], 300, 90_000)[0] for d in row["doc_ids"]])
                    seen += len(exact)
                    assert (bound >= exact).all() and bound.dtype == np.int64
    assert seen == 12 * 300
