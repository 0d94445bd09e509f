"""Counts against plain Python, trees for monotone scores, held-out accuracy."""

import re

import numpy as np
from odd import DOCUMENTS, documents, rows, words

from partysieve.llm import quality_trees as q


def brute(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    triples = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = {i + k for i, t in enumerate(triples) if triples.count(t) > 1 for k in range(3)} if len(w) < 2000 else None
    repeats = len(hit) if hit is not None else None
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeats]


def test_counts():
    texts = [t for _, t in DOCUMENTS] + ["a b c a b c", "x x x x", "### | <b> &amp; $5 100%*", "a\nb\na \na\n\n \n", "ÉÈ éè"]
    got, _ = q.counts([(t or "").encode() for t in texts])
    for text, row in zip(texts, got.tolist()):
        want = brute(text)
        assert row[:4] == want[:4]
        assert want[4] is None or row[4] == want[4]


def test_judged_rows(spark):
    out = q.judge(documents(spark), None)
    assert {r["doc_id"]: r["kept"] for r in out.where("doc_id IN (1, 3, 4, 10, 14)").collect()} == {1: True, 3: False, 4: False, 10: True, 14: False}
    assert out.columns.count("kept") == 1 and out.columns.count("score") == 1 and "copy" in out.columns
    assert out.where("NOT base_failed AND kept").count() == out.where("kept").count()
    assert q.judge(documents(spark).where("false"), None).collect() == []
    assert q.train(documents(spark), spark.createDataFrame([], "doc_id long, quality int")) is None
    one_kind = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (8, None)], "doc_id long, quality int")
    assert q.train(documents(spark), one_kind) is None


def test_repeated_id_is_one_document(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(q, "fit", lambda x, *_: seen.append(x))
    docs = spark.createDataFrame([(1, f"text {'word ' * i}") for i in range(50)] + [(2, "a"), (3, "b c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (1, 1), (2, 1), (3, 0)], "doc_id long, quality int")
    for n in (4, 1):
        q.train(docs.repartition(n), labels)
    assert len(seen[0]) == 4 and np.array_equal(seen[0], seen[1])


def test_monotone():
    draw = np.random.default_rng(3)
    x = draw.random((3000, 4))
    y = (x[:, 0] + np.sin(9 * x[:, 1]) / 2 + draw.normal(0, 0.3, 3000) < 0.7).astype(float)
    trees = q.fit(x, y, (-1, 0, 1, 0), trees=25)
    grid = np.repeat(draw.random((50, 4)), 40, axis=0)
    for j, sign in ((0, -1), (2, 1)):
        moved = grid.copy()
        moved[:, j] = np.tile(np.linspace(-0.5, 1.5, 40), 50)
        steps = np.diff(trees.scores(moved).reshape(50, 40), axis=1)
        assert (sign * steps >= -1e-9).all()
    assert ((trees.scores(x) > 0) == (y > 0)).mean() > 0.75


def test_held_out(spark):
    path = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    trees = q.train(docs, labels.where("doc_id % 3 <> 0"))
    held = q.judge(docs, trees).join(labels.where("doc_id % 3 = 0"), "doc_id").where("NOT base_failed")
    right, n, clean_gone = held.selectExpr("count_if(kept = (quality = 1))", "count(*)", "count_if(quality = 1 AND NOT kept)").first()
    assert right >= 0.97 * n and clean_gone == 0
    again = q.train(docs.repartition(5), labels.where("doc_id % 3 <> 0").repartition(3))
    assert np.array_equal(trees.threshold, again.threshold) and np.array_equal(trees.value, again.value)
