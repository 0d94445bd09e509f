"""Fingerprints, edits and verified links against plain Python."""

import hashlib

import numpy as np
import pytest
from odd import DOCUMENTS, documents, rows

from partysieve.llm import fingerprints as f


def brute(docs):
    ordered = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (d, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        cut = len(text) // 2
        changed = text[:len(text) - cut] + after[:cut]
        marks = f.signatures([text.encode(), changed.encode(), after.encode()])
        out.append((d, len(text), hashlib.sha256(changed.encode()).hexdigest(), marks[0].tobytes().hex(), marks[1].tobytes().hex(),
                    float((marks[0] == marks[1]).mean()), float((marks[0] == marks[2]).mean())))
    return sorted(out, key=repr)


@pytest.mark.parametrize("docs", [DOCUMENTS, [(3, "only one")], [(None, "x y"), (None, "b"), (None, None)], [(5, "a"), (5, "a"), (5, "b")], []])
@pytest.mark.parametrize("parts", [1, 7])
def test_edits(spark, docs, parts):
    assert rows(f.fingerprint_edits(documents(spark, docs), parts=parts)) == brute(docs)


def test_every_row_meets_its_next(spark):
    docs = [(i * 7919 % 10007, f"text {i} " * (i % 5)) for i in range(700)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    assert rows(f.fingerprint_edits(frame, parts=40)) == brute(docs)


def test_likeness_estimates_similarity():
    one = [f"w{i}" for i in range(2000)]
    other = one[:1000] + [f"x{i}" for i in range(1000)]
    a, b = f.signatures([" ".join(one).encode(), " ".join(other).encode()])
    assert abs(f.likeness(a, b) - 1 / 3) < 0.2
    empty, blank, full = f.signatures([b"", b" \n", b"a"])
    assert (empty == blank).all() and (empty != full).any()


def test_signed(spark):
    got = {r["doc_id"]: r["fingerprint"] for r in f.signed(documents(spark)).collect() if r["doc_id"] is not None}
    assert got[10] == got[15] and got[3] == got[4] == got[5] and got[6] != got[7] and len(got[1]) == 8 * f.HASHES


def test_groups(spark):
    base = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join([*base[:40 * i], f"e{i}", *base[40 * i + 1:]])) for i in range(1, 7)] + [(20, " ".join(base)), (21, " ".join(base))]
    docs += [(30, "far away " * 9), (None, " ".join(base)), (31, ""), (32, None)]
    got = {r["doc_id"]: r["component_id"] for r in f.grouped(spark.createDataFrame(docs, "doc_id long, text string"), percent=80).collect()}
    assert got == {**{i: 1 for i in range(1, 7)}, 20: 1, 21: 1, 30: 30, None: None, 31: 31, 32: 32}
    assert np.isclose(f.likeness(np.arange(4), np.arange(4)), 1)
