"""Both passage operators against windows compared one by one."""

import hashlib
import random

import pytest
from odd import DOCUMENTS, documents, rows, words

from partysieve.llm import passages, seed_extend, suffix_dedup
from partysieve.llm import words as words_

OPERATORS = [suffix_dedup, seed_extend]


def brute(docs, length=50):
    found = [(d, words(t)) for d, t in docs]
    leads = {}
    for d, w in found:
        if d is not None:
            for i in range(len(w) - length + 1):
                key = tuple(w[i:i + length])
                leads[key] = min(d, leads.get(key, d))
    out = []
    for d, w in found:
        gone = set()
        for i in range(len(w) - length + 1):
            if d is not None and leads[tuple(w[i:i + length])] < d:
                gone.update(range(i, i + length))
        runs = sum(i - 1 not in gone for i in gone)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), runs, hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("operator", OPERATORS)
def test_odd_rows(spark, operator):
    assert rows(operator.dedup(documents(spark))) == brute(DOCUMENTS)


@pytest.mark.parametrize("operator", OPERATORS)
def test_empty(spark, operator):
    assert operator.dedup(documents(spark).where("false")).collect() == []


@pytest.mark.parametrize("operator", OPERATORS)
@pytest.mark.parametrize("seed, group", [(1, 64), (2, 64), (1, 3), (2, 0), (3, 10_000)])
def test_random_overlaps(spark, monkeypatch, operator, seed, group):
    """Passages that overlap, repeat within a document, have edits, and few different words; extended, compared by hash, or both."""
    monkeypatch.setattr(passages, "GROUP", group)
    monkeypatch.setattr(passages, "ROWS", 50)
    monkeypatch.setattr(words_, "BATCH_ROWS", 40 if seed == 1 else 500)
    draw = random.Random(seed)
    pool = [f"w{i}" for i in range(draw.choice([3, 400]))]
    base = [[draw.choice(pool) for _ in range(draw.randint(30, 160))] for _ in range(6)]
    docs = []
    for d in range(60):
        w = []
        for _ in range(draw.randint(1, 4)):
            part = list(draw.choice(base))
            a, b = sorted((draw.randint(0, len(part)), draw.randint(0, len(part))))
            part = part[a:b] if draw.random() < 0.5 else part
            if part and draw.random() < 0.4:
                part[draw.randrange(len(part))] = f"edit{draw.randint(0, 3)}"
            w += part + [f"own{d}"] * (draw.random() < 0.5)
        docs.append((draw.randint(0, 50), " ".join(w)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert rows(operator.dedup(frame)) == brute(docs)


@pytest.mark.parametrize("operator", OPERATORS)
def test_hot_group_across_partitions(spark, operator):
    """Copies beyond a range partition, and a third of all anchors one: only the least document keeps its words."""
    text = " ".join(f"h{i}" for i in range(60))
    docs = [(i, text if i % 2 else f"x{i} {text} y{i}") for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert rows(operator.dedup(frame)) == brute(docs)


def test_cleaned_keeps_white_space(spark):
    text = " ".join(f"p{i}" for i in range(50))
    docs = [(1, f"a\tb\n{text}\nend"), (2, f" c \n d\n{text}\n\ne  f "), (3, text)]
    got = {r["doc_id"]: r["text"] for r in suffix_dedup.cleaned(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {2: " c \n d\ne  f ", 3: ""}


def test_other_lengths(spark):
    docs = [(1, "x " + " ".join(map(str, range(40)))), (2, " ".join(map(str, range(5, 40))))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for length in (17, 35, 36):
        assert rows(seed_extend.dedup(frame, min_words=length)) == brute(docs, length)
    with pytest.raises(ValueError):
        seed_extend.dedup(frame, min_words=16)


@pytest.mark.parametrize("sorted_", [False, True])
def test_extension(sorted_):
    """Matches around an anchor, word by word, against plain comparison."""
    import numpy as np
    import pyarrow as pa

    draw = random.Random(3)
    rows_ = []
    for anchor in range(8):
        for doc in range(draw.randint(1, 9)):
            right = [7] * 16 + [1 + (draw.random() < 0.04) for _ in range(34)]
            left = [3 + (draw.random() < 0.04) for _ in range(34)]
            keep = draw.choice([50, 40])
            rows_.append((anchor, doc % 5, 0, 100 + doc, right[:keep] + [0] * (50 - keep), left))
    want = set()
    for a in rows_:
        for b in rows_:
            if a[0] == b[0] and a[1] < b[1]:
                r = next((i for i in range(50) if a[4][i] != b[4][i] or not a[4][i]), 50)
                back = next((i for i in range(34) if a[5][i] != b[5][i]), 34)
                if r + back >= 50:
                    want.add((b[1], 0, b[3] - back, b[3] + r))
    packed = [(*r[:4], *(np.array(x, np.uint64).tobytes() for x in r[4:])) for r in rows_]
    packed.sort(key=lambda r: (r[0], r[4]) if sorted_ else r[:2])
    table = pa.Table.from_arrays([pa.array(c) for c in zip(*packed)], names=["anchor", "doc_id", "copy", "start", "after", "before"])
    got = pa.Table.from_batches(list(passages.extended(50, sorted_)(iter(table.to_batches(max_chunksize=4)))))
    assert set(zip(*(c.to_pylist() for c in got.columns))) == want and want


def test_neighbours_stream():
    """The same decisions whatever the batches are, and those of whole groups inside the partition."""
    import pyarrow as pa

    draw = random.Random(8)
    found = sorted((draw.randrange(12), draw.randrange(2), draw.randrange(2), draw.randrange(3), 0, i) for i in range(120))
    names = ["anchor", "right", "left", "doc_id", "copy", "start"]
    columns = {n: pa.array(c, pa.int32() if n == "start" else pa.int64()) for n, c in zip(names, zip(*found))}
    table = pa.table(columns | {"windows": pa.array([1] * len(found), pa.int32())})

    def run(size):
        out = pa.Table.from_batches(list(suffix_dedup.neighbours(iter(table.to_batches(max_chunksize=size)))))
        return sorted(zip(*(out.column(c).to_pylist() for c in ("kind", "anchor", "right", "left", "doc_id", "start"))))

    want = run(1000)
    for size in (1, 2, 3, 7, 20):
        assert run(size) == want
    first, last = found[0][0], found[-1][0]
    for anchor in {f[0] for f in found} - {first, last}:
        group = [f for f in found if f[0] == anchor]
        fork = len({f[:3] for f in group}) > 1 and len({f[3] for f in group}) > 1
        lead = {k: min(f[3] for f in group if f[:3] == k) for k in {f[:3] for f in group}}
        expected = [("whole" if f[3] > lead[f[:3]] else "part", *f[:4], f[5]) for f in group if f[3] > lead[f[:3]] or fork]
        assert [w for w in want if w[1] == anchor] == sorted(expected)
    assert {w[0] for w in want if w[1] in (first, last)} >= {"open", "end"}
