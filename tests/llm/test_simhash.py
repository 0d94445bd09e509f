"""SimHash groups against all pairs, and the rings against every difference they must let through."""

import random

import numpy as np
import pytest
from odd import DOCUMENTS, documents, rows, words
from xxhash import xxh64_intdigest

from partysieve.llm import simhash_ring


def fingerprint(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute(docs):
    prints = [fingerprint(t) for _, t in docs]
    parent = {d: d for d, _ in docs if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, _), p in zip(docs, prints):
        for (b, _), q in zip(docs, prints):
            if a is not None and b is not None and (p ^ q).bit_count() <= 3:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted([(d, f"{p:016x}", None if d is None else root(d)) for (d, _), p in zip(docs, prints)], key=repr)


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(4)


def test_odd_rows(spark):
    assert rows(simhash_ring.near_duplicates(documents(spark))) == brute(DOCUMENTS)


def test_empty(spark):
    assert simhash_ring.near_duplicates(documents(spark).where("false")).collect() == []
    got = rows(simhash_ring.near_duplicates(documents(spark).where("text IS NULL")))
    assert got == [(3, "0" * 16, 3), (None, "0" * 16, None)]


def family(draw, n, size=60):
    base = [f"w{draw.randrange(10 ** 6)}" for _ in range(size)]
    out = [" ".join(base)]
    for _ in range(n - 1):
        own = list(base)
        own[draw.randrange(size)] = f"e{draw.randrange(10 ** 6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("bucket", [1000, 2])
def test_families(spark, monkeypatch, bucket):
    """Copies, near copies in buckets of any size, and chains of them; ids of several rows join their texts."""
    monkeypatch.setattr(simhash_ring, "BUCKET", bucket)
    draw = random.Random(4)
    texts = [t for n in (150, 40, 9, 2) for t in family(draw, n, draw.choice([40, 300]))] + ["same text here"] * 30
    texts += [" ".join(f"x{draw.randrange(10 ** 6)}" for _ in range(50)) for _ in range(40)]
    draw.shuffle(texts)
    docs = [(i - 20 if i % 50 else 7, t) for i, t in enumerate(texts)]
    want = brute(docs)
    assert 1 < len({r[2] for r in want}) < len({r[1] for r in want}) < len(docs)
    assert rows(simhash_ring.near_duplicates(frame(spark, docs))) == want


def test_long_text_and_batches(monkeypatch):
    texts = [b"a b c d " * 500, b"", b"x", b"Aa Bb Cc"] * 3
    want = [fingerprint(t.decode()) for t in texts]
    assert simhash_ring.fingerprints(texts).tolist() == want
    monkeypatch.setattr(simhash_ring, "HASHES", 7)
    assert simhash_ring.fingerprints(texts).tolist() == want


@pytest.mark.parametrize("segments", [simhash_ring.COARSE, simhash_ring.FINE])
def test_rings_let_every_difference_through(segments):
    draw = random.Random(segments)
    ways = simhash_ring.chains(segments)
    assert {(m % (1 << 64)).bit_count() for _, m in ways} == {32 if segments == simhash_ring.COARSE else 52}
    for _ in range(2000):
        x = sum(1 << b for b in draw.sample(range(64), draw.randint(0, 3)))
        met = [s for s, m in ways if x & m == 0]
        assert simhash_ring.within(np.full(len(met), x, np.uint64), np.array(met), segments).any()
        far = x | sum(1 << b for b in draw.sample(range(64), 12))
        if far.bit_count() > 3:
            assert not simhash_ring.within(np.full(segments, far, np.uint64), np.arange(segments), segments).any()


def test_pairs_within_a_bucket(monkeypatch):
    """A bucket that lies across Arrow batches gives the same links as one batch."""
    import pyarrow as pa

    draw = random.Random(9)
    keys = sorted(draw.choices(range(12), k=200))
    prints = np.array([draw.choice([0, 1 << 63]) ^ sum(1 << b for b in draw.sample(range(20), 2)) for _ in keys], np.uint64)
    table = pa.table({"key": pa.array(keys, pa.int64()), "start": pa.array([k % 8 for k in keys], pa.int8()), "print": pa.array(prints.view(np.int64))})

    def run(size):
        monkeypatch.setattr(simhash_ring, "ROWS", size)
        out = pa.Table.from_batches(list(simhash_ring._compare(8)(iter(table.to_batches(max_chunksize=size)))))
        parent = {}

        def root(x):
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        for a, b in zip(*(out.column(c).to_pylist() for c in "ab")):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
        return {p: root(p) for p in prints.view(np.int64).tolist()}

    assert run(5) == run(100_000)
