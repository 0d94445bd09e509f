"""Near-duplicate groups against all pairs."""

import random

import pytest
from odd import DOCUMENTS, documents, rows, words

from partysieve.llm import bbit_dedup
from partysieve.llm.components import components
from partysieve.sources.stages import StageArea


def lowered(text):
    return words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, percent=85):
    sets = []
    for _, t in docs:
        w = lowered(t)
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = {d: d for d, _ in docs if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(docs):
        for j, (b, _) in enumerate(docs[:i]):
            both = len(sets[i] & sets[j])
            if a is not None and b is not None and both and 100 * both >= percent * len(sets[i] | sets[j]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted([(d, len(s), None if d is None else root(d), d is None or root(d) == d) for (d, _), s in zip(docs, sets)], key=repr)


def test_odd_rows(spark):
    assert rows(bbit_dedup.near_duplicates(documents(spark))) == brute(DOCUMENTS)


def test_empty(spark):
    assert bbit_dedup.near_duplicates(documents(spark).where("false")).collect() == []
    assert len(bbit_dedup.near_duplicates(documents(spark).where("text IS NULL")).collect()) == 2


@pytest.mark.parametrize("tile", [256, 8])
def test_families(spark, monkeypatch, tile):
    """Stars around a text that is or is not there, chains, copies; in one tile and in many."""
    monkeypatch.setattr(bbit_dedup, "TILE", tile)
    draw = random.Random(3)
    docs, d = [], 0
    for family, n in enumerate((90, 60, 40, 3, 2)):
        base = [f"f{family}w{i}" for i in range(draw.choice([60, 200]))]
        if family % 2:
            docs.append((d, " ".join(base)))
        chain = list(base)
        for k in range(n):
            d += 1
            own = list(chain if family == 2 else base)
            for _ in range(1 + (family == 0)):
                own[draw.randrange(len(own))] = f"e{d}"
            if family == 2:
                chain = own
            docs.append((d, " ".join(own)))
            if k % 9 == 0:
                docs.append((d + 1000, " ".join(own)))
    draw.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert rows(bbit_dedup.near_duplicates(frame)) == brute(docs)


def test_links_between_stars(spark, monkeypatch):
    """Two stars bridged by rows that neither hub links to the other, and chains of 9 beside a large cluster."""
    monkeypatch.setattr(bbit_dedup, "TILE", 8)

    def changed(words_, places, mark):
        out = list(words_)
        for place in places:
            out[place] = f"{mark}{place}"
        return out

    base = [f"s{i}" for i in range(200)]
    bridge = [base]  # three words changed a step: a step is a link, two are not
    for k in range(3):
        bridge.append(changed(bridge[-1], (20 + 30 * k, 28 + 30 * k, 36 + 30 * k), f"b{k}x"))
    texts = list(bridge)
    for star in (bridge[0], bridge[3]):
        texts += [changed(star, (110 + 2 * k,), f"m{len(texts)}x") for k in range(40)]
    for chain in range(6):
        link = [f"c{chain}w{i}" for i in range(200)]
        for k in range(9):
            texts.append(link)
            link = changed(link, (10 + 20 * k, 16 + 20 * k, 22 + 20 * k), f"c{chain}k{k}x")
    docs = [(d, " ".join(t)) for d, t in enumerate(texts, -5)]
    want = brute(docs)
    assert len({r[2] for r in want}) == 7
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert rows(bbit_dedup.near_duplicates(frame)) == want


def test_estimates():
    draw = random.Random(5)
    one = {f"{i}" for i in range(600)}
    for similar in (0.5, 0.85):
        n = round(600 * 2 * similar / (1 + similar))
        other = set(sorted(one)[:n]) | {f"x{i}" for i in range(600 - n)}
        a, b = (bbit_dedup.shingles([" ".join(f"{x} . . . ." for x in sorted(s)).encode()])[0] for s in (one, other))
        true = len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
        import numpy as np

        marks = [np.frombuffer(x, np.uint8) for x in bbit_dedup.packed(bbit_dedup.minima([a, b]))]
        assert abs(bbit_dedup.estimates(marks[0], marks[1][None])[0] - true) < 0.15
    assert draw


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long"), StageArea(spark)).collect()))
    assert got == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}
