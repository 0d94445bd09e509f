"""The conversation trie against prefixes counted one by one, and the z-fast trie against a dictionary of prefixes."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from odd import rows, words
from pyspark.sql import functions as F

from partysieve.llm import zfast_trie
from partysieve.llm.zfast_trie import Sequence, Trie, two_fattest

ODD = [(0, 1, "user", "a b"), (0, 0, "system", "s"), (0, None, None, None), (0, 2, "user", ""), (3, 5, "user", "own three words"),
       (3, 5, "user", "own three words"), (3, 5, "assistant", "own"), (5, 0, "user", "x"), (26, 0, "user", "no donor"), (None, 0, "user", "lost"),
       (7, 0, None, "y"), (-5, 0, "user", "below zero"), (-20, 1, "user", "donor below"), (-25, 0, "user", "z"), (41, 0, "u", "q " * 9000), (40, 0, "u", "w")]


def brute(data):
    own = {}
    for c, turn, role, text in data:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5((hashlib.md5(role.encode()).hexdigest() + hashlib.md5(text.encode()).hexdigest()).encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - int(np.fmod(c, 20))
        full = tuple(own.get(donor, [])[:h] + turns[h:])
        for d in range(len(full) + 1):
            members.setdefault(full[:d], []).append(c)
        ends.setdefault(full, []).append(c)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(x[:len(q)] == q and len(x) > len(q) for x in below)]
        saved = sum((len(members[q]) - 1) * len(words(q[-1][1])) for q in below if q)
        sha = hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids), len(leaves), saved, sha))
    return sorted(out, key=repr)


def frame(spark, data):
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(4)
    return df.withColumns({c: F.lit("clash") for c in ("conv", "depth", "words", "pos", "h", "donor", "x", "low")})


def test_odd_rows(spark):
    assert rows(zfast_trie.prefix_trie(frame(spark, ODD))) == brute(ODD)


def test_empty(spark):
    assert zfast_trie.prefix_trie(frame(spark, ODD).where("false")).collect() == []
    assert zfast_trie.prefix_trie(frame(spark, ODD).where("conv_id IS NULL")).collect() == []


@pytest.mark.parametrize("piece", [4096, 2, 5])
def test_random_conversations(spark, monkeypatch, piece):
    """Shared beginnings of all lengths, copies, a long conversation; with small pieces and tries that are handed on early."""
    monkeypatch.setattr(zfast_trie, "PIECE", piece)
    if piece < 10:
        monkeypatch.setattr(zfast_trie, "HELD", 40)
    draw = random.Random(piece)
    data, seen = [], [[]]
    for c in range(70):
        turns = list(draw.choice(seen))[:draw.randint(0, 9)] if draw.random() < 0.8 else []
        turns += [(draw.choice(["user", "assistant"]), "w " * draw.randint(0, 3) + str(draw.randint(0, 2))) for _ in range(draw.randint(0, 4))]
        seen.append(turns)
        data += [(c * 3 - 9, i if draw.random() < 0.9 else 5, *t) for i, t in enumerate(turns)]
    data += [(1000, i, "user", f"t{i % 3}") for i in range(60)] + [(1020 + k, i, "user", f"t{i % 3}") for k in (0, 1, 2) for i in range(40)]
    data += [(c, i, "system", "same") for c in range(2000, 2040) for i in range(5)]
    draw.shuffle(data)
    assert rows(zfast_trie.prefix_trie(frame(spark, data))) == brute(data)


def test_long_conversation_over_many_partitions(spark):
    """A third of all rows is one conversation: its turns lie in several range partitions and keep their places."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        data = [(1, i, "user", f"t{i}") for i in range(400)] + [(c, i, "user", f"t{i}") for c in range(20, 120) for i in range(8)]
        from partysieve.sources.stages import StageArea

        stages = StageArea(spark)
        turns, _ = zfast_trie._ordered(frame(spark, data), stages, "conv_id", "turn", "role", "text")
        parts = stages.read("ordered", spark.read.parquet(stages._paths["ordered"]).schema).where("conv = 1").select("part").distinct().count()
        got = sorted(r["pos"] for r in turns.where("conv = 1").collect())
        assert parts > 1 and got == list(range(1, 401))
        assert rows(zfast_trie.prefix_trie(frame(spark, data))) == brute(data)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_two_fattest():
    for a in range(0, 70):
        for b in range(a + 1, 70):
            best = max(range(a + 1, b + 1), key=lambda n: n & -n)
            assert two_fattest(a, b) & -two_fattest(a, b) == best & -best and a < two_fattest(a, b) <= b


def test_zfast_trie():
    """Nodes are the ends and forks of what was inserted; exits take a number of look-ups that is logarithmic in the depth."""
    draw = random.Random(1)
    texts = [tuple(draw.choice("ab") for _ in range(draw.randint(0, 12))) for _ in range(200)] + [("a",) * 4000, ("a",) * 3000 + ("b",)]

    def sequence(t):
        keys = [(0, 0)]
        for x in t:
            keys.append((hash((keys[-1], x)), 1))
        return Sequence(0, keys, np.zeros(len(t) + 1, np.int64))

    trie = Trie(sequence(()))
    batch = [(sequence(t), 1, i, (i, 0)) for i, t in enumerate(texts)]
    for at in range(0, len(batch), 30):
        trie.add(batch[at:at + 30])
    got = {n.along.key(n.depth): (n.sums[0], n.low[0]) for n in trie.totals()}
    prefixes = {}
    for i, t in enumerate(texts):
        for d, k in enumerate(sequence(t).keys):
            prefixes.setdefault(k, []).append((i, t[d] if d < len(t) else None))
    want = {k: (len(x), min(i for i, _ in x)) for k, x in prefixes.items()
            if k == (0, 0) or len({s for _, s in x}) > 1 or any(s is None for _, s in x)}
    assert got == want

    class Counted(dict):
        asked = 0

        def get(self, *a):
            Counted.asked += 1
            return super().get(*a)

    trie.nodes = Counted(trie.nodes)
    assert trie.locate(sequence(("a",) * 4000 + ("c",))).depth == 4000 and Counted.asked <= 13
