"""The mix against its promises."""

import pytest
from odd import DOCUMENTS, documents, rows

from partysieve.llm import mixture as m


def filled(sizes, weights, total, epochs):
    """Targets by sharing the excess again until none is above its limit."""
    out, free = {}, set(sizes)
    while free:
        level = (total - sum(out.values())) / sum(weights[s] for s in free)
        above = {s for s in free if weights[s] * level >= epochs * sizes[s]}
        if not above:
            return out | {s: weights[s] * level for s in free}
        out |= {s: epochs * sizes[s] for s in above}
        free -= above
    return out


def test_odd_rows(spark):
    got = m.taken(documents(spark)).collect()
    assert len(got) == len(DOCUMENTS)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert rows(m.taken(documents(spark))) == sorted(map(tuple, got), key=repr)  # reruns agree


def test_empty(spark):
    assert m.taken(documents(spark).where("false")).collect() == []
    assert m.repeated(documents(spark).where("false")).collect() == []
    assert {r["taken"] for r in m.taken(documents(spark).where("text IS NULL")).collect()} == {0}


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_targets(spark, block):
    docs = [(i, "w " * (i % 37), f"s{i % 7}" if i % 3 else None if i % 2 else "hot") for i in range(600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = m.taken(frame, block=block).join(frame.select("doc_id", "source"), "doc_id").collect()
    sizes, taken, target = {}, {}, {}
    for r in got:
        s = r["source"]
        sizes[s], taken[s] = sizes.get(s, 0) + r["size"], taken.get(s, 0) + r["taken"]
        target[s] = r["target"]
    names = sorted(s for s in sizes if s is not None) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    want = filled(sizes, weights, 1.5 * sum(sizes.values()), 2)
    for s in names:
        assert target[s] == pytest.approx(want[s]) and taken[s] == int(target[s] + 1e-9)


def test_schedule_is_even(spark):
    sources = spark.createDataFrame([(0, 60_000), (1, 30_000), (2, 0), (3, 9_000), (4, 1_000)], "source_id long, quota long")
    slots = sorted(map(tuple, m.schedule(spark, sources, block=10).collect()))
    assert len(slots) == 10_000 and len({s for s, _, _ in slots}) == 10_000
    for source, n in ((0, 6000), (1, 3000), (3, 900), (4, 100)):
        assert sorted(r for _, s, r in slots if s == source) == list(range(n))
        for start in range(0, 9000, 1000):  # any stretch has the overall share
            assert abs(sum(s == source for _, s, _ in slots[start:start + 1000]) - n / 10) <= 12


def test_repeated_keeps_columns(spark):
    frame = documents(spark)
    out = m.repeated(frame)
    assert out.columns == frame.columns
    assert out.groupBy("doc_id", "text").count().agg({"count": "max"}).first()[0] <= 4


def test_repeated_is_in_mixing_order(spark):
    docs = [(i, "w " * 10, "abc"[i % 3]) for i in range(600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    first = {(r["doc_id"], r["epoch"]): r["slot"] for r in _places(frame).collect()}
    seen, slots = {}, []
    for r in m.repeated(frame, block=10).collect():
        epoch = seen.get(r["doc_id"], 0)
        seen[r["doc_id"]] = epoch + 1
        slots.append(first[r["doc_id"], epoch])
    assert slots == sorted(slots) and len(slots) > 600


def _places(frame):
    mixed = m.mixture(frame, block=10)
    return mixed.pieces.join(mixed.rows.select("row", "doc_id"), "row").groupBy("doc_id", "epoch").agg({"slot": "min"}).withColumnRenamed("min(slot)", "slot")
