"""Near-duplicate groups by SimHash: segments on a ring, chains of them within proportional budgets, then the full distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from partysieve.llm.components import components
from partysieve.llm.passages import narrowed
from partysieve.llm.words import signed, small_batches, utf8
from partysieve.sources.stages import StageArea

#: Words of a shingle, and the seed of its hash.
SHINGLE, SEED = 3, 42
#: Bits in which linked fingerprints differ at most.
DISTANCE = 3
#: Fingerprints of a bucket that are compared with each other at once. Larger buckets are dealt anew by
#: the finer ring, whose buckets have 4,096 fingerprints at most because they fix all but 12 bits.
BUCKET = 1000
#: Segments of the first and of the finer ring.
COARSE, FINE = 8, 16
#: Shingle hashes whose bits are spread out at once, and rows of buckets that are compared at once.
HASHES, ROWS = 200_000, 100_000


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """The 64-bit SimHash of each text: a bit is set if more than half of its shingles' hashes have it."""
    ones = np.zeros((len(texts), 64), np.int64)
    totals = np.zeros(len(texts), np.int64)
    hashes: list[int] = []
    runs: list[tuple[int, int]] = []  # text, number of hashes in turn

    def count() -> None:
        if hashes:
            flat = np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
            at = np.cumsum([0, *(n for _, n in runs[:-1])])
            ones[[i for i, _ in runs]] += np.add.reduceat(np.unpackbits(flat, axis=1), at, axis=0, dtype=np.int64)
            hashes.clear()
            runs.clear()

    for i, text in enumerate(texts):
        words = text.lower().split()  # of bytes: ASCII letters only
        line = b" ".join(words)
        ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
        starts = [0, *(e + 1 for e in ends)]
        grams = max(len(words) - SHINGLE + 1, min(len(words), 1))
        totals[i] = grams
        for a in range(0, grams, HASHES):
            b = min(a + HASHES, grams)
            last = ends[SHINGLE - 1 + a:SHINGLE - 1 + b] or [len(line)]
            hashes += [xxh64_intdigest(line[x:y], SEED) for x, y in zip(starts[a:b], last)]
            runs.append((i, b - a))
            if len(hashes) >= HASHES:
                count()
    count()
    return np.packbits(2 * ones > totals[:, None], axis=1).reshape(-1, 8).view(">u8").ravel().astype(np.uint64)


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = signed(fingerprints(utf8(batch.column("text"))))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=["doc_id", "print"])


def budget(length: int, segments: int) -> int:
    """Bits in which the first `length` segments of a chain differ at most."""
    return length * DISTANCE // segments


def chains(segments: int) -> list[tuple[int, int]]:
    """The start and the bits that are kept of each way in which a chain may spend its budget.

    Going round the ring from the right start, two fingerprints within the distance never exceed the budget
    of the segments so far. The segments before the budget becomes b + 1 hold b differences at most, so
    all but b of them are equal: each way names the segments that need not be. The coarse ring is
    followed until the budget is two, the fine one to its end.
    """
    bits = 64 // segments
    tops = [n for n in range(1, segments + 1) if n == segments or budget(n, segments) < budget(n + 1, segments)]
    tops = tops[:2] if segments == COARSE else tops
    ways: set[frozenset[int]] = {frozenset()}
    for low, n in zip([0, *tops], tops):
        ways = {w.union(more) for w in ways for k in range(budget(n, segments) - len(w) + 1) for more in combinations(range(low, n), k)}
    ways = {w for w in ways if not any(w < v for v in ways)}  # the others are covered by those that leave out more
    out = []
    for start in range(segments):
        for way in sorted(map(sorted, ways)):
            kept = [(start + i) % segments for i in range(tops[-1]) if i not in way]
            mask = sum(((1 << bits) - 1) << (64 - bits * (s + 1)) for s in kept)
            out.append((start, mask - (1 << 64) if mask >> 63 else mask))
    return out


def keyed(prints: DataFrame, segments: int) -> DataFrame:
    """key, start, print: a row for each way; fingerprints that agree in a way's bits share its key."""
    ways = F.array(*[F.struct(F.lit(i).alias("way"), F.lit(start).cast("byte").alias("start"), F.lit(mask).cast("long").alias("mask"))
                     for i, (start, mask) in enumerate(chains(segments))])
    return (prints.select("print", F.explode(ways).alias("w"))
            .select(F.xxhash64("w.way", F.col("print").bitwiseAND(F.col("w.mask"))).alias("key"), "w.start", "print"))


def within(x: np.ndarray, start: np.ndarray, segments: int) -> np.ndarray:
    """Which differences stay within the budgets of the chain from their start; its end is the full Hamming check."""
    bits = 64 // segments
    turn = start.astype(np.uint64) * np.uint64(bits)
    x = (x << turn) | (x >> ((np.uint64(64) - turn) & np.uint64(63)))
    left = np.arange(len(x))
    for n in range(1, segments + 1):
        left = left[np.bitwise_count(x[left] >> np.uint64(64 - n * bits)) <= budget(n, segments)]
    out = np.zeros(len(x), bool)
    out[left] = True
    return out


def joined(keys: np.ndarray, starts: np.ndarray, prints: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the fingerprints of each bucket as all links between them would. Equal keys are adjacent."""
    values, node = np.unique(prints, return_inverse=True)
    root = np.arange(len(values))
    rows, step = np.arange(len(keys)), 0
    while len(rows):
        step += 1
        rows = rows[rows + step < len(keys)]
        rows = rows[keys[rows] == keys[rows + step]]
        apart = rows[root[node[rows]] != root[node[rows + step]]]
        near = apart[within(prints[apart] ^ prints[apart + step], starts[apart], segments)]
        a, b = node[near], node[near + step]
        while len(a):
            x, y = root[a], root[b]
            open_ = x != y
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root = root[root]
    moved = np.flatnonzero(root != np.arange(len(root)))
    return values[moved], values[root[moved]]


def _compare(segments: int):
    """Links within the buckets of a partition that is sorted by key. A bucket is held whole; it is bounded."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0

        def links(upto: int | None):
            keys, starts, prints = (np.concatenate(c) for c in zip(*held))
            if upto is None:  # the last bucket may go on
                upto = int(np.searchsorted(keys, keys[-1]))
            rest = (keys[upto:], starts[upto:], prints[upto:])
            a, b = joined(keys[:upto], starts[:upto], prints[:upto].view(np.uint64), segments)
            return rest, pa.RecordBatch.from_arrays([pa.array(signed(a)), pa.array(signed(b))], names=["a", "b"])

        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy(False) for c in ("key", "start", "print")))
            n += batch.num_rows
            if n >= ROWS:
                rest, found = links(None)
                held, n = [rest], len(rest[0])
                yield found
        if n:
            yield links(n)[1]

    return of


def _near(prints: DataFrame, segments: int, stages: StageArea) -> tuple[DataFrame, DataFrame | None]:
    """Links of the buckets of one ring, and the fingerprints whose buckets are too large for it."""
    name = f"ring-{segments}"
    shared = keyed(prints, segments).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Written, so that the join reads both sides afresh and Spark can split the rows of a hot key.
    shared = stages.cut(shared, f"{name}-keys", {"hot": F.col("n") > BUCKET})
    members = stages.cut(keyed(prints, segments).join(shared, "key"), f"{name}-members")
    hot = stages.counted[f"{name}-keys"]["hot"] if segments == COARSE else 0
    cold = members.where(F.col("n") <= BUCKET) if hot else members
    small = cold.select("key", "start", "print").repartition("key").sortWithinPartitions("key", "print")
    links = stages.cut(small.mapInArrow(_compare(segments), "a long, b long"), f"{name}-links")
    if not hot:
        return links, None
    return links, stages.cut(members.where(F.col("n") > BUCKET).select("print").distinct(), f"{name}-hot")


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", stages: StageArea | None = None) -> DataFrame:
    """Per document doc_id, fingerprint, component_id.

    A fingerprint is the SimHash of all 3-word shingles, A-Z lower-cased, repeats included, by XXH64; a text with
    fewer words has one shingle, all its words, and one without words, or a null, has fingerprint zero. Documents
    whose fingerprints differ in three bits or fewer are linked; component_id is the smallest doc_id reachable.

    Equal fingerprints are one class. The 64 bits are segments on a ring: for any pair within the distance, the
    pigeonring principle gives a start from which the differences of the segments so far stay within
    their share of the distance. Classes are joined by the bits that such a chain must leave equal (32 of 64 for
    the ring of eight segments). In a bucket, pairs that are not joined yet run along the chain and drop out where it
    exceeds its budget; those that come round have passed the full Hamming check. Buckets with more than BUCKET classes, which
    are one group of near copies, go through the ring of sixteen segments followed to its end: its buckets fix 52 bits
    and so are bounded. Nothing is lost either way, and no bucket emits more links than it has classes.

    A null doc_id has a fingerprint, no links and a null component_id. Rows with one doc_id are one document, which
    has the links of all of them; each row shows its own fingerprint. Equal rows stay. Very long texts count whole. An
    empty table gives no rows. Other columns are ignored, whatever their names.
    """
    spark = documents.sparkSession
    stages = stages or StageArea(spark)
    small_batches(spark)
    found = stages.cut(narrowed(documents, doc_id, text).mapInArrow(_prints, "doc_id long, print long"), "prints")
    known = found.where("doc_id IS NOT NULL")
    classes = stages.cut(known.groupBy("print").agg(F.min("doc_id").alias("lead")), "classes")
    links, hot = _near(classes.select("print"), COARSE, stages)
    if hot is not None:
        links = links.unionByName(_near(hot, FINE, stages)[0])
    several = known.groupBy("doc_id").agg(F.min("print").alias("b"), F.max("print").alias("high")).where("b < high")
    links = links.unionByName(known.join(several, "doc_id").select(F.col("print").alias("a"), "b"))
    ends = components(links, stages, "ends")
    rooted = classes.join(ends.withColumnRenamed("node", "print"), "print", "left").select("print", "lead", F.coalesce("component", "print").alias("root"))
    rooted = stages.cut(rooted, "rooted")
    least = stages.cut(rooted.groupBy("root").agg(F.min("lead").alias("component_id")), "least")
    named = stages.cut(rooted.join(least, "root").select("print", "component_id"), "named")
    return (found.join(named, "print", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
                    F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))
