"""MinHash fingerprints: universal hash permutations over shingles, banded joins, verified similarity."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partysieve.llm.bbit_dedup import resolve, set_keys
from partysieve.llm.passages import narrowed
from partysieve.llm.words import BASES, WHITE, Runs, hashed, mix, small_batches, steps, utf8
from partysieve.sources.stages import StageArea

#: Words of a shingle, and hash functions of a signature.
SHINGLE, HASHES = 5, 64
#: Minima of a band; 16 bands then miss a pair of similarity 0.8 with a chance of 2e-4.
ROWS = 4

_draw = np.random.default_rng(7041)
_A = _draw.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _draw.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in turn (repeats included), and where each text's begin and end.

    A text with fewer words than a shingle has one of all its words; an empty one has that of none.
    """
    words, bounds = hashed(texts)
    n = np.diff(bounds)
    runs = Runs(words, BASES[0])
    length = np.where(n >= SHINGLE, SHINGLE, n)
    many = n - length + 1
    ends = np.cumsum(many)
    at = np.arange(ends[-1] if len(ends) else 0)
    text_of = np.repeat(np.arange(len(texts)), many)
    starts = bounds[text_of] + at - (ends - many)[text_of]
    grams = mix(runs.of(starts, length[text_of]) + length[text_of].astype(np.uint64))
    return grams, np.append(ends - many, ends[-1:] if len(ends) else [0])


def signatures(texts: list[bytes]) -> np.ndarray:
    """For each text the least value of every hash function over its shingles, as 32 bits."""
    if not texts:
        return np.zeros((0, HASHES), np.uint32)
    grams, bounds = shingle_sets(texts)
    out = np.empty((HASHES, len(texts)), np.uint32)
    buffer = np.empty_like(grams)
    for i, (a, b) in enumerate(zip(_A, _B)):
        np.multiply(grams, a, out=buffer)
        buffer += b
        out[i] = np.minimum.reduceat(buffer, bounds[:-1]) >> np.uint64(32)
    return np.ascontiguousarray(out.T)


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The share of equal minima, which estimates the similarity of the shingle sets."""
    return (one == other).mean(axis=-1)


def signed(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row doc_id, signature (64 unsigned 32-bit minima, as bytes) and fingerprint (the same in hex)."""
    small_batches(documents.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text"))
            for a, b in steps(texts):
                raw = [x.tobytes() for x in signatures(texts[a:b])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(raw, pa.binary()), pa.array([x.hex() for x in raw], pa.string())],
                    names=["doc_id", "signature", "fingerprint"])

    return narrowed(documents, doc_id, text).mapInArrow(of, "doc_id long, signature binary, fingerprint string")


def sets_of(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted set of each text's shingles; empty for a text without words."""
    grams, bounds = shingle_sets(texts)
    return [np.unique(grams[s:e]) if t.strip(WHITE) else grams[:0] for t, s, e in zip(texts, bounds[:-1], bounds[1:])]


def grouped(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80,
            stages: StageArea | None = None) -> DataFrame:
    """Groups of documents that are linked by equal bands and a similarity of `percent` / 100, verified on full sets.

    Per row doc_id, n_shingles, component_id (the smallest doc_id reachable), kept. Signature bands are joined,
    equal sets are represented by one document, and no group is spelled out in pairs; see
    `bbit_dedup.resolve`. Null ids and texts without words take no part; rows with one id are one document.
    """
    small_batches(documents.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text"))
            for a, b in steps(texts):
                sets, marks = sets_of(texts[a:b]), signatures(texts[a:b])
                keys = np.zeros((len(marks), HASHES // ROWS), np.uint64) + mix(np.arange(1, HASHES // ROWS + 1, dtype=np.uint64))
                for r in range(ROWS):
                    keys = mix(keys ^ marks[:, r::ROWS].astype(np.uint64))
                one, two = zip(*map(set_keys, sets))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()), pa.array(one, pa.int64()),
                     pa.array(two, pa.int64()),
                     pa.array([k if len(s) else None for k, s in zip(keys.view(np.int64), sets)], pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "one", "two", "bands"])

    documents = narrowed(documents, doc_id, text)
    bands = documents.mapInArrow(of, "doc_id long, n_shingles long, one long, two long, bands array<long>")
    return resolve(documents, bands, percent, stages or StageArea(documents.sparkSession), sets_of)


def edited(text: str, after: str) -> str:
    """The text with its last floor(n / 2) characters replaced by the first ones of the next document."""
    cut = len(text) // 2
    return text[:len(text) - cut] + after[:cut]


def _ranges(rows: DataFrame, parts: int) -> tuple[list[int], dict[int, list[int]], bool]:
    """Bounds of ranges of ids with about as many rows each, and where the first id of each also goes.

    Ids alone are read. The driver gets a sample of about 50 ids a range and one id for each range.
    """
    ids = rows.select("doc_id")
    n, nulls = ids.agg(F.count(F.lit(1)), F.count_if(F.col("doc_id").isNull())).first()
    share = min(1.0, 50 * parts / max(1, n))
    some = sorted(r[0] for r in ids.dropna().sample(share, 11).collect()) if n > nulls else []
    bounds = sorted({some[len(some) * i // parts] for i in range(1, parts)}) if some else []

    def parts_of(batches):
        for batch in batches:
            part, doc = _part(batch.column("doc_id"), bounds)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(doc)], names=["part", "doc_id"])

    firsts = sorted((r["part"], r["first"]) for r in ids.dropna().mapInArrow(parts_of, "part int, doc_id long")
                    .groupBy("part").agg(F.max("doc_id").alias("first")).collect())
    also: dict[int, list[int]] = {}
    for (before, _), (_, first) in zip(firsts, firsts[1:]):
        also.setdefault(first, []).append(before)
    if firsts:  # after the last comes the first; null ids stand between the two
        also.setdefault(firsts[0][1], []).append(len(bounds) + 1 if nulls else firsts[-1][0])
    return bounds, also, bool(nulls)


def _part(ids: pa.Array, bounds: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The part of each id, from the greatest ids to the least; nulls have the last one."""
    missing = ids.is_null().to_numpy(zero_copy_only=False)
    doc = ids.fill_null(0).to_numpy(zero_copy_only=False)
    part = len(bounds) - np.searchsorted(np.array(bounds, np.int64), doc, side="right")
    return np.where(missing, len(bounds) + 1, part).astype(np.int32), doc


def _even_keys(spark: SparkSession, parts: int) -> np.ndarray:
    """For each of so many partitions a number that Spark's hash deals to it, so that no two parts share one."""
    at = F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts))
    found = spark.range(40 * parts).groupBy(at.alias("at")).agg(F.min(F.col("id").cast("int")).alias("key")).collect()
    keys = {r["at"]: r["key"] for r in found}
    return np.array([keys.get(i, i) for i in range(parts)], np.int32)


def fingerprint_edits(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Per row doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next smaller id, after the last one the first. Equal ids
    follow each other by their texts, null ids come last, also by their texts; a null text is empty. An only document
    is its own next one. Other columns are ignored, whatever their names.

    Texts move once, to ranges of ids, in order; the first row of each range also goes to the range before, so
    that each row stands before its next one and no task sees more than its range and one batch at a time.
    """
    spark = documents.sparkSession
    small_batches(spark)
    rows = narrowed(documents, doc_id, text)
    parts = parts or 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds, also, nulls = _ranges(rows, parts)
    last = len(bounds) + 1

    keys = _even_keys(spark, parts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, doc = _part(batch.column("doc_id"), bounds)
            rows = np.arange(len(part))
            more = [(i, to) for i in rows[part < last].tolist() for to in also.get(int(doc[i]), ())]
            take = np.append(rows, [i for i, _ in more]).astype(np.int64)
            to = np.append(part, [to for _, to in more]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(take)), batch.column("text").take(pa.array(take)), pa.array(to),
                 pa.array(np.arange(len(take)) >= len(rows)), pa.array(keys[to % parts])],
                names=["doc_id", "text", "part", "halo", "key"])

    dealt = rows.mapInArrow(deal, "doc_id long, text string, part int, halo boolean, key int")
    if nulls:
        dealt = _with_nulls(rows, dealt, bounds, keys)
    ordered = dealt.repartition(parts, "key").sortWithinPartitions("part", "halo", F.desc_nulls_last("doc_id"), "text")
    return ordered.mapInArrow(_compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                        "edited_fingerprint string, near_edited double, near_next double")


def _with_nulls(rows: DataFrame, dealt: DataFrame, bounds: list[int], keys: np.ndarray) -> DataFrame:
    """The first null row follows the least id, so its text also goes there. Null ids are one part."""
    last = len(bounds) + 1
    first = rows.where("doc_id IS NULL").agg(F.min(F.coalesce("text", F.lit("")))).first()[0]
    nearest = rows.where("doc_id IS NOT NULL").agg(F.min("doc_id")).first()[0]
    if nearest is None:  # null ids only: the first follows the last
        to = last
    else:
        to = int(_part(pa.array([nearest], pa.int64()), bounds)[0][0])
    halo = rows.sparkSession.createDataFrame([(None, first, to, True, int(keys[to % len(keys)]))], dealt.schema)
    return dealt.withColumn("text", F.coalesce("text", F.lit(""))).unionByName(halo)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of ordered rows: each row that is no halo, with the row after it."""
    held: list[tuple] = []
    for batch in batches:
        new = list(zip(batch.column("doc_id").to_pylist(), [x or "" for x in batch.column("text").to_pylist()],
                       batch.column("part").to_pylist(), batch.column("halo").to_pylist()))
        for a, b in steps([x[1] for x in new]):
            rows = held + new[a:b]
            held = rows[-1:]
            yield from _compared(rows)


def _compared(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    at = [i for i in range(len(rows) - 1) if not rows[i][3] and rows[i][2] == rows[i + 1][2]]
    if not at:
        return
    own = signatures([x[1].encode() for x in rows])
    changed = [edited(rows[i][1], rows[i + 1][1]).encode() for i in at]
    after = signatures(changed)
    at_ = np.array(at)
    yield pa.RecordBatch.from_arrays(
        [pa.array([rows[i][0] for i in at], pa.int64()), pa.array([len(rows[i][1]) for i in at], pa.int64()),
         pa.array([hashlib.sha256(x).hexdigest() for x in changed], pa.string()),
         pa.array([own[i].tobytes().hex() for i in at], pa.string()), pa.array([x.tobytes().hex() for x in after], pa.string()),
         pa.array(likeness(own[at_], after)), pa.array(likeness(own[at_], own[at_ + 1]))],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
