"""Ranked lexical search over bit-sliced Bloom signatures: upper bounds first, exact scores for what they cannot exclude."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from partysieve.llm.passages import copy_of, narrowed
from partysieve.llm.words import mix, small_batches, utf8
from partysieve.sources.stages import StageArea

#: Hash positions of an entry, and bits of a signature for each entry at least (twice as many at most).
HASHES, BITS = 4, 8
#: Documents of a block at most, and bits of its slices together.
WIDTH, CELLS = 1024, 1 << 23
#: Entries tell these numbers of occurrences apart: 1, 2, 3, 4, 6, 8, 12, 16, 24, ...
LEVELS = np.sort([n << i for i in range(50) for n in (1, 3)])
#: Terms of a task's dictionary before it is handed on.
DICTIONARY = 100_000
#: Terms of the queries of one round; they are sent to every task.
QUERY_TERMS = 200_000
#: Rows and query numbers of candidates that are broadcast, under 10 MB; beyond that they are joined by shuffle.
BROADCAST_CANDIDATES = 300_000

#: What the terms of a text are, in the bytes of UTF-8: ASCII letters and digits, and all that is not ASCII.
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_INDEX = ("term string, documents long, bits int, doc_ids array<long>, copies array<long>, sizes array<long>, "
          "levels int, terms long, slices binary")
_ARROW = pa.schema([("term", pa.string()), ("documents", pa.int64()), ("bits", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                    ("copies", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("levels", pa.int32()),
                    ("terms", pa.int64()), ("slices", pa.binary())])


def terms_of(text: bytes) -> list[bytes]:
    return _TERM.findall(text.lower())  # of bytes: ASCII letters only


def positions(hashes: np.ndarray, level: np.ndarray | int, bits: int) -> np.ndarray:
    """The slices of entries (term, level), a row each."""
    x = mix(hashes + np.asarray(level).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    step = mix(x) | np.uint64(1)
    return ((x[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def gain(tf: np.ndarray | int, m: np.ndarray | int):
    """What a term's weight is multiplied by."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def lengths(sizes: list[int], documents: int, terms: int) -> list[int]:
    """Each document's m, from its number of terms."""
    return [100 - 25 + 25 * n * documents // terms for n in sizes]


@dataclass
class Index:
    """rows: partial counts of terms (term, documents), and blocks of signatures. Totals: documents with terms, all terms."""

    rows: DataFrame
    documents: int
    terms: int


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents whose signatures have the same number of bits, and partial counts of terms."""
    waiting: dict[int, list[tuple]] = {}
    seen: Counter[bytes] = Counter()

    def rows(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in _ARROW], schema=_ARROW)

    def counts() -> pa.RecordBatch:
        out = rows(len(seen), term=pa.array(list(seen), pa.binary()).cast(pa.string()), documents=pa.array(seen.values(), pa.int64()))
        seen.clear()
        return out

    def block(bits: int) -> pa.RecordBatch:
        ids, copies, sizes, levels, entries = zip(*waiting.pop(bits))
        dense = np.zeros((bits, -(-len(ids) // 8) * 8), bool)
        for i, (hashes, level) in enumerate(entries):
            dense[positions(hashes, level, bits), i] = True
        return rows(1, bits=pa.array([bits], pa.int32()), doc_ids=pa.array([ids], pa.list_(pa.int64())),
                    copies=pa.array([copies], pa.list_(pa.int64())), sizes=pa.array([sizes], pa.list_(pa.int64())),
                    levels=pa.array([max(levels)], pa.int32()), terms=pa.array([sum(sizes)], pa.int64()),
                    slices=pa.array([np.packbits(dense, axis=1).tobytes()], pa.binary()))

    for batch in batches:
        ids, copies = batch.column("doc_id").to_pylist(), batch.column("copy").to_pylist()
        for doc_id, copy, text in zip(ids, copies, utf8(batch.column("text"))):
            found = Counter(terms_of(text))
            if not found:
                continue
            seen.update(found.keys())
            hashes = np.fromiter(map(xxh64_intdigest, found), np.uint64, len(found))
            tf = np.fromiter(found.values(), np.int64, len(found))
            depth = np.searchsorted(LEVELS, tf, side="right")  # levels of each term
            entry = (np.repeat(hashes, depth), np.arange(depth.sum()) - np.repeat(np.cumsum(depth) - depth, depth))
            bits = 1 << max(6, int(BITS * len(entry[0]) - 1).bit_length())
            waiting.setdefault(bits, []).append((doc_id, copy, int(tf.sum()), int(depth.max()), entry))
            if len(waiting[bits]) >= max(8, min(WIDTH, CELLS // bits)):
                yield block(bits)
            if len(seen) >= DICTIONARY:
                yield counts()
    for bits in list(waiting):
        yield block(bits)
    if seen:
        yield counts()


def build(documents: DataFrame, stages: StageArea, doc_id: str = "doc_id", text: str = "text") -> Index:
    """Signatures of all documents, in one pass over their whole texts.

    A document's Bloom signature holds an entry for each term and each level of occurrences that it reaches.
    Documents with about as many entries make a block, whose slices hold one bit of all of them side by side.
    """
    small_batches(documents.sparkSession)
    docs = narrowed(documents, doc_id, text)
    rows = stages.cut(docs.withColumn("copy", copy_of(F.col("text"))).mapInArrow(_signatures, _INDEX), "index")
    n, terms = rows.where("slices IS NOT NULL").agg(F.sum(F.size("doc_ids")), F.sum("terms")).first()
    return Index(rows, n or 0, terms or 0)


class Queries:
    """The queries of one round: their terms' hashes and weights."""

    def __init__(self, rows: list[tuple[int, str, int]]):
        names = sorted({t for _, t, _ in rows})
        at = {t: i for i, t in enumerate(names)}
        self.hashes = np.array([xxh64_intdigest(t.encode()) for t in names], np.uint64)
        self.weights: dict[int, dict[bytes, int]] = {}
        for query, term, weight in rows:
            self.weights.setdefault(query, {})[term.encode()] = weight
        self.ids = list(self.weights)
        self.at = {q: np.array([at[t.decode()] for t in w]) for q, w in self.weights.items()}

    def bounds(self, bits: int, sizes: list[int], levels: int, slices: bytes, documents: int, terms: int) -> Iterator[tuple[int, np.ndarray]]:
        """Of each query, an upper bound of every document's score in a block."""
        width = -(-len(sizes) // 8)
        cells = np.frombuffer(slices, np.uint8).reshape(bits, width)
        n, m = np.array(sizes, np.int64), np.array(lengths(sizes, documents, terms), np.int64)
        masks, gains, live, before = [], [], np.arange(len(self.hashes)), np.int64(0)
        for level in range(levels):
            place = positions(self.hashes[live], level, bits)
            mask = np.zeros((len(self.hashes), width), np.uint8)
            mask[live] = cells[place[:, 0]]
            for i in range(1, HASHES):
                mask[live] &= cells[place[:, i]]
            if masks:
                mask &= masks[-1]
            live = np.flatnonzero(mask.any(axis=1))
            most = gain(np.minimum(LEVELS[level + 1] - 1, n), m)  # of a term that does not reach the next level
            masks.append(mask)
            gains.append(most - before)
            before = most
            if not len(live):
                break
        some = masks[0].any(axis=1)
        for query in self.ids:
            at, weights = self.at[query], np.fromiter(self.weights[query].values(), np.float64)
            bound = np.zeros(len(sizes), np.int64)
            keep = some[at]
            at, weights = at[keep], weights[keep]
            for mask, more in zip(masks, gains):
                keep = mask[at].any(axis=1)
                at, weights = at[keep], weights[keep]
                if not len(at):
                    break
                sums = weights @ np.unpackbits(mask[at], axis=1, count=len(sizes))
                bound += sums.astype(np.int64) * more
            yield query, bound

    def score(self, text: bytes, queries: list[int], documents: int, terms: int) -> list[int]:
        """The exact scores of a text."""
        found = terms_of(text)
        tf, m = Counter(found), lengths([len(found)], documents, terms)[0]
        gains = {t: gain(n, m) for t, n in tf.items()}
        return [sum(w * gains.get(t, 0) for t, w in self.weights[q].items()) for q in queries]


def _best(queries: Queries, index: Index, probes: int):
    """Of each query, the documents of a task with the greatest bounds."""
    documents, terms = index.documents, index.terms

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, list]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                for q, bound in queries.bounds(row["bits"], row["sizes"], row["levels"], row["slices"], documents, terms):
                    high, keys = best.get(q, (np.zeros(0, np.int64), []))
                    least = high[-1] if len(high) == probes else 0
                    new = np.flatnonzero(bound > least)
                    if len(new):
                        high = np.concatenate([high, bound[new]])
                        keys = keys + [(row["doc_ids"][i], row["copies"][i]) for i in new]
                        order = np.argsort(-high, kind="stable")[:probes]
                        best[q] = high[order], [keys[i] for i in order]
        out = [(q, int(b), *k) for q, (high, keys) in best.items() for b, k in zip(high, keys)]
        for at in range(0, len(out), 50_000):
            part = list(zip(*out[at:at + 50_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in part], names=["query", "bound", "doc_id", "copy"])

    return of


def _possible(queries: Queries, least: dict[int, int], index: Index):
    """Documents that some query's bound does not exclude, with those queries."""
    documents, terms = index.documents, index.terms

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asked: dict[int, list[int]] = {}
                for q, bound in queries.bounds(row["bits"], row["sizes"], row["levels"], row["slices"], documents, terms):
                    for i in np.flatnonzero(bound >= least.get(q, 1)).tolist():
                        asked.setdefault(i, []).append(q)
                if asked:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["doc_ids"][i] for i in asked], pa.int64()), pa.array([row["copies"][i] for i in asked], pa.int64()),
                         pa.array(list(asked.values()), pa.list_(pa.int64()))], names=["doc_id", "copy", "queries"])

    return of


def _scores(queries: Queries, index: Index):
    documents, terms = index.documents, index.terms

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, copy, text, asked in zip(batch.column("doc_id").to_pylist(), batch.column("copy").to_pylist(),
                                                 utf8(batch.column("text")), batch.column("queries").to_pylist()):
                found = queries.score(text, asked, documents, terms)
                rows += [(q, doc_id, copy, s) for q, s in zip(asked, found) if s > 0]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["query", "doc_id", "copy", "score"])

    return of


_SCORES = "query long, doc_id long, copy long, score long"


def _scored(docs: DataFrame, candidates: DataFrame, queries: Queries, index: Index, size: int) -> DataFrame:
    """Exact scores of candidates: doc_id, copy, queries. Each document is read once for all its queries."""
    named = candidates.select(F.col("doc_id").alias("id"), F.col("copy").alias("of"), "queries")
    named = F.broadcast(named) if size <= BROADCAST_CANDIDATES else named.hint("merge")
    met = docs.join(named, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("copy") == F.col("of")))
    return met.select("doc_id", "copy", "text", "queries").mapInArrow(_scores(queries, index), _SCORES)


def search(index: Index, documents: DataFrame, items: DataFrame, stages: StageArea, k: int = 20, doc_id: str = "doc_id",
           text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The `k` documents with the highest scores above 0 for each item: item_id, rank, doc_id, score.

    `index` is that of the same documents. A score sums, over the item's terms, the term's weight floor(1000 ln((2N + 2) / (2df + 1)))
    times (10^9 tf) div (1000 tf + 12 m), where m grows with the document's length; equal scores go by doc_id.

    Every block of signatures gives each query an upper bound for its documents: the slices of the query's terms are
    combined to bitmaps that have all documents with the term, level by level of occurrences, and the weighted sums of a level's
    bitmaps count with what a document of that length can gain there. The documents with the greatest bounds are scored
    exactly first; the k-th best of them is a threshold. All documents whose bound reaches it are then scored exactly, however many they are: no other can be
    among the k best. Queries go in rounds of about QUERY_TERMS terms, each of which reads the signatures twice.

    Items with equal texts are one query. A null or term-less item has no rows, as a document without terms is in none. A null or repeated
    item_id stands for each of its rows. Rows with equal doc_id are documents of their own, ordered by a digest of their text; a null doc_id comes after
    the others. Very long texts count whole. Empty tables give no rows. Other columns are ignored, whatever their names.
    """
    spark = documents.sparkSession
    small_batches(spark)
    docs = narrowed(documents, doc_id, text).withColumn("copy", copy_of(F.col("text")))
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).where("text IS NOT NULL")
    asked = asked.withColumn("query", F.xxhash64("text"))
    queried = stages.cut(asked.dropDuplicates(["query"]).mapInArrow(_query_terms, "query long, term string, times long"), "query-terms")
    known = (index.rows.where("term IS NOT NULL").select("term", "documents").join(queried.select("term").distinct(), "term")
             .groupBy("term").agg(F.sum("documents").alias("df")))
    weight = F.floor(1000 * F.log(F.lit(2.0 * index.documents + 2) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weights = stages.cut(queried.join(known, "term").select("query", "term", (F.col("times") * weight).alias("weight"))
                         .where("weight > 0"), "query-weights", rows=stages.rows["query-terms"])
    blocks = index.rows.where("slices IS NOT NULL").drop("term", "documents")
    rounds = -(-stages.rows["query-weights"] // QUERY_TERMS)
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "copy")
    results: list[DataFrame] = []
    for r in range(rounds):
        rows = weights.where(F.pmod("query", F.lit(rounds)) == r).collect()  # about QUERY_TERMS rows
        if not rows:
            continue
        queries = Queries([tuple(x) for x in rows])
        high = Window.partitionBy("query").orderBy(F.desc("bound"), "doc_id", "copy")
        first = (blocks.mapInArrow(_best(queries, index, 2 * k), "query long, bound long, doc_id long, copy long")
                 .withColumn("n", F.row_number().over(high)).where(F.col("n") <= 2 * k)
                 .groupBy("doc_id", "copy").agg(F.collect_set("query").alias("queries")))
        first = stages.cut(first, f"probes-{r}", rows=2 * k * len(queries.ids))
        tried = _scored(docs, first, queries, index, stages.rows[f"probes-{r}"] + 2 * k * len(queries.ids))
        kth = tried.withColumn("n", F.row_number().over(by_score)).where(F.col("n") == k)
        least = {x["query"]: x["score"] for x in kth.select("query", "score").collect()}  # a number for each query
        # Equal rows have equal signatures, so they ask the same.
        candidates = blocks.mapInArrow(_possible(queries, least, index), "doc_id long, copy long, queries array<long>")
        candidates = stages.cut(candidates.dropDuplicates(["doc_id", "copy"]), f"candidates-{r}", rows=index.documents)
        size = candidates.agg(F.coalesce(F.sum(F.size("queries") + 1), F.lit(0))).first()[0]
        scored = _scored(docs, candidates, queries, index, size).withColumn("rank", F.row_number().over(by_score))
        results.append(stages.cut(scored.where(F.col("rank") <= k), f"results-{r}", rows=k * len(queries.ids)))
    if not results:
        return asked.where("false").select("item_id", F.lit(1).alias("rank"), F.lit(1).cast("long").alias("doc_id"), F.lit(1).cast("long").alias("score"))
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    return asked.select("item_id", "query").join(found, "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for query, text in zip(batch.column("query").to_pylist(), utf8(batch.column("text"))):
            found = Counter(terms_of(text))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([query] * len(found), pa.int64()), pa.array(list(found), pa.binary()).cast(pa.string()),
                     pa.array(found.values(), pa.int64())], names=["query", "term", "times"])
