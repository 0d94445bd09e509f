"""Repeated passages: what the suffix-array and the seed-and-extend operators share.

A window is `length` consecutive words of one document. Every window belongs to its minimiser,
the position inside it whose `k` words have the least hash (the first at a tie). Neighbouring
windows mostly have the same one; the windows of one minimiser make a *block*. What is chosen
depends on the window's words alone, so equal windows of two documents belong to equal
minimisers, at the same place in them. A window can therefore only repeat where a block with the
same k words at its minimiser (the same *anchor*) exists, and equal blocks repeat in all windows.

The two operators find out by their own methods which blocks repeat in whole and which may
repeat in part, and extend the latter from the shared anchor, word by word to both sides, each in its own order of
comparison (`extended`). An anchor with more than GROUP different blocks (the ends of a passage that very many
documents have, each in words of its own) is not extended pair by pair: all windows of its blocks are compared by
hash instead, which gives the same words. Documents concerned are read again once for both, and repeated words
are cut out. All rows are narrow but for two joins of texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from partysieve.llm.words import BASES, Runs, hashed, leftmost_minima, mix, signed, small_batches, steps, two_runs, utf8
from partysieve.sources.stages import StageArea

#: Words of an anchor. Long enough that unrelated texts hardly ever share one; a window of 50
#: words then has 35 places for its minimiser.
K = 16

#: Different blocks of one anchor that are extended against each other.
GROUP = 64
#: Rows that are extended at once.
ROWS = 20_000

#: Block rows have `start` set, document rows have `sha` set. `copy` tells rows with one
#: document id and different texts apart.
BLOCKS = ("doc_id long, copy long, start int, windows int, anchor long, right long, left long, "
          "n_words long, sha string")
#: Blocks with these equal have equal words and their minimiser at the same place.
SAME = ["anchor", "right", "left"]


def narrowed(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def copy_of(text: Column) -> Column:
    """Tells texts of one document id apart; the same number as `_copies` gives."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _copies(texts: list[bytes]) -> np.ndarray:
    return np.array([xxh64_intdigest(x, 42) for x in texts], np.uint64).view(np.int64)


class Blocks:
    """The blocks of some texts, as arrays over all of them."""

    def __init__(self, texts: list[bytes], length: int):
        self.length = length
        self.words, self.bounds = hashed(texts)
        width = length - K + 1
        self.runs = Runs(self.words, BASES[0])
        n = len(self.words)
        grams = self.runs.of(np.arange(max(0, n - K + 1)), K)
        least = leftmost_minima(grams, width)
        sizes = np.diff(self.bounds)
        text_of = np.repeat(np.arange(len(texts)), sizes)
        whole = np.zeros(len(least), bool)
        if len(least):
            whole = text_of[:len(least)] == text_of[length - 1:length - 1 + len(least)]
        starts = np.flatnonzero(whole)
        least = least[starts]
        if len(starts):
            new = np.ones(len(starts), bool)
            new[1:] = (least[1:] != least[:-1]) | (starts[1:] != starts[:-1] + 1)
            first = np.flatnonzero(new)
            self.count = np.diff(np.append(first, len(starts)))
            self.start, self.at = starts[first], least[first]
        else:
            self.count = self.start = self.at = np.zeros(0, np.int64)
        self.text = text_of[self.start]
        self.anchor = grams[self.at] if len(self.at) else np.zeros(0, np.uint64)

    def rows(self) -> dict[str, np.ndarray]:
        """Of each block: its first word's place in the text, the number of windows, and the hashes."""
        end = self.start + self.count + self.length - 1
        before, after = self.at - self.start, end - self.at
        salt = mix(before.astype(np.uint64) << np.uint64(32) | after.astype(np.uint64))
        return {
            "start": (self.start - self.bounds[self.text]).astype(np.int32),
            "windows": self.count.astype(np.int32),
            "anchor": signed(self.anchor),
            "right": signed(self.runs.of(self.at, after) ^ salt),
            "left": signed(self.runs.of(self.start, before) ^ salt),
        }


def blocks(documents: DataFrame, length: int) -> DataFrame:
    """A row for each block of every text, and one for each text; see BLOCKS."""
    if length <= K:
        raise ValueError(f"a passage has more than {K} words")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.array(batch.column("doc_id").to_pylist(), dtype=object)
            texts = utf8(batch.column("text"))
            for a, b in steps(texts):
                part, own = texts[a:b], ids[a:b]
                copies = _copies(part)
                found = Blocks(part, length)
                rows = found.rows()
                yield _batch(own[found.text], copies[found.text], len(found.text), **rows)
                shas = [hashlib.sha256(b" ".join(x.split())).hexdigest() for x in part]
                yield _batch(own, copies, len(part), n_words=np.diff(found.bounds), sha=shas)

    small_batches(documents.sparkSession)
    return documents.mapInArrow(of, BLOCKS)


_ARROW = pa.schema([("doc_id", pa.int64()), ("copy", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()),
                    ("anchor", pa.int64()), ("right", pa.int64()), ("left", pa.int64()), ("n_words", pa.int64()), ("sha", pa.string())])


def _batch(ids, copies, n: int, **columns) -> pa.RecordBatch:
    columns |= {"doc_id": list(ids), "copy": copies}
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _ARROW], schema=_ARROW)


def grouped(occurrences: DataFrame, stages: StageArea) -> tuple[DataFrame, DataFrame]:
    """Which blocks repeat in whole, and which may repeat in part, from joins by their hashes.

    Equal blocks are represented by the least document: others repeat in whole. Where an anchor
    has blocks that differ, their representatives' windows must be compared. Aggregates are
    written before they are joined back: Spark can then split the rows of a hot block or anchor.
    """
    rows = occurrences.where("doc_id IS NOT NULL")
    classes = stages.cut(rows.groupBy(*SAME).agg(F.min("doc_id").alias("lead"), F.max("doc_id").alias("last")), "block-classes")
    forks = (classes.groupBy("anchor")
             .agg(F.count(F.lit(1)).alias("n"), F.min("lead").alias("low"), F.max("last").alias("high"))
             .where("n > 1 AND low < high").select("anchor"))
    whole = rows.join(classes.where("lead < last"), SAME).where("doc_id > lead")
    forked = stages.cut(classes.join(forks, "anchor", "left_semi").select(*SAME, "lead"), "forked")
    return whole, rows.join(forked, SAME).where("doc_id = lead")


def windows_of(texts: list[bytes], asked: list[list[tuple[int, int]]], length: int):
    """Text, place and 128-bit hash of each window of the blocks asked for (start, windows)."""
    words, bounds = hashed(texts)
    one, two = two_runs(words)
    text = np.repeat(np.arange(len(texts)), [len(x) for x in asked])
    flat = np.array([y for x in asked for y in x], np.int64).reshape(-1, 2)
    which = np.repeat(np.arange(len(flat)), flat[:, 1])
    within = np.arange(len(which)) - np.repeat(np.cumsum(flat[:, 1]) - flat[:, 1], flat[:, 1])
    place = flat[which, 0] + within
    at = place + bounds[text[which]]
    return text[which], place, signed(one.of(at, length)), signed(two.of(at, length))


def surroundings(texts: list[bytes], asked: list[list[tuple[int, int, int]]], length: int):
    """Of each block asked for (start, windows, anchor): its text, the anchor's place there, and the words around it.

    The words are hashes: `length` from the anchor's first on, and length - K before it, the nearest first. Those
    outside the block are zero.
    """
    words, bounds = hashed(texts)
    text = np.repeat(np.arange(len(texts)), [len(x) for x in asked])
    start, count, anchor = np.array([y for x in asked for y in x], np.int64).reshape(-1, 3).T
    first = bounds[text] + start
    grams = signed(Runs(words, BASES[0]).of(np.arange(max(0, len(words) - K + 1)), K))
    at = first + (grams[first[:, None] + np.arange(length - K + 1)] == anchor[:, None]).argmax(axis=1)
    end = first + count + length - 1

    def near(steps_: np.ndarray) -> np.ndarray:
        place = at[:, None] + steps_
        inside = (place >= first[:, None]) & (place < end[:, None])
        return np.where(inside, words[np.clip(place, 0, len(words) - 1)], np.uint64(0))

    return text, at - bounds[text], near(np.arange(length)), near(-1 - np.arange(length - K))


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from the first on are equal, in rows of words; zero stands for none."""
    return np.logical_and.accumulate((a == b) & (a != 0), axis=1).sum(axis=1)


def extended(length: int, sorted_: bool):
    """Spans of words that repeat around shared anchors, from the blocks of a partition that is sorted by anchor.

    Each block is compared with the others of its anchor, up to the first different word on both sides; what is
    `length` words or longer repeats in the later document. Blocks that are `sorted_` by the words from the anchor on are a
    stretch of a suffix array: only neighbours are compared to the right, others have the least of the prefixes between them.
    """

    def spans(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        anchor, docs, copies, at = (rows[c] for c in ("anchor", "doc_id", "copy", "start"))
        right, left = (np.frombuffer(b"".join(rows[c]), np.uint64).reshape(len(anchor), -1) for c in ("after", "before"))
        low, step, out = np.arange(len(anchor)), 0, []
        prefix = common(right[:-1], right[1:]) if sorted_ else None
        reach = np.full(len(anchor), length)
        while len(low):
            step += 1
            low = low[low + step < len(anchor)]
            low = low[anchor[low] == anchor[low + step]]
            high = low + step
            if sorted_:
                reach[low] = np.minimum(reach[low], prefix[high - 1])
                forward = reach[low]
            else:
                forward = common(right[low], right[high])
            back = common(left[low], left[high])
            hit = (forward + back >= length) & (docs[low] != docs[high])
            later = np.where(docs[low] > docs[high], low, high)[hit]
            out.append(np.stack([later, at[later] - back[hit], at[later] + forward[hit]]))
        row, a, b = np.unique(np.concatenate([np.zeros((3, 0), np.int64), *out], axis=1), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(docs[row], pa.int64()), pa.array(copies[row], pa.int64()),
                                           pa.array(a, pa.int32()), pa.array(b, pa.int32())], names=["doc_id", "copy", "from", "to"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        n = 0

        def cut_off(all_: bool):
            rows = {c: np.concatenate([x[c] for x in held]) for c in held[0]}
            upto = n if all_ else int(np.flatnonzero(rows["anchor"] == rows["anchor"][-1])[0])  # the last group may go on
            return {c: x[upto:] for c, x in rows.items()}, spans({c: x[:upto] for c, x in rows.items()})

        for batch in batches:
            if batch.num_rows:
                held.append({c: batch.column(c).to_numpy(False) for c in ("anchor", "doc_id", "copy", "start", "after", "before")})
                n += batch.num_rows
            if n >= ROWS:
                rest, found = cut_off(False)
                held, n = [rest], len(rest["anchor"])
                yield found
        if n:
            yield cut_off(True)[1]

    return of


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of words [from, to) that overlapping or touching spans cover."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> tuple[list[bytes], int, list[tuple[int, int]]]:
    """The words outside the spans, how many are inside, and the maximal repeats."""
    words, kept, at = text.split(), [], 0
    merged = covered(spans)
    for a, b in merged:
        kept += words[at:a]
        at = b
    kept += words[at:]
    return kept, len(words) - len(kept), merged


_WINDOWS = "doc_id long, copy long, start int, one long, two long, anchor long, after binary, before binary"
_WINDOW_ROWS = pa.schema([("doc_id", pa.int64()), ("copy", pa.int64()), ("start", pa.int32()), ("one", pa.int64()), ("two", pa.int64()),
                          ("anchor", pa.int64()), ("after", pa.binary()), ("before", pa.binary())])


def repeated_spans(documents: DataFrame, whole: DataFrame, partly: DataFrame, stages: StageArea, length: int,
                   order: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The texts that may have repeats (doc_id, copy, text), and the repeated spans of words of those that do.

    documents: doc_id, text. whole: blocks that repeat in whole (doc_id, copy, start, windows). partly: blocks
    that may repeat in part (also anchor), one or a few of each kind. `order` are the columns by which the blocks of an anchor
    are sorted to be extended: `after`, the words from the anchor on, makes them a suffix array. Both results are
    written: spans has doc_id, copy, spans.
    """
    parts = stages.cut(partly.select("doc_id", "copy", "start", "windows", "anchor"), "parts")
    many = stages.cut(parts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP).select("anchor", F.lit(True).alias("many")), "many")
    parts = parts.join(many, "anchor", "left").withColumn("many", F.coalesce("many", F.lit(False)))
    marks = (whole.select("doc_id", "copy", F.lit(None).cast("struct<start: int, windows: int, anchor: bigint, many: boolean>").alias("mark"))
             .unionByName(parts.select("doc_id", "copy", F.struct("start", "windows", "anchor", "many").alias("mark")))
             .groupBy("doc_id", "copy").agg(F.collect_set("mark").alias("marks")))
    # The one join that moves every text.
    texts = documents.withColumn("copy", copy_of(F.col("text")))
    concerned = texts.join(marks, ["doc_id", "copy"]).select("doc_id", "copy", "text", "marks")
    concerned = stages.cut(concerned, "concerned")

    def compare(batches):
        for batch in batches:
            ids, copies = batch.column("doc_id").to_numpy(False), batch.column("copy").to_numpy(False)
            texts = utf8(batch.column("text"))
            marks_ = batch.column("marks").to_pylist()
            hashed_ = [[(m["start"], m["windows"]) for m in x if m["many"]] for x in marks_]
            grown = [[(m["start"], m["windows"], m["anchor"]) for m in x if not m["many"]] for x in marks_]

            def rows(text, place, **columns):
                columns |= dict(doc_id=pa.array(ids[a:b][text], pa.int64()), copy=pa.array(copies[a:b][text], pa.int64()),
                                start=pa.array(place.astype(np.int32)))
                return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(len(text), f.type)) for f in _WINDOW_ROWS], schema=_WINDOW_ROWS)

            for a, b in steps(texts):
                if any(hashed_[a:b]):
                    text, place, one, two = windows_of(texts[a:b], hashed_[a:b], length)
                    yield rows(text, place, one=pa.array(one), two=pa.array(two))
                if any(grown[a:b]):
                    text, place, after, before = surroundings(texts[a:b], grown[a:b], length)
                    anchor = [y[2] for x in grown[a:b] for y in x]
                    yield rows(text, place, anchor=pa.array(anchor, pa.int64()), after=pa.array([x.tobytes() for x in after], pa.binary()),
                               before=pa.array([x.tobytes() for x in before], pa.binary()))

    found = stages.cut(concerned.mapInArrow(compare, _WINDOWS), "windows")
    windows = found.where("one IS NOT NULL").select("doc_id", "copy", "start", "one", "two")
    by = ["anchor", *(order or ()), "doc_id", "copy", "start"]
    groups = (found.where("anchor IS NOT NULL").select("anchor", "doc_id", "copy", "start", "after", "before")
              .repartition("anchor").sortWithinPartitions(*by))
    grown = groups.mapInArrow(extended(length, "after" in (order or ())), "doc_id long, copy long, from int, to int")
    # Written, so that the join reads both sides afresh and Spark can split a window that very many documents have.
    earliest = stages.cut(windows.groupBy("one", "two").agg(F.min("doc_id").alias("lead"), F.max("doc_id").alias("last"))
                          .where("lead < last").drop("last"), "earliest")
    repeated = windows.join(earliest, ["one", "two"]).where("doc_id > lead")
    spans = (repeated.select("doc_id", "copy", F.col("start").alias("from"), (F.col("start") + length).alias("to"))
             .unionByName(whole.select("doc_id", "copy", F.col("start").alias("from"),
                                       (F.col("start") + F.col("windows") + (length - 1)).alias("to")))
             .unionByName(grown)
             .groupBy("doc_id", "copy").agg(F.collect_set(F.struct("from", "to")).alias("spans")))
    return concerned.select("doc_id", "copy", "text"), stages.cut(spans, "spans")


def cut(documents: DataFrame, found: DataFrame, whole: DataFrame, partly: DataFrame,
        stages: StageArea, length: int, order: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Remove repeated words; see `repeated_spans`. found: what `blocks` gave.

    Returns documents without a repeat (doc_id, n_words, sha) and, for the others, doc_id, copy, text,
    and their repeated spans of words.
    """
    concerned, spans = repeated_spans(documents, whole, partly, stages, length, order)
    hit = concerned.join(spans, ["doc_id", "copy"])
    rest = found.where("sha IS NOT NULL").join(spans.select("doc_id", "copy"), ["doc_id", "copy"], "left_anti")
    return rest.select("doc_id", "n_words", "sha"), hit.select("doc_id", "copy", "text", "spans")


def digests(hit: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, n_repeats, sha of documents with repeated spans."""

    def of(batches):
        for batch in batches:
            ids, spans = batch.column("doc_id"), batch.column("spans").to_pylist()
            rows = []
            for text, own in zip(utf8(batch.column("text")), spans):
                kept, gone, merged = without(text, [(s["from"], s["to"]) for s in own])
                rows.append((len(kept) + gone, gone, len(merged), hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array([r[i] for r in rows], pa.int64()) for i in range(3)), pa.array([r[3] for r in rows], pa.string())],
                names=["doc_id", "n_words", "n_removed", "n_repeats", "sha"])

    return hit.mapInArrow(of, "doc_id long, n_words long, n_removed long, n_repeats long, sha string")


def table(rest: DataFrame, hit: DataFrame) -> DataFrame:
    """One row per document: words, removed words, maximal repeats, digest of what stays."""
    zero: Column = F.lit(0).cast("long")
    return (rest.select("doc_id", "n_words", zero.alias("n_removed"), zero.alias("n_repeats"), "sha")
            .unionByName(digests(hit))
            .select("doc_id", "n_words", "n_removed", "n_repeats", F.col("sha").alias("kept_sha256")))
