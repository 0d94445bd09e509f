"""Substring dedup by a sparse suffix array: sort suffixes at minimisers, compare neighbours, extend matches to both sides."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from partysieve.llm import passages
from partysieve.sources.stages import StageArea

_SORTED = ["anchor", "right", "left", "doc_id", "copy", "start"]
_FOUND = "doc_id long, copy long, start int, windows int, anchor long, right long, left long, low long, high long, kind string"


def split(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 50,
          stages: StageArea | None = None) -> tuple[DataFrame, DataFrame]:
    """Remove repeats of at least `min_words` words of which a document with a smaller id has one too.

    Of all suffixes only those at content-selected minimisers are kept (about one in eighteen
    words); any repeat of the least length has at least one. They are sorted twice. First by hashes: of the
    words at the minimiser, of the block's rest to the right, then to the left, then by the
    document, so that equal content is adjacent. Range partitions with the document in their key also split a suffix
    that a third of all documents have. Neighbours in this order are compared: those equal to
    the right and to the left repeat in whole, and the first of them, with the least
    document, stays. The first and the last suffixes of a partition may go on
    in another one: a few rows of each partition's ends are joined to decide on them. What is left, one suffix of each kind
    that shares its minimiser's words with others and differs on a side, is sorted by content, the words one after the other: neighbours' common
    prefixes give the match to the right, words before the minimiser are compared to extend it to the left (`passages.extended`; a minimiser with
    very many kinds goes by the hashes of all its windows).

    Results and the cases of nulls, repeated rows and clashing names are those of
    `seed_extend.split`; the way there is another. Returns documents without a repeat (doc_id,
    n_words, sha) and those with one (doc_id, copy, text, spans).
    """
    documents = passages.narrowed(documents, doc_id, text)
    stages = stages or StageArea(documents.sparkSession)
    found, whole, partly = _decided(documents, min_words, stages)
    return passages.cut(documents, found, whole, partly, stages, min_words, order=["after"])


def repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 50,
            stages: StageArea | None = None) -> DataFrame:
    """Only the spans that `split` removes, of the documents that have any: doc_id, copy, spans."""
    documents = passages.narrowed(documents, doc_id, text)
    stages = stages or StageArea(documents.sparkSession)
    _, whole, partly = _decided(documents, min_words, stages)
    return passages.repeated_spans(documents, whole, partly, stages, min_words, order=["after"])[1]


def _decided(documents: DataFrame, min_words: int, stages: StageArea) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All suffixes, those of blocks that repeat in whole, and those of blocks that may repeat in part."""
    found = stages.cut(passages.blocks(documents, min_words), "suffixes")
    suffixes = found.where("start IS NOT NULL AND doc_id IS NOT NULL").drop("n_words", "sha")
    array = suffixes.repartitionByRange(*_SORTED).sortWithinPartitions(*_SORTED)
    kinds = stages.cut(array.mapInArrow(neighbours, _FOUND), "neighbours")
    # Two or four rows of each partition tell what goes on in the next one.
    ends = kinds.where("kind = 'end'")
    leads = ends.groupBy(*passages.SAME).agg(F.min("doc_id").alias("lead"))
    forks = (ends.groupBy("anchor")
             .agg(F.min(F.struct("right", "left")).alias("one"), F.max(F.struct("right", "left")).alias("other"),
                  F.min("low").alias("low"), F.max("high").alias("high"))
             .select("anchor", ((F.col("one") != F.col("other")) & (F.col("low") < F.col("high"))).alias("fork")))
    opened = (kinds.where("kind = 'open'").join(leads, passages.SAME, "left").join(forks, "anchor")
              .withColumn("kind", F.when(F.col("doc_id") > F.col("lead"), "whole").when(F.col("fork"), "part")))
    columns = ["doc_id", "copy", "start", "windows", "anchor", "kind"]
    decided = kinds.where("kind IN ('whole', 'part')").select(*columns).unionByName(opened.select(*columns))
    return found, decided.where("kind = 'whole'"), decided.where("kind = 'part'")


def dedup(documents: DataFrame, **options) -> DataFrame:
    """`split`, then one row per document: doc_id, n_words, n_removed, n_repeats, kept_sha256."""
    return passages.table(*split(documents, **options))


def cleaned(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 50,
            stages: StageArea | None = None) -> DataFrame:
    """doc_id and text with the repeats cut out, of those documents only that have any."""
    _, hit = split(documents, doc_id, text, min_words, stages)
    return hit.select("doc_id", "copy", without_spans("text", "spans").alias("text"))


@F.arrow_udf(StringType())
def without_spans(text: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts without the words of their spans and the white space after each of them; a null stays null."""
    return pa.array([None if t is None else _rest(t, [(s["from"], s["to"]) for s in own or ()])
                     for t, own in zip(text.cast(pa.binary()).to_pylist(), spans.to_pylist())], pa.string())


#: Else Spark moves a filter on the result below, and cuts every text a second time in Python processes of their own.
without_spans = without_spans.asNondeterministic()


def _rest(text: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the white space after each of them."""
    gone = set()
    for a, b in passages.covered(spans):
        gone.update(range(a, b))
    pieces = _WORDS.finditer(text)
    return b"".join(m.group() for i, m in enumerate(pieces) if i not in gone).decode()




#: A word with the white space after it; the first one with that before it.
_WORDS = re.compile(rb"(?:\A[\t-\r ]+)?[^\t-\r ]+[\t-\r ]*")


_ROW = ("doc_id", "copy", "start", "windows", "anchor", "right", "left")


class _Group:
    """What is known of the suffixes of one minimiser so far, in one partition."""

    def __init__(self, first: dict[str, int], is_first: bool):
        self.first, self.is_first = first, is_first
        self.last, self.low, self.high, self.classes = first, first["doc_id"], first["doc_id"], 0
        self.waiting: list[dict[str, np.ndarray]] = []  # of the least documents, until blocks are known to differ

    @property
    def fork(self) -> bool:
        return self.classes > 1 and self.low < self.high


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decide the suffixes of one sorted partition by comparing each with the one before it.

    Batches stream through: of a minimiser whose suffixes go on, only those of one document wait. The first and the last
    minimiser of the partition may go on in another one: what is not certain of them is left open, and their end rows tell what is here.
    """
    group: _Group | None = None
    before: dict[str, int] | None = None  # the row before, with the least document of its class as lead
    first_class = True
    out: list[tuple[str, dict[str, np.ndarray], int, int]] = []

    def take(rows: dict[str, np.ndarray], which: np.ndarray) -> dict[str, np.ndarray]:
        return {c: rows[c][which] for c in _ROW}

    def decided() -> Iterator[pa.RecordBatch]:
        for kind, rows, low, high in out:
            n = len(rows["doc_id"])
            for at in range(0, n, 50_000):
                part = [pa.array(rows[c][at:at + 50_000], pa.int32() if c in ("start", "windows") else pa.int64()) for c in _ROW]
                k = len(part[0])
                yield pa.RecordBatch.from_arrays([*part, pa.array(np.full(k, low)), pa.array(np.full(k, high)), pa.array([kind] * k, pa.string())],
                                                 names=[*_ROW, "low", "high", "kind"])
        out.clear()

    def end(row: dict[str, int]) -> None:
        out.append(("end", {c: np.array([row["lead" if c == "doc_id" else c]]) for c in _ROW}, group.low, group.high))

    def close(is_last: bool) -> None:
        if group.is_first or is_last:
            for rows in group.waiting:
                out.append(("open", rows, group.low, group.high))
            end(group.first)
            end(group.last)

    def absorb(rows: dict[str, np.ndarray], fresh: np.ndarray, lead: np.ndarray, a: int, b: int) -> None:
        """Rows a to b go on with the current group."""
        nonlocal first_class
        docs = rows["doc_id"][a:b]
        group.low, group.high = min(group.low, int(docs.min())), max(group.high, int(docs.max()))
        group.classes += int(fresh[a:b].sum())
        group.last = {c: int(rows[c][b - 1]) for c in _ROW} | {"lead": int(lead[b - 1])}
        own = a + np.flatnonzero(docs == lead[a:b])
        if first_class:  # its least document may be in an earlier partition
            starts = a + np.flatnonzero(fresh[a:b])
            later = [x for x in starts.tolist() if not (a == 0 and before is None and x == 0)]
            until = later[0] if later else b
            out.append(("open", take(rows, own[own < until]), group.low, group.high))
            own = own[own >= until]
            first_class = not later
        if len(own):
            group.waiting.append(take(rows, own))
        if group.fork:
            for waiting in group.waiting:
                out.append(("part", waiting, group.low, group.high))
            group.waiting = []

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        rows = {c: batch.column(c).to_numpy(False).astype(np.int64) for c in _ROW}

        def changed(*names: str) -> np.ndarray:
            new = np.zeros(n, bool)
            for c in names:
                new[1:] |= rows[c][1:] != rows[c][:-1]
                new[0] |= before is None or int(rows[c][0]) != before[c]
            return new

        fresh, begins = changed(*passages.SAME), np.flatnonzero(changed("anchor"))
        place = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))
        lead = np.where(place >= 0, rows["doc_id"][place], before["lead"] if before else 0)
        whole = rows["doc_id"] > lead
        if whole.any():
            out.append(("whole", take(rows, np.flatnonzero(whole)), 0, 0))
        edges = [0, *begins[begins > 0].tolist(), n]
        if group is None or (len(begins) and begins[0] == 0):
            if group is not None:
                close(False)
                first_class = False
            group = _Group({c: int(rows[c][0]) for c in _ROW} | {"lead": int(rows["doc_id"][0])}, group is None)
        absorb(rows, fresh, lead, 0, edges[1])
        if len(edges) > 2:
            close(False)
            first_class = False
            inner = np.array(edges[1:-1])  # where groups begin; all but the last end in this batch
            if len(inner) > 1:
                span = slice(inner[0], inner[-1])
                at = inner[:-1] - inner[0]
                sizes = np.diff(inner)
                classes = np.add.reduceat(fresh[span].astype(np.int64), at)
                low, high = np.minimum.reduceat(rows["doc_id"][span], at), np.maximum.reduceat(rows["doc_id"][span], at)
                fork = np.repeat((classes > 1) & (low < high), sizes)
                parts = inner[0] + np.flatnonzero(fork & ~whole[span])
                if len(parts):
                    out.append(("part", take(rows, parts), 0, 0))
            a = int(inner[-1])
            group = _Group({c: int(rows[c][a]) for c in _ROW} | {"lead": int(rows["doc_id"][a])}, False)
            absorb(rows, fresh, lead, a, n)
        before = {c: int(rows[c][n - 1]) for c in _ROW} | {"lead": int(lead[n - 1])}
        yield from decided()
    if group is not None:
        close(True)
        yield from decided()
