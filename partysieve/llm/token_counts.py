"""Token counts without token ids: byte-pair merging with a heap and a linked list."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partysieve.llm.words import small_batches, utf8

#: Pieces whose counts a worker remembers.
REMEMBERED = 300_000


def byte_symbols() -> list[str]:
    """The visible character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others for U+0100 on, in turn.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Counter:
    """Counts tokens of texts by a vocabulary file with merges in order of rank."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        ids = model["vocab"]
        self._byte = [ids[s] for s in byte_symbols()]
        self._merge: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self._merge.setdefault(ids[left] << 20 | ids[right], (rank, ids[left + right]))
        special = [regex.escape(t["content"]) for t in data.get("added_tokens", [])]
        self._special = regex.compile("|".join(special)) if special else None
        self._pieces = regex.compile(pattern)
        self._known: dict[str, int] = {}

    def merges(self, data: bytes) -> int:
        """How many pairs merge in one piece: pop the lowest rank, join, look at the new neighbours."""
        ids = [self._byte[b] for b in data]
        n, merge = len(ids), self._merge
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = merge.get(ids[i] << 20 | ids[i + 1])
            if found:
                heap.append((found[0], i, ids[i] << 20 | ids[i + 1], found[1]))
        heapify(heap)
        done = 0
        while heap:
            _, i, pair, new = heappop(heap)
            j = after[i]
            if j >= n or ids[i] < 0 or ids[i] << 20 | ids[j] != pair:
                continue  # one of the two has merged with another since
            done += 1
            ids[i], ids[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := merge.get(new << 20 | ids[k]):
                    heappush(heap, (found[0], i, new << 20 | ids[k], found[1]))
            h = before[i]
            if h >= 0:
                if found := merge.get(ids[h] << 20 | new):
                    heappush(heap, (found[0], h, ids[h] << 20 | new, found[1]))
        return done

    def _count(self, piece: str) -> int:
        data = piece.encode("utf-8", "surrogatepass")
        return len(data) - self.merges(data)

    def count(self, text: str) -> int:
        """The number of tokens: initial symbols minus merges over all pieces; a special string is one."""
        if not self._special:
            return self._plain(text)
        total = start = 0
        for found in self._special.finditer(text):
            total += self._plain(text[start:found.start()]) + 1
            start = found.end()
        return total + self._plain(text[start:] if start else text)

    def _plain(self, text: str) -> int:
        known, total = self._known, 0
        for piece in self._pieces.findall(text):
            n = known.get(piece)
            if n is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                n = self._count(piece)
                if len(piece) <= 64:
                    known[piece] = n
            total += n
        return total


@lru_cache(maxsize=2)
def counter(path: str, pattern: str) -> Counter:
    """One for each worker process and vocabulary."""
    return Counter(path, pattern)


def count_tokens(documents: DataFrame, path: str, pattern: str, limit: int = 512,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens).

    Each text is counted whole, however long, by itself, in one pass without a shuffle. A null or empty text has
    no tokens; rows with null or repeated ids are counted like any other. `path` is a vocabulary
    file that every executor has. Other columns are ignored, whatever their names.
    """
    small_batches(documents.sparkSession)
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path, pattern).count
        for batch in batches:
            sizes = [len(x) for x in utf8(batch.column("text"))]
            tokens = [count(x) if x else 0 for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(of, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
