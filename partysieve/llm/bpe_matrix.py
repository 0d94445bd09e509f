"""Byte-level BPE in padded numpy matrices: each round, every row merges its leftmost pair of least rank."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partysieve.llm.words import small_batches

#: Pieces whose ids a worker remembers.
REMEMBERED = 200_000
#: Cells of a matrix.
CELLS = 1 << 21
#: Pieces with more bytes are a matrix of their own, of rows of SPAN symbols.
LONG, SPAN = 2048, 256
_NONE = np.int32(1 << 30)


class Pairs:
    """A hash table from two adjacent ids to the id they merge to, which is also its rank."""

    def __init__(self, left: np.ndarray, right: np.ndarray, new: np.ndarray):
        keys = self._key(left, right)
        size = 1 << int(4 * len(keys)).bit_length()
        self._mask = np.uint64(size - 1)
        self._keys = np.full(size, np.uint64(0xFFFFFFFFFFFFFFFF))
        self._new = np.full(size, _NONE, np.int32)
        self.probes, todo, at = 0, np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self._keys[at] == np.uint64(0xFFFFFFFFFFFFFFFF)
            slots, first = np.unique(at[free], return_index=True)
            won = todo[free][first]
            self._keys[slots], self._new[slots] = keys[won], new[won]
            left_over = np.ones(len(todo), bool)
            left_over[np.flatnonzero(free)[first]] = False
            todo, at = todo[left_over], (at[left_over] + np.uint64(1)) & self._mask
            self.probes += 1

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint64) << np.uint64(20) | right.astype(np.uint64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) & self._mask

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged id of each pair, or a number above all ids."""
        keys = self._key(left, right)
        at = self._slot(keys)
        out = np.where(self._keys[at] == keys, self._new[at], _NONE)
        open_ = np.flatnonzero((self._keys[at] != keys) & (self._new[at] != _NONE))
        keys, at = keys[open_], at[open_]
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at = (at + np.uint64(1)) & self._mask
            same = self._keys[at] == keys
            out[open_[same]] = self._new[at[same]]
            more = ~same & (self._new[at] != _NONE)
            open_, keys, at = open_[more], keys[more], at[more]
        return out


class Codec:
    """Encodes and decodes by a file of base64 tokens and their ranks, which are the ids."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self._ids = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.tokens = {rank: token for token, rank in self._ids.items()}
        pairs = [(self._ids[t[:i]], self._ids[t[i:]], rank) for t, rank in self._ids.items()
                 for i in range(1, len(t)) if t[:i] in self._ids and t[i:] in self._ids]
        self._pairs = Pairs(*np.array(pairs, np.int32).reshape(-1, 3).T)
        self._byte = np.array([self._ids[bytes([b])] for b in range(256)], np.int32)
        self._pieces = regex.compile(pattern)
        self._known: dict[str, tuple[str, int, bytes]] = {}

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece, by itself."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self._ids.get(piece)
            if whole is not None:
                out[i] = [whole]
            elif len(piece) > LONG:
                out[i] = self._merged_long(piece)
            else:
                buckets.setdefault(max(4, 1 << (len(piece) - 1).bit_length()), []).append(i)
        for width, members in sorted(buckets.items()):
            most = max(1, CELLS // width)
            for start in range(0, len(members), most):
                part = members[start:start + most]
                for i, ids in zip(part, self._merged([pieces[i] for i in part])):
                    out[i] = ids
        return out

    def _merged(self, pieces: list[bytes]) -> list[list[int]]:
        sizes = np.array([len(p) for p in pieces])
        ids = np.full((len(pieces), int(sizes.max())), -1, np.int32)
        ids[np.arange(ids.shape[1]) < sizes[:, None]] = self._byte[np.frombuffer(b"".join(pieces), np.uint8)]
        out: list = [None] * len(pieces)
        live = np.arange(len(pieces))
        rank = self._ranks(ids)
        while len(live):
            at = rank.argmin(axis=1)  # the leftmost of the least
            rows = np.arange(len(live))
            best = rank[rows, at]
            ended = best == _NONE
            if ended.any():
                for i, row, n in zip(live[ended], ids[ended].tolist(), sizes[ended].tolist()):
                    out[i] = row[:n]
                go = ~ended
                live, ids, rank, sizes, at, best = live[go], ids[go], rank[go], sizes[go], at[go], best[go]
                if not len(live):
                    break
                rows = np.arange(len(live))
            # Compaction: what is right of the pair moves one place to the left.
            sizes = sizes - 1
            width = int(sizes.max())
            source = np.arange(width)[None, :]
            source = source + (source > at[:, None])
            ids = np.take_along_axis(np.pad(ids, ((0, 0), (0, 1)), constant_values=-1), source, 1)
            ids[rows, at] = best
            rank = np.take_along_axis(np.pad(rank, ((0, 0), (0, 2)), constant_values=_NONE), source, 1)
            rank[rows, at] = self._at(ids, rows, at)
            left = at > 0
            rank[rows[left], at[left] - 1] = self._at(ids, rows[left], at[left] - 1)
        return out

    def _merged_long(self, piece: bytes) -> list[int]:
        """The ids of one long piece: the same merges in the same order, but a round only looks at what changed.

        The ranks lie in rows of SPAN places with their least value beside them, so that the leftmost least pair is found in two
        steps. A merge leaves a gap; when half of the places are gaps, they are closed.
        """
        ids = self._byte[np.frombuffer(piece, np.uint8)]
        while True:
            n = len(ids)
            rows = -(-n // SPAN)
            rank = np.full((rows, SPAN), _NONE, np.int32)
            flat = rank.reshape(-1)
            flat[:n - 1] = self._pairs.find(ids[:-1], ids[1:])
            low = rank.min(axis=1)
            own, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
            gaps = 0
            while 2 * gaps < n:
                row = int(low.argmin())
                best = int(low[row])
                if best == _NONE:
                    break
                at = row * SPAN + int(rank[row].argmin())
                gone = after[at]
                after[at] = to = after[gone]
                own[at], own[gone], flat[gone] = best, -1, _NONE
                flat[at] = _NONE
                if to < n:
                    before[to] = at
                    flat[at] = self._rank(own[at], own[to])
                changed = {row, gone // SPAN}
                if (left := before[at]) >= 0:
                    flat[left] = self._rank(own[left], best)
                    changed.add(left // SPAN)
                for r in changed:
                    low[r] = rank[r].min()
                gaps += 1
            ids = np.array([x for x in own if x >= 0], np.int32)
            if len(ids) < 2 or best == _NONE:
                return ids.tolist()

    def _rank(self, left: int, right: int) -> int:
        return self._ids.get(self.tokens[left] + self.tokens[right], int(_NONE))

    def _ranks(self, ids: np.ndarray) -> np.ndarray:
        out = np.full(ids.shape, _NONE, np.int32)
        both = ids[:, 1:] >= 0
        out[:, :-1][both] = self._pairs.find(ids[:, :-1][both], ids[:, 1:][both])
        return out

    def _at(self, ids: np.ndarray, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), _NONE, np.int32)
        full = at + 1 < ids.shape[1]
        full[full] = ids[rows[full], at[full] + 1] >= 0
        out[full] = self._pairs.find(ids[rows[full], at[full]], ids[rows[full], at[full] + 1])
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def rows(self, texts: list[str]) -> list[tuple[str, int, bytes]]:
        """Of each text its ids joined by one space, how many they are, and what they decode to."""
        pieces = [self._pieces.findall(t) for t in texts]
        known = self._known
        if len(known) > REMEMBERED:
            known.clear()
        own: dict[str, tuple[str, int, bytes]] = {}
        new = list({p for ps in pieces for p in ps if p not in known})
        for piece, ids in zip(new, self.encode_pieces([p.encode("utf-8", "surrogatepass") for p in new])):
            (known if len(piece) <= 64 else own)[piece] = (" ".join(map(str, ids)), len(ids), self.decode(ids))
        out = []
        for ps in pieces:
            found = [known.get(p) or own[p] for p in ps]
            out.append((" ".join([f[0] for f in found]), sum([f[1] for f in found]), b"".join([f[2] for f in found])))
        return out

    def encode(self, text: str) -> list[int]:
        return [int(x) for x in self.rows([text])[0][0].split()]


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One for each worker process and vocabulary."""
    return Codec(path, pattern)


def _steps(texts: list[str], limit: int = 1_000_000) -> Iterator[list[str]]:
    part: list[str] = []
    size = 0
    for text in texts:
        if part and size + len(text) > limit:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def encoded(documents: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """The documents' columns and `ids`, the token ids of the whole text (null and empty: none)."""
    small_batches(documents.sparkSession)
    kept = documents.drop("ids") if text != "ids" else documents

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            texts = [x or "" for x in batch.column(text).to_pylist()]
            ids = [[int(i) for i in r[0].split()] for part in _steps(texts) for r in own.rows(part)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))],
                                             names=[*batch.schema.names, "ids"])

    return kept.mapInArrow(of, T.StructType([*kept.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def digests(documents: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row doc_id, n_tokens, ids_sha256, decoded_sha256.

    Each text is encoded and decoded whole, however long it or a piece of it is, in one pass without a shuffle. A null or empty text has
    no ids; the digests are then those of nothing. Rows with null or repeated ids are rows like
    any other; other columns are ignored, whatever their names.
    """
    small_batches(documents.sparkSession)
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            found = [(n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(data).hexdigest())
                     for part in _steps(texts) for ids, n, data in own.rows(part)]
            n, ids, data = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(data, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(of, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
