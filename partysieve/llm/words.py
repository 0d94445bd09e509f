"""Words of whole texts as numpy arrays: hashes, rolling hashes of runs, minimisers.

A word is a run of characters other than U+0020 and U+0009..U+000D. In UTF-8 these are single
bytes that occur in no other character, and `bytes.split()` splits at exactly these six.
All hashes are 64 bits wide and live in wrapping unsigned arithmetic.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from xxhash import xxh64_intdigest

#: Bytes of text that one numpy step takes together; a longer text is a step of its own.
STEP_BYTES = 1_000_000
#: Rows and bytes of an Arrow batch between the JVM and a Python worker; they bound both sides' memory.
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20


#: The bytes that are white space between words.
WHITE = b" \t\n\r\x0b\x0c"

#: By application, the folder with the code it was sent; removed when the process ends.
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def small_batches(spark: SparkSession) -> None:
    """Ready a session for Python tasks.

    Texts may be long, so fewer rows and bytes go at a time than by default. The package's code is sent to
    executors by Spark, once per application; they need not have it installed.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if spark.sparkContext.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.TemporaryDirectory(prefix="partysieve-code-", ignore_cleanup_errors=True)
        archive = Path(folder.name) / "partysieve.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped[spark.sparkContext.applicationId] = folder


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The texts' UTF-8 bytes; a null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def steps(texts: list[bytes], limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about `limit` bytes together."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of all texts in turn, and where each text's words begin and end."""
    words: list[bytes] = []
    bounds = np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        words += text.split()
        bounds[i + 1] = len(words)
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words)), bounds


@lru_cache(maxsize=8)
def _powers_to(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _powers(base: int, n: int) -> np.ndarray:
    return _powers_to(base, 1 << max(10, int(n).bit_length()))[:n]


class Runs:
    """Hashes of runs of words: a polynomial over the words' hashes, from prefix sums."""

    def __init__(self, words: np.ndarray, base: int):
        n = len(words)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * _powers(base, n), out=self._sums[1:])
        self._back = _powers(pow(base, -1, 1 << 64), n + 1)

    def of(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        """The hash of `lengths` words from each start; equal runs have equal hashes."""
        return mix((self._sums[starts + lengths] - self._sums[starts]) * self._back[starts])


#: Odd bases of two independent polynomials; together they make 128-bit hashes.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def two_runs(words: np.ndarray) -> tuple[Runs, Runs]:
    return Runs(words, BASES[0]), Runs(mix(words + np.uint64(1)), BASES[1])


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each start, the position of the least of `width` values from there, the first at a tie."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at, low, span = np.arange(len(values)), values, 1

    def better(at, low, shift, size):
        right = low[shift:shift + size] < low[:size]
        return (np.where(right, at[shift:shift + size], at[:size]),
                np.where(right, low[shift:shift + size], low[:size]))

    while span * 2 <= width:
        at, low = better(at, low, span, len(low) - span)
        span *= 2
    if span < width:
        at, low = better(at, low, width - span, n)
    return at[:n]
