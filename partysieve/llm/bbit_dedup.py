"""Near-duplicate groups by b-bit MinHash: bands give candidates, bit counts estimate, full sets confirm."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partysieve.llm.components import components
from partysieve.llm.passages import narrowed
from partysieve.llm.words import BASES, Runs, hashed, mix, signed, small_batches, steps, utf8
from partysieve.sources.stages import StageArea

#: Words of a shingle.
SHINGLE = 5
#: Bands and minima of a band. Two sets of similarity 0.85 share no band with a chance of
#: (1 - 0.85 ** 5) ** 26, about 2e-7; unrelated texts share none.
BANDS, ROWS = 26, 5
#: Low bits that are kept of each minimum; 26 * 5 * 4 bits are 65 bytes a document.
BITS = 4
#: An estimate has a standard error of about 0.035 at 0.85. A pair this much below the threshold,
#: over seven errors, is not worth its full sets.
SLACK = 0.27
#: A row with its full set weighs as much as so many narrow rows.
WIDE = 10
#: Documents of a tile; two tiles are compared in one task.
TILE = 256

_SIGNED = "doc_id long, n_shingles long, one long, two long, bands array<long>"
_SETS = "doc_id long, cluster long, one long, shingles array<long>, signature binary"


def shingles(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted set of 64-bit shingle hashes of each text, A-Z lower-cased."""
    words, bounds = hashed([x.lower() for x in texts])  # of bytes: ASCII letters only
    runs = Runs(words, BASES[0])
    sizes = np.diff(bounds)
    grams = runs.of(np.arange(max(0, len(words) - SHINGLE + 1)), SHINGLE)
    out = []
    for start, n in zip(bounds[:-1].tolist(), sizes.tolist()):
        if n >= SHINGLE:
            out.append(np.unique(grams[start:start + n - SHINGLE + 1]))
        elif n:
            out.append(mix(runs.of(np.array([start]), n) + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _universal() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240501)
    a = draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


_A, _B = _universal()


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """For each non-empty set the least value of every hash function."""
    flat = np.concatenate(sets)
    at = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(_A), len(sets)), np.uint64)
    buffer = np.empty_like(flat)
    for i, (a, b) in enumerate(zip(_A, _B)):
        np.multiply(flat, a, out=buffer)
        buffer += b
        np.minimum.reduceat(buffer, at, out=out[i])
    return out.T


def packed(minima_: np.ndarray) -> list[bytes]:
    """The low bits of the minima, two to a byte."""
    low = (mix(minima_) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    return [x.tobytes() for x in (low[:, 0::2] << np.uint8(4)) | low[:, 1::2]]


_EQUAL_PARTS = np.array([(x & 15 == 0) + (x >> 4 == 0) for x in range(256)], np.uint8)


def estimates(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Similarities from packed signatures, corrected for minima that differ but collide in their low bits."""
    equal = _EQUAL_PARTS[one ^ many].sum(axis=-1) / (BANDS * ROWS)
    chance = 1 / (1 << BITS)
    return (equal - chance) / (1 - chance)


def _band_keys(minima_: np.ndarray) -> np.ndarray:
    out = np.zeros((len(minima_), BANDS), np.uint64) + mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for r in range(ROWS):
        out = mix(out ^ minima_[:, r::ROWS])
    return out


def set_keys(s: np.ndarray) -> tuple[int | None, int | None]:
    """128 bits that are equal for equal sets, in any order; nulls for an empty set."""
    if not len(s):
        return None, None
    one, two = mix(s).sum(keepdims=True), np.bitwise_xor.reduce(mix(s * _A[0] + np.uint64(len(s))), keepdims=True)
    return int(signed(one)[0]), int(signed(two)[0])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("doc_id"), utf8(batch.column("text"))
        for a, b in steps(texts):
            sets = shingles(texts[a:b])
            full = [i for i, s in enumerate(sets) if len(s)]
            keys: list = [None] * len(sets)
            if full:
                for i, k in zip(full, signed(_band_keys(minima([sets[i] for i in full])))):
                    keys[i] = k
            one, two = zip(*map(set_keys, sets))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()), pa.array(one, pa.int64()),
                 pa.array(two, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "one", "two", "bands"])


def _gather(sets_of: Callable[[list[bytes]], list[np.ndarray]]):
    """Full sets of the representatives among the rows; a row's other texts of its id are passed over."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, asked = utf8(batch.column("text")), batch.column("asked").to_pylist()
            ids, clusters = batch.column("doc_id").to_pylist(), batch.column("cluster").to_pylist()
            for a, b in steps(texts):
                rows = []
                for i, s in enumerate(sets_of(texts[a:b]), a):
                    if len(s) and set_keys(s)[0] in asked[i]:
                        rows.append((ids[i], clusters[i], set_keys(s)[0], s))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                         pa.array([r[2] for r in rows], pa.int64()),
                         pa.array([signed(r[3]) for r in rows], pa.list_(pa.int64())),
                         pa.array(packed(minima([r[3] for r in rows])), pa.binary())],
                        names=["doc_id", "cluster", "one", "shingles", "signature"])

    return of


def _linked(n: int, m: int, both: int, percent: int) -> bool:
    return 100 * both >= percent * (n + m - both)


def compare_tiles(percent: int):
    """Links that join what is still apart, between the targets and the askers of two tiles."""

    def of(group: pd.DataFrame) -> pd.DataFrame:
        ids, ask = group["doc_id"].to_numpy(), group["asks"].to_numpy()
        sets = [np.asarray(s).view(np.uint64) for s in group["shingles"]]
        sizes = np.array([len(s) for s in sets])
        marks = np.stack([np.frombuffer(x, np.uint8) for x in group["signature"]])
        parent = list(range(len(ids)))
        first: dict[int, int] = {}
        labels = group["label"].to_numpy()

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for i, label in enumerate(labels):  # what hubs have joined before, and rows of one id
            parent[root(i)] = root(first.setdefault(label, i))
        links = []
        targets = np.flatnonzero(~ask)
        for i in np.flatnonzero(ask):
            likely = estimates(marks[i], marks[targets])
            small, large = np.minimum(sizes[i], sizes[targets]), np.maximum(sizes[i], sizes[targets])
            near = np.flatnonzero((likely >= percent / 100 - SLACK) & (100 * small >= percent * large))
            for t in targets[near[np.argsort(-likely[near], kind="stable")]]:
                if root(i) != root(t):
                    both = len(np.intersect1d(sets[i], sets[t], assume_unique=True))
                    if _linked(sizes[i], sizes[t], both, percent):
                        links.append((ids[i], ids[t]))
                        parent[root(i)] = root(t)
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return of


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85,
                    stages: StageArea | None = None) -> DataFrame:
    """Per document doc_id, n_shingles, component_id, kept.

    Documents are linked whose sets of 5-word shingles (A-Z lower-cased) have a similarity of
    `percent` / 100 or more. A text with fewer words has one shingle, all its words; a null text,
    or one without words, has none and no link. component_id is the smallest doc_id reachable,
    kept is whether that is the document's own.

    Equal sets are one class, with its least document for all. Classes that share a band of
    full minima are candidates; they are gathered into clusters, outside which there is no link. In a
    cluster the document with the most band mates, its hub, is compared with all others on full
    sets, as long as that joins many; mostly nothing is left then, so that groups of thousands cost
    one comparison for each. Rows of different hubs, and rows of none, are then compared in tiles, skipping pairs
    that are joined already, that are too far apart by their distances to a hub, that differ in size, or
    whose corrected b-bit estimate is far too low.
    A tile gives at most one link for each document. No pair of a group is emitted otherwise.

    A null doc_id has no links, a null component_id and is kept. Rows with one doc_id are one document,
    which has the links of all of them. Other columns are ignored, whatever their names.
    """
    spark = documents.sparkSession
    stages = stages or StageArea(spark)
    small_batches(spark)
    documents = narrowed(documents, doc_id, text)
    return resolve(documents, documents.mapInArrow(_sign, _SIGNED), percent, stages)


def resolve(documents: DataFrame, signed_: DataFrame, percent: int, stages: StageArea,
            sets_of: Callable[[list[bytes]], list[np.ndarray]] = shingles) -> DataFrame:
    """The groups of `near_duplicates` from band keys: doc_id, n_shingles, the set's keys one and two, bands.

    documents: doc_id, text. sets_of gives texts' sorted full sets, with the same keys.
    """
    found = stages.cut(signed_, "signed")
    full = found.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stages.cut(full.groupBy("one", "two").agg(F.min("doc_id").alias("lead")), "classes", rows=stages.rows["signed"])
    leads = (full.join(classes, ["one", "two"]).where("doc_id = lead")
             .select("doc_id", "one", F.explode("bands").alias("band")))
    shared = (leads.groupBy("band").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
                                        F.count(F.lit(1)).alias("mates")).where("low < high"))
    # Written, here and for the hubs, so that Spark can split the rows of a hot band or cluster in the join.
    shared = stages.cut(shared, "shared")
    mates = stages.cut(leads.join(shared, "band").select("doc_id", "one", "low", "mates"), "mates")
    clusters = components(mates.select(F.col("doc_id").alias("a"), F.col("low").alias("b")), stages, "clusters", rows=stages.rows["mates"])
    asked = (mates.groupBy("doc_id").agg(F.collect_set("one").alias("asked"), F.sum("mates").alias("central"))
             .join(clusters.withColumnRenamed("node", "doc_id").withColumnRenamed("component", "cluster"), "doc_id"))
    asked = stages.cut(asked, "asked", rows=stages.rows["mates"])
    # The one join that moves every text; by merging at any size, so that small inputs foretell large ones.
    sets = stages.cut(documents.join(asked.hint("merge"), "doc_id").mapInArrow(_gather(sets_of), _SETS).dropDuplicates(["doc_id", "one"]), "sets")
    links = _links(sets, asked.select("doc_id", "central"), percent, stages)
    ends = components(links, stages, "ends", rows=stages.rows["links"]).withColumnRenamed("node", "lead")
    nodes = (found.where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", "n_shingles", "one", "two")
             .join(classes, ["one", "two"]).join(ends, "lead", "left")
             .select("doc_id", "n_shingles", F.coalesce("component", "lead").alias("component_id")))
    alone = found.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return nodes.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _links(sets: DataFrame, central: DataFrame, percent: int, stages: StageArea) -> DataFrame:
    """Links on full sets that give each cluster's components.

    The rows that the hub of a round joins are its star; star 0 are the rows of no hub. Jaccard distances obey the
    triangle inequality: a row linked to some row of a star has a similarity of 2 * percent / 100 - 1 or more to the
    star's hub. A row therefore asks only earlier stars whose hub is that close, and of these only the ones
    that links to hubs have not joined to it yet. Every row of star 0 also asks star 0.
    """
    size = F.size("shingles")
    state = sets.join(central, "doc_id").withColumns({"star": F.lit(0), "close": F.array().cast("array<int>")})
    state = stages.cut(state.select("doc_id", "cluster", "one", "shingles", "signature", "central", "star", "close"), "state-0", rows=WIDE * stages.rows["sets"])
    links: list[DataFrame] = []
    step, left = 0, stages.rows["state-0"]
    while left:
        step += 1
        open_ = state.where("star = 0")
        hub = open_.groupBy("cluster").agg(F.max(F.struct("central", F.negative("doc_id").alias("back"), "one")).alias("h"))
        hub = state.join(hub.select("cluster", F.negative("h.back").alias("doc_id"), F.col("h.one").alias("one")),
                         ["cluster", "doc_id", "one"])
        hub = stages.cut(hub.select("cluster", F.col("doc_id").alias("hub"), F.col("shingles").alias("hub_set")), f"hub-{step}", rows=stages.rows["sets"])
        small, large = F.least(size, F.size("hub_set")), F.greatest(size, F.size("hub_set"))
        # A row that has a star is only asked for links, an open one also whether it is close.
        least = F.when(F.col("star") == 0, 2 * percent - 100).otherwise(percent)
        both = F.when(small * 100 >= large * least, F.size(F.array_intersect("shingles", "hub_set")))

        def alike(share: int):
            return F.coalesce(F.col("both") * 100 >= (size + F.size("hub_set") - F.col("both")) * share, F.lit(False))

        tested = (state.join(hub, "cluster", "left").withColumn("both", both)
                  .withColumns({"linked": alike(percent), "near": alike(2 * percent - 100)}))
        # A row that an earlier hub has joined stays in its star; a link to both hubs joins the hubs.
        tested = tested.select("doc_id", "cluster", "one", "shingles", "signature", "central",
                               F.when((F.col("star") == 0) & F.col("linked"), step).otherwise(F.col("star")).alias("star"),
                               F.when((F.col("star") == 0) & F.col("near") & ~F.col("linked"), F.array_append("close", F.lit(step)))
                               .otherwise(F.col("close")).alias("close"),
                               F.when(F.col("linked"), F.col("hub")).alias("by"))
        tested = stages.cut(tested, f"state-{step}", rows=WIDE * stages.rows["sets"])
        links.append(tested.where("by IS NOT NULL AND by <> doc_id").select(F.col("doc_id").alias("a"), F.col("by").alias("b")))
        state = tested.drop("by")
        counts = state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("star") == 0).alias("u"))
        # Rows that the tiles would have to read, against those of another hub's round.
        tiles = F.ceil(F.col("n") / TILE)
        now = counts.agg(F.sum("u"), F.sum(F.when(F.col("u") > 0, F.col("n") * F.ceil(F.col("u") / TILE) + F.col("u") * tiles)),
                         F.sum(F.when(F.col("u") > 0, F.col("n")))).first()
        before, left = left, now[0] or 0
        if not left or now[1] <= 4 * now[2] or left > 0.9 * before:
            break
    out = sets.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b")).where("false")
    for more in links:
        out = out.unionByName(more)
    if left or step > 1:  # one star that has all rows needs nothing more
        out = out.unionByName(_between(state, out, percent, stages, step))
    return stages.cut(out, "links", rows=step * stages.rows["sets"])


def _between(state: DataFrame, known: DataFrame, percent: int, stages: StageArea, step: int) -> DataFrame:
    """Links between stars that the known ones leave apart, and of rows without a star."""
    n = stages.rows["sets"]
    labels = components(known, stages, "hubs", rows=step * n).select(F.col("node").alias("doc_id"), "component")
    marked = (state.select("cluster", "doc_id", "one", "star", "close").join(labels, "doc_id", "left")
              .select("cluster", "doc_id", "one", "star", "close", F.coalesce("component", "doc_id").alias("label")))
    marked = stages.cut(marked, "marked", rows=n)
    stars = marked.groupBy("cluster", "star").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("home"))
    asked = F.explode(F.when(F.col("star") == 0, F.array_append("close", F.lit(0))).otherwise(F.col("close")))
    asks = (marked.select("cluster", "doc_id", "one", "label", asked.alias("star")).join(stars, ["cluster", "star"])
            .where("CASE WHEN star = 0 THEN n > 1 ELSE label <> home END"))
    asks = stages.cut(asks.select("cluster", "star", "doc_id", "one", "label", "n"), "asks", rows=step * n)
    counts = (asks.groupBy("cluster", "star").agg(F.count(F.lit(1)).alias("u"), F.max("n").alias("n"))
              .select("cluster", "star", F.ceil(F.col("n") / TILE).alias("rows"), F.ceil(F.col("u") / TILE).alias("columns")))
    spread = F.xxhash64("doc_id", "one")
    sets = state.select("doc_id", "one", "shingles", "signature")
    targets = (state.drop("close").join(counts, ["cluster", "star"]).join(marked.select("doc_id", "one", "label"), ["doc_id", "one"])
               .withColumn("row", F.pmod(spread, F.col("rows")))
               .withColumn("column", F.explode(F.sequence(F.lit(0).cast("long"), F.col("columns") - 1)))
               .withColumn("asks", F.lit(False)))
    askers = (asks.drop("n").join(counts, ["cluster", "star"]).join(sets, ["doc_id", "one"])
              .withColumn("column", F.pmod(spread, F.col("columns")))
              .withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
              .withColumn("asks", F.lit(True)))
    pairs = targets.unionByName(askers, allowMissingColumns=True).select(
        "cluster", "star", "row", "column", "doc_id", "shingles", "signature", "label", "asks")
    return pairs.groupBy("cluster", "star", "row", "column").applyInPandas(compare_tiles(percent), "a long, b long")
