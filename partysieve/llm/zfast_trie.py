"""Prefix trie of conversations: z-fast tries in the tasks, their nodes expanded and merged by Spark."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partysieve.llm.words import BASES, mix, signed, small_batches
from partysieve.sources.stages import StageArea

#: Turns of a piece; a longer conversation is cut into pieces, which go to tasks of their own.
PIECE = 4096
#: Turns that the tries of a task hold before their nodes are handed on.
HELD = 400_000
#: Turns that a donor passes on, and conversations that share a donor.
HEADS, SHARED = 4, 20

_WORDS = r"[^\x20\x09-\x0D]+"
_KEY = ["depth", "p1", "p2"]


@dataclass(eq=False)
class Sequence:
    """A piece of a conversation: prefix keys and words so far, from the depth before its first turn."""

    start: int
    keys: list[tuple[int, int]]
    words: np.ndarray

    @property
    def end(self) -> int:
        return self.start + len(self.keys) - 1

    def key(self, depth: int) -> tuple[int, int]:
        return self.keys[depth - self.start]


@dataclass(eq=False)
class Node:
    """A compacted node: the edge from its parent's depth (left out) to its own depth, along some sequence."""

    above: int
    depth: int
    along: Sequence
    children: dict[tuple[int, int], Node] = field(default_factory=dict)
    sums: list[int] = field(default_factory=lambda: [0, 0])
    low: tuple[int, int] | None = None

    def handle(self) -> tuple[int, tuple[int, int]]:
        depth = two_fattest(self.above, self.depth)
        return depth, self.along.key(depth)


def two_fattest(a: int, b: int) -> int:
    """The number in (a, b] that the highest power of two divides."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


class Trie:
    """A z-fast trie: compacted nodes by the prefix at the two-fattest depth of their edge."""

    def __init__(self, root: Sequence):
        self.root = Node(root.start - 1, root.start, root)
        self.nodes: dict[tuple[int, tuple[int, int]], Node] = {}

    def locate(self, s: Sequence, node: Node | None = None) -> Node:
        """The deepest node whose whole prefix the sequence has, by fat binary search below `node`."""
        node = node or self.root
        a, b = node.depth, s.end
        while a < b:
            f = two_fattest(a, b)
            met = self.nodes.get((f, s.key(f)))
            if met is None:
                b = f - 1
            elif met.depth <= s.end and met.along.key(met.depth) == s.key(met.depth):
                node, a = met, met.depth
            else:  # the sequence leaves on this node's edge, below its parent
                b = met.above
        return node

    def insert(self, s: Sequence, node: Node) -> Node:
        """The node at the end of the sequence; it exits at `node` or below."""
        node = self.locate(s, node)
        if node.depth == s.end:
            return node
        child = node.children.get(s.key(node.depth + 1))
        if child is None:
            return self._hang(node, s)
        low, high = node.depth + 1, min(child.depth, s.end)
        while low < high:  # the last depth where both are equal
            half = (low + high + 1) // 2
            low, high = (half, high) if child.along.key(half) == s.key(half) else (low, half - 1)
        del self.nodes[child.handle()]
        middle = Node(node.depth, low, child.along)
        node.children[child.along.key(node.depth + 1)] = middle
        child.above = low
        middle.children[child.along.key(low + 1)] = child
        self.nodes[child.handle()] = child
        self.nodes[middle.handle()] = middle
        return middle if low == s.end else self._hang(middle, s)

    def _hang(self, node: Node, s: Sequence) -> Node:
        leaf = Node(node.depth, s.end, s)
        node.children[s.key(node.depth + 1)] = leaf
        self.nodes[leaf.handle()] = leaf
        return leaf

    def add(self, batch: list[tuple[Sequence, int, int, tuple[int, int]]]) -> None:
        """Insert a batch: all exit nodes are located first. Each sequence brings two numbers, and its id with another one."""
        exits = [self.locate(s) for s, *_ in batch]
        for (s, x, y, low), found in zip(batch, exits):
            node = self.insert(s, found)
            node.sums[0] += x
            node.sums[1] += y
            if node.low is None or low < node.low:
                node.low = low

    def totals(self) -> list[Node]:
        """All nodes, each with the numbers of its whole subtree."""
        order, stack = [], [self.root]
        while stack:
            node = stack.pop()
            order.append(node)
            stack.extend(node.children.values())
        for node in reversed(order):
            for child in node.children.values():
                node.sums[0] += child.sums[0]
                node.sums[1] += child.sums[1]
                if child.low is not None and (node.low is None or child.low < node.low):
                    node.low = child.low
        return order


_NODES = ("conv long, depth long, p1 long, p2 long, q1 long, q2 long, x long, y long, low long, low_value long, "
          "words long, before long")
_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in _NODES.split(", ")])


def sequences(batch: pa.RecordBatch) -> list[Sequence]:
    """The pieces of a batch. A prefix's key are two polynomials over the digests of its turns."""
    column = batch.column("turns")
    flat, at = column.flatten(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))])
    digests = np.frombuffer(b"".join(flat.field("digest").to_pylist()), "<u8").reshape(-1, 2)
    words = flat.field("words").to_numpy(zero_copy_only=False)
    start, before = batch.column("start").to_pylist(), batch.column("before").to_pylist()
    s1, s2 = batch.column("s1").to_pylist(), batch.column("s2").to_pylist()
    out = []
    for i, o in enumerate(start):
        part = slice(int(at[i]), int(at[i + 1]))
        powers = np.arange(o + 1, o + 1 + part.stop - part.start)
        sums = [np.concatenate([np.array([first], np.int64).view(np.uint64), digests[part, k] * _power(BASES[k], powers)]).cumsum(dtype=np.uint64)
                for k, first in enumerate((s1[i], s2[i]))]
        keys = list(zip(*(signed(mix(x)).tolist() for x in sums)))
        out.append(Sequence(o, keys, before[i] + np.concatenate([[0], words[part].cumsum()]).astype(np.int64)))
    return out


def _power(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents, in wrapping arithmetic; exponents follow one another."""
    if not len(exponents):
        return np.zeros(0, np.uint64)
    out = np.full(len(exponents), base, np.uint64)
    out[0] = pow(base, int(exponents[0]), 1 << 64)
    return np.multiply.accumulate(out)


def _expanded(trie: Trie) -> Iterator[pa.RecordBatch]:
    """The edges of a trie as nodes of one turn each; the root only where it is the root of all."""
    rows: list[np.ndarray] = []
    held = 0
    for node in trie.totals():
        s, low = node.along, node.low
        if node is trie.root:
            if node.depth:
                continue
            part = [[0], [s.keys[0][0]], [s.keys[0][1]], [0], [0], [0], [0]]
        else:
            a, b = node.above - s.start, node.depth - s.start
            own = np.array(s.keys[a:b + 1], np.int64)
            part = [np.arange(node.above + 1, node.depth + 1), own[1:, 0], own[1:, 1], own[:-1, 0], own[:-1, 1],
                    np.diff(s.words[a:b + 1]), s.words[a:b]]
        n = len(part[0])
        rows.append(np.vstack([*part, *(np.full(n, v) for v in (*node.sums, *low))]))
        held += n
        if held >= 50_000:
            yield _rows(rows)
            rows, held = [], 0
    if rows:
        yield _rows(rows)


def _rows(parts: list[np.ndarray]) -> pa.RecordBatch:
    depth, p1, p2, q1, q2, words, before, x, y, low, value = np.hstack(parts).astype(np.int64)
    columns = dict(depth=depth, p1=p1, p2=p2, q1=q1, q2=q2, x=x, y=y, low=low, low_value=value, words=words, before=before)
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name]) if f.name in columns else pa.nulls(len(depth), f.type) for f in _ARROW], schema=_ARROW)


def tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the tries of a partition's pieces, and where each conversation ends (conv and its node's key).

    Pieces that go on from the same prefix are one trie. Tries are handed on, and begun afresh, when they hold HELD turns.
    """
    found: dict[tuple, Trie] = {}
    held = 0
    for batch in batches:
        pieces = sequences(batch)
        x, y, value, conv = (batch.column(c).to_pylist() for c in ("x", "y", "value", "conv"))
        of: dict[tuple, list] = {}
        for i, s in enumerate(pieces):
            of.setdefault((s.start, s.keys[0]), []).append((s, x[i], y[i], (conv[i], value[i])))
            held += len(s.keys)
        for at, group in of.items():
            if at not in found:
                found[at] = Trie(group[0][0])
            found[at].add(group)
        last = [i for i, is_last in enumerate(batch.column("last").to_pylist()) if is_last]
        ends = dict(conv=[conv[i] for i in last], depth=[pieces[i].end for i in last],
                    p1=[pieces[i].keys[-1][0] for i in last], p2=[pieces[i].keys[-1][1] for i in last])
        yield pa.RecordBatch.from_arrays([pa.array(ends.get(f.name, [None] * len(last)), f.type) for f in _ARROW], schema=_ARROW)
        if held >= HELD:
            for trie in found.values():
                yield from _expanded(trie)
            found, held = {}, 0
    for trie in found.values():
        yield from _expanded(trie)


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions of turns within the part of their conversation that a sorted partition has."""
    part, last, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        conv, n = batch.column("conv").to_numpy(), batch.num_rows
        if not n:
            continue
        first = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        local = np.arange(n) - np.repeat(first, np.diff(np.append(first, n))) + 1
        if conv[0] == last:
            local[:(first[1] if len(first) > 1 else n)] += count
        last, count = conv[-1], int(local[-1])
        yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(np.full(n, part)), pa.array(local), batch.column("digest"), batch.column("words")],
                                         names=["conv", "part", "local", "digest", "words"])


def _ordered(conversations: DataFrame, stages: StageArea, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """conv, pos, digest, words of all turns, and the conversations (conv).

    Range partitions in the order of turns split a long conversation; a turn's position in its partition is raised by what
    earlier partitions have of its conversation, a number for each partition at most.
    """
    own, said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    turns = conversations.select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.md5(own), F.md5(said)))).alias("digest"),
        F.regexp_count(said, F.lit(_WORDS)).cast("long").alias("words"), F.monotonically_increasing_id().alias("any")).where("conv IS NOT NULL")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("any")]
    parts = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "digest", "words")
    rows = stages.cut(parts.mapInArrow(_placed, "conv long, part long, local long, digest binary, words long"), "ordered")
    spans = stages.cut(rows.groupBy("conv", "part").agg(F.max("local").alias("n")), "spans")
    several = spans.groupBy("conv").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1").select("conv")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (spans.join(several, "conv").select("conv", "part", F.sum("n").over(before).alias("before")).where("before IS NOT NULL"))
    # At most one row for each partition of `rows`: the conversation that its first row goes on with.
    placed = (rows.join(F.broadcast(earlier), ["conv", "part"], "left")
              .select("conv", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "words"))
    return placed, spans.select("conv").distinct()


def _rebuilt(turns: DataFrame, convs: DataFrame, stages: StageArea) -> DataFrame:
    """conv, depth, digest, words of the rebuilt conversations; a row of depth 0 for each stands for the root."""
    heads = (turns.where((F.col("conv") % SHARED == 0) & (F.col("pos") < HEADS)).groupBy(F.col("conv").alias("donor"))
             .agg(F.collect_list(F.struct("pos", "digest", "words")).alias("head")))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    known = (convs.withColumns({"h": h, "donor": F.col("conv") - F.col("conv") % SHARED}).join(heads, "donor", "left")
             .select("conv", "h", F.filter("head", lambda t: t["pos"] <= F.col("h")).alias("head")))
    known = known.withColumn("given", F.greatest(F.size("head"), F.lit(0)).cast("long"))
    known = stages.cut(known, "heads")  # written, so that Spark can split the turns of a long conversation in the join
    own = (turns.join(known.select("conv", "h", "given"), "conv").where("pos > h")
           .select("conv", (F.col("pos") - F.col("h") + F.col("given")).alias("depth"), "digest", "words"))
    given = known.select("conv", F.explode("head").alias("t")).select("conv", F.col("t.pos").cast("long").alias("depth"), "t.digest", "t.words")
    root = known.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("words"))
    return own.unionByName(given).unionByName(root)


def _pieces(rows: DataFrame, stages: StageArea) -> DataFrame:
    """conv, start, turns, s1, s2, before, total, last: pieces of bounded length with what they need to know of the others."""
    piece = F.expr(f"(greatest(depth, 1) - 1) div {PIECE}")
    gathered = rows.groupBy("conv", piece.alias("piece")).agg(
        F.sort_array(F.collect_list(F.when(F.col("depth") > 0, F.struct("depth", "digest", "words")))).alias("turns"), F.sum("words").alias("own"))
    gathered = stages.cut(gathered.select("conv", (F.col("piece") * PIECE).alias("start"), F.transform("turns", lambda t: F.struct(t["digest"], t["words"])).alias("turns"), "own"),
                          "gathered", {"long": F.col("start") > 0})
    zero = F.lit(0).cast("long")
    if not stages.counted["gathered"]["long"]:
        return gathered.select("conv", "start", "turns", zero.alias("s1"), zero.alias("s2"), zero.alias("before"), F.col("own").alias("total"), F.lit(True).alias("last"))
    long = stages.cut(gathered.where("start > 0").groupBy("conv").agg(F.max("start").alias("top")), "long")
    sums = gathered.join(long, "conv").mapInArrow(_summed, "conv long, start long, s1 long, s2 long, own long")
    sums = sums.repartition("conv").sortWithinPartitions("conv", "start").mapInArrow(_running, "conv long, start long, s1 long, s2 long, before long")
    sums = stages.cut(sums, "running")
    totals = gathered.join(long, "conv").groupBy("conv").agg(F.sum("own").alias("total"), F.max("start").alias("top"))
    totals = stages.cut(totals, "totals")
    return (gathered.join(sums, ["conv", "start"], "left").join(totals, "conv", "left")
            .select("conv", "start", "turns", F.coalesce("s1", zero).alias("s1"), F.coalesce("s2", zero).alias("s2"),
                    F.coalesce("before", zero).alias("before"), F.coalesce("total", "own").alias("total"),
                    (F.col("start") == F.coalesce("top", zero)).alias("last")))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each piece adds to the polynomials of its conversation, and its words."""
    for batch in batches:
        out = []
        for conv, start, turns, own in zip(*(batch.column(c).to_pylist() for c in ("conv", "start", "turns", "own"))):
            digests = np.frombuffer(b"".join(t["digest"] for t in turns), "<u8").reshape(-1, 2)
            powers = np.arange(start + 1, start + 1 + len(digests))
            out.append((conv, start, *(int(signed((digests[:, k] * _power(BASES[k], powers)).sum(keepdims=True, dtype=np.uint64))[0]) for k in (0, 1)), own))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["conv", "start", "s1", "s2", "own"])


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of all earlier pieces; a partition is sorted by conversation and start."""
    last, s1, s2, words = None, 0, 0, 0
    wrap = (1 << 64) - 1
    for batch in batches:
        out = []
        for conv, start, a, b, own in zip(*(c.to_pylist() for c in batch.columns)):
            if conv != last:
                last, s1, s2, words = conv, 0, 0, 0
            out.append((conv, start, *(x - (1 << 64) if x >> 63 else x for x in (s1, s2)), words))
            s1, s2, words = (s1 + a) & wrap, (s2 + b) & wrap, words + own
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["conv", "start", "s1", "s2", "before"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the sorted ids of each node; a partition is sorted by node and id, and holds one state."""
    key, state, done = None, None, []

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([*(pa.array([d[i] for d in done], pa.int64()) for i in range(3)), pa.array([d[3] for d in done], pa.string())],
                                         names=[*_KEY, "sha"])
        done.clear()
        return out

    for batch in batches:
        for *at, conv in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "conv"))):
            if at != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = at, hashlib.sha256(b"%d" % conv)
            else:
                state.update(b",%d" % conv)
        if done:
            yield flush()
    if key is not None:
        done.append((*key, state.hexdigest()))
        yield flush()


def _merged(nodes: DataFrame) -> DataFrame:
    """The nodes of all tries, one row for each."""
    return nodes.groupBy(*_KEY).agg(
        F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.sum("x").alias("x"), F.sum("y").alias("y"), F.min(F.struct("low", "low_value")).alias("low"),
        F.min("words").alias("words"), F.min("before").alias("before"))


def prefix_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                stages: StageArea | None = None) -> DataFrame:
    """The prefixes that rebuilt conversations share: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A conversation c is rebuilt from the first h turns of conversation c - c % 20, h = crc32(c) % 4, and its own turns after its first h.
    Each distinct prefix of a rebuilt conversation is a node; see the columns in the README.

    Turns become digests of 128 bits and go to range partitions in their order, so that no conversation is sorted in one task. Rebuilt
    conversations, in pieces of PIECE turns, go through z-fast tries: compacted nodes in a table by the prefix at the two-fattest depth
    of their edge. For each batch, the exit nodes are located by fat binary search, a number of look-ups that is logarithmic in the depth, and the sequences are
    inserted there. A trie's edges are expanded to nodes of one turn, and Spark adds up the nodes of all tries by their prefix: a prefix that very many
    conversations have is one row of each trie. Sums over subtrees come from sums over members: what depends on distinct nodes is
    given to the smallest member of each, and a second pass over the tries adds that up. Only the SHA-256 of the members that end at one node is sequential
    by its definition: their sorted ids stream through one state.

    Turns of one number are ordered by a digest of role and text; null roles and texts are empty, a null turn comes first. Equal rows are turns of their own.
    Rows with a null conv_id belong to no conversation. Empty texts have no words, very long ones count whole. An
    empty table gives no rows. Other columns are ignored, whatever their names.
    """
    spark = conversations.sparkSession
    stages = stages or StageArea(spark)
    small_batches(spark)
    turns, convs = _ordered(conversations, stages, conv_id, turn, role, text)
    pieces = stages.cut(_pieces(_rebuilt(turns, convs, stages), stages), "pieces")
    one = F.lit(1).cast("long")
    asked = pieces.select("conv", "start", "turns", "s1", "s2", "before", "last", one.alias("x"), F.col("total").alias("y"), F.col("total").alias("value"))
    first = stages.cut(asked.mapInArrow(tries, _NODES), "first-tries")
    nodes = stages.cut(_merged(first.where("conv IS NULL")), "nodes")
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count(F.lit(1)).alias("kids"))
    full = stages.cut(nodes.join(kids, _KEY, "left").withColumn("kids", F.coalesce("kids", F.lit(0))), "full")
    tops = stages.cut(full.groupBy(F.col("low.low").alias("conv")).agg(F.sum("words").alias("x"), F.count_if(F.col("kids") == 0).alias("y")), "tops")
    again = pieces.join(tops, "conv").select("conv", "start", "turns", "s1", "s2", "before", F.lit(False).alias("last"), "x", "y", F.col("x").alias("value"))
    second = _merged(again.mapInArrow(tries, _NODES).where("conv IS NULL")).select(
        *_KEY, F.col("x").alias("apart"), F.col("y").alias("n_leaves"), F.col("low.low_value").alias("own"))
    second = stages.cut(second, "second-tries")
    ends = first.where("conv IS NOT NULL").select(*_KEY, "conv")
    classes = stages.cut(ends.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")), "classes")
    many = ends.join(classes.where("n > 1").select(*_KEY), _KEY).repartition(*_KEY).sortWithinPartitions(*_KEY, "conv")
    shas = (classes.where("n = 1").select(*_KEY, F.sha2(F.col("conv").cast("string").cast("binary"), 256).alias("sha"))
            .unionByName(many.select(*_KEY, "conv").mapInArrow(_digests, "depth long, p1 long, p2 long, sha string")))
    shas = stages.cut(shas, "shas")
    parents = full.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("low.low").alias("parent_conv_id"))
    # All turns of members below the parent, less those of one turn for each distinct node there.
    saved = (F.col("y") - F.col("x") * F.col("before")) - (F.col("low.low_value") - F.col("before") + F.col("apart") - F.col("own"))
    joined = (full.join(parents, ["depth", "q1", "q2"], "left").join(second, _KEY).join(shas, _KEY, "left"))
    return joined.select(
        F.col("low.low").alias("conv_id"), "depth", "parent_conv_id", F.col("x").alias("n_convs"), F.col("kids").cast("long").alias("n_children"),
        F.col("n_leaves"), saved.alias("saved_tokens"), F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
