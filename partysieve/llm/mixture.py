"""Mix sources to target weights by a low-discrepancy schedule of equal-token blocks. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partysieve.sources.identity import numbered
from partysieve.sources.stages import StageArea

#: Words of a block.
BLOCK = 1024
#: Hex digits of the shuffle key that deal a source's documents into parts, so that no source is
#: ordered in one task. Parts of a source: 16 ** PART_DIGITS at most.
PART_DIGITS = 3
#: Slots of a chunk; a source's slots are ranked by chunk.
CHUNK = 8192
#: Cells of the unit interval. Schedule points fall evenly on them, whatever the weights are.
CELLS = 4096
#: 2 / (1 + sqrt(5)); its multiples' fractions are the schedule's points.
GOLDEN = "0.618033988749894848"

#: The column that holds a row's number while it has the documents' own names beside it.
_ROW = "mixture: row"
_WORDS = r"[^\x20\x09-\x0D]+"


@dataclass
class Mix:
    """rows: row, doc_id, size, source_id. carried: row, and the documents' columns under `of`, read afresh from the source.
    sources: source_id, source, source_size, weight, target, quota. slots: slot, source_id, rank. pieces: slot, row, epoch,
    from (where the row's words start in its source's stream), words."""

    rows: DataFrame
    carried: DataFrame
    sources: DataFrame
    slots: DataFrame
    pieces: DataFrame


def targets(sizes: DataFrame, weights: tuple[int, ...], percent: int, epochs: int) -> DataFrame:
    """Each source's target: source, source_size -> source_id, weight, target, quota.

    Sources in code point order, null last, have the weights in turn. They share `percent` of all
    words by weight; a target stops at `epochs` times its source's size, and what is cut off is
    shared again. Sources sorted by limit over weight fill up in this order, so one pass finds the
    level at which the rest stand. The windows see one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("ratio", "source_id")
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("source_id"), F.lit(len(weights))) + 1).cast("int"))
    limit = F.col("source_size") * epochs
    level = ((F.sum("source_size").over(everything) * (percent / 100)
              - F.coalesce(F.sum(limit).over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             / F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing)))
    return (sizes.withColumn("source_id", (F.row_number().over(by_name) - 1).cast("long"))
            .withColumn("weight", weight).withColumn("ratio", limit / F.col("weight"))
            .withColumn("level", level).withColumn("full", F.col("level") >= F.col("ratio"))
            .withColumn("rest", F.max(F.when(~F.col("full"), F.col("level"))).over(everything))
            .withColumn("target", F.when(F.col("full"), limit.cast("double")).otherwise(F.col("weight") * F.col("rest")))
            .withColumn("quota", F.floor("target"))
            .select("source_id", "source", "source_size", "weight", "target", "quota"))


def schedule(spark: SparkSession, sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """Slots in mixing order: slot, source_id, rank. A source's ranks are 0, 1, ... without a gap.

    Slot t has the point frac(t * golden ratio). The points go through the sources' cumulative
    weights, so that any stretch of slots is mixed like the whole. A source has as many slots as
    its quota has blocks: the few beyond are left out, the few that are missing stand at the end.
    """
    ordered = Window.orderBy("source_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    weighed = (sources.withColumn("blocks", F.ceil(F.col("quota") / block))
               .withColumn("high", F.sum("blocks").over(ordered)).withColumn("low", F.col("high") - F.col("blocks")))
    total = weighed.agg(F.coalesce(F.max("high"), F.lit(0))).first()[0]
    n = max(1, total)
    cells = (weighed.where("blocks > 0")
             .withColumn("cell", F.explode(F.expr(f"sequence(low * {CELLS} div {n}, (high * {CELLS} - 1) div {n})")))
             .select("cell", "low", "high", "source_id", "blocks"))
    point = F.expr(f"cast(id as decimal(19, 0)) * cast('{GOLDEN}' as decimal(18, 18)) % 1")
    points = (spark.range(total).withColumn("at", F.floor(point.cast("decimal(18, 18)").cast("double") * n))
              .withColumn("at", F.least("at", F.lit(n - 1))).withColumn("cell", F.expr(f"at * {CELLS} div {n}")))
    drawn = (points.join(cells, "cell").where("at >= low AND at < high")
             .select(F.col("id").alias("slot"), "source_id", F.expr(f"id div {CHUNK}").alias("chunk")))
    counts = drawn.groupBy("source_id", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = counts.withColumn("before", F.sum("n").over(Window.partitionBy("source_id").orderBy("chunk")) - F.col("n"))
    inside = F.row_number().over(Window.partitionBy("source_id", "chunk").orderBy("slot")) - 1
    ranked = (drawn.withColumn("inside", inside).join(earlier, ["source_id", "chunk"])
              .join(weighed.select("source_id", "blocks"), "source_id")
              .select("slot", "source_id", (F.col("before") + F.col("inside")).alias("rank"), "blocks")
              .where("rank < blocks").drop("blocks"))
    had = counts.groupBy("source_id").agg(F.sum("n").alias("had"))
    missing = (weighed.join(had, "source_id", "left").withColumn("had", F.coalesce("had", F.lit(0)))
               .where("had < blocks").withColumn("rank", F.explode(F.expr("sequence(had, blocks - 1)")))
               .select((F.lit(n) + F.col("low") + F.col("rank")).alias("slot"), "source_id", "rank"))
    return ranked.unionByName(missing)


def _shuffled(rows: DataFrame, epochs: int) -> DataFrame:
    """Where each document's words stand in its source's stream, which has all documents once an epoch."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    dealt = (rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
             .withColumn("key", F.md5(F.concat(text, F.lit(":"), F.col("epoch").cast("string"))))
             .withColumn("part", F.substring("key", 1, PART_DIGITS)))
    parts = dealt.groupBy("source_id", "epoch", "part").agg(F.sum("size").alias("n"))
    parts = parts.withColumn("before", F.sum("n").over(Window.partitionBy("source_id").orderBy("epoch", "part")) - F.col("n"))
    inside = Window.partitionBy("source_id", "epoch", "part").orderBy("key", "doc_id", "size", "row")
    return (dealt.withColumn("inside", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
            .join(parts, ["source_id", "epoch", "part"])
            .withColumn("from", F.col("before") + F.col("inside"))
            .select("row", "source_id", "epoch", "from", (F.col("from") + F.col("size")).alias("to")))


def mixture(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
            weights: tuple[int, ...] = (5, 2, 1), percent: int = 150, epochs: int = 2, block: int = BLOCK,
            stages: StageArea | None = None) -> Mix:
    """Mix documents so that each source's words come to its target.

    Sizes are words. A source's documents are shuffled by a digest of their id, afresh for each
    epoch, and its stream of words is cut into blocks of `block` words; slot after slot takes the
    next block of the source that the schedule names. The last block ends at the quota, so a
    source gives its target rounded down, and no document more than `epochs` times its size.

    A null text has no words, a null source is a source of its own, the last one. Null and repeated
    ids only share a place in the shuffle; equal rows are rows of their own. Very long texts are only counted. An
    empty table gives empty frames. Other columns are carried, whatever their names.
    """
    spark = documents.sparkSession
    stages = stages or StageArea(spark)
    words: Column = F.coalesce(F.regexp_count(F.col(text), F.lit(_WORDS)), F.lit(0)).cast("long")
    known = numbered(documents, _ROW, stages.cut, "documents")
    narrow = known.select(F.col(f"`{_ROW}`").alias("row"), F.col(doc_id).cast("long").alias("doc_id"),
                          F.col(source).cast("string").alias("source"), words.alias("size"))
    narrow = stages.cut(narrow, "sizes")
    sources = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, percent, epochs)
    sources = stages.cut(sources, "sources")
    rows = (narrow.join(sources.select("source_id", F.col("source").alias("name")), F.col("source").eqNullSafe(F.col("name")))
            .drop("name"))
    slots = stages.cut(schedule(spark, sources, block), "slots")
    placed = (_shuffled(rows, epochs).join(sources.select("source_id", "quota"), "source_id")
              .withColumn("to", F.least("to", "quota")).where(F.col("from") < F.col("to")))
    cut = (placed.withColumn("rank", F.explode(F.expr(f"sequence(`from` div {block}, (`to` - 1) div {block})")))
           .withColumn("words", F.least(F.col("to"), (F.col("rank") + 1) * block) - F.greatest(F.col("from"), F.col("rank") * block)))
    pieces = cut.join(slots, ["source_id", "rank"]).select("slot", "row", "epoch", "from", "words")
    carried = known.select(F.col(f"`{_ROW}`").alias("row"), F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("of"))
    return Mix(rows, carried, sources, slots, pieces)


def taken(documents: DataFrame, **options) -> DataFrame:
    """Per document doc_id, size, source_size, target, taken, first_slot: where the schedule first takes words of it, null if nowhere."""
    mixed = mixture(documents, **options)
    words = mixed.pieces.groupBy("row").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    return (mixed.rows.join(mixed.sources, "source_id").join(words, "row", "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "first_slot"))


def repeated(documents: DataFrame, **options) -> DataFrame:
    """The documents with their own columns, each as often as the mix takes it, to the nearest whole number.

    The copies are in mixing order: each stands where the schedule first takes words of it in its epoch. What
    is decided about a row is narrow; the documents themselves are joined to it by their row number, and each copy goes
    to the partition of its slot, which follows from the slot by arithmetic. Null and empty texts have no words and
    are not taken; ties, repeated rows, clashing names and empty tables are as in `mixture`.
    """
    mixed = mixture(documents, **options)
    # An epoch begins only after the one before has taken the whole document, so there are as many as copies or one more.
    words = (mixed.pieces.groupBy("row", "epoch").agg(F.sum("words").alias("words"), F.min("slot").alias("slot"), F.min("from").alias("from"))
             .groupBy("row").agg(F.sum("words").alias("taken"), F.sort_array(F.collect_list(F.struct("epoch", "slot", "from"))).alias("places")))
    times = F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size"))).cast("int")
    copies = mixed.rows.where("size > 0").join(words, "row").select("row", "places", times.alias("times")).where("times > 0")
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = mixed.slots.agg(F.coalesce(F.max("slot"), F.lit(0)) + 1).first()[0]
    part = F.expr(f"cast(place.slot * {parts} div {slots} as int)")
    return (mixed.carried.join(copies, "row").withColumn("place", F.explode(F.slice("places", 1, F.col("times"))))
            .select("of", "place.slot", "place.from", "row", part.alias("part")).repartitionById(parts, "part")
            .sortWithinPartitions("slot", "from", "row").select("of.*"))
