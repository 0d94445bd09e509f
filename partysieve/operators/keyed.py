"""Joining one row per key back to a large table without letting a hot key pile up.

A key may hold a third of all rows. Aggregating it is safe, because every task
reduces its rows before the shuffle. Joining the reduced row back is not: all rows of
the key would meet in one task, and Spark's own skew handling cannot split a side
that was just aggregated. So keys are told apart by their row count:

* hot keys (more than `hot_rows` rows) go to every task. There can be at most
  total rows / `hot_rows` of them, which bounds the broadcast.
* all other keys are joined by shuffle, in a salt of zero. Rows that cannot match there
  (hot, NULL or ineligible key) take a salt from their hash and spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partysieve.operators.rewrite import rewrite_where

HOT_ROWS = 2_000_000
BROADCAST_ROWS = 100_000
SPREAD = 1 << 20
#: Rows a partition, on average, of a side that is hashed. The other side, the facts, is then not sorted, and nothing of it spills.
HASH_ROWS = 50_000
ROWS = "_rows"
HIT = "_hit"


def attach(
    df: DataFrame,
    keyed: DataFrame,
    on: Mapping[str, Column],
    values: Sequence[str],
    eligible: Column | None = None,
    name: str = HIT,
    hot_rows: int = HOT_ROWS,
    spread_by: Sequence[str] = ("record_id",),
    cut: Callable[[DataFrame, str], DataFrame] | None = None,
    settle: Callable[[DataFrame], DataFrame] | None = None,
    count: int | None = None,
) -> DataFrame:
    """Add a struct column with the values of the row's key, NULL where there is none.

    `keyed` has one row per key, the columns named in `on`, the values, and the number
    of rows of that key in `df` as `_rows`. `on` maps its columns to expressions
    over `df`. Rows outside `eligible` are not matched.

    With `cut` the keyed rows are written first. They are then there to be counted, and if
    they are few, `df` is not shuffled at all. Otherwise, with `settle`, the result is written, so that the shuffle can go
    before the next step has its own; `settle` may delete what it reads from. `count` is the number of keyed rows, where it is known.
    """
    if cut is not None:
        keyed = cut(keyed, "keyed")
        count = keyed.select(*on).count()
        if count <= BROADCAST_ROWS:
            return _attach_small(df, keyed, on, values, eligible, name)
    keys = [f"_key{i}" for i in range(len(on))]
    packed = keyed.select(
        *[F.col(c).alias(k) for c, k in zip(on, keys)],
        F.struct(*values).alias("_found"),
        F.col(ROWS),
    )
    hot = packed.where(F.col(ROWS) > hot_rows).select(*keys, F.col("_found").alias("_hot"))
    # Zero, but not a literal: the optimizer would move a literal out of the join keys, and
    # the rows would be shuffled by the key alone.
    zero = F.least(F.col(ROWS), F.lit(0)).cast("int")
    cold = packed.where(F.col(ROWS) <= hot_rows).select(
        *keys, zero.alias("_salt"), F.col("_found").alias("_cold"))
    if count is not None and hashable(df.sparkSession, count):
        cold = cold.hint("shuffle_hash")

    known = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    for expr in on.values():
        known = known & expr.isNotNull()
    out = df.withColumns({
        "_known": known, **{k: F.when(known, expr) for k, expr in zip(keys, on.values())}})
    out = out.join(F.broadcast(hot), keys, "left")
    scattered = F.lit(1) + F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)).cast("int")
    out = out.withColumn(
        "_salt", F.when(F.col("_known") & F.col("_hot").isNull(), F.lit(0)).otherwise(scattered))
    out = out.join(cold, [*keys, "_salt"], "left")
    out = out.select(*df.columns, F.coalesce("_hot", "_cold").alias(name))
    return out if settle is None else settle(out)


def hashable(spark: SparkSession, rows: int) -> bool:
    """Whether a side of one row per key and so many rows is small enough in each partition to be hashed."""
    return rows <= HASH_ROWS * int(spark.conf.get("spark.sql.shuffle.partitions"))


def one_per_key(dim: DataFrame, on: Sequence[str], values: Sequence[str],
                order: Sequence[str] = ()) -> DataFrame:
    """Reduce to one row per key: the least by `order`, then by the values, NULL after all others."""
    rank = [x for i, c in enumerate([*order, *values])
            for x in (F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(f"_o{i}"))]
    least = dim.groupBy(*on).agg(F.min(F.struct(*rank, *values)).alias("_least"))
    return least.select(*on, *[F.col(f"_least.{v}").alias(v) for v in values if v not in on])


def bounded(df: DataFrame, rows: int) -> bool:
    """Whether the frame has at most so many rows, by a plain count, summed on the map side."""
    return df.count() <= rows


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, Column],
    values: Sequence[str],
    order: Sequence[str] = (),
    eligible: Column | None = None,
    name: str = HIT,
    broadcast_rows: int | None = None,
    hot_rows: int = HOT_ROWS,
    spread_by: Sequence[str] = ("record_id",),
    settle: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Left join a reference table, reduced to one row per key, as a struct column.

    The table is broadcast if its checked row count allows it. Beyond that the rows per
    key are counted and the join goes through `attach`.
    """
    unique = one_per_key(dim.where(_all_present(on)), list(on), values, order)
    count = dim.select(*on).count()
    if count <= (BROADCAST_ROWS if broadcast_rows is None else broadcast_rows):
        return _attach_small(df, unique, on, values, eligible, name)
    rows = df if eligible is None else df.where(eligible)
    hot = (rows.groupBy(*[e.alias(c) for c, e in on.items()])
           .agg(F.count(F.lit(1)).alias(ROWS)).where(F.col(ROWS) > hot_rows))
    # At most total rows / hot_rows keys are counted as hot.
    keyed = unique.join(F.broadcast(hot), list(on), "left").fillna(0, [ROWS])
    return attach(df, keyed, on, values, eligible, name, hot_rows, spread_by, settle=settle, count=count)


def _attach_small(df, keyed, on, values, eligible, name) -> DataFrame:
    """Left join by broadcast, for a table whose row count was checked."""
    keys = [f"_key{i}" for i in range(len(on))]
    packed = keyed.select(*[F.col(c).alias(k) for c, k in zip(on, keys)],
                          F.struct(*values).alias(name))
    exprs = [e if eligible is None else F.when(eligible, e) for e in on.values()]
    out = df.withColumns(dict(zip(keys, exprs))).join(F.broadcast(packed), keys, "left")
    return out.select(*df.columns, name)


def _all_present(columns) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
    return cond


def update_from(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, Column],
    sets: Mapping[str, str],
    code: str | Column | None = None,
    order: Sequence[str] = (),
    where: Column | None = None,
    rule: str | None = None,
    **options,
) -> DataFrame:
    """Update matched rows from a reference table (column -> table column).

    A matched NULL is written; unmatched rows stay as they are.
    """
    values = list(dict.fromkeys(sets.values())) or list(on)[:1]
    out = lookup(df, dim, on, values, order=order, eligible=where, **options)
    out = rewrite_where(out, F.col(HIT).isNotNull(),
                        {c: F.col(f"{HIT}.{v}") for c, v in sets.items()}, code, rule)
    return out.drop(HIT)
