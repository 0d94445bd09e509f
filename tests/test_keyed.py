"""Joins back by key: hot keys, NULL keys, duplicates, and tables beyond the broadcast bound."""

import pytest
from pyspark.sql import functions as F

from partysieve.operators import keyed
from partysieve.operators.keyed import attach, bounded, lookup, update_from


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows under one key, a few without a key."""
    return spark.range(3000).select(
        F.col("id").alias("record_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("key"),
        F.lit("-").alias("rule_trace"), F.lit(0).alias("v"))


def expected(rows, known):
    return {r["record_id"]: known(r["key"]) for r in rows.collect()}


@pytest.mark.parametrize("hot_rows", [0, 20, 500, 10**6])
def test_attach_gives_the_same_for_any_threshold(rows, hot_rows):
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("_rows"))
    counts = counts.where("key is null or key <> 'k5'")
    out = attach(rows, counts, {"key": F.col("key")}, ["n"], hot_rows=hot_rows).collect()
    assert len(out) == 3000
    n = {r["key"]: r["n"] for r in counts.collect()}
    want = expected(rows, lambda k: None if k is None else n.get(k))
    assert {r["record_id"]: r["_hit"] and r["_hit"]["n"] for r in out} == want


def test_attach_skips_ineligible_rows(rows):
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_rows"), F.lit(1).alias("n"))
    out = attach(rows, counts, {"key": F.col("key")}, ["n"], eligible=F.col("key") != "hot",
                 hot_rows=500)
    assert out.where("_hit is not null and key = 'hot'").count() == 0
    assert out.where("_hit is null and key <> 'hot' and key is not null").count() == 0


def tasks(out):
    """Rows of the hot key per task, counted so that the join is needed."""
    found = out.where("key = 'hot'").groupBy(F.spark_partition_id()).agg(F.count("_hit"))
    return [r[1] for r in found.collect()]


def test_hot_rows_spread_over_tasks(spark, rows):
    """The rows of the hot key do not meet in one partition of the join."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_rows"), F.lit(1).alias("n"))
        out = attach(rows, counts, {"key": F.col("key")}, ["n"], hot_rows=500)
        sizes = tasks(out)
        assert len(sizes) == 8 and sum(sizes) == 1000 and max(sizes) < 250
        unsplit = attach(rows, counts, {"key": F.col("key")}, ["n"], hot_rows=10**6)
        assert tasks(unsplit) == [1000]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("broadcast_rows,hot_rows", [(10**5, 10**6), (2, 10**6), (2, 100)])
def test_lookup_takes_the_least_and_ignores_null_keys(spark, rows, broadcast_rows, hot_rows):
    dim = spark.createDataFrame(
        [("hot", 2, "b"), ("hot", 1, "z"), ("k7", 5, None), (None, 0, "never")],
        "key string, rank int, name string")
    out = lookup(rows, dim, {"key": F.col("key")}, ["rank", "name"], order=["rank"],
                 broadcast_rows=broadcast_rows, hot_rows=hot_rows).collect()
    want = expected(rows, {"hot": (1, "z"), "k7": (5, None)}.get)
    assert {r["record_id"]: r["_hit"] and tuple(r["_hit"]) for r in out} == want


def test_update_writes_a_matched_null(spark, rows):
    dim = spark.createDataFrame([("hot", None), ("k7", 9)], "key string, x int")
    out = update_from(rows, dim, {"key": F.col("key")}, {"v": "x"}, "-U",
                      where=F.col("record_id") < 2000)
    for r in out.collect():
        hit = r["record_id"] < 2000 and r["key"] in ("hot", "k7")
        assert r["v"] == ({"hot": None, "k7": 9}[r["key"]] if hit else 0)
        assert r["rule_trace"] == ("--U" if hit else "-")


def test_bounded(spark):
    assert bounded(spark.range(5), 5)
    assert not bounded(spark.range(6), 5)


def test_update_without_values_marks_only(spark, rows):
    dim = spark.createDataFrame([("hot",)], "key string")
    out = update_from(rows, dim, {"key": F.col("key")}, {}, "-M")
    assert out.where("rule_trace = '--M'").count() == 1000


def test_defaults_are_sane():
    assert keyed.BROADCAST_ROWS < keyed.HOT_ROWS
