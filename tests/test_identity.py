"""Row numbers from the files themselves."""

from pyspark.sql import functions as F

from partysieve.sources import identity
from partysieve.sources.stages import StageArea


def numbers(df, stages, **options):
    return {r["k"]: r["n"] for r in identity.numbered(df, "n", stages.cut, **options).collect()}


def test_files_give_the_same_numbers_again(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("_file")).repartition(7).write.parquet(str(tmp_path / "t"))
    df, stages = spark.read.parquet(str(tmp_path / "t")), StageArea(spark)
    found = numbers(df, stages)
    assert sorted(found.values()) == list(range(1000))
    assert list(stages.rows) == ["source-files"] and stages.rows["source-files"] == 7
    part = numbers(df.where("k % 3 = 0").select("k"), StageArea(spark))
    assert len(part) == 334 and len(set(part.values())) == 334
    assert numbers(df.select("k"), StageArea(spark)) == found
    assert "source" not in stages.rows  # no copy


def test_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(identity, "BROADCAST_FILES", 2)
    spark.range(100).withColumnRenamed("id", "k").repartition(5).write.parquet(str(tmp_path / "t"))
    assert sorted(numbers(spark.read.parquet(str(tmp_path / "t")), StageArea(spark)).values()) == list(range(100))


def test_other_frames_are_written(spark):
    stages = StageArea(spark)
    found = numbers(spark.range(50).select(F.col("id").alias("k")), stages)
    assert len(set(found.values())) == 50 and stages.rows == {"source": 50}
    empty = spark.range(0).select(F.col("id").alias("k"))
    assert numbers(empty, StageArea(spark)) == {}


def test_empty_file_table(spark, tmp_path):
    spark.range(0).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "t"))
    assert numbers(spark.read.schema("k long").parquet(str(tmp_path / "t")), StageArea(spark)) == {}
