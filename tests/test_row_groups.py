"""Stages of wide rows in small row groups: a task's writer holds one in the heap."""

import pyarrow.parquet as parquet
import pytest
from compare import connect, differences
from pyspark.sql import functions as F
from test_cluster import tables  # noqa: F401

import __spark_entry__ as registered
from partysieve.sources import stages
from partysieve.sources.stages import StageArea

QUERIES = (
    "agg_distinct",
    "agg_max_by",
    "agg_max_date",
    "audit_log",
    "agg_singletons",
    "blank_to_null",
    "delete_marked",
    "copy_insured_by_name",
    "fixed_overrides",
    "copy_insured_by_code",
    "fn_case",
    "documents_all",
    "fn_cast",
    "fn_text",
    "fn_null",
    "fn_concat",
    "fn_substr",
    "fn_translate",
    "audit_full_run",
)


@pytest.fixture
def area(spark, tmp_path, monkeypatch):
    """A folder for stages, and row groups that a few hundred rows fill."""
    monkeypatch.setattr(stages, "ROW_GROUP", 16 << 10, raising=False)
    monkeypatch.setattr(stages, "checkpoint_root", lambda _: str(tmp_path / "stages"))
    return tmp_path / "stages"


def groups(folder, stage: str) -> list[int]:
    return [parquet.ParquetFile(f).num_row_groups for f in folder.glob(f"run-*/{stage}-*/*.parquet")]


@pytest.fixture
def many(spark, tables, tmp_path):  # noqa: F811
    """The tables with 40 lines for each one, so that each file of the extract gets more than one row group."""
    folder = tmp_path / "data"
    folder.mkdir()
    for file in tables.iterdir():
        if file.name != "lineitem.parquet":
            (folder / file.name).symlink_to(file)
    lines = spark.read.parquet(str(tables / "lineitem.parquet")).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(39))))
    lines = lines.withColumn("l_suppkey", F.col("l_suppkey") + 20 * F.col("k")).drop("k")
    parquet.write_table(lines.toArrow(), folder / "lineitem.parquet")
    return str(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_the_extract_has_small_row_groups(spark, many, area, name):
    out = registered.QUERIES[name](spark, many)
    assert differences(out, connect(many), registered.build()[name]) is None
    found = groups(area, "extract")
    assert found and min(found) > 1


def test_narrow_stages_keep_the_default(spark, area):
    rows = spark.range(0, 20_000, 1, 1)
    for name, n in (("narrow", 2), ("wide", 20)):
        assert StageArea(spark).cut(rows.select(*[(F.col("id") * i).alias(f"c{i}") for i in range(n)]), name).count() == 20_000
    assert groups(area, "narrow") == [1] and min(groups(area, "wide")) > 1
