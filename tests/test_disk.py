"""What queries leave on the disks: shuffles go with their job, stages when the next is written, and rows carry what rules need."""

import re
import time

import pyarrow.parquet as parquet
import pytest
from compare import connect, differences
from test_cluster import tables  # noqa: F401

import __spark_entry__ as registered
from partysieve.operators import keyed
from partysieve.sources import stages
from partysieve.sources.stages import StageArea


@pytest.fixture
def area(tmp_path, monkeypatch):
    monkeypatch.setattr(stages, "checkpoint_root", lambda _: str(tmp_path / "stages"))
    return tmp_path / "stages"


def run(spark, tables, tmp_path, name):  # noqa: F811
    """The query's frame, found right, by a path of its own: the extract is written anew."""
    data = tmp_path / "data"
    data.symlink_to(tables)
    out = registered.QUERIES[name](spark, str(data))
    assert differences(out, connect(str(data)), registered.build()[name]) is None
    return out


def left(area) -> dict[str, set]:
    """The columns and codecs of each stage that is there, by its name; the extract apart."""
    out = {}
    for file in area.rglob("*.parquet"):
        stage = re.sub(r"-[0-9a-f]{8}$", "", file.relative_to(area).parts[1])
        meta = parquet.ParquetFile(file)
        codecs = {meta.metadata.row_group(0).column(0).compression} if meta.metadata.num_row_groups else set()
        known = out.setdefault(stage, (len(meta.schema_arrow.names), set()))
        known[1].update(codecs)
    assert out.pop("extract")[1] <= {"ZSTD"}
    return out


def shuffled(spark) -> set[str]:
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {found.apply(i).getName() for i in range(found.size())}
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def gone(spark, before: set[str]) -> bool:
    """Spark removes the files beside its work, so a moment later."""
    for _ in range(100):
        if not shuffled(spark) - before:
            return True
        time.sleep(0.1)
    return False


@pytest.mark.parametrize("name", ("parent_holder_rows", "src_load_tables", "rule_r0041", "next_ids", "rule_r040", "publish_roundtrip"))
def test_shuffles_go_with_their_job(spark, tables, tmp_path, area, name):  # noqa: F811
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the extract is then derived by shuffles
    before = shuffled(spark)
    try:
        run(spark, tables, tmp_path, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert gone(spark, before)


def test_audit_log_clears_its_steps(spark, tables, tmp_path, area):  # noqa: F811
    run(spark, tables, tmp_path, "audit_log")
    assert left(area).keys() == {"audit"}


def test_renumber_orders_narrow_rows(spark, tables, tmp_path, area):  # noqa: F811
    run(spark, tables, tmp_path, "renumber")
    assert left(area)["placed"][0] < 15


def test_regions_keep_one_narrow_stage(spark, tables, tmp_path, area):  # noqa: F811
    run(spark, tables, tmp_path, "regions_all")
    found = left(area)
    assert found.keys() == {"by-policy", "keyed"} and found["by-policy"][0] < 20


def test_regimes_keep_one_narrow_stage(spark, tables, tmp_path, area, monkeypatch):  # noqa: F811
    monkeypatch.setattr(keyed, "BROADCAST_ROWS", 0)
    run(spark, tables, tmp_path, "regimes_all")
    found = left(area)
    assert found.keys() == {"filled", "keyed"} and found["filled"][0] < 15


def test_one_version_is_left(spark, tables, tmp_path, area):  # noqa: F811
    run(spark, tables, tmp_path, "publish_roundtrip")
    assert len([*area.glob("*/published-*/version=*")]) == 1 and left(area)["published"][1] == {"ZSTD"}


def test_the_copy_is_compressed(spark, tables, tmp_path, area):  # noqa: F811
    run(spark, tables, tmp_path, "src_load_tables")
    assert left(area)["theirs"][1] == {"ZSTD"}


def test_few_parents_leave_the_rows_in_place(spark, tables, tmp_path, area):  # noqa: F811
    out = run(spark, tables, tmp_path, "rule_r0041")
    assert "_salt" not in out._jdf.queryExecution().toString() and "keyed" in left(area)


@pytest.mark.parametrize("name", ("full_run", "audit_full_run"))
def test_a_run_replaces_its_stages(spark, tables, tmp_path, area, monkeypatch, name):  # noqa: F811
    """Also where all joins are by shuffle."""
    monkeypatch.setattr(keyed, "BROADCAST_ROWS", 0)
    most, cut = [], StageArea.cut

    def counted(self, *args, **options):
        out = cut(self, *args, **options)
        most.append(sum(w > 20 and n != "extract" for n, (w, _) in left(area).items()) if any(area.glob("*/extract-*/_SUCCESS")) else 0)
        return out

    monkeypatch.setattr(StageArea, "cut", counted)
    run(spark, tables, tmp_path, name)
    assert max(most) <= 2
    assert not left(area).keys() & {"parties", "placed", "documents", "rated", "filled"}


def test_few_keys_a_partition_are_hashed(spark, monkeypatch):
    rows, facts = spark.range(40).selectExpr("id", "id * 2 AS value", "10L AS _rows"), spark.range(400).selectExpr("id AS record_id", "id % 50 AS id")
    found = []
    for most in (50_000, 0):
        monkeypatch.setattr(keyed, "HASH_ROWS", most)
        out = keyed.attach(facts, rows, {"id": facts["id"]}, ["value"], count=40)
        found.append(sorted((r["record_id"], r["_hit"] and r["_hit"]["value"]) for r in out.collect()))
        hinted = "shuffle_hash" in out._jdf.queryExecution().logical().toString() or "ShuffledHashJoin" in out._jdf.queryExecution().toString()
        assert hinted == (most > 0)
    assert found[0] == found[1] and sum(v is not None for _, v in found[0]) == 320
