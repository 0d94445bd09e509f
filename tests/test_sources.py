"""Ids, stages, sinks, audit and loading."""

import random

import pytest
from pyspark.sql import functions as F

from partysieve.catalog.fixtures import FIXTURE_PACK as PACK
from partysieve.catalog.fixtures import dimensions, extract
from partysieve.operators.counts import affected_rows, rule_counts
from partysieve.operators.counts import RULES
from partysieve.operators.ids import next_ids, renumber
from partysieve.plans import run
from partysieve.schema import DIMENSIONS, PARTY_POLICY, WORKING_COLUMNS
from partysieve.sources import sinks
from partysieve.sources.audit import AuditTrail
from partysieve.sources.stages import StageArea, checkpoint_root
from partysieve.sources.tables import check_parallel, load_tables, read_table

SF = "/root/testdata/sf0.001"


@pytest.fixture
def stages(spark, tmp_path):
    return StageArea(spark, str(tmp_path))


def test_renumber_is_dense_and_in_order(spark, stages):
    ids = random.Random(1).sample(range(10**9), 900)
    df = spark.createDataFrame([(i, "b" if k % 7 else None) for k, i in enumerate(ids + ids[:90])],
                               "record_id bigint, note string")
    out = renumber(df.withColumn("was", F.col("record_id")), ["record_id", "note"], stages.cut)
    rows = sorted(out.collect(), key=lambda r: r["record_id"])
    assert [r["record_id"] for r in rows] == list(range(1, 991))
    order = [(r["was"], r["note"] or "") for r in rows]
    assert order == sorted(order)


def test_renumber_puts_everything_in_one_place_right(spark, stages):
    """All rows share the leading column; the others still order them."""
    df = spark.range(500).select(F.lit(7).cast("bigint").alias("record_id"),
                                 F.col("id").alias("x"))
    out = renumber(df, ["record_id", "x"], stages.cut, start=11).collect()
    assert all(r["record_id"] == r["x"] + 11 for r in out)


def test_next_ids_follow_the_greatest(spark, stages):
    old = spark.createDataFrame([(5,), (3,)], "record_id bigint")
    new = spark.createDataFrame([(0, "b"), (0, "a")], "record_id bigint, k string")
    out = next_ids(new, old, ["k"], stages.cut)
    assert {r["k"]: r["record_id"] for r in out.collect()} == {"a": 6, "b": 7}


def test_stage_counts_rows_and_can_be_cleared(spark, stages):
    df = stages.cut(spark.range(10).toDF("x"), "a")
    assert stages.rows["a"] == 10 and df.count() == 10 and stages.has("a")
    again = stages.cut(df.where("x > 6"), "a")
    assert stages.rows["a"] == 3 and again.count() == 3
    stages.clear()
    assert not stages.has("a")


def test_checkpoint_root_is_the_configured_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert checkpoint_root(spark) == (named.rstrip("/") if named else checkpoint_root(spark))


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    """On a cluster neither no folder nor one of the machine's own will do."""
    from types import SimpleNamespace

    from partysieve.sources import stages as module

    def session(root):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: root), sparkContext=SimpleNamespace(master="yarn"))

    monkeypatch.setattr(module, "_is_local", lambda _, root: root.startswith("file:"))
    assert checkpoint_root(session("hdfs://x/y/")) == "hdfs://x/y"
    for root in (None, "file:///tmp/x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_root(session(root))


def test_a_mount_that_all_share_is_taken(spark, tmp_path, monkeypatch):
    """A cluster's folder may have the scheme file: if tasks and the driver see the same files there."""
    from partysieve.sources import stages as module

    monkeypatch.setattr(module, "_SETTING", "partysieve.test.folder")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    spark.conf.set("partysieve.test.folder", f"file://{tmp_path}/")
    try:
        area = StageArea(spark)
        assert area.path.startswith(f"file://{tmp_path}/run-")
        assert area.cut(spark.range(100).toDF("x"), "a").count() == 100
        assert [p.name for p in tmp_path.iterdir()] == [area.path.rpartition("/")[2]]  # the trial is gone
        (tmp_path / "taken").write_text("")
        spark.conf.set("partysieve.test.folder", f"file://{tmp_path}/taken")
        with pytest.raises(ValueError, match="a trial failed"):
            checkpoint_root(spark)
    finally:
        spark.conf.unset("partysieve.test.folder")


APART = """
import sys
from pyspark.sql import SparkSession
from partysieve.sources.stages import StageArea

spark = SparkSession.builder.config(map={
    "spark.master": "local-cluster[2,1,1024]", "spark.driver.host": "127.0.0.1", "spark.ui.enabled": "false",
    "spark.sql.warehouse.dir": sys.argv[1]} | ({"spark.checkpoint.dir": sys.argv[2]} if sys.argv[2:] else {})).getOrCreate()
try:
    area = StageArea(spark)
    print("ROWS", area.cut(spark.range(0, 100, 1, 8).toDF("x"), "a").count(), area.path)
except ValueError as error:
    print("REFUSED", error)
spark.stop()
"""


@pytest.mark.parametrize("named", (None, "shared", "apart"))
def test_executors_apart_lose_no_rows(tmp_path, named):
    """Executors with temporary folders of their own: rows are written where all see them, or not at all."""
    import importlib.util
    import os
    import subprocess
    import sys
    from pathlib import Path

    repo = Path(__file__).resolve().parent.parent
    for folder in ("home/work", "conf", "cwd/.tmp"):
        (tmp_path / folder).mkdir(parents=True)
    for p in Path(importlib.util.find_spec("pyspark").origin).parent.iterdir():  # executors work in Spark's home
        if p.name not in ("work", "conf"):
            (tmp_path / "home" / p.name).symlink_to(p)
    env = {k: v for k, v in os.environ.items() if not k.startswith(("SPARK_", "PYSPARK_"))} | {
        "SPARK_HOME": f"{tmp_path}/home", "SPARK_CONF_DIR": f"{tmp_path}/conf", "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_SCALA_VERSION": "2.13",
        "SPARK_LOCAL_DIRS": f"{tmp_path}/local", "PYTHONPATH": str(repo), "PYSPARK_PYTHON": sys.executable, "TMPDIR": "/proc/self/cwd/.tmp"}
    folder = {None: [], "shared": [f"file://{tmp_path}/shared"], "apart": ["file:///proc/self/cwd/.tmp/stages"]}[named]
    done = subprocess.run([sys.executable, "-c", APART, f"{tmp_path}/warehouse", *folder], env=env, cwd=tmp_path / "cwd", capture_output=True, text=True, timeout=180)
    said = next((x.split(" ", 2) for x in done.stdout.splitlines() if x.startswith(("ROWS", "REFUSED"))), done.stderr[-2000:])
    if named == "apart":
        assert said[0] == "REFUSED" and "0 are found" in said[2], said
    else:
        assert said[:2] == ["ROWS", "100"] and f"{tmp_path}/{'shared' if named else 'warehouse'}/run-" in said[2], said


def test_append_and_clear(spark, tmp_path):
    target, df = str(tmp_path / "t"), spark.createDataFrame([(1, "a", 2.0)], "x int, y string, z double")
    for _ in range(2):
        sinks.append_columns(df, ["x", "z"], target)
    assert [tuple(r) for r in spark.read.parquet(target).collect()] == [(1, 2.0)] * 2
    sinks.clear_staging(spark, target)
    assert spark.read.parquet(target).count() == 0
    assert spark.read.parquet(target).columns == ["x", "z"]


def test_publish_can_read_what_it_replaces(spark, tmp_path):
    target = str(tmp_path / "p")
    sinks.publish(spark.range(5), target)
    sinks.publish(sinks.read_published(spark, target).where("id > 1"), target)
    assert sinks.read_published(spark, target).columns == ["id"]
    assert sinks.read_published(spark, target).count() == 3


def test_unfinished_versions_are_not_read(spark, tmp_path):
    target = str(tmp_path / "p")
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, target)
    first = sinks.publish(spark.range(5), target)
    spark.range(9).write.parquet(f"{target}/version=99999999T000000")
    (tmp_path / "p" / "version=99999999T000000" / "_SUCCESS").unlink()
    read = sinks.read_published(spark, target)
    assert read.count() == 5 and all(first in f for f in read.inputFiles())
    second = sinks.publish(spark.range(6), target)
    sinks.retain(spark, target, 1)
    assert sinks.versions(spark, target) == [second]


def test_audit_numbers_on(spark, tmp_path):
    target, audit = str(tmp_path / "a"), AuditTrail(spark)
    audit.step("one")
    audit.step("two", 2, rows=4)
    audit.append_to(target)
    audit.step("three", 3, rows=5, changed=2)
    audit.append_to(target)
    rows = spark.read.parquet(target).orderBy("audit_id").collect()
    assert [(r["audit_id"], r["entry"], r["rows"], r["changed"]) for r in rows] == [
        (1, "one", None, None), (2, " two", 4, None), (3, "   three", 5, 2)]
    assert {r["run_id"] for r in rows} == {audit.run_id} != {AuditTrail(spark).run_id}


def test_a_failed_run_leaves_its_records(spark, tmp_path, monkeypatch):
    """Step 11 fails: the table tells the steps before it and that it failed; stages are gone."""
    from partysieve.plans import regions

    def fail(*_, **__):
        raise RuntimeError("step 11")

    monkeypatch.setattr(regions, "resolve_policies", fail)
    stages, target = StageArea(spark, str(tmp_path / "s")), str(tmp_path / "audit")
    with pytest.raises(RuntimeError):
        run.run_and_publish(extract(spark, SF), dimensions(spark, SF), PACK, stages, AuditTrail(spark, target), str(tmp_path / "p"))
    entries = [r["entry"].strip() for r in spark.read.parquet(target).orderBy("audit_id").collect()]
    assert entries[0] == "RUN - START" and entries[-1] == "RUN - FAILED: RuntimeError"
    ends = [e.split(".")[0] for e in entries if e[0].isdigit() and e.endswith("END")]
    assert ends == [str(i) for i in range(11)] and "R002" in entries and "ACTIVITY" in entries
    assert [e.split(".")[0] for e in entries if e[0].isdigit() and "FAILED" in e] == ["11", "12", "13"]
    assert len(list((tmp_path / "audit").glob("*.parquet"))) == 1
    assert not (tmp_path / "p").exists() and not stages.has("documents")


def test_a_missing_product_stops_the_run(spark, stages):
    from dataclasses import replace

    dims = dimensions(spark, SF)
    none = replace(dims, product=dims.product.where("product_code <> 'ECONOMY'"))
    with pytest.raises(ValueError, match="no product"):
        run.run(extract(spark, SF), none, PACK, stages)


def test_absent_columns_are_an_error(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).withColumnRenamed("id", "recrod_id").write.parquet(path)
    sources = {"party_policy": path} | {name: path for name in DIMENSIONS}
    with pytest.raises(ValueError, match="record_id"):
        load_tables(spark, sources)


def test_load_aligns_by_name(spark, tmp_path):
    extract(spark, SF).select("policy_no", F.col("record_id").alias("theirs")).write.parquet(
        str(tmp_path / "party_policy"))
    sources = {"party_policy": str(tmp_path / "party_policy")}
    for name, schema in DIMENSIONS.items():
        sources[name] = str(tmp_path / name)
        spark.createDataFrame([], schema).write.parquet(sources[name])
    fact, dims = load_tables(spark, sources, {
        "party_policy": {"record_id": "theirs", "policy_no": "policy_no"}},
        {"party_policy": set(PARTY_POLICY.fieldNames()) - {"record_id", "policy_no"}})
    assert fact.schema.fieldNames() == PARTY_POLICY.fieldNames()
    assert fact.where("record_id is not null and note is null").count() == fact.count()
    assert dims.product.columns == DIMENSIONS["product"].fieldNames()
    assert read_table(spark, {"format": "parquet", "path": sources["product"]}).count() == 0


def test_rule_counts(fact):
    traces = ["--R002-R007-R007", "-R050-1", "-R050", "R001-R0041 - R060", "-", None]
    df = fact([{"record_id": i, "rule_trace": t} for i, t in enumerate(traces)])
    assert {r["rule_code"]: r["rows"] for r in rule_counts(df).collect()} == {
        "R002": 1, "R007": 1, "R050-1": 1, "R050": 1, "R001": 1, "R0041": 1, "R060": 1}
    assert affected_rows(df, none=F.col("rule_trace").isNull(), all=F.lit(True)).first() == (1, 6)


def test_schema_is_complete():
    assert len(PARTY_POLICY) == 55 and len(set(PARTY_POLICY.fieldNames())) == 55
    assert set(WORKING_COLUMNS) <= set(PARTY_POLICY.fieldNames())


def test_full_run_invariants(spark, stages, tmp_path):
    """Ids are dense, columns keep their order, and the audit tells the steps."""
    audit, target = AuditTrail(spark, str(tmp_path / "audit")), str(tmp_path / "published")
    run.run_and_publish(extract(spark, SF), dimensions(spark, SF), PACK, stages, audit, target)
    df = sinks.read_published(spark, target)
    n = stages.rows["placed"]
    assert tuple(df.agg(F.min("record_id"), F.max("record_id"), F.count_distinct("record_id")).first()) == (1, n, n)
    assert df.columns == PARTY_POLICY.fieldNames()
    entries = [r["entry"] for r in spark.read.parquet(str(tmp_path / "audit")).orderBy("audit_id").collect()]
    assert entries[0] == "RUN - START" and entries[-1] == "RUN - END"
    for step in run.STEPS:
        assert entries.count(f" {step} - START") == entries.count(f" {step} - END") == 1
    assert sorted(e.strip() for e in entries if e.startswith("   ")) == sorted(RULES)
    assert len(list((tmp_path / "audit").glob("*"))) <= 2  # one file, and its checksum where there is one
    assert n == stages.rows["rated"] == df.count() and not stages.has("rated")


def test_second_run_of_the_party_steps(spark, stages):
    """A second run drops what it added and adds it again, and R001 finds a holder now.

    Only the insured copies change in number: each holder that the first run left, also
    those it added itself, now has its copy.
    """
    dims = dimensions(spark, SF)
    first = stages.cut(run.add_parties(extract(spark, SF), dims, PACK, stages), "first")
    second = stages.cut(run.add_parties(first, dims, PACK, stages), "second")
    r001 = F.coalesce(F.col("rule_trace").startswith("R001"), F.lit(False))
    assert first.where(r001).count() > 0 and second.where(r001).count() == 0
    copies = F.col("note").isin(PACK.copy_by_name_note, PACK.copy_by_code_note)
    holders = first.where(F.col("party_role") == PACK.holder).agg(
        F.count_if(F.col("product_name") == PACK.copy_by_name_product)
        + F.count_if((F.col("line_code") == "Brand#3") & (F.col("product_code") == "PROMO")))
    assert second.where(copies).count() == holders.first()[0]
    rest = F.coalesce(~copies, F.lit(True))
    assert second.where(rest).count() == first.where(rest).count() > 0


def test_a_large_jdbc_table_needs_bounds():
    whole = {"format": "jdbc", "url": "jdbc:x", "dbtable": "t"}
    bounds = {"partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "4"}
    with pytest.raises(ValueError, match="partitionColumn, lowerBound, upperBound, numPartitions"):
        check_parallel(whole)
    with pytest.raises(ValueError, match="upperBound"):
        check_parallel(whole | {k: v for k, v in bounds.items() if k != "upperBound"})
    for fine in (whole | bounds, whole | {"numPartitions": 1}, "raw.table", "/path/t", {"format": "parquet", "path": "/t"}):
        check_parallel(fine)


def test_job_file(spark, tmp_path):
    """The whole job from a file: sources by path, a pack with its overrides, audit and versions."""
    import json
    from dataclasses import asdict

    from partysieve.__main__ import read_job, run_job

    extract(spark, SF).write.parquet(str(tmp_path / "fact"))
    dims, sources = dimensions(spark, SF), {"party_policy": str(tmp_path / "fact")}
    for name in DIMENSIONS:
        sources[name] = str(tmp_path / name)
        getattr(dims, name).write.parquet(sources[name])
    job = {"sources": sources, "pack": asdict(PACK), "audit": str(tmp_path / "audit"), "target": str(tmp_path / "out"), "keep_versions": 1}
    (tmp_path / "job.json").write_text(json.dumps(job, indent=1))
    found = read_job(spark, str(tmp_path / "job.json"))
    version = run_job(spark, found)
    assert sinks.versions(spark, job["target"]) == [version]
    want = run.run(extract(spark, SF), dims, PACK, StageArea(spark, str(tmp_path / "s")))
    got = sinks.read_published(spark, job["target"])
    assert got.drop("version").exceptAll(want).isEmpty() and got.count() == want.count()
    assert spark.read.parquet(job["audit"]).where("entry = 'RUN - END'").count() == 1
    with pytest.raises(ValueError, match="targett"):
        run_job(spark, found | {"targett": "x"})
    with pytest.raises(FileNotFoundError):
        read_job(spark, str(tmp_path / "none.json"))
