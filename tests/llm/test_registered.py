"""Registered queries against SQL, and the pipeline's stages against brute force."""

import duckdb
import pytest
from compare import differences
from odd import documents, rows, words

import __spark_entry__ as registered
import corpus_pipeline
from partysieve.llm import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark", "conversations"):
        out.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return out


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, con, name):
    assert differences(catalog.QUERIES[name](spark, SF), con, catalog.SQL[name]) is None


def test_registered():
    names = registered.queries()
    assert {n.split("_")[0] for n in catalog.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(catalog.QUERIES) < set(names) and "pipeline" in names and set(catalog.SQL) < set(registered.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_whole_table(spark, name):
    """What SQL cannot express is tested by operator; here: one row for each row of the table."""
    kind = "pages" if name.startswith("op2") else "documents"
    key = "page_id" if kind == "pages" else "doc_id"
    got = catalog.QUERIES[name](spark, SF)
    assert rows(got.select(key)) == rows(spark.read.parquet(f"{SF}/{kind}.parquet").select(key))


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < out.count() <= 400
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert not rows(out.select("doc_id").join(docs, "doc_id", "left_anti"))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
    kept = corpus_pipeline.quality(spark, docs, SF)
    verdicts = catalog.op1_quality_trees(spark, SF).where("kept").select("doc_id")
    assert rows(kept.select("doc_id")) == rows(verdicts)
    groups = catalog.op5_bbit_minhash_dedup(spark, SF).where("kept").select("doc_id")
    assert rows(corpus_pipeline.near_duplicates(spark, docs, SF).select("doc_id")) == rows(groups)
    left = {r["doc_id"]: len(words(r["text"])) for r in corpus_pipeline.repeated_passages(spark, docs, SF).collect()}
    want = {r["doc_id"]: r["n_words"] - r["n_removed"] for r in catalog.op3_suffix_array_dedup(spark, SF).collect()}
    assert {d: n for d, n in want.items() if n or d in left} == left


def test_odd_rows_pass_all_stages(spark):
    frame = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (frame, frame.where("false")):
            out = stage(spark, docs, SF)
            assert out.columns == frame.columns
            out.collect()
    kept = corpus_pipeline.near_duplicates(spark, frame, SF)
    assert rows(kept.where("doc_id IS NULL").select("text")) == rows(frame.where("doc_id IS NULL").select("text"))
    cut = corpus_pipeline.repeated_passages(spark, frame, SF)
    assert cut.where("doc_id IN (2, 3, 4)").count() == 3 and cut.where("doc_id = 12").count() == 0
