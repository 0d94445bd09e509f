"""Each stage of the pipeline against plain Python, or SQL, on a whole table."""

import base64
import hashlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken
from odd import rows, words
from test_near_duplicates import brute as near
from test_passages import brute as repeats

import corpus_pipeline
from partysieve.llm import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def plain(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def repeated_words(text):
    w = words(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = {g for g, n in Counter(grams).items() if n > 1}
    return len({j for i, g in enumerate(grams) if g in often for j in range(i, i + 3)}), len(w)


def test_quality(spark, docs, plain):
    """What the base rule rejects goes; the trees' part is held-out accuracy (test_quality)."""
    kept = {r["doc_id"] for r in corpus_pipeline.quality(spark, docs, SF).collect()}
    failed = {d for d, t in plain for n, all_ in [repeated_words(t)] if all_ < 50 or 100 * n > 50 * all_}
    assert kept and failed and not kept & failed


def test_near_duplicates(spark, docs, plain):
    got = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, SF).select("doc_id").collect())
    assert got == sorted(d for d, _, _, kept in near(plain) if kept) and len(got) < len(plain)


def test_repeated_passages(spark, docs, plain):
    got = {r["doc_id"]: r for r in corpus_pipeline.repeated_passages(spark, docs, SF).collect()}
    want = {d: (n - gone, sha) for d, n, gone, _, sha in repeats(plain)}
    assert {d for d, (n, _) in want.items() if n} <= set(got)
    for d, r in got.items():
        left = words(r["text"])
        assert (len(left), hashlib.sha256(" ".join(left).encode()).hexdigest()) == want[d]
        assert r["n_chars"] == len(r["text"]) or r["text"] in dict(plain).values()


def test_repeated_passages_cut_texts_once(spark):
    """A filter on the cut texts does not cut them again below."""
    text = " ".join(f"w{i}" for i in range(60))
    own = spark.createDataFrame([(1, text, 1), (2, text, 1), (3, f"before {text} after", 1)], "doc_id long, text string, n_chars long")
    out = corpus_pipeline.repeated_passages(spark, own, SF)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()) == [(1, text, 1), (3, "before after", 12)]


def test_mixture(spark, docs, plain):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    mix = con.execute("SELECT doc_id, size, taken FROM (" + catalog.SQL["op7_source_mixture"] + ")").fetchall()
    want = Counter({d: (2 * taken + size) // (2 * size) for d, size, taken in mix if size})
    got = Counter(r["doc_id"] for r in corpus_pipeline.mixed(spark, docs, SF).select("doc_id").collect())
    assert got == +want


def test_encoded(spark, docs, plain):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for d, t in plain:
        ids = encoding.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert rows(corpus_pipeline.encoded(spark, docs, SF)) == sorted(want, key=repr)


def test_nothing_but_the_result_is_left(spark, tmp_path, monkeypatch):
    """After a run, the folder of stages holds the last stage and narrow rows."""
    from partysieve.sources import stages

    monkeypatch.setattr(stages, "checkpoint_root", lambda _: str(tmp_path))
    n = corpus_pipeline.run(spark, SF).count()
    names = {f.parent.name.rsplit("-", 1)[0] for f in tmp_path.rglob("*.parquet")}
    assert n and "byte-level-BPE" in names and not names & {"quality-rules", "MinHash-near-dedup", "suffix-array-dedup", "source-mixture", "concerned", "sets"}
