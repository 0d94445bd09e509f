"""The stages that turn documents into an encoded training mix, each written and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partysieve.llm import bbit_dedup, bpe_matrix, mixture, passages, quality_trees, suffix_dedup
from partysieve.llm.catalog import table
from partysieve.sources.stages import StageArea


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the base rule and the boosted trees accept, with their own columns.

    Every row is judged by its whole text; a null text has no words and goes. Ties, repeated rows and null
    ids do not matter. Without documents or labels of both kinds the base rule decides alone.
    """
    trees = quality_trees.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    judged = quality_trees.judge(docs, trees, prefix="quality: ")
    return judged.where("`quality: kept`").select(*(F.col(f"`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest id, of each group linked by 85 of 100 shingles.

    Texts without words and rows with a null id stay. Rows with one id are one document and stay or
    go together. Of what the operator writes, only the ids of documents that go are left.
    """
    work = StageArea(spark)
    groups = bbit_dedup.near_duplicates(docs, percent=85, stages=work)
    gone = StageArea(spark).cut(groups.where("NOT kept").select("doc_id").distinct(), "gone")
    work.clear()
    return docs.join(gone, "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words or more out of all documents but that with the smallest id; nothing else changes.

    A document that has nothing left goes. n_chars, where there is such a column, follows the text.
    Null texts and ids are passed through. Of what the operator writes, only the places to cut are left.
    """
    work = StageArea(spark)
    repeats = StageArea(spark).cut(suffix_dedup.repeats(docs, stages=work), "repeats")
    work.clear()
    named = repeats.select(F.col("doc_id").alias("repeats: id"), F.col("copy").alias("repeats: copy"), F.col("spans").alias("repeats: spans"))
    spans, text = F.col("`repeats: spans`"), F.col("text")
    joined = docs.join(named, (F.col("doc_id") == F.col("`repeats: id`")) & (passages.copy_of(text) == F.col("`repeats: copy`")), "left")
    joined = joined.withColumn("repeats: rest", suffix_dedup.without_spans(F.when(spans.isNotNull(), text), spans))
    rest = F.col("`repeats: rest`")
    now = {"text": F.coalesce(rest, text)}
    if "n_chars" in docs.columns:
        now["n_chars"] = F.when(rest.isNull(), F.col("n_chars")).otherwise(F.length(rest))
    kept = joined.where(rest.isNull() | rest.rlike(r"[^\x20\x09-\x0D]"))
    return kept.select(*(now.get(f.name, F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name) for f in docs.schema))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to weights 5, 2, 1, ...: each document as often as the mix takes it, not at all, once or twice.

    Documents without words are not taken; a null source is a source. Null and repeated ids, equal rows, other
    columns of any name and an empty table are as in `mixture.mixture`. Numbers about rows are all that is written.
    """
    return mixture.repeated(docs, weights=(5, 2, 1), percent=150, epochs=2)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the byte-level BPE ids of each document and of what they decode to.

    Null and empty texts have no ids; a null id is passed through, equal rows are rows of their own, other columns are
    left out whatever their names. Very long texts are encoded whole.
    """
    return bpe_matrix.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("source mixture", mixed),
    ("byte-level BPE", encoded),
]

#: SQL can express neither the trees nor the encoding; the tests check the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder. What a stage wrote goes once the next one is written."""
    area = StageArea(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, written = area.cut(stage(spark, docs, sf_dir), name.replace(" ", "-")), name.replace(" ", "-")
        if before is not None:
            area.drop(before)
        before = written
    return docs
