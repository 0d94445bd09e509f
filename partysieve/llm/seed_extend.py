"""Substring dedup by seeds: join documents on winnowed anchors, extend matches to both sides, keep maximal repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partysieve.llm import passages
from partysieve.sources.stages import StageArea


def split(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 50,
          stages: StageArea | None = None) -> tuple[DataFrame, DataFrame]:
    """Repeats of at least `min_words` words that also start in a document with a smaller id.

    Seeds: every window's winnowed anchor (`passages`), joined over all documents; anchors of one
    document only end there, which are nearly all. Where the
    hashes of both sides of the block equal those of a smaller document, the
    block repeats in whole and touches the next one. Where a side differs, the match is extended from the anchor, word by word to the left and to the
    right, up to the first difference (`passages.extended`; an anchor with very many different surroundings goes by the hashes of all
    its windows). Touching matches make the maximal repeats, none of them shorter than the threshold. The result is exact: each word is removed that lies in a
    window which also starts in a document with a smaller id.

    No pairs are formed: a group of copies is compared with its least document, by aggregates
    that combine on the map side and are written, and by joins of them to the rows, whose hot keys Spark can split. Returns documents without a
    repeat (doc_id, n_words, sha) and those with one (doc_id, copy, text, spans).

    Null and empty texts have no words. A document with a null id neither loses words nor makes
    others lose them. Rows with one id count as one document: they never repeat each other, and
    each is cut by its own text. Other columns are ignored, whatever their names.
    """
    documents = passages.narrowed(documents, doc_id, text)
    stages = stages or StageArea(documents.sparkSession)
    found = stages.cut(passages.blocks(documents, min_words), "blocks")
    rows = found.where("start IS NOT NULL").drop("n_words", "sha")
    shared = (rows.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
              .where("low < high").select("anchor"))
    shared = stages.cut(shared, "shared-anchors")
    seeds = stages.cut(rows.join(shared, "anchor", "left_semi"), "seeds")
    return passages.cut(documents, found, *passages.grouped(seeds, stages), stages, min_words)


def dedup(documents: DataFrame, **options) -> DataFrame:
    """`split`, then one row per document: doc_id, n_words, n_removed, n_repeats, kept_sha256."""
    return passages.table(*split(documents, **options))
