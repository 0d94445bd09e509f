"""Step 9: document types and numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partysieve.functions.text import append_text, choose, numeric_only, pad_to_eight
from partysieve.operators.counts import marks
from partysieve.operators.keyed import ROWS, attach
from partysieve.operators.rewrite import rewrite_where
from partysieve.pack import RulePack

CONFLICT_RULES = ("R005", "R006", "R007")


def _numeric_of_length(n: int):
    return (F.length("doc_no_eval") == n) & numeric_only(F.col("doc_no_eval"))


def type_from_number(df: DataFrame, pack: RulePack) -> DataFrame:
    """R002: an unknown type with a number of eight digits is a national id."""
    return rewrite_where(
        df, (F.col("doc_type_eval") == pack.unknown_type) & _numeric_of_length(8),
        {"doc_type_eval": F.lit(pack.national_type)}, "-R002", "R002")


def pad_number(df: DataFrame, pack: RulePack) -> DataFrame:
    """R003: a national id of seven digits gets a zero in front."""
    return rewrite_where(
        df, (F.col("doc_type_eval") == pack.national_type) & _numeric_of_length(7),
        {"doc_no_eval": pad_to_eight(F.col("doc_no_eval"))}, "-R003", "R003")


def type_from_legacy(df: DataFrame, pack: RulePack) -> DataFrame:
    """R004: a legacy type with a number of eight digits is a national id."""
    return rewrite_where(
        df, (F.col("doc_type_eval") == pack.legacy_type) & _numeric_of_length(8),
        {"doc_type_eval": F.lit(pack.national_type)}, "-R004", "R004")


def type_from_loan(df: DataFrame, pack: RulePack) -> DataFrame:
    """R020 for documents: an unknown type under a loan product is a national id."""
    return rewrite_where(
        df, F.upper("product_name").isin(*pack.loan_products)
        & (F.col("doc_type_eval") == pack.unknown_type),
        {"doc_type_eval": F.lit(pack.national_type)}, "-R020", "R020 DOCUMENTS")


def normalise_documents(df: DataFrame, pack: RulePack) -> DataFrame:
    """The four row-local rules in order, as one decision per row.

    No two act on the same row: the numbers have different lengths or the types differ,
    and a row that R002 turned is no longer unknown for R020. Deciding once keeps the
    conditions from nesting in one another.
    """
    kind, loan = F.col("doc_type_eval"), F.upper("product_name").isin(*pack.loan_products)
    rule = (
        F.when((kind == pack.unknown_type) & _numeric_of_length(8), F.lit("-R002"))
        .when((kind == pack.national_type) & _numeric_of_length(7), F.lit("-R003"))
        .when((kind == pack.legacy_type) & _numeric_of_length(8), F.lit("-R004"))
        .when((kind == pack.unknown_type) & loan, F.lit("-R020"))
    )
    rule_of_row = F.col("_rule")
    return df.withColumn("_rule", rule).withColumns({
        "doc_type_eval": F.when(rule_of_row.isNotNull(), F.lit(pack.national_type))
                          .otherwise(kind),
        "doc_no_eval": F.when(rule_of_row == "-R003", pad_to_eight(F.col("doc_no_eval")))
                        .otherwise(F.col("doc_no_eval")),
        "rule_trace": F.when(rule_of_row.isNotNull(),
                             append_text(F.col("rule_trace"), rule_of_row))
                       .otherwise(F.col("rule_trace")),
        **marks(df, {"R002": rule_of_row == "-R002", "R003": rule_of_row == "-R003", "R004": rule_of_row == "-R004",
                     "R020 DOCUMENTS": rule_of_row == "-R020"}),
    }).drop("_rule")


def override_doc_types(df: DataFrame, pack: RulePack) -> DataFrame:
    """Documents whose type is decided by configuration. No rule code."""
    chosen = choose(F.col("doc_no_eval"), pack.doc_type_overrides)
    return rewrite_where(df, chosen.isNotNull(), {"doc_type_eval": chosen}, rule="TYPE OVERRIDE")


def has_document(pack: RulePack):
    return F.col("doc_no_eval") != pack.no_document


def document_groups(df: DataFrame, pack: RulePack, regions: bool = False) -> DataFrame:
    """One row per document number with what its conflict rules need to know.

    Equal (document, date, type, and with `regions` region) are counted first, inside the map tasks, so
    that a document with very many rows reaches the shuffle as its few distinct
    combinations. These are dealt by document once; the facts by type, by date and by document
    then need no other exchange, and nothing is collected.
    """
    known_type = F.col("doc_type_eval") != pack.unknown_type
    known_region = F.col("region_eval") != pack.no_region
    placed = ["region_eval"] if regions else []
    rows = (
        df.where(has_document(pack))
        .groupBy("doc_no_eval", "start_date", "doc_type_eval", *placed)
        .agg(F.count(F.lit(1)).alias(ROWS))
        .repartition("doc_no_eval")
    )
    region = F.coalesce("region_eval", F.lit("-1"))
    first, later, last = [], [], []
    if regions:
        first = [F.min(region).alias("_region_min"), F.max(region).alias("_region_max"),
                 F.min(F.when(known_region, F.col("region_eval"))).alias("_region")]
        later = [F.min("_region_min").alias("_region_min"), F.max("_region_max").alias("_region_max"),
                 F.min("_region").alias("_region")]
        placed_date = F.when(F.col("_region").isNotNull(), F.col("start_date"))
        last = [F.min("_region_min").alias("region_min"), F.max("_region_max").alias("region_max"),
                F.max_by("_region", placed_date).alias("latest_region")]
    by_type = rows.groupBy("doc_no_eval", "start_date", "doc_type_eval").agg(F.sum(ROWS).alias(ROWS), *first)
    by_date = by_type.groupBy("doc_no_eval", "start_date").agg(
        F.min("doc_type_eval").alias("_min"), F.max("doc_type_eval").alias("_max"),
        F.count("doc_type_eval").alias("_types"),
        F.max(F.col("doc_type_eval") == pack.national_type).alias("_national"),
        F.max(~known_type).alias("_unknown"),
        F.min(F.when(known_type, F.col("doc_type_eval"))).alias("_known_min"),
        F.max(F.when(known_type, F.col("doc_type_eval"))).alias("_known_max"),
        F.sum(ROWS).alias(ROWS), *later)
    typed_date = F.when(F.col("_known_min").isNotNull(), F.col("start_date"))
    return by_date.groupBy("doc_no_eval").agg(
        F.min("_min").alias("type_min"), F.max("_max").alias("type_max"),
        F.max("_national").alias("has_national"), F.max("_unknown").alias("has_unknown"),
        F.min("_known_min").alias("known_min"), F.max("_known_max").alias("known_max"),
        F.max_by("_max", typed_date).alias("latest_type"), F.max_by("_types", typed_date).alias("latest_types"),
        F.sum(ROWS).alias(ROWS), *last)


def region_groups(df: DataFrame, pack: RulePack) -> DataFrame:
    """What `document_groups` tells of regions alone: without types there are fewer combinations and one level less."""
    region = F.col("region_eval")
    rows = (
        df.where(has_document(pack)).groupBy("doc_no_eval", "start_date", "region_eval")
        .agg(F.count(F.lit(1)).alias(ROWS)).repartition("doc_no_eval")
    )
    by_date = rows.groupBy("doc_no_eval", "start_date").agg(
        F.min(F.coalesce(region, F.lit("-1"))).alias("_min"), F.max(F.coalesce(region, F.lit("-1"))).alias("_max"),
        F.min(F.when(region != pack.no_region, region)).alias("_region"), F.sum(ROWS).alias(ROWS))
    placed_date = F.when(F.col("_region").isNotNull(), F.col("start_date"))
    return by_date.groupBy("doc_no_eval").agg(
        F.min("_min").alias("region_min"), F.max("_max").alias("region_max"),
        F.max_by("_region", placed_date).alias("latest_region"), F.sum(ROWS).alias(ROWS))


def document_decisions(
    df: DataFrame, pack: RulePack, rules: Sequence[str] = CONFLICT_RULES, regions: bool = False
) -> DataFrame:
    """The decided type, its rule code and, if asked, the decided region per document.

    R005, R006 and R007 exclude one another: the first two leave a document with a
    single type, on which the later ones do not act. So one decision per document is the
    same as the three updates in a row.
    """
    moved = F.lit(None).cast("string")
    if regions:
        moved = F.when(F.col("region_min") != F.col("region_max"), F.col("latest_region"))
    if not rules:
        out = region_groups(df, pack).select("doc_no_eval", F.lit(None).cast("string").alias("doc_type"),
                                             F.lit(None).cast("string").alias("code"), moved.alias("region"), ROWS)
        return out.where(F.col("region").isNotNull())
    several = F.col("type_min") != F.col("type_max")
    one_known = F.col("has_unknown") & (F.col("known_min") == F.col("known_max"))
    cases = {
        "R005": (several & F.col("has_national") & (F.length("doc_no_eval") == 8),
                 F.lit(pack.national_type), F.lit("-R005")),
        "R006": (one_known, F.col("known_min"), F.lit("-R006")),
        # The code is appended once for each candidate type on the latest date.
        "R007": (several & (F.col("latest_types") > 0), F.col("latest_type"),
                 F.repeat(F.lit("-R007"), F.col("latest_types").cast("int"))),
    }
    decided, code = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed([r for r in CONFLICT_RULES if r in rules]):
        cond, value, text = cases[rule]
        decided, code = F.when(cond, value).otherwise(decided), F.when(cond, text).otherwise(code)
    out = document_groups(df, pack, regions).select(
        "doc_no_eval", decided.alias("doc_type"), code.alias("code"), moved.alias("region"), ROWS)
    return out.where(F.col("doc_type").isNotNull() | F.col("region").isNotNull())


def resolve_documents(
    df: DataFrame, pack: RulePack, rules: Sequence[str] = CONFLICT_RULES, regions: bool = False,
    **options,
) -> DataFrame:
    """Write the decisions to all rows of each document, in one join.

    With `regions`, the region at the latest date is settled in the same pass; the caller
    then has normalised the regions already.
    """
    on = {"doc_no_eval": F.col("doc_no_eval")}
    out = attach(df, document_decisions(df, pack, rules, regions), on,
                 ["doc_type", "code", "region"], eligible=has_document(pack), **options)
    return out.withColumns({
        "doc_type_eval": F.coalesce("_hit.doc_type", "doc_type_eval"),
        "region_eval": F.coalesce("_hit.region", "region_eval"),
        "rule_trace": F.when(F.col("_hit.code").isNotNull(),
                             append_text(F.col("rule_trace"), F.col("_hit.code")))
                       .otherwise(F.col("rule_trace")),
        **marks(df, {r: F.col("_hit.code").startswith(f"-{r}") for r in CONFLICT_RULES}
                | {"LATEST REGION": F.col("_hit.region").isNotNull()}),
    }).drop("_hit")
