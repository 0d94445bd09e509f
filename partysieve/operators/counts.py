"""Counting what the rules did."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: While a run counts, a column with a bit for each rule that acted on the row. It travels with the row, so that the
#: counts are those of the rows that are written, however often the plan before that is run.
MARKS = "_did"
#: The rules by their bits; those without a code have a name. Two rules share the code R020.
RULES = (
    "ACTIVITY", "INSURED BY NAME", "INSURED BY CODE", "R001", "PARENT POLICY", "R0041", "R040", "R060",
    "R002", "R003", "R004", "R020 DOCUMENTS", "R005", "R006", "R007", "TYPE OVERRIDE", "LATEST REGION",
    "R050", "R050-1", "R057-1", "R058", "R065", "REGION OVERRIDE", "R018", "PRODUCT 1", "PRODUCT 2", "PRODUCT 3",
    "PERSON TYPE", "R019", "R020 REGIMES", "R021", "HIGHEST REGIME",
)


def _bit(rule: str) -> int:
    return 1 << RULES.index(rule)


def with_marks(df: DataFrame) -> DataFrame:
    """Rows on which no rule has acted yet; from here on the rules note themselves."""
    return df.withColumn(MARKS, F.lit(0).cast("bigint"))


def marks(df: DataFrame, hits: Mapping[str, Column]) -> dict[str, Column]:
    """The new marks, by the condition of each rule; none if the frame does not count."""
    if MARKS not in df.columns:
        return {}
    out = F.col(MARKS)
    for rule, hit in hits.items():
        out = out.bitwiseOR(F.when(hit, _bit(rule)).otherwise(0).cast("bigint"))
    return {MARKS: out}


def copied(df: DataFrame, rule: str) -> dict[str, Column]:
    """The marks of a row that a rule adds: of its origin's, only what is decided by the source row."""
    if MARKS not in df.columns:
        return {}
    return {MARKS: F.col(MARKS).bitwiseAND(F.lit(_bit("ACTIVITY")).cast("bigint")).bitwiseOR(F.lit(_bit(rule)).cast("bigint"))}


def marked(*rules: str) -> dict[str, Column]:
    """Conditions that tell the rows on which each rule has acted."""
    return {rule: F.col(MARKS).bitwiseAND(F.lit(_bit(rule)).cast("bigint")) != 0 for rule in rules}


def rule_counts(df: DataFrame, trace: Column | None = None) -> DataFrame:
    """Rows per rule code, read from the rule trace in one pass.

    Codes are separated by dashes, except that a few end in '-1'; a code that a row
    carries several times counts once.
    """
    text = F.translate(F.col("rule_trace") if trace is None else trace, " ", "")
    codes = F.array_distinct(F.split(F.regexp_replace(text, "-1(?=-|$)", "_1"), "-"))
    return (
        df.select(F.explode(codes).alias("_code"))
        .where(F.col("_code") != "")
        .groupBy(F.translate("_code", "_", "-").alias("rule_code"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def affected_rows(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row with the number of rows that meet each named condition."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])
