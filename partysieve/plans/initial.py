"""Step 7: dense ids and the cleaned columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partysieve.functions.text import blank_to_null
from partysieve.pack import RulePack

# A copied row keeps the id of its source until here, and the rows added for parent policies
# share the last id; the other columns tell them apart.
ID_ORDER = ("record_id", "parent_policy_no", "doc_type_eval", "doc_no_eval", "party_role",
            "note", "rule_trace", "active")


def eval_columns(pack: RulePack) -> dict[str, Column]:
    """Trimmed and defaulted columns, from the raw ones of the same row.

    A missing value takes its default; a blank one stays NULL.
    """
    def cleaned(name: str, default: str | None = None):
        c = F.col(name)
        return blank_to_null(c if default is None else F.coalesce(c, F.lit(default)))

    activity = F.coalesce("activity_code", F.lit("-1"))
    return {
        "currency_code": cleaned("currency_code"),
        "pay_freq_code": cleaned("pay_freq_code"),
        "regulator_product_code": cleaned("regulator_product_code"),
        "activity_text": cleaned("activity_text"),
        "nationality_eval": F.upper(cleaned("nationality", pack.unknown_nationality)),
        "region_eval": F.upper(cleaned("region_raw")),
        "activity_id_eval": F.lit(-1),
        "doc_type_eval": cleaned("doc_type", pack.unknown_type),
        "doc_no_eval": cleaned("doc_no", pack.no_document),
        "on_watchlist": F.lit(0),
        "party_name_eval": cleaned("party_name"),
        "surname_1_eval": cleaned("surname_1"),
        "surname_2_eval": cleaned("surname_2"),
        "activity_code_eval": blank_to_null(
            F.when(activity == "-", F.lit("-1")).otherwise(activity)),
        "regime_eval": F.col("regime_id"),
    }


def init_eval_columns(df: DataFrame, pack: RulePack) -> DataFrame:
    return df.withColumns(eval_columns(pack))
