"""Hand-off of issued policies to the shipment service."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partysieve.operators.keyed import lookup
from partysieve.operators.rewrite import rewrite_where
from partysieve.pack import RulePack

HANDOFF_KEYS = ("product_id", "policy_id", "operation_id", "event")
HANDOFF_COLUMNS = ("product_id", "policy_id", "shipment_id", "operation_id", "event")
_NAMES = ("surname_1", "surname_2", "first_name", "second_name")


def pending_handoffs(df: DataFrame, pack: RulePack) -> DataFrame:
    """Issued policies that are not shipped yet and name a person with an email."""
    named = F.coalesce(*_NAMES).isNotNull()
    return df.where(
        F.col("shipment_id").isNull() & (F.col("shipment_kind") == pack.handoff_kind)
        & F.col("event").isin(*pack.handoff_events) & named & F.col("email").isNotNull()
    ).select(*HANDOFF_COLUMNS)


def shipped_handoffs(df: DataFrame) -> DataFrame:
    return df.where(F.col("shipment_id").isNotNull()).select(*HANDOFF_COLUMNS)


def sync_handoffs(df: DataFrame, staged: DataFrame) -> DataFrame:
    """Take over the staged shipment ids; `changed` tells the rows whose id differed."""
    out = lookup(df, staged, {c: F.col(c) for c in HANDOFF_KEYS}, ["shipment_id"],
                 spread_by=HANDOFF_KEYS)
    changed = F.col("_hit").isNotNull() & ~F.col("_hit.shipment_id").eqNullSafe(
        F.col("shipment_id"))
    out = out.withColumn("changed", changed)
    return rewrite_where(out, F.col("changed"),
                         {"shipment_id": F.col("_hit.shipment_id")}).drop("_hit")
