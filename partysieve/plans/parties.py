"""Steps 0-6 and 8: missing parties, parent policies, activity codes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partysieve.functions.text import all_equal, before_dash, blank_to_null, folded, is_like
from partysieve.operators.counts import copied
from partysieve.operators.keyed import BROADCAST_ROWS, ROWS, attach, bounded, lookup, update_from
from partysieve.operators.rewrite import copy_rows, delete_marked, rewrite_where
from partysieve.pack import RulePack
from partysieve.schema import NOT_COPIED_TO_HOLDER, NOT_COPIED_TO_PARENT_HOLDER
from partysieve.sources.tables import activity_lookup

LAST_ID = (1 << 63) - 1


def trim_activity(df: DataFrame) -> DataFrame:
    """Step 0: trim the activity code, blank becomes NULL."""
    return df.withColumn("activity_code", blank_to_null(F.col("activity_code")))


def reset_state(df: DataFrame) -> DataFrame:
    """Step 1: an empty rule trace, and every row active."""
    return df.withColumns({"rule_trace": F.lit("-"), "active": F.lit(1)})


def copy_insured_by_name(df: DataFrame, pack: RulePack) -> DataFrame:
    """Step 2: holders of one product, by name, are also insured."""
    return _copy_insured(df, F.col("product_name") == pack.copy_by_name_product,
                         pack.copy_by_name_note, pack, "INSURED BY NAME")


def copy_insured_by_code(df: DataFrame, pack: RulePack) -> DataFrame:
    """Step 3: the same for one product by its codes."""
    return _copy_insured(df, all_equal(pack.copy_by_code_product), pack.copy_by_code_note, pack, "INSURED BY CODE")


def _copy_insured(df: DataFrame, product, note: str, pack: RulePack, rule: str) -> DataFrame:
    kept = reset_state(delete_marked(df, "note", f"%{note}%"))
    return copy_rows(kept, (F.col("party_role") == pack.holder) & product, {
        "party_role": F.lit(pack.insured), "note": F.lit(note)}, rule)


def holderless_policies(df: DataFrame, pack: RulePack) -> DataFrame:
    """Policies that hold one product and have no holder among the rows of that product."""
    product = F.col("product_name") == pack.holderless_product
    holder = product & (F.col("party_role") == pack.holder)
    groups = df.groupBy("policy_no").agg(
        F.count_if(product).alias("_product"), F.count_if(holder).alias("_holders"),
        F.count(F.lit(1)).alias(ROWS))
    return groups.where((F.col("_product") > 0) & (F.col("_holders") == 0)).select(
        "policy_no", F.col("_product"), ROWS)


def add_missing_holders(df: DataFrame, pack: RulePack, **options) -> DataFrame:
    """Step 4, R001: every row of a policy without a holder is also added as holder."""
    marked = attach(df, holderless_policies(df, pack), {"policy_no": F.col("policy_no")},
                    ["_product"], name="_holderless", **options)
    sets = {c: F.lit(None) for c in NOT_COPIED_TO_HOLDER if c in df.columns}
    sets |= {"party_role": F.lit(pack.holder), "rule_trace": F.lit("R001")}
    return copy_rows(marked, F.col("_holderless").isNotNull(), sets, "R001").drop("_holderless")


def derive_parent_policy(df: DataFrame, product: DataFrame, pack: RulePack, **options) -> DataFrame:
    """Step 5: the parent of a group policy is its number before the first dash."""
    group = product.where(F.col("is_group") == 1).select("product_key")
    marked = lookup(df, group, {"product_key": F.col("product_key")}, ["product_key"],
                    eligible=F.col("source_system") != pack.sheet_source, **options)
    parent = F.expr("try_cast(_before AS DECIMAL(38,0))")
    return (
        marked.withColumn("_before", before_dash(F.col("policy_no")))
        .transform(rewrite_where, F.col("_hit").isNotNull(), {"parent_policy_no": parent}, rule="PARENT POLICY")
        .drop("_before", "_hit")
    )


def _group_holder(pack: RulePack):
    return ((F.col("party_role") == pack.holder)
            & (F.col("source_system") != pack.sheet_source))


def parent_holder_keys(df: DataFrame, pack: RulePack) -> DataFrame:
    """Distinct (parent, document) of active holders of group policies."""
    return df.where(
        _group_holder(pack) & (F.col("active") == 1) & (F.col("parent_policy_no") > 0)
    ).select("parent_policy_no", "doc_type_eval", "doc_no_eval").distinct()


def deactivate_group_holders(df: DataFrame, pack: RulePack, **options) -> DataFrame:
    """R0041: holders under a parent that has an active holder become inactive."""
    parents = df.where(_group_holder(pack)).groupBy("parent_policy_no").agg(
        F.count_if((F.col("active") == 1) & (F.col("parent_policy_no") > 0)).alias("_active"),
        F.count(F.lit(1)).alias(ROWS))
    marked = attach(df, parents.where(F.col("_active") > 0),
                    {"parent_policy_no": F.col("parent_policy_no")}, ["_active"],
                    eligible=_group_holder(pack), **options)
    return rewrite_where(marked, F.col("_hit").isNotNull(), {"active": F.lit(0)},
                         "-R0041", "R0041").drop("_hit")


def drop_generated_holders(df: DataFrame, pack: RulePack) -> DataFrame:
    """Rows that an earlier run added for parent policies."""
    df = delete_marked(df, "rule_trace", "%-R040%")
    return delete_marked(df, "note", f"%{pack.parent_holder_note}%")


_PARENT_KEY = ("parent_policy_no", "doc_type_eval", "doc_no_eval")


def _generated(pack: RulePack):
    """Rows that an earlier run added for parent policies."""
    return is_like(F.col("rule_trace"), "%-R040%") | is_like(F.col("note"), f"%{pack.parent_holder_note}%")


def parent_holder_ids(df: DataFrame, pack: RulePack) -> DataFrame:
    """The least id of a holder row for each (parent, document) that R040 is for, in one narrow pass.

    `asked` keys have an active holder of a group policy; rows of an earlier run count there, but are not copied.
    """
    holder = F.col("party_role") == pack.holder
    asked = _group_holder(pack) & (F.col("active") == 1) & (F.col("parent_policy_no") > 0)
    known = df.where(holder & F.col("parent_policy_no").isNotNull() & F.col("doc_type_eval").isNotNull() & F.col("doc_no_eval").isNotNull())
    keys = known.groupBy(*_PARENT_KEY).agg(
        F.max(F.coalesce(asked, F.lit(False))).alias("_asked"), F.min(F.when(~_generated(pack), F.col("record_id"))).alias("record_id"))
    return keys.where(F.col("_asked") & F.col("record_id").isNotNull()).drop("_asked")


def parent_holder_rows(df: DataFrame, pack: RulePack, cut: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """R040: one holder row per (parent, document), with the parent's number as policy.

    The row taken is the least by id and then by all its columns. The keys and their least ids come from one
    narrow aggregate; only then the rows with those ids are looked up with all their columns, and
    the few that share one are told apart. With `cut` the keys are written, counted, and broadcast if
    their number allows it, so that rows are not shuffled for the look-up.
    """
    rest = [c for c in df.columns if c not in (*_PARENT_KEY, "record_id")]
    ids = parent_holder_ids(df, pack)
    if cut is not None:
        ids = cut(ids, "parent-keys")
        if bounded(ids, BROADCAST_ROWS):
            ids = F.broadcast(ids)
    least = (
        df.where((F.col("party_role") == pack.holder) & ~_generated(pack)).join(ids, [*_PARENT_KEY, "record_id"])
        .groupBy(*_PARENT_KEY, "record_id").agg(F.min(F.struct(*rest)).alias("_row"))
        .select(*[F.col(c) if c in (*_PARENT_KEY, "record_id") else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )
    sets = {
        "policy_no": F.col("parent_policy_no").cast("string"),
        "note": F.lit(pack.parent_holder_note),
        "rule_trace": F.lit("-R040"),
        "active": F.lit(1),
        **{c: F.lit(None).cast("string") for c in NOT_COPIED_TO_PARENT_HOLDER},
        **copied(df, "R040"),
    }
    return least.withColumns({c: v for c, v in sets.items() if c in df.columns})


def add_parent_holders(df: DataFrame, pack: RulePack, cut: Callable[[DataFrame, str], DataFrame] | None = None, **options) -> DataFrame:
    """R0041 and R040. The added rows have the greatest possible id until they are
    renumbered; they overwrite what R0041 changes, so they are taken from the rows before."""
    added = parent_holder_rows(df, pack, cut).withColumn("record_id", F.lit(LAST_ID))
    kept = drop_generated_holders(deactivate_group_holders(df, pack, cut=cut, **options), pack)
    return kept.unionByName(added)


def match_activity(df: DataFrame, activities: DataFrame, pack: RulePack) -> DataFrame:
    """Step 6: activity code by equal description, for the sources without codes."""
    codes = activity_lookup(activities, pack.activity_property).withColumn(
        "_folded", F.upper(F.nullif(F.trim("description"), F.lit("'"))))
    return update_from(
        df, codes, {"_folded": folded(F.col("activity_text"))}, {"activity_code": "code"},
        where=F.col("source_system").isin(*pack.activity_sources), rule="ACTIVITY")


def required_product(product: DataFrame, pack: RulePack, check: bool = False) -> DataFrame:
    """Least key of the provisional product, one row; with `check`, it must exist."""
    found = product.where(all_equal(pack.provisional_product)).select("product_key")
    if check and found.isEmpty():
        raise ValueError(f"no product with {dict(pack.provisional_product)}")
    return found.agg(F.min("product_key").alias("product_key"))


def deactivate_provisional(
    df: DataFrame, product: DataFrame, pack: RulePack, check: bool = False
) -> DataFrame:
    """Step 8, R060: insured rows of the provisional product become inactive."""
    marked = lookup(df, required_product(product, pack, check),
                    {"product_key": F.col("product_key")}, ["product_key"],
                    eligible=F.col("party_role") == pack.insured)
    return rewrite_where(marked, F.col("_hit").isNotNull(), {"active": F.lit(0)},
                         " - R060", "R060").drop("_hit")
