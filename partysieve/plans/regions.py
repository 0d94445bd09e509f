"""Step 11: regions, settled by document, by policy, then by holder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partysieve.functions.text import all_equal, choose
from partysieve.operators.counts import marks
from partysieve.operators.keyed import ROWS, attach, update_from
from partysieve.operators.rewrite import rewrite_where
from partysieve.pack import RulePack
from partysieve.plans.documents import resolve_documents

POLICY_RULES = ("R050", "R050-1", "R057-1")


def normalise_region(df: DataFrame, pack: RulePack) -> DataFrame:
    """Loan products and the digital source take the capital; placeholders take none."""
    region = F.col("region_eval")
    synonym = choose(region, pack.region_synonyms)
    return df.withColumn("region_eval", F.when(
        F.upper("product_name").isin(*pack.loan_products), F.lit(pack.capital_region))
        .when(F.col("source_system") == pack.digital_source, F.lit(pack.capital_region))
        .when(synonym.isNotNull(), synonym)
        .when(F.coalesce(region, F.lit("-")).isin(*pack.region_placeholders),
              F.lit(pack.no_region))
        .otherwise(region))


def latest_region(df: DataFrame, pack: RulePack, **options) -> DataFrame:
    """A document with several regions takes the one at its latest date. No rule code."""
    return resolve_documents(df, pack, rules=(), regions=True, **options)


def _known(pack: RulePack) -> Column:
    return F.col("region_eval") != pack.no_region


def policy_groups(df: DataFrame, pack: RulePack) -> DataFrame:
    """One row per policy with what the rules by policy need to know.

    The first aggregate collapses equal (policy, role, source, product match, region)
    rows, so a policy with very many parties is reduced before the shuffle.
    """
    product = F.coalesce(all_equal(pack.beneficiary_only_product), F.lit(False))
    distinct = (
        df.groupBy("policy_no", "party_role", "source_system", product.alias("_product"),
                   "region_eval")
        .agg(F.max("record_id").alias("_newest"), F.count(F.lit(1)).alias(ROWS))
    )
    role, region = F.col("party_role"), F.col("region_eval")
    beneficiary = (role == pack.beneficiary) & F.col("_product")
    sheet = F.col("source_system") == pack.sheet_source
    known = _known(pack)
    return distinct.groupBy("policy_no").agg(
        F.max(F.coalesce(role.isin(pack.holder, pack.insured), F.lit(False))).alias("has_party"),
        F.max(F.coalesce(role == pack.holder, F.lit(False))).alias("has_holder"),
        F.min(F.when(beneficiary, region)).alias("beneficiary_min"),
        F.max(F.when(beneficiary, region)).alias("beneficiary_max"),
        F.min(F.when(sheet, region)).alias("sheet_min"),
        F.max(F.when(sheet, region)).alias("sheet_max"),
        F.min(F.when(known, region)).alias("known_min"),
        F.max(F.when(known, region)).alias("known_max"),
        F.max_by(F.when(known, region), F.when(known, F.col("_newest"))).alias("newest"),
        F.min(F.when(known & (role == pack.holder), region)).alias("holder_region"),
        F.sum(ROWS).alias(ROWS),
    )


def policy_decisions(
    df: DataFrame, pack: RulePack, rules: Sequence[str] = POLICY_RULES, keep_holder: bool = True
) -> DataFrame:
    """The decided region and rule code per policy and, with `keep_holder`, the region its holders then have.

    Each rule leaves a policy with a single region, on which the later ones do not act,
    so one decision per policy is the same as the three updates in a row.

    Policies without a holder or insured are found by NOT IN, for which one such row
    without a policy number means that no policy qualifies.
    """
    groups = policy_groups(df, pack)
    no_number = df.where(
        F.col("policy_no").isNull() & F.col("party_role").isin(pack.holder, pack.insured))
    orphan = ~F.col("has_party") & F.col("policy_no").isNotNull() & ~F.col("_null_party")
    several = orphan & (F.col("beneficiary_min") != F.col("beneficiary_max"))
    listed = (F.lit(True) if pack.newest_region_policies is None
              else F.col("policy_no").isin(*pack.newest_region_policies))
    cases = {
        "R050": (several & (F.col("known_min") == F.col("known_max")), F.col("known_min")),
        "R050-1": (several & F.col("newest").isNotNull(), F.col("newest")),
        "R057-1": (listed & (F.col("sheet_min") != F.col("sheet_max"))
                   & F.col("newest").isNotNull(), F.col("newest")),
    }
    region, code = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed([r for r in POLICY_RULES if r in rules]):
        cond, value = cases[rule]
        region = F.when(cond, value).otherwise(region)
        code = F.when(cond, F.lit(f"-{rule}")).otherwise(code)
    decided = groups.withColumn("_null_party", no_number.exists()).select(
        "policy_no", region.alias("region"), code.alias("code"), "has_holder", "holder_region",
        ROWS)
    holder = F.when(F.col("region").isNotNull() & F.col("has_holder"), F.col("region")).when(
        F.col("region").isNull(), F.col("holder_region"))
    kept = holder if keep_holder else F.lit(None).cast("string")
    return decided.select("policy_no", "region", "code", kept.alias("holder_region"), ROWS).where(
        F.col("region").isNotNull() | F.col("holder_region").isNotNull())


def resolve_policies(
    df: DataFrame, pack: RulePack, rules: Sequence[str] = POLICY_RULES, keep_holder: bool = False,
    **options,
) -> DataFrame:
    """Write the decided regions to all rows of their policy.

    With `keep_holder` the region of the policy's holders stays as `_holder_region`.
    """
    out = attach(df, policy_decisions(df, pack, rules, keep_holder), {"policy_no": F.col("policy_no")},
                 ["region", "code", "holder_region"], **options)
    holder = F.col("_hit.holder_region")
    # Marks first: a rewrite reads the row as it came in.
    out = out.withColumns({"_holder_region": holder, **marks(df, {r: F.col("_hit.code") == f"-{r}" for r in POLICY_RULES})})
    out = rewrite_where(out, F.col("_hit.region").isNotNull(),
                        {"region_eval": F.col("_hit.region")}, F.col("_hit.code")).drop("_hit")
    return out if keep_holder else out.drop("_holder_region")


def single_gap_clients(df: DataFrame, pack: RulePack) -> DataFrame:
    """Clients with exactly one row that has no region and is not a holder's."""
    gap = (F.col("region_eval") == pack.no_region) & (F.col("party_role") != pack.holder)
    return (
        df.groupBy("doc_type_eval", "doc_no_eval")
        .agg(F.count_if(gap).alias("gaps"), F.count(F.lit(1)).alias(ROWS))
        .where(F.col("gaps") == 1)
    )


def region_from_holder(df: DataFrame, pack: RulePack, **options) -> DataFrame:
    """R058 on rows that carry `_holder_region`: such clients take the holder's region."""
    on = {c: F.col(c) for c in ("doc_type_eval", "doc_no_eval")}
    out = attach(df, single_gap_clients(df, pack), on, ["gaps"],
                 eligible=F.col("_holder_region").isNotNull(), **options)
    return rewrite_where(
        out, F.col("_hit").isNotNull(),
        {"region_eval": F.col("_holder_region")}, "-R058", "R058").drop("_hit", "_holder_region")


def capital_for_product(df: DataFrame, pack: RulePack) -> DataFrame:
    """R065: rows of one product without a region take the capital."""
    return rewrite_where(
        df, all_equal(pack.capital_product) & (F.col("region_eval") == pack.no_region),
        {"region_eval": F.lit(pack.capital_region)}, " - R065", "R065")


def override_regions(df: DataFrame, pack: RulePack) -> DataFrame:
    """Policies whose region is decided by configuration. No rule code."""
    chosen = choose(F.col("policy_no"), pack.region_overrides)
    return rewrite_where(df, chosen.isNotNull(), {"region_eval": chosen}, rule="REGION OVERRIDE")


def region_ids(df: DataFrame, region: DataFrame, pack: RulePack) -> DataFrame:
    """Region id by name; unchanged unless the pack asks for the lookup."""
    if not pack.lookup_region_id:
        return df
    return update_from(df, region, {"code": F.col("region_eval")}, {"region_id": "region_id"})


def mark_unknown_region_id(df: DataFrame, pack: RulePack) -> DataFrame:
    """R018: marks the rows whose region id is -1."""
    return rewrite_where(df, F.col("region_id") == -1, {"region_id": F.lit(-1)}, "-R018", "R018")


def finish_regions(df: DataFrame, region: DataFrame, pack: RulePack) -> DataFrame:
    """The row-local end of the step."""
    df = override_regions(capital_for_product(df, pack), pack)
    return mark_unknown_region_id(region_ids(df, region, pack), pack)
