"""The registered queries: every operator and rule on the derived extract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partysieve.catalog.fixtures import (
    FIXTURE_PACK as PACK,
)
from partysieve.catalog.fixtures import (
    derive,
    derived_extract,
    dimension,
    dimensions,
    extract,
)
from partysieve.functions import text
from partysieve.operators.counts import rule_counts
from partysieve.operators.ids import next_ids, renumber
from partysieve.operators.keyed import attach, lookup, update_from
from partysieve.operators.rewrite import copy_rows, rewrite_where
from partysieve.plans import (
    documents,
    handoff,
    initial,
    nationality,
    parties,
    products,
    regimes,
    regions,
    run,
)
from partysieve.schema import DIMENSIONS, NOT_COPIED_TO_HOLDER, PARTY_POLICY
from partysieve.sources import sinks
from partysieve.sources.audit import AuditTrail
from partysieve.sources.stages import CODEC, StageArea
from partysieve.sources.tables import activity_lookup, load_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DOC = ("record_id", "doc_type_eval", "doc_no_eval", "rule_trace")
REGION = ("record_id", "region_eval", "rule_trace")
REGIME = ("record_id", "regime_eval", "on_watchlist", "rule_trace")
PARTY = ("record_id", "policy_no", "party_role", "note", "rule_trace", "active")
# What the rules of a step read or write, besides the constants of the pack. Where a query cuts the plan or orders whole rows, it
# takes these along and no others, as a run does.
REGIME_RULES = (*REGIME, "doc_type", "doc_no", "doc_type_eval", "doc_no_eval", "product_key", "product_name", "source_system", "active")
REGION_RULES = (*REGION, "region_id", "policy_no", "party_role", "source_system", "line_code", "product_name", "doc_type_eval", "doc_no_eval", "start_date")
PARTY_RULES = tuple(dict.fromkeys((*PARTY, "activity_code", "product_name", "line_code", "product_code", *NOT_COPIED_TO_HOLDER)))
MONEY = ("premium", "premium_total", "premium_collected", "premium_total_local")


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore avoids a shadowed import."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Money as double and the parent number as text, to compare across engines."""
    types = {c: "double" for c in MONEY} | {"parent_policy_no": "string"}
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in df.columns})


# --- the extract at the points where single rules start ------------------------------

def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return initial.init_eval_columns(parties.trim_activity(extract(spark, sf)), PACK)


def with_documents(spark: SparkSession, sf: str) -> DataFrame:
    return documents.normalise_documents(cleaned(spark, sf), PACK)


def with_regions(spark: SparkSession, sf: str) -> DataFrame:
    return regions.normalise_region(cleaned(spark, sf), PACK)


def with_parents(spark: SparkSession, sf: str) -> DataFrame:
    return parties.derive_parent_policy(extract(spark, sf), dimension(spark, sf, "product"), PACK)


# --- sources and sinks ---------------------------------------------------------------

@query
def src_scan(spark, sf):
    return plain(derived_extract(spark, sf))


@query
def handoff_pending(spark, sf):
    return handoff.pending_handoffs(derive(spark, sf, "handoff"), PACK)


@query
def handoff_shipped(spark, sf):
    return handoff.shipped_handoffs(derive(spark, sf, "handoff"))


@query
def sink_append(spark, sf):
    source = derive(spark, sf, "handoff")
    target = StageArea(spark).new_path("staging")
    for rows in (handoff.shipped_handoffs(source), handoff.pending_handoffs(source, PACK)):
        sinks.append_columns(rows, handoff.HANDOFF_COLUMNS, target)
    return spark.read.parquet(target)


@query
def clear_staging(spark, sf):
    """Fill, empty, and fill again: only the second filling is left."""
    source, target = derive(spark, sf, "handoff"), StageArea(spark).new_path("staging")
    sinks.append_columns(handoff.shipped_handoffs(source), handoff.HANDOFF_COLUMNS, target)
    sinks.clear_staging(spark, target)
    pending = handoff.pending_handoffs(source, PACK)
    sinks.append_columns(pending, handoff.HANDOFF_COLUMNS, target)
    return spark.read.parquet(target)


@query
def publish_roundtrip(spark, sf):
    target = StageArea(spark).new_path("published")
    sinks.publish(extract(spark, sf), target)
    sinks.publish(parties.reset_state(sinks.read_published(spark, target)), target)
    sinks.retain(spark, target, 1)
    return plain(sinks.read_published(spark, target))


@query
def audit_log(spark, sf):
    stages, audit = StageArea(spark), AuditTrail(spark)
    audit.step("RUN - START")
    df = parties.reset_state(parties.trim_activity(extract(spark, sf).select(*PARTY_RULES)))
    for level, name, rule in (
        (2, "0-1. TRIM, STATE", lambda d, _: d),
        (2, "2. INSURED BY NAME", parties.copy_insured_by_name),
        (2, "3. INSURED BY CODE", parties.copy_insured_by_code),
        (3, "4. MISSING HOLDERS", lambda d, pack: parties.add_missing_holders(d, pack, cut=stages.cut)),
    ):
        df = stages.cut(rule(df, PACK), "step")
        stages.keep("step")
        audit.step(name, level, stages.rows["step"])
    stages.clear()
    target = stages.new_path("audit")
    audit.append_to(target)
    return spark.read.parquet(target).select("audit_id", "entry", "rows")


@query
def activity_lookup_(spark, sf):
    return activity_lookup(dimension(spark, sf, "activity"), PACK.activity_property)


# --- projections, filters, predicates ------------------------------------------------

@query
def reset_state(spark, sf):
    return parties.reset_state(extract(spark, sf)).select(
        "record_id", "rule_trace", "active", "policy_no", "note")


@query
def blank_to_null(spark, sf):
    return parties.trim_activity(extract(spark, sf)).select("record_id", "activity_code")


@query
def init_eval(spark, sf):
    return plain(cleaned(spark, sf))


@query
def delete_marked(spark, sf):
    return parties.drop_generated_holders(extract(spark, sf), PACK).select(
        "record_id", "note", "rule_trace")


@query
def rewrite_where_(spark, sf):
    out = rewrite_where(
        cleaned(spark, sf), (F.col("active") == 0) & F.col("note").isNull(),
        {"note": F.lit("DROPPED"), "regime_eval": F.lit(None)}, "-X001")
    return out.select("record_id", "note", "regime_eval", "rule_trace")


@query
def rule_r002(spark, sf):
    return documents.type_from_number(cleaned(spark, sf), PACK).select(*DOC)


@query
def rule_r003(spark, sf):
    return documents.pad_number(cleaned(spark, sf), PACK).select(*DOC)


@query
def rule_r004(spark, sf):
    return documents.type_from_legacy(cleaned(spark, sf), PACK).select(*DOC)


@query
def rule_r020_doc(spark, sf):
    return documents.type_from_loan(cleaned(spark, sf), PACK).select(*DOC)


@query
def fixed_overrides(spark, sf):
    df = documents.override_doc_types(with_regions(spark, sf), PACK)
    return regions.override_regions(df, PACK).select("record_id", "doc_type_eval", "region_eval")


@query
def region_normalise(spark, sf):
    return with_regions(spark, sf).select("record_id", "region_eval")


@query
def rule_r065(spark, sf):
    return regions.capital_for_product(with_regions(spark, sf), PACK).select(*REGION)


@query
def rule_r018(spark, sf):
    return regions.mark_unknown_region_id(cleaned(spark, sf), PACK).select(
        "record_id", "region_id", "rule_trace")


@query
def person_type(spark, sf):
    return products.classify_person(cleaned(spark, sf), PACK).select("record_id", "person_type")


@query
def predicate_mix(spark, sf):
    return cleaned(spark, sf).where(
        regimes.regime_source(PACK) & F.col("doc_type_eval").isNull()
        & (F.col("party_role") != PACK.holder) & (F.col("product_key") > 0)
    ).select("record_id", "source_system", "product_name", "doc_type_eval")


@query
def lookup_required(spark, sf):
    return parties.required_product(dimension(spark, sf, "product"), PACK, check=True)


# --- joins ---------------------------------------------------------------------------

@query
def update_from_(spark, sf):
    group = dimension(spark, sf, "product").where(F.col("is_group") == 1)
    out = update_from(cleaned(spark, sf), group, {"product_key": F.col("product_key")},
                      {"regime_eval": "regime_id"}, "-X002")
    return out.select("record_id", "regime_eval", "rule_trace")


@query
def handoff_sync(spark, sf):
    out = handoff.sync_handoffs(derive(spark, sf, "handoff"), derive(spark, sf, "handoff_staged"))
    return out.select(*handoff.HANDOFF_KEYS, "shipment_id", "changed")


@query
def join_inner(spark, sf):
    rows = cleaned(spark, sf).select("record_id", "product_key")
    out = lookup(rows, dimension(spark, sf, "product"), {"product_key": F.col("product_key")},
                 ["regime_id"])
    return out.where(F.col("_hit").isNotNull()).select(*rows.columns, "_hit.regime_id")


def newest_known(df: DataFrame) -> DataFrame:
    """Newest row with a region per policy, as aggregates without a join back."""
    known = F.col("region_eval") != PACK.no_region
    return df.where(known).groupBy("policy_no").agg(
        F.max("record_id").alias("record_id"),
        F.max_by("region_eval", "record_id").alias("region_eval"))


@query
def join_multikey(spark, sf):
    df = cleaned(spark, sf)
    newest = newest_known(df).select("policy_no", "record_id")
    return df.select("policy_no", "record_id", "region_eval").join(
        newest, ["policy_no", "record_id"])


@query
def join_left_chain(spark, sf):
    return nationality.join_nationality(
        cleaned(spark, sf), dimension(spark, sf, "doc_type"), dimension(spark, sf, "nationality"),
    ).select("record_id", "doc_kind", "national_id", "unknown_id")


@query
def join_watchlist(spark, sf):
    return regimes.join_watchlist(
        cleaned(spark, sf), dimension(spark, sf, "watchlist"), PACK,
    ).select("record_id", "_listed.*")


@query
def join_semi(spark, sf):
    """IN over an aggregate of the same table, joined back without piling up a hot policy."""
    df = extract(spark, sf)
    found = attach(df.select("record_id", "policy_no"), parties.holderless_policies(df, PACK),
                   {"policy_no": F.col("policy_no")}, ["_product"])
    return found.where(F.col("_hit").isNotNull()).drop("_hit")


@query
def join_not_in(spark, sf):
    """NOT IN over the parties' policies, through an aggregate by policy."""
    df = extract(spark, sf)
    groups = regions.policy_groups(df, PACK).where(~F.col("has_party"))
    unnumbered = df.where(
        F.col("policy_no").isNull() & F.col("party_role").isin(PACK.holder, PACK.insured))
    rows = df.where((F.col("party_role") == PACK.beneficiary) & ~unnumbered.exists())
    found = attach(rows.select("record_id", "policy_no"), groups,
                   {"policy_no": F.col("policy_no")}, ["has_party"])
    return found.where(F.col("_hit").isNotNull()).drop("_hit")


@query
def nationality_map(spark, sf):
    return nationality.map_nationality(
        cleaned(spark, sf), dimension(spark, sf, "doc_type"), dimension(spark, sf, "nationality"),
        PACK).select("record_id", "nationality_eval")


@query
def parent_policy(spark, sf):
    return plain(with_parents(spark, sf).select("record_id", "parent_policy_no"))


@query
def rule_r0041(spark, sf):
    return plain(parties.deactivate_group_holders(with_parents(spark, sf), PACK, cut=StageArea(spark).cut).select(
        "record_id", "parent_policy_no", "active", "rule_trace"))


@query
def activity_match(spark, sf):
    return parties.match_activity(
        extract(spark, sf), dimension(spark, sf, "activity"), PACK,
    ).select("record_id", "activity_code")


@query
def rule_r060(spark, sf):
    return parties.deactivate_provisional(
        cleaned(spark, sf), dimension(spark, sf, "product"), PACK, check=True,
    ).select("record_id", "active", "rule_trace")


@query
def product_map_1(spark, sf):
    return products.map_product_full(
        cleaned(spark, sf), dimension(spark, sf, "product"), PACK,
    ).select("record_id", "product_key", "risk_id")


@query
def product_map_2(spark, sf):
    return products.map_product_named(
        cleaned(spark, sf), dimension(spark, sf, "product"), PACK,
    ).select("record_id", "product_key", "risk_id")


@query
def product_map_3(spark, sf):
    return products.map_product_short(
        cleaned(spark, sf), dimension(spark, sf, "product"), PACK,
    ).select("record_id", "product_key", "risk_id", "product_name")


@query
def region_id_lookup(spark, sf):
    return update_from(
        with_regions(spark, sf), dimension(spark, sf, "region"), {"code": F.col("region_eval")},
        {"region_id": "region_id"}).select("record_id", "region_id")


# --- aggregates, windows, set operations ---------------------------------------------

@query
def agg_count_distinct_having(spark, sf):
    df = with_documents(spark, sf).where(documents.has_document(PACK))
    return df.groupBy("doc_no_eval").agg(
        F.count_distinct("doc_type_eval").alias("n_types")).where(F.col("n_types") > 1)


@query
def agg_distinct_pairs(spark, sf):
    pairs = with_documents(spark, sf).where(documents.has_document(PACK)).select(
        "doc_no_eval", "doc_type_eval").distinct()
    return pairs.groupBy("doc_no_eval").agg(
        F.count("doc_type_eval").alias("n_types")).where(F.col("n_types") > 1)


@query
def agg_singletons(spark, sf):
    gaps = with_regions(spark, sf).where(
        (F.col("region_eval") == PACK.no_region) & (F.col("party_role") != PACK.holder))
    return gaps.groupBy("doc_type_eval", "doc_no_eval").agg(
        F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") == 1)


@query
def agg_max_date(spark, sf):
    df = with_documents(spark, sf).where(
        documents.has_document(PACK) & (F.col("doc_type_eval") != PACK.unknown_type))
    return df.groupBy("doc_no_eval").agg(F.max("start_date").alias("start_date"))


@query
def agg_max_by(spark, sf):
    return newest_known(with_regions(spark, sf)).select("policy_no", "region_eval")


@query
def regime_max(spark, sf):
    return regimes.highest_regime(cleaned(spark, sf)).select("record_id", "regime_eval")


@query
def agg_distinct(spark, sf):
    return plain(parties.parent_holder_keys(with_parents(spark, sf), PACK))


@query
def rule_counts_(spark, sf):
    df = parties.reset_state(cleaned(spark, sf))
    df = documents.resolve_documents(documents.normalise_documents(df, PACK), PACK)
    return rule_counts(df)


@query
def window_row_number(spark, sf):
    """First region per document. The window runs over distinct candidates only."""
    known = with_regions(spark, sf).where(
        documents.has_document(PACK) & (F.col("region_eval") != PACK.no_region))
    latest = known.groupBy("doc_no_eval", "region_eval").agg(F.max("start_date").alias("at"))
    several = documents.document_groups(with_regions(spark, sf), PACK, regions=True).where(
        F.col("region_min") != F.col("region_max")).select("doc_no_eval")
    order = Window.partitionBy("doc_no_eval").orderBy(F.desc("at"), "region_eval")
    return (latest.join(several, "doc_no_eval", "left_semi")
            .withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") == 1).select("doc_no_eval", "region_eval"))


HOLDER_ROW = ("policy_no", "doc_type_eval", "doc_no_eval", "party_name", "note", "rule_trace",
              "source_file")


def _parent_rows(spark, sf):
    df = with_parents(spark, sf)
    kept = parties.drop_generated_holders(df, PACK)
    return df, kept, parties.parent_holder_rows(df, PACK, StageArea(spark).cut)


def _numbered_parent_rows(spark, sf):
    df, kept, added = _parent_rows(spark, sf)
    order = ["parent_policy_no", "doc_type_eval", "doc_no_eval"]
    return kept, next_ids(added, df, order, StageArea(spark).cut)


@query
def parent_holder_rows(spark, sf):
    return _parent_rows(spark, sf)[2].select(*HOLDER_ROW)


@query
def next_ids_(spark, sf):
    return _numbered_parent_rows(spark, sf)[1].select(
        "record_id", "policy_no", "doc_no_eval", "doc_type_eval")


@query
def rule_r040(spark, sf):
    kept, added = _numbered_parent_rows(spark, sf)
    return kept.unionByName(added).select("record_id", *HOLDER_ROW)


@query
def set_union_all(spark, sf):
    """All rows plus changed copies of some: one pass instead of a union."""
    rows = extract(spark, sf).select("policy_no", "party_role", "note", "product_name")
    copied = (F.col("party_role") == PACK.holder) & (
        F.col("product_name") == PACK.copy_by_name_product)
    return copy_rows(rows, copied, {
        "party_role": F.lit(PACK.insured), "note": F.lit("copy")}).drop("product_name")


@query
def set_except(spark, sf):
    rows = extract(spark, sf).where(F.col("product_name") == PACK.holderless_product)
    holders = rows.where(F.col("party_role") == PACK.holder)
    return rows.select("policy_no").subtract(holders.select("policy_no"))


@query
def renumber_(spark, sf):
    rows = extract(spark, sf).select(*dict.fromkeys((*PARTY, "product_name", *initial.ID_ORDER)))
    df = parties.copy_insured_by_name(parties.reset_state(rows), PACK).drop("product_name")
    return renumber(df, initial.ID_ORDER, StageArea(spark).cut).select(*PARTY)


# --- composite rules -----------------------------------------------------------------

@query
def copy_insured_by_name(spark, sf):
    return parties.copy_insured_by_name(extract(spark, sf), PACK).select(*PARTY)


@query
def copy_insured_by_code(spark, sf):
    return parties.copy_insured_by_code(extract(spark, sf), PACK).select(*PARTY)


@query
def rule_r001(spark, sf):
    return parties.add_missing_holders(parties.reset_state(extract(spark, sf)), PACK).select(
        *PARTY, "doc_no", "doc_no_eval", "source_file", "policy_status")


def _documents(spark, sf, *rules):
    return documents.resolve_documents(with_documents(spark, sf), PACK, rules, cut=StageArea(spark).cut).select(*DOC)


@query
def rule_r005(spark, sf):
    return _documents(spark, sf, "R005")


@query
def rule_r006(spark, sf):
    return _documents(spark, sf, "R006")


@query
def rule_r007(spark, sf):
    return _documents(spark, sf, "R007")


@query
def documents_all(spark, sf):
    return _documents(spark, sf, "R005", "R006", "R007")


@query
def region_latest(spark, sf):
    return regions.latest_region(with_regions(spark, sf), PACK, cut=StageArea(spark).cut).select("record_id", "region_eval")


def _policies(spark, sf, *rules):
    return regions.resolve_policies(with_regions(spark, sf), PACK, rules, cut=StageArea(spark).cut).select(*REGION)


@query
def rule_r050(spark, sf):
    return _policies(spark, sf, "R050")


@query
def rule_r050_1(spark, sf):
    return _policies(spark, sf, "R050-1")


@query
def rule_r057_1(spark, sf):
    return _policies(spark, sf, "R057-1")


@query
def rule_r058(spark, sf):
    cut = StageArea(spark).cut
    df = regions.resolve_policies(with_regions(spark, sf), PACK, (), keep_holder=True, cut=cut)
    return regions.region_from_holder(df, PACK, cut=cut).select(*REGION)


@query
def regions_all(spark, sf):
    stages = StageArea(spark)
    rows = with_regions(spark, sf).select(*REGION_RULES)
    df = stages.cut(regions.latest_region(rows, PACK, cut=stages.cut), "by-document")
    stages.keep("by-document")
    df = stages.cut(regions.resolve_policies(df, PACK, keep_holder=True, cut=stages.cut), "by-policy")
    stages.keep("by-policy")
    df = regions.region_from_holder(df, PACK, cut=stages.cut)
    return regions.finish_regions(df, dimension(spark, sf, "region"), PACK).select(*REGION)


@query
def rule_r019(spark, sf):
    return regimes.rate_by_watchlist(
        cleaned(spark, sf), dimension(spark, sf, "product"), dimension(spark, sf, "watchlist"),
        PACK).select(*REGIME)


@query
def rule_r020_regime(spark, sf):
    return regimes.regime_by_document(
        cleaned(spark, sf), dimension(spark, sf, "product"), PACK).select(*REGIME)


@query
def rule_r021(spark, sf):
    return regimes.regime_by_product(
        cleaned(spark, sf), dimension(spark, sf, "product"), PACK).select(*REGIME)


@query
def regimes_all(spark, sf):
    stages, product = StageArea(spark), dimension(spark, sf, "product")
    df = regimes.rate_by_watchlist(
        cleaned(spark, sf).select(*REGIME_RULES), product, dimension(spark, sf, "watchlist"), PACK, settle=stages.settle())
    df = stages.cut(df, "rated")
    stages.keep("rated")
    df = stages.cut(regimes.fill_missing_regimes(df, product, PACK, cut=stages.cut), "filled")
    stages.keep("filled")
    return regimes.highest_regime(df, cut=stages.cut).select(*REGIME)


@query
def src_load_tables(spark, sf):
    """The extract under other column names and the reference tables by name, through `load_tables`."""
    path = StageArea(spark).new_path("theirs")
    theirs = {c: f"src_{c}" for c in PARTY_POLICY.fieldNames()}
    extract(spark, sf).select(*[F.col(c).alias(t) for c, t in theirs.items()]).write.parquet(path, compression=CODEC)
    sources = {"party_policy": path}
    for name in DIMENSIONS:
        sources[name] = f"loaded_{name}"
        dimension(spark, sf, name).createOrReplaceTempView(sources[name])
    fact, _ = load_tables(spark, sources, {"party_policy": theirs})
    return plain(fact)


@query
def src_load_dimensions(spark, sf):
    """The reference tables by other names, from paths and from a reader with options: rows and a digest of each as it was loaded."""
    area = StageArea(spark)
    sources, names = {"party_policy": area.new_path("fact")}, {}
    spark.createDataFrame([], PARTY_POLICY).write.parquet(sources["party_policy"])
    for i, (name, schema) in enumerate(DIMENSIONS.items()):
        names[name] = {c: f"their {c}" for c in reversed(schema.fieldNames())}
        path = area.new_path(name)
        dimension(spark, sf, name).select(*[F.col(c).alias(t) for c, t in names[name].items()]).write.parquet(path)
        sources[name] = path if i % 2 else {"format": "parquet", "path": path}
    _, dims = load_tables(spark, sources, names)
    out = None
    for name, schema in DIMENSIONS.items():
        texts = [F.round(F.col(f.name) * 100).cast("bigint") if f.dataType.typeName() == "double" else F.col(f.name) for f in schema]
        line = F.concat_ws("|", *[F.coalesce(t.cast("string"), F.lit("~")) for t in texts])
        number = F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("bigint")
        one = getattr(dims, name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"), F.sum(number).alias("digest"))
        out = one if out is None else out.unionByName(one)
    return out


@query
def audit_full_run(spark, sf):
    """Rows on which each rule acted in a full run, also those without a code, as its audit tells them."""
    stages, audit = StageArea(spark), AuditTrail(spark)
    run.run(extract(spark, sf), dimensions(spark, sf), PACK, stages, audit)
    stages.clear()
    return audit.frame().where("changed > 0").select(F.trim("entry").alias("entry"), "changed")


@query
def full_run(spark, sf):
    return plain(run.run(extract(spark, sf), dimensions(spark, sf), PACK, StageArea(spark)))


# --- scalar functions ----------------------------------------------------------------

@query
def fn_null(spark, sf):
    return extract(spark, sf).select(
        "record_id", F.coalesce("region_raw", F.lit("-")).alias("region_or_dash"),
        F.nullif("currency_code", F.lit(" ")).alias("currency"),
        F.coalesce("regime_id", F.lit(0)).alias("regime"))


@query
def fn_text(spark, sf):
    return extract(spark, sf).select(
        "record_id", F.trim("currency_code").alias("trimmed"),
        F.upper("activity_text").alias("upper_text"), F.length("party_name").alias("n_chars"))


@query
def fn_translate(spark, sf):
    return extract(spark, sf).select(
        "record_id", F.translate("doc_no", " +-.0123456789", " ").alias("rest"),
        text.numeric_only(F.col("doc_no")).alias("numeric_only"))


@query
def fn_concat(spark, sf):
    return extract(spark, sf).select(
        "record_id", text.append_text(F.col("rule_trace"), "-R000").alias("appended"))


@query
def fn_substr(spark, sf):
    return extract(spark, sf).select(
        "record_id", text.before_dash(F.col("policy_no")).alias("prefix"),
        F.substring(text.append_text(F.lit("000"), F.col("doc_no")), -8, 8).alias("padded"))


@query
def fn_cast(spark, sf):
    return extract(spark, sf).select(
        "record_id",
        F.col("doc_no").try_cast("decimal(38,0)").cast("string").alias("doc_number"),
        F.col("regime_id").cast("string").alias("regime_text"))


@query
def fn_case(spark, sf):
    return nationality.map_nationality(
        with_regions(spark, sf), dimension(spark, sf, "doc_type"),
        dimension(spark, sf, "nationality"), PACK,
    ).select("record_id", "nationality_eval", "region_eval", "activity_code_eval")
