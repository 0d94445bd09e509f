"""A party-policy extract and its reference tables, derived from the TPC-H-like tables.

The same SQL text builds them in Spark and in the oracle. Every expression is row-local
over equi-joins: ids come from a digest of the line's key, not from a global row number.
"""

from __future__ import annotations

from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from partysieve.pack import RulePack
from partysieve.schema import DIMENSIONS, PARTY_POLICY, align
from partysieve.sources.session import configure, spread
from partysieve.sources.stages import StageArea
from partysieve.sources.tables import Dimensions

TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")

# Policies that R057-1 is for.
LISTED = tuple(f"{i % 400:06d}-{i}" for i in range(6, 6000, 10))

FIXTURE_PACK = RulePack(
    holder="HOLDER", insured="INSURED", beneficiary="BENEFICIARY",
    copy_by_name_product="cold widget", copy_by_name_note="auto: INSURED BY NAME",
    copy_by_code_product={"line_code": "Brand#3", "product_code": "PROMO"},
    copy_by_code_note="auto: INSURED BY CODE",
    holderless_product="cold widget", parent_holder_note="auto: HOLDER COPY",
    sheet_source="SHEET", digital_source="DIGITAL",
    activity_sources=("LEGACY", "SHEET"), activity_property=1,
    provisional_product={"product_code": "ECONOMY"},
    loan_products=("RED PLATE", "HOT RING"),
    region_synonyms={"PORT PROVINCE": "PORT"},
    region_placeholders=("EUROPE", "-", "."),
    beneficiary_only_product={"line_code": "Brand#3"}, capital_product={"line_code": "Brand#1"},
    product_sources_full=("CORE",), product_sources_named=("LEGACY",),
    product_sources_short=("SHEET",),
    regime_sources=("CORE", "LEGACY", "DIGITAL"),
    regime_sheet_products=("cold widget", "red plate"),
    handoff_events=("ISSUE", "QUICK", "PROPOSAL"),
    doc_type_overrides={"10000004": "DNI"}, region_overrides={"000077-77": "ABROAD"},
    newest_region_policies=LISTED,
)

# Blank numbers become NULL; '-' stands for them in one rule; signs and spaces leave a number numeric.
_DOC_NO = """CASE WHEN c.c_custkey % 24 = 8 THEN '-' WHEN c.c_custkey % 24 = 20 THEN ' '
      WHEN c.c_custkey % 24 = 13 THEN CONCAT('1 +-.', CAST(100 + c.c_custkey % 900 AS VARCHAR(20)))
      WHEN c.c_custkey % 11 = 0 THEN '0' WHEN c.c_custkey % 13 = 3 THEN NULL
      WHEN c.c_custkey % 5 = 1 THEN CAST(1000000 + c.c_custkey AS VARCHAR(20))
      WHEN c.c_custkey % 5 = 2 THEN CONCAT('X', CAST(100000 + c.c_custkey AS VARCHAR(20)))
      ELSE CAST(10000000 + c.c_custkey AS VARCHAR(20)) END"""

_DOC_TYPE = """CASE c.c_custkey % 4
      WHEN 0 THEN CASE WHEN o.o_orderkey % 3 = 0 THEN CASE WHEN c.c_custkey % 8 = 0 THEN ' ' ELSE NULL END ELSE 'CE' END
      WHEN 1 THEN CASE WHEN o.o_orderkey % 3 = 0 THEN NULL WHEN o.o_orderkey % 3 = 1 THEN 'LE' ELSE 'DNI' END
      WHEN 2 THEN CASE WHEN o.o_orderkey % 2 = 0 THEN 'CE' ELSE 'PAS' END
      ELSE CASE WHEN o.o_orderkey % 9 = 0 THEN 'DNI' ELSE 'RUCJ' END END"""

_SOURCE = """CASE WHEN l.l_orderkey % 10 < 6 THEN 'CORE' WHEN l.l_orderkey % 10 = 6 THEN 'SHEET'
      WHEN l.l_orderkey % 10 = 7 THEN 'DIGITAL' ELSE 'LEGACY' END"""

_LINE_KEY = """CONCAT_WS('|', CAST(l.l_orderkey AS VARCHAR(20)), CAST(l.l_linenumber AS VARCHAR(20)),
      CAST(l.l_partkey AS VARCHAR(20)), CAST(l.l_suppkey AS VARCHAR(20)),
      CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR(20)))"""

# Some orders also have a guest: a client of one row, insured without a region beside a holder who has one. All other clients
# have many rows, whose regions are settled by document before the rule on single gaps (R058) can act.
_FAMILIES = "(SELECT 0 AS slot, 0 AS family UNION ALL SELECT 1 AS slot, 0 AS family UNION ALL SELECT 1 AS slot, 1 AS family)"
_SLOT = "CASE WHEN l.l_linenumber = 1 AND o.o_orderkey % 35 = 2 THEN 1 ELSE 0 END"


def _guest(value: str, other: str) -> str:
    return f"CASE WHEN f.family = 1 THEN {value} ELSE {other} END"


_GUEST_NO = "CONCAT('G', CAST(o.o_orderkey AS VARCHAR(20)), '-', CAST(l.l_partkey AS VARCHAR(20)), '-', CAST(l.l_suppkey AS VARCHAR(20)))"
_ROW_KEY = f"CONCAT({_guest("'guest|'", "''")}, {_LINE_KEY})"
_ID = {
    "spark": f"CAST(CONV(SUBSTR(MD5({_ROW_KEY}), 1, 15), 16, 10) AS BIGINT)",
    "duckdb": f"CAST(CONCAT('0x', SUBSTR(MD5({_ROW_KEY}), 1, 15)) AS BIGINT)",
}

EXTRACT = f"""
SELECT $ID AS record_id,
 CASE o.o_orderkey % 40 WHEN 6 THEN CAST(o.o_orderkey AS VARCHAR(20)) WHEN 7 THEN CONCAT('TX-', CAST(o.o_orderkey AS VARCHAR(20)))
      ELSE CONCAT(LPAD(CAST(o.o_orderkey % 400 AS VARCHAR(20)), 6, '0'), '-', CAST(o.o_orderkey AS VARCHAR(20))) END AS policy_no,
 c.c_mktsegment AS business_line,
 CASE l.l_returnflag WHEN 'A' THEN ' USD ' WHEN 'R' THEN 'PEN' ELSE ' ' END AS currency_code,
 CAST(o.o_totalprice AS DECIMAL(18,2)) AS premium,
 CASE l.l_linenumber % 3 WHEN 0 THEN ' M ' WHEN 1 THEN '' ELSE 'A' END AS pay_freq_code,
 CAST(l.l_extendedprice AS DECIMAL(18,2)) AS premium_total,
 CONCAT(' ', c.c_name) AS party_name,
 CASE WHEN c.c_custkey % 6 = 0 THEN NULL ELSE n.n_name END AS surname_1,
 CASE WHEN c.c_custkey % 6 = 1 THEN ' ' ELSE r.r_name END AS surname_2,
 {_guest("'CE'", _DOC_TYPE)} AS doc_type,
 {_guest(_GUEST_NO, _DOC_NO)} AS doc_no,
 CASE WHEN f.family = 1 THEN 'INSURED' WHEN o.o_orderkey % 5 = 0 THEN 'BENEFICIARY' WHEN o.o_orderkey % 5 = 1 AND l.l_linenumber % 2 = 1 THEN 'INSURED'
      WHEN o.o_orderkey % 5 = 1 THEN 'BENEFICIARY' WHEN l.l_linenumber % 3 = 1 THEN 'HOLDER'
      WHEN l.l_linenumber % 3 = 2 THEN 'INSURED' ELSE 'BENEFICIARY' END AS party_role,
 CASE WHEN c.c_custkey % 9 = 0 THEN NULL WHEN c.c_custkey % 9 = 1 THEN ' ' ELSE n.n_name END AS nationality,
 CASE WHEN l.l_returnflag = 'A' THEN 'PERSONA NATURAL' WHEN l.l_returnflag = 'R' THEN 'PERSONA JURIDICA' ELSE NULL END AS person_type,
 p.p_brand AS line_code,
 CAST(p.p_size AS VARCHAR(20)) AS subline_code,
 p.p_type AS product_code,
 CONCAT(' ', p.p_brand, ' ') AS regulator_product_code,
 CASE l.l_linenumber % 4 WHEN 0 THEN ' ' WHEN 1 THEN '-' WHEN 2 THEN ' 77 ' ELSE NULL END AS activity_code,
 CASE WHEN l.l_linenumber = 5 THEN NULL ELSE LOWER(o.o_orderpriority) END AS activity_text,
 CASE WHEN l.l_linenumber = 3 THEN NULL ELSE CAST(l.l_partkey % 3 + 1 AS INTEGER) END AS regime_id,
 o.o_orderdate AS issue_date, o.o_orderdate AS start_date, l.l_shipdate AS end_date,
 {_SOURCE} AS source_system,
 CASE WHEN f.family = 1 THEN '-' WHEN l.l_suppkey % 6 = 0 THEN 'NINGUNO' WHEN l.l_suppkey % 17 = 0 THEN NULL WHEN l.l_suppkey % 7 = 3 THEN 'Port Province' ELSE r.r_name END AS region_raw,
 CAST(NULL AS VARCHAR(20)) AS nationality_eval,
 CAST(NULL AS VARCHAR(20)) AS region_eval,
 CASE WHEN l.l_suppkey % 19 = 0 THEN -1 WHEN l.l_suppkey % 19 = 1 THEN NULL ELSE r.r_regionkey END AS region_id,
 p.p_name AS product_name,
 CAST(NULL AS INTEGER) AS risk_id,
 CAST(l.l_partkey AS BIGINT) AS product_key,
 CAST(o.o_orderdate AS DATE) AS birth_date,
 CAST(p.p_size AS INTEGER) AS actuarial_age,
 o.o_orderstatus AS pay_period,
 CAST(l.l_quantity AS DECIMAL(18,2)) AS premium_collected,
 CAST(NULL AS INTEGER) AS activity_id_eval,
 CAST(l.l_extendedprice AS DECIMAL(18,2)) AS premium_total_local,
 NULLIF(TRIM(COALESCE({_guest("'CE'", _DOC_TYPE)}, '-1')), '') AS doc_type_eval,
 COALESCE({_guest(_GUEST_NO, _DOC_NO)}, '0') AS doc_no_eval,
 CASE WHEN l.l_linenumber % 4 = 0 THEN CASE l.l_returnflag WHEN 'A' THEN 'auto: HOLDER COPY A' WHEN 'R' THEN 'auto: INSURED BY NAME' ELSE 'auto: INSURED BY CODE' END
      WHEN l.l_linenumber % 4 = 1 THEN NULL ELSE 'extract' END AS note,
 CASE WHEN l.l_linestatus = 'F' AND l.l_returnflag = 'A' THEN '--R002-R040' WHEN l.l_linestatus = 'F' THEN NULL ELSE '--R0041' END AS rule_trace,
 o.o_orderdate AS created_at, l.l_shipdate AS modified_at,
 CAST(NULL AS INTEGER) AS on_watchlist,
 CASE WHEN l.l_returnflag = 'N' THEN 0 ELSE 1 END AS active,
 c.c_name AS party_name_eval,
 CAST(NULL AS VARCHAR(20)) AS surname_1_eval, CAST(NULL AS VARCHAR(20)) AS surname_2_eval,
 CAST(NULL AS VARCHAR(20)) AS activity_code_eval,
 CASE WHEN l.l_linenumber = 3 THEN NULL ELSE CAST(l.l_partkey % 3 + 1 AS INTEGER) END AS regime_eval,
 CAST(NULL AS DECIMAL(38,0)) AS parent_policy_no,
 CASE WHEN l.l_orderkey % 10 = 6 THEN CONCAT('sheet-', c.c_mktsegment) ELSE NULL END AS source_file,
 o.o_orderstatus AS policy_status
FROM {{lineitem}} l JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey JOIN {{customer}} c ON o.o_custkey = c.c_custkey
 JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey JOIN {{region}} r ON n.n_regionkey = r.r_regionkey
 JOIN {{part}} p ON l.l_partkey = p.p_partkey JOIN {_FAMILIES} f ON f.slot = {_SLOT}
"""

PRODUCT = """
SELECT CAST(p_partkey AS BIGINT) AS product_key, p_brand AS line_code, CAST(p_size AS VARCHAR(20)) AS subline_code,
 p_type AS product_code, p_name AS product_name, CAST(p_partkey % 3 + 1 AS INTEGER) AS risk_id,
 CASE WHEN p_partkey % 8 = 5 THEN NULL ELSE CAST(p_partkey % 3 + 1 AS INTEGER) END AS regime_id,
 CASE p_partkey % 3 WHEN 0 THEN 'CORE' WHEN 1 THEN 'LEGACY' ELSE 'SHEET' END AS source_system,
 CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS is_group
FROM {part}
"""

DOC_TYPE = """
SELECT DISTINCT doc_type, CASE doc_type WHEN 'DNI' THEN 1 WHEN 'LE' THEN 1 WHEN 'CE' THEN 2 WHEN 'PAS' THEN 2 ELSE 3 END AS kind
FROM (SELECT CASE c_custkey % 6 WHEN 0 THEN 'DNI' WHEN 1 THEN 'LE' WHEN 2 THEN 'CE' WHEN 3 THEN 'PAS' WHEN 4 THEN 'RUCJ' ELSE '-1' END AS doc_type FROM {customer}) codes
"""

NATIONALITY = """
SELECT CAST(n_nationkey AS INTEGER) AS nationality_id, n_name AS origin,
 CASE n_nationkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE -1 END AS final_id FROM {nation}
"""

REGION = "SELECT r_name AS code, CAST(r_regionkey AS INTEGER) AS region_id FROM {region}"

WATCHLIST = f"""
SELECT CASE c.c_custkey % 4 WHEN 1 THEN 'DNI' WHEN 3 THEN 'RUCJ' ELSE 'CE' END AS doc_type, {_DOC_NO} AS doc_no,
 CASE WHEN c.c_acctbal < 0 THEN 'Alto' WHEN c.c_acctbal < 6000 THEN 'Bajo' WHEN c.c_acctbal < 8000 THEN 'Medio' ELSE NULL END AS rating,
 c.c_acctbal AS exposure
FROM {{customer}} c WHERE c.c_mktsegment IN ('BUILDING', 'MACHINERY')
"""

ACTIVITY = """
SELECT DISTINCT SUBSTR(o_orderpriority, 1, 1) AS code, CONCAT(' ', o_orderpriority, ' ') AS description,
 CASE o_orderpriority WHEN '3-MEDIUM' THEN 2 ELSE 1 END AS property_id FROM {orders}
"""

HANDOFF = """
SELECT o.o_custkey % 7 AS product_id, o.o_orderkey AS policy_id, o.o_orderkey % 3 AS operation_id,
 CASE o.o_orderpriority WHEN '1-URGENT' THEN 'QUICK' WHEN '2-HIGH' THEN 'ISSUE' WHEN '3-MEDIUM' THEN 'PROPOSAL' ELSE 'QUOTE' END AS event,
 CASE WHEN o.o_orderstatus = 'O' THEN NULL ELSE o.o_orderkey * 10 END AS shipment_id,
 CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'X' ELSE 'E' END AS shipment_kind,
 CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE c.c_name END AS surname_1, CAST(NULL AS VARCHAR(20)) AS surname_2,
 CASE WHEN c.c_custkey % 4 = 0 THEN NULL ELSE c.c_mktsegment END AS first_name, CAST(NULL AS VARCHAR(20)) AS second_name,
 CASE WHEN c.c_acctbal < 0 THEN NULL ELSE CONCAT(c.c_name, '@example.com') END AS email
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
"""

HANDOFF_STAGED = """
SELECT o_custkey % 7 AS product_id, o_orderkey AS policy_id, o_orderkey % 3 AS operation_id,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'QUICK' WHEN '2-HIGH' THEN 'ISSUE' WHEN '3-MEDIUM' THEN 'PROPOSAL' ELSE 'QUOTE' END AS event,
 CASE o_orderpriority WHEN '5-LOW' THEN o_orderkey * 10 WHEN '4-NOT SPECIFIED' THEN NULL ELSE o_orderkey * 10 + 1 END AS shipment_id
FROM {orders} WHERE o_orderstatus <> 'P'
"""

DERIVED = {
    "extract": EXTRACT, "product": PRODUCT, "doc_type_dim": DOC_TYPE,
    "nationality_dim": NATIONALITY, "region_dim": REGION, "watchlist": WATCHLIST,
    "activity": ACTIVITY, "handoff": HANDOFF, "handoff_staged": HANDOFF_STAGED,
}


def duckdb_text(name: str) -> str:
    text = DERIVED[name].replace("$ID", _ID["duckdb"])
    return text.format(**{t: t for t in TABLES}).strip()


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = DERIVED[name].replace("$ID", _ID["spark"])
    configure(spark)
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in text}
    if "lineitem" in used:
        used["lineitem"] = spread(used["lineitem"])
    return spark.sql(text, **used)


def derived_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(derive(spark, sf_dir, "extract"), PARTY_POLICY)


_tables: dict[tuple[str, str], StageArea] = {}
_writing = Lock()


def extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract as the table that a deployment would have: derived and written once
    per application and source folder, then read by every query with its own columns.
    Queries that run at the same time wait for the one that writes it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _writing:
        if key not in _tables or not _tables[key].has("extract"):
            area = StageArea(spark)
            area.cut(derived_extract(spark, sf_dir), "extract")
            _tables[key] = area
        return _tables[key].read("extract", PARTY_POLICY)


_DIM_NAMES = {"doc_type": "doc_type_dim", "nationality": "nationality_dim", "region": "region_dim"}


def dimension(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return align(derive(spark, sf_dir, _DIM_NAMES.get(name, name)), DIMENSIONS[name])


def dimensions(spark: SparkSession, sf_dir: str) -> Dimensions:
    return Dimensions(**{name: dimension(spark, sf_dir, name) for name in DIMENSIONS})
