"""Column contract of the party-policy table and its reference tables."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES: dict[str, DataType] = {
    "STRING": StringType(), "INT": IntegerType(), "BIGINT": LongType(), "DOUBLE": DoubleType(),
    "DATE": DateType(), "TIMESTAMP_NTZ": TimestampNTZType(),
    "MONEY": DecimalType(18, 2), "NUMBER": DecimalType(38, 0),
}


def _schema(columns: str) -> StructType:
    """Build without a session, which reading DDL would need."""
    pairs = (c.split() for c in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


PARTY_POLICY = _schema("""
    record_id BIGINT, policy_no STRING, business_line STRING, currency_code STRING,
    premium MONEY, pay_freq_code STRING, premium_total MONEY,
    party_name STRING, surname_1 STRING, surname_2 STRING,
    doc_type STRING, doc_no STRING, party_role STRING, nationality STRING,
    person_type STRING, line_code STRING, subline_code STRING, product_code STRING,
    regulator_product_code STRING, activity_code STRING, activity_text STRING,
    regime_id INT, issue_date TIMESTAMP_NTZ, start_date TIMESTAMP_NTZ, end_date TIMESTAMP_NTZ,
    source_system STRING, region_raw STRING, nationality_eval STRING, region_eval STRING,
    region_id INT, product_name STRING, risk_id INT, product_key BIGINT, birth_date DATE,
    actuarial_age INT, pay_period STRING, premium_collected MONEY,
    activity_id_eval INT, premium_total_local MONEY, doc_type_eval STRING,
    doc_no_eval STRING, note STRING, rule_trace STRING, created_at TIMESTAMP_NTZ,
    modified_at TIMESTAMP_NTZ, on_watchlist INT, active INT, party_name_eval STRING,
    surname_1_eval STRING, surname_2_eval STRING, activity_code_eval STRING,
    regime_eval INT, parent_policy_no NUMBER, source_file STRING, policy_status STRING
""")

DIMENSIONS = {
    "product": _schema(
        "product_key BIGINT, line_code STRING, subline_code STRING, product_code STRING, "
        "product_name STRING, risk_id INT, regime_id INT, source_system STRING, is_group INT"
    ),
    "doc_type": _schema("doc_type STRING, kind INT"),
    "nationality": _schema("nationality_id INT, origin STRING, final_id INT"),
    "region": _schema("code STRING, region_id INT"),
    "watchlist": _schema(
        "doc_type STRING, doc_no STRING, rating STRING, exposure DOUBLE"
    ),
    "activity": _schema("code STRING, description STRING, property_id BIGINT"),
}

# Columns that a holder row copied from a holderless policy does not take over.
NOT_COPIED_TO_HOLDER = (
    "doc_type_eval", "doc_no_eval", "note", "created_at", "modified_at", "on_watchlist",
    "party_name_eval", "surname_1_eval", "surname_2_eval", "activity_code_eval",
    "regime_eval", "parent_policy_no", "source_file", "policy_status",
)

# And those that a holder row added for a parent policy does not take over.
NOT_COPIED_TO_PARENT_HOLDER = ("source_file", "policy_status")

# What the rules read or write, but for `note`, `parent_policy_no` and `regime_id`, which the party
# steps need. Every other column is only carried, so the run leaves it out of all shuffles and
# joins it once at the end.
WORKING_COLUMNS = (
    "record_id", "policy_no", "party_role", "doc_type", "doc_no", "source_system",
    "line_code", "subline_code", "product_code", "product_name", "product_key", "risk_id",
    "start_date", "person_type", "nationality_eval", "region_eval", "region_id",
    "doc_type_eval", "doc_no_eval", "rule_trace", "active", "on_watchlist", "regime_eval",
)


def align(df: DataFrame, schema: StructType, optional: Collection[str] = ()) -> DataFrame:
    """Select the schema's columns by name, cast to its types.

    Absent columns are an error, but for those named as optional, which become NULL.
    """
    present = {c.lower() for c in df.columns}
    absent = [f.name for f in schema if f.name.lower() not in present and f.name not in optional]
    if absent:
        raise ValueError(f"the source has no column {', '.join(absent)}; it has {', '.join(df.columns)}")
    return df.select(*[
        (F.col(f.name) if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])
