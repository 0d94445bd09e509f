"""Every registered query against its SQL counterpart, on whole tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as registered

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = registered.QUERIES, registered.build()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_rules_act_in_the_order_of_the_run(spark):
    """Each rule has rows left when its turn comes, but R021: R019 has rated the rows that it would go by."""
    from partysieve.operators.counts import RULES

    acted = {r["entry"] for r in QUERIES["audit_full_run"](spark, "/root/testdata/sf0.01").collect()}
    assert set(RULES) - acted == {"R021"}


def test_entry(spark):
    rows = registered.entry(spark).collect()
    assert sum(r["rows"] for r in rows) > 6000


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
         "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", ["src_scan", "init_eval", "parent_holder_rows", "handoff_sync",
                                  "fn_text", "join_left_chain", "rule_r019", "agg_singletons"])
def test_types(spark, con, name):
    got = {c: TYPES[t] for c, t in QUERIES[name](spark, SF).dtypes}
    want = {r[0]: str(r[1]) for r in con.execute("DESCRIBE " + ORACLES[name]).fetchall()}
    assert got == want
