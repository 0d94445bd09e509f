"""Queries on a cluster without a named folder for stages, whose warehouse all machines share."""

from datetime import datetime, timedelta

import pyarrow.parquet as parquet
import pytest
from compare import connect, differences

import __spark_entry__ as registered
from partysieve.sources import stages

QUERIES = (
    "agg_count_distinct_having",
    "agg_distinct_pairs",
    "agg_distinct",
    "agg_max_by",
    "agg_max_date",
    "audit_log",
    "agg_singletons",
    "blank_to_null",
    "clear_staging",
    "audit_full_run",
    "delete_marked",
    "copy_insured_by_name",
    "fixed_overrides",
    "copy_insured_by_code",
    "fn_case",
    "documents_all",
    "fn_cast",
    "fn_text",
    "fn_null",
    "fn_concat",
    "fn_substr",
    "fn_translate",
)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Own rows: 120 orders of 4 lines each, of 30 customers, with the parts that rules ask for."""
    folder = tmp_path_factory.mktemp("tables")
    day = lambda i: datetime(2020, 1, 1) + timedelta(days=i % 90)
    rows = {
        "region": ("r_regionkey int, r_name string", [(i, n) for i, n in enumerate(("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"))]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(i, f"NATION_{i}", i % 5) for i in range(10)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                     [(i, f"Customer#{i}", i * 7 % 10, 600.0 * i - 900, ("BUILDING", "MACHINERY", "OTHER")[i % 3]) for i in range(30)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(0, "Supplier#0", 0, 1.0)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int",
                 [(i, ("cold widget", "red plate", "hot ring")[i % 3], f"Brand#{i % 4}", ("PROMO", "ECONOMY", "LARGE")[i // 4 % 3], i % 5) for i in range(24)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
                   [(i, (i * 11 + i // 30) % 30, "OFP"[i % 3], 10.25 * i, day(i * 17), ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")[i // 2 % 5]) for i in range(120)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
                     [(i, (i * 5 + k * 7) % 24, (i + k * 3) % 20, k, k + 1.0, 2.5 * i, "ARN"[(i + k) % 3], "OF"[(i + k) % 2], day(i + k)) for i in range(120) for k in range(1, 5)]),
    }
    for name, (schema, found) in rows.items():
        parquet.write_table(spark.createDataFrame(found, schema).toArrow(), folder / f"{name}.parquet")
    return folder


@pytest.fixture
def warehouse(spark, tmp_path, monkeypatch):
    """A session that shows a cluster's master, names no folder for stages, and has this warehouse."""
    monkeypatch.setattr(stages, "_SETTING", "partysieve.test.none")
    monkeypatch.setattr(stages, "_WAREHOUSE", "partysieve.test.warehouse")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    spark.conf.set("partysieve.test.warehouse", f"file://{tmp_path}/warehouse")
    yield tmp_path / "warehouse"
    spark.conf.unset("partysieve.test.warehouse")


@pytest.mark.parametrize("name", QUERIES)
def test_the_warehouse_holds_the_stages(spark, tables, tmp_path, warehouse, name):
    data = tmp_path / "data"  # a path of its own: the extract is written anew
    data.symlink_to(tables)
    out = registered.QUERIES[name](spark, str(data))
    assert differences(out, connect(str(data)), registered.build()[name]) is None
    assert out.count() and any(warehouse.glob("run-*/*"))


def test_a_warehouse_that_is_not_shared_is_refused(spark, warehouse):
    warehouse.write_text("")  # no task can write there
    with pytest.raises(ValueError, match="the warehouse, .*, is none"):
        stages.checkpoint_root(spark)
