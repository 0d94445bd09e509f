from pyspark.sql import functions as F

from partysieve.functions import text
from partysieve.operators.rewrite import copy_rows, delete_marked, rewrite_where


def values(spark, expr, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("c"))).collect()]


def test_blank_to_null_trims_spaces_but_not_tabs(spark):
    assert values(spark, text.blank_to_null, [" a ", "  ", "", "\t", None]) == [
        "a", None, None, "\t", None]


def test_numeric_only(spark):
    rows = ["12345678", "1.5-+ 2", "1a", " ", "\t", None]
    assert values(spark, text.numeric_only, rows) == [True, True, False, True, False, True]


def test_append_treats_null_as_empty(spark):
    assert values(spark, lambda c: text.append_text(c, "-R1"), [None, "", "-"]) == [
        "-R1", "-R1", "--R1"]


def test_before_dash(spark):
    assert values(spark, text.before_dash, ["12-9-3", "12", "-5", "ab-1", None]) == [
        "12", None, "", "ab", None]


def test_pad_to_eight(spark):
    assert values(spark, text.pad_to_eight, ["1234567", "123456789", None]) == [
        "01234567", "23456789", None]


def test_choose_and_all_equal(spark):
    assert values(spark, lambda c: text.choose(c, {"a": "1", "b": "2"}), ["a", "b", "c", None]) == [
        "1", "2", None, None]
    assert values(spark, lambda c: text.choose(c, {}), ["a"]) == [None]
    assert values(spark, lambda c: text.all_equal({}), ["a", None]) == [True, True]
    assert values(spark, lambda c: text.all_equal({"c": "a"}), ["a", "b"]) == [True, False]


def test_rewrite_reads_old_values_and_leaves_null_conditions_alone(spark, fact):
    df = fact([{"record_id": 1, "note": "a", "active": 1},
               {"record_id": 2, "note": None, "active": 1}])
    out = rewrite_where(df, F.col("note") == "a",
                        {"note": F.lit("b"), "policy_no": F.col("note")}, "-X")
    got = [tuple(r) for r in out.orderBy("record_id").select(
        "note", "policy_no", "rule_trace").collect()]
    assert got == [("b", "a", "-X"), (None, None, None)]


def test_delete_marked_keeps_rows_without_text(spark, fact):
    df = fact([{"record_id": i, "note": n} for i, n in enumerate([None, "x", "an auto: A", "auto"])])
    out = delete_marked(df, "note", "%auto: A%").orderBy("record_id").collect()
    assert [r["note"] for r in out] == [None, "x", "auto"]
    wild = delete_marked(df, "note", "%auto_ A%").orderBy("record_id").collect()
    assert [r["note"] for r in wild] == [None, "x", "auto"]


def test_copy_rows_is_union_all(spark, fact):
    df = fact([{"record_id": i, "party_role": r} for i, r in enumerate(["H", "I", None, "H"])])
    got = copy_rows(df, F.col("party_role") == "H", {"party_role": F.lit("I")})
    assert got.columns == df.columns
    assert sorted((r["record_id"], r["party_role"] or "") for r in got.collect()) == [
        (0, "H"), (0, "I"), (1, "I"), (2, ""), (3, "H"), (3, "I")]
