"""Rules against row-by-row models that follow the original loops, on random rows.

Keys are small and many, so that one frame holds a few hundred independent cases.
"""

import random
from collections import defaultdict
from dataclasses import replace

import pytest
from conftest import day
from pyspark.sql import functions as F

from partysieve.catalog.fixtures import FIXTURE_PACK as PACK
from partysieve.plans import documents, handoff, parties, regimes, regions

NONE = PACK.no_region


def again(fact, df):
    """The same rows with a short plan."""
    return fact([r.asDict() for r in df.collect()])


def random_documents(seed):
    rnd, rows = random.Random(seed), []
    for doc in range(250):
        number = rnd.choice([f"{doc:08d}", f"{doc:08d}", f"{doc:07d}", "0"])
        for _ in range(rnd.randint(1, 5)):
            rows.append({
                "record_id": len(rows), "doc_no_eval": rnd.choice([number] * 9 + [None]),
                "doc_type_eval": rnd.choice(["DNI", "CE", "PAS", "-1", "-1", None]),
                "region_eval": rnd.choice(["LIMA", "CUSCO", NONE, NONE, None]),
                "start_date": rnd.choice([day(0), day(1), day(1), day(2), None]),
                "rule_trace": rnd.choice(["-", None])})
    return rows


def by_document(rows):
    groups = defaultdict(list)
    for r in rows:
        if r["doc_no_eval"] not in (None, "0"):
            groups[r["doc_no_eval"]].append(r)
    return groups


def set_type(rows, value, code):
    for r in rows:
        r["doc_type_eval"], r["rule_trace"] = value, (r["rule_trace"] or "") + code


def model_documents(rows):
    for doc, group in by_document(rows).items():
        types = {r["doc_type_eval"] for r in group} - {None}
        if len(types) > 1 and "DNI" in types and len(doc) == 8:
            set_type(group, "DNI", "-R005")
    for group in by_document(rows).values():
        types = {r["doc_type_eval"] for r in group} - {None}
        if "-1" in types and len(types - {"-1"}) == 1:
            set_type(group, (types - {"-1"}).pop(), "-R006")
    for group in by_document(rows).values():
        types = {r["doc_type_eval"] for r in group} - {None}
        dates = [r["start_date"] for r in group
                 if r["doc_type_eval"] not in (None, "-1") and r["start_date"]]
        if len(types) > 1 and dates:
            latest = sorted({r["doc_type_eval"] for r in group if r["start_date"] == max(dates)
                             and r["doc_type_eval"]})
            for value in latest:
                set_type(group, value, "-R007")


def model_regions(rows):
    for group in by_document(rows).values():
        known = [r for r in group if r["region_eval"] not in (None, NONE) and r["start_date"]]
        if len({r["region_eval"] or "-1" for r in group}) > 1 and known:
            latest = max(r["start_date"] for r in known)
            region = min(r["region_eval"] for r in known if r["start_date"] == latest)
            for r in group:
                r["region_eval"] = region


def result(df, *columns):
    return {r["record_id"]: tuple(r[c] for c in columns)
            for r in df.select("record_id", *columns).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_documents_and_regions(fact, seed):
    rows = random_documents(seed)
    df = fact(rows)
    model_documents(rows)
    model_regions(rows)
    columns = ("doc_type_eval", "rule_trace", "region_eval")
    want = {r["record_id"]: tuple(r[c] for c in columns) for r in rows}
    assert result(documents.resolve_documents(df, PACK, regions=True), *columns) == want
    if seed > 1:
        return
    single = df
    for rule in documents.CONFLICT_RULES:
        single = again(fact, documents.resolve_documents(single, PACK, (rule,)))
    assert result(regions.latest_region(single, PACK), *columns) == want


LISTED = tuple(f"p{i}" for i in range(0, 200, 3))
POLICY_PACK = replace(PACK, newest_region_policies=LISTED)


def random_policies(seed, null_party):
    rnd, rows = random.Random(seed), []
    for policy in range(200):
        roles = rnd.choice([["BENEFICIARY"], ["BENEFICIARY"], ["HOLDER", "INSURED", "BENEFICIARY"]])
        for _ in range(rnd.randint(1, 5)):
            rows.append({
                "record_id": 1 + len(rows), "policy_no": f"p{policy}",
                "party_role": rnd.choice(roles),
                "source_system": rnd.choice(["CORE", "SHEET"]),
                "line_code": rnd.choice(["Brand#3", "Brand#3", "Brand#3", "Brand#1", None]),
                "doc_type_eval": rnd.choice(["DNI", "CE", None]),
                "doc_no_eval": str(rnd.randint(0, 60)),
                "region_eval": rnd.choice(["LIMA", "CUSCO", "PUNO", NONE, NONE, None]),
                "rule_trace": "-"})
    rows.append({"record_id": 1 + len(rows), "policy_no": None, "region_eval": "LIMA",
                 "party_role": "HOLDER" if null_party else "BENEFICIARY", "rule_trace": "-"})
    rnd.shuffle(rows)
    return rows


def model_policies(rows):
    by_policy = defaultdict(list)
    for r in rows:
        if r["policy_no"] is not None:
            by_policy[r["policy_no"]].append(r)
    null_party = any(r["policy_no"] is None and r["party_role"] in ("HOLDER", "INSURED")
                     for r in rows)

    def regions_of(group):
        return {r["region_eval"] for r in group} - {None}

    def known(group):
        return [r for r in group if r["region_eval"] not in (None, NONE)]

    def orphan(group):
        own = [r for r in group if r["line_code"] == "Brand#3"]
        return (not null_party and len(regions_of(own)) > 1
                and all(r["party_role"] == "BENEFICIARY" for r in group))

    def write(group, region, code):
        for r in group:
            r["region_eval"], r["rule_trace"] = region, r["rule_trace"] + code

    for group in by_policy.values():
        if orphan(group) and len(regions_of(known(group))) == 1:
            write(group, regions_of(known(group)).pop(), "-R050")
    for group in by_policy.values():
        if orphan(group) and known(group):
            write(group, max(known(group), key=lambda r: r["record_id"])["region_eval"], "-R050-1")
    for group in by_policy.values():
        sheet = [r for r in group if r["source_system"] == "SHEET"]
        if group[0]["policy_no"] in LISTED and len(regions_of(sheet)) > 1 and known(group):
            write(group, max(known(group), key=lambda r: r["record_id"])["region_eval"], "-R057-1")

    gaps = defaultdict(int)
    for r in rows:
        if r["region_eval"] == NONE and r["party_role"] != "HOLDER":
            gaps[r.get("doc_type_eval"), r.get("doc_no_eval")] += 1
    holder = {p: min(h) for p, g in by_policy.items()
              if (h := [r["region_eval"] for r in known(g) if r["party_role"] == "HOLDER"])}
    for r in rows:
        client = (r.get("doc_type_eval"), r.get("doc_no_eval"))
        if None not in client and gaps[client] == 1 and r["policy_no"] in holder:
            r["region_eval"], r["rule_trace"] = holder[r["policy_no"]], r["rule_trace"] + "-R058"


@pytest.mark.parametrize("seed,null_party", [(1, False), (2, False), (3, True)])
def test_policies(fact, seed, null_party):
    rows = random_policies(seed, null_party)
    df = fact(rows)
    model_policies(rows)
    want = {r["record_id"]: (r["region_eval"], r["rule_trace"]) for r in rows}
    fused = regions.region_from_holder(
        regions.resolve_policies(df, POLICY_PACK, keep_holder=True), POLICY_PACK)
    assert result(fused, "region_eval", "rule_trace") == want
    if seed > 1:
        return
    single = df
    for rule in regions.POLICY_RULES:
        single = again(fact, regions.resolve_policies(single, POLICY_PACK, (rule,)))
    single = regions.resolve_policies(single, POLICY_PACK, (), keep_holder=True)
    assert result(regions.region_from_holder(single, POLICY_PACK), "region_eval", "rule_trace") == want


@pytest.mark.parametrize("seed", [1, 2])
def test_missing_regimes(spark, fact, seed):
    rnd = random.Random(seed)
    product = {k: rnd.choice([1, 2, 3, None]) for k in range(40)}
    rows = [{
        "record_id": i, "product_key": rnd.randint(0, 45), "rule_trace": "-",
        "doc_type_eval": rnd.choice(["DNI", None]), "doc_no_eval": rnd.choice([None, *"-abcdefgh"]),
        "doc_type": rnd.choice([None, "DNI"]), "doc_no": rnd.choice([None, "1"]),
        "regime_eval": rnd.choice([None, None, 1]), "source_system": rnd.choice(["CORE", "OTHER"]),
    } for i in range(150)]
    df = fact(rows)
    dim = spark.createDataFrame(list(product.items()), "product_key bigint, regime_id int")

    loop = sorted({(r["product_key"], r["doc_no_eval"]) for r in rows if r["doc_no_eval"]
                   and r["doc_type_eval"] is None and r["regime_eval"] is None
                   and r["source_system"] == "CORE" and r["product_key"] in product})
    for key, doc in loop:
        for r in rows:
            if product[key] and (r["doc_no_eval"] or "-") == doc and r["regime_eval"] is None:
                r["regime_eval"], r["rule_trace"] = product[key], r["rule_trace"] + "-R020"
    loop = [r["product_key"] for r in rows if r["doc_type"] is None and r["doc_no"] is None
            and r["regime_eval"] is None and r["source_system"] == "CORE"
            and r["product_key"] in product]
    for key in loop:
        for r in rows:
            if product[key] and r["product_key"] == key and r["regime_eval"] is None:
                r["regime_eval"], r["rule_trace"] = product[key], r["rule_trace"] + "-R021"
    want = {r["record_id"]: (r["regime_eval"], r["rule_trace"]) for r in rows}
    assert result(regimes.fill_missing_regimes(df, dim, PACK), "regime_eval", "rule_trace") == want


def test_a_regime_beats_none(spark, fact):
    """Two rows of a product key, one without a regime: the other one decides. The same for staged ids."""
    dim = spark.createDataFrame([(1, None), (1, 2)], "product_key bigint, regime_id int")
    rows = [{"record_id": i, "product_key": 1, "rule_trace": "-", "doc_no_eval": "a", "source_system": "CORE"} for i in (1, 2)]
    got = result(regimes.fill_missing_regimes(fact(rows), dim, PACK), "regime_eval", "rule_trace")
    assert got == {1: (2, "--R020"), 2: (2, "--R020")}
    keys = "product_id bigint, policy_id bigint, operation_id bigint, event string, shipment_id bigint"
    staged = spark.createDataFrame([(1, 1, 1, "e", None), (1, 1, 1, "e", 7)], keys)
    held = spark.createDataFrame([(1, 1, 1, "e", 5)], keys)
    assert handoff.sync_handoffs(held, staged).first()["shipment_id"] == 7


def test_no_document_is_the_document_dash(spark, fact):
    dim = spark.createDataFrame([(1, 2)], "product_key bigint, regime_id int")
    rows = [{"record_id": 1, "product_key": 1, "rule_trace": "-", "doc_no_eval": "-", "doc_no": "-", "source_system": "CORE"},
            {"record_id": 2, "product_key": 9, "rule_trace": "-", "doc_type": "X", "source_system": "CORE"}]
    got = result(regimes.fill_missing_regimes(fact(rows), dim, PACK), "regime_eval", "rule_trace")
    assert got == {1: (2, "--R020"), 2: (2, "--R020")}
    rows[0]["doc_no_eval"] = None  # no example any more
    got = result(regimes.fill_missing_regimes(fact(rows), dim, PACK), "regime_eval")
    assert got[2] == (None,)


def test_watchlist_entry_with_the_highest_regime_wins(spark, fact):
    dim = spark.createDataFrame([(1, 2), (2, 3), (3, None)], "product_key bigint, regime_id int")
    listed = spark.createDataFrame(
        [("DNI", "a", "Bajo", 2000.0), ("DNI", "a", "Medio", 0.0), ("DNI", "b", "Alto", 0.0),
         ("DNI", "b", None, 0.0), ("DNI", "c", None, 0.0), ("DNI", "d", "Medio", 9000.0),
         ("DNI", "d", None, 0.0), (None, "e", "Alto", 0.0)],
        "doc_type string, doc_no string, rating string, exposure double")
    rows = [{"record_id": 10 * k + i, "product_key": k, "doc_type_eval": "DNI", "doc_no_eval": d,
             "regime_eval": 9} for k in (1, 2, 3, 4) for i, d in enumerate("abcdez")]
    rows.append({"record_id": 99, "product_key": 1, "doc_type_eval": None, "doc_no_eval": "a",
                 "regime_eval": 9})
    got = result(regimes.rate_by_watchlist(fact(rows), dim, listed, PACK),
                 "regime_eval", "on_watchlist")
    assert [got[10 + i] for i in range(6)] == [(2, 1), (3, 1), (2, 0), (2, 0), (2, 0), (2, 0)]
    assert [got[20 + i] for i in range(6)] == [(1, 1), (3, 1), (3, 0), (3, 0), (3, 0), (3, 0)]
    assert [got[30 + i] for i in range(6)] == [(1, 1), (3, 1), (None, 0), (1, 1), (None, 0),
                                               (None, 0)]
    assert all(got[40 + i] == (9, None) for i in range(6))
    assert got[99] == (9, None)


def test_parent_holders(spark, fact):
    rows, base = [], {"party_role": "HOLDER", "source_system": "CORE", "active": 1,
                      "rule_trace": "-", "parent_policy_no": 7, "doc_type_eval": "DNI",
                      "doc_no_eval": "a", "policy_no": "7-1", "source_file": "f"}
    for change in ({}, {"party_name": "second"}, {"doc_no_eval": None}, {"doc_no_eval": "b"},
                   {"source_system": "SHEET"}, {"source_system": None}, {"party_role": "INSURED"},
                   {"parent_policy_no": 0}, {"parent_policy_no": 8, "active": 0},
                   {"note": "x auto: HOLDER COPY y"}, {"rule_trace": "--R040"}):
        rows.append({**base, "record_id": len(rows), **change})
    out = parties.add_parent_holders(fact(rows), PACK).collect()
    added = [r for r in out if r["record_id"] == parties.LAST_ID]
    assert sorted((r["policy_no"], r["doc_no_eval"], r["party_name"], r["active"], r["rule_trace"],
                   r["source_file"]) for r in added) == [
        ("7", "a", None, 1, "-R040", None), ("7", "b", None, 1, "-R040", None)]
    kept = {r["record_id"]: (r["active"], r["rule_trace"]) for r in out if r not in added}
    off, on = (0, "--R0041"), (1, "-")
    assert kept == {0: off, 1: off, 2: off, 3: off, 4: on, 5: on, 6: on, 7: on, 8: (0, "-")}


def test_parent_policy_number(spark, fact):
    product = spark.createDataFrame([(1, 1), (2, 0)], "product_key bigint, is_group int")
    rows = [{"record_id": i, "policy_no": p, "product_key": k, "source_system": s,
             "parent_policy_no": 5} for i, (p, k, s) in enumerate([
                 ("0012-3", 1, "CORE"), ("0012", 1, "CORE"), ("ab-3", 1, "CORE"),
                 ("12-3", 2, "CORE"), ("12-3", 1, "SHEET"), ("12-3", 1, None), (None, 1, "CORE")])]
    got = result(parties.derive_parent_policy(fact(rows), product, PACK), "parent_policy_no")
    assert [got[i][0] for i in range(7)] == [12, None, None, 5, 5, 5, None]


def test_null_policy_is_never_holderless(spark, fact):
    rows = [{"record_id": i, "policy_no": p, "product_name": "cold widget", "party_role": "INSURED",
             "rule_trace": "-", "active": 1} for i, p in enumerate([None, "p"])]
    out = parties.add_missing_holders(fact(rows), PACK)
    assert sorted((r["record_id"], r["party_role"], r["rule_trace"]) for r in out.collect()) == [
        (0, "INSURED", "-"), (1, "HOLDER", "R001"), (1, "INSURED", "-")]


def test_overrides_and_empty_pack(spark, fact):
    df = fact([{"record_id": 1, "doc_no_eval": "10000004", "policy_no": "000077-77"}])
    out = regions.override_regions(documents.override_doc_types(df, PACK), PACK).first()
    assert (out["doc_type_eval"], out["region_eval"]) == ("DNI", "ABROAD")
    from partysieve.pack import RulePack
    with pytest.raises(TypeError):
        RulePack()
    pack = RulePack(doc_type_overrides={}, region_overrides={}, newest_region_policies=())
    same = regions.override_regions(documents.override_doc_types(df, pack), pack)
    assert same.where(F.col("doc_type_eval").isNotNull()).count() == 0
    assert documents.resolve_documents(same, pack).count() == 1
    assert regions.resolve_policies(same, pack).count() == 1
