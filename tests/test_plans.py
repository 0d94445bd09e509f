"""Where the fact table is shuffled, read from physical plans."""

import pytest

from partysieve.catalog.fixtures import FIXTURE_PACK as PACK
from partysieve.catalog.fixtures import dimensions, extract
from partysieve.plans import documents, initial, regimes, regions
from partysieve.sources.stages import StageArea

SF = "/root/testdata/sf0.001"


def shuffles(df) -> list[str]:
    """Shuffles on the way from the fact's files to the result; what is broadcast does not count."""
    out, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(node.initialPlan())
        elif not name.startswith("BroadcastExchange"):
            if name.startswith("ShuffleExchange"):
                out.append(node.simpleString(1000))
            children = node.children()
            stack += [children.apply(i) for i in range(children.size())]
    return out


@pytest.fixture(scope="module")
def fact(spark):
    return initial.init_eval_columns(extract(spark, SF), PACK)


STEPS = {
    "documents": lambda df, dims, cut: documents.resolve_documents(documents.normalise_documents(df, PACK), PACK, regions=True, cut=cut),
    "policies": lambda df, dims, cut: regions.region_from_holder(regions.resolve_policies(df, PACK, keep_holder=True, cut=cut), PACK, cut=cut),
    "watch list": lambda df, dims, cut: regimes.rate_by_watchlist(df, dims.product, dims.watchlist, PACK),
    "highest regime": lambda df, dims, cut: regimes.highest_regime(df, cut=cut),
}


@pytest.mark.parametrize("name", STEPS)
def test_few_decisions_leave_the_fact_in_place(spark, fact, name):
    out = STEPS[name](fact, dimensions(spark, SF), StageArea(spark).cut)
    assert shuffles(out) == []


def test_many_decisions_move_it_once(spark, fact):
    """Without a count of the decisions, and beyond Spark's own limit, the join is by key and salt: one shuffle of the fact."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = shuffles(regimes.highest_regime(fact))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum("_salt" in x for x in found) == 2  # the fact and the decisions
