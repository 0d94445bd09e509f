import os
import sys
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                os.path.dirname(os.path.abspath(__file__))]

from partysieve.schema import PARTY_POLICY
from partysieve.sources.session import configure


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    session = configure(builder.getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def fact(spark):
    """Build a party-policy frame from rows that name only the columns they need."""
    names = PARTY_POLICY.fieldNames()

    def value(row, name):
        found = row.get(name)
        return Decimal(found) if name == "parent_policy_no" and found is not None else found

    def build(rows):
        return spark.createDataFrame([tuple(value(r, n) for n in names) for r in rows],
                                     PARTY_POLICY).coalesce(4)

    return build


def day(n: int) -> datetime:
    return datetime(2020, 1, 1 + n)
