"""Run the whole job from a file: `spark-submit ... -m partysieve job.json`, or `python -m partysieve job.json`.

The file is JSON:

    {"sources": {"party_policy": "raw.party_policy" | "/path" | {"format": "jdbc", ...}, "product": ..., ...},
     "columns": {"party_policy": {"record_id": "their name", ...}}, "optional": {"party_policy": ["source_file"]},
     "pack": {"doc_type_overrides": {}, "region_overrides": {}, "newest_region_policies": [], ...},
     "audit": "/warehouse/audit", "target": "/warehouse/party_policy", "keep_versions": 5}

`columns`, `optional`, `audit` and `keep_versions` may be absent. Prints the version that was written.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Mapping
from typing import Any

from pyspark.sql import SparkSession

from partysieve.pack import RulePack
from partysieve.plans.run import run_and_publish
from partysieve.sources import sinks
from partysieve.sources.audit import AuditTrail
from partysieve.sources.session import configure
from partysieve.sources.stages import StageArea, file_system
from partysieve.sources.tables import load_tables

KEYS = {"sources", "columns", "optional", "pack", "audit", "target", "keep_versions"}


def rule_pack(values: Mapping[str, Any]) -> RulePack:
    """A pack from JSON values; lists become tuples, and a name that is no value of a pack is an error."""
    return RulePack(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})


def run_job(spark: SparkSession, job: Mapping[str, Any]) -> str:
    """Load, run, publish, and delete versions beyond `keep_versions`; the version written."""
    if unknown := set(job) - KEYS:
        raise ValueError(f"unknown in the job file: {', '.join(sorted(unknown))}")
    configure(spark)
    fact, dims = load_tables(spark, job["sources"], job.get("columns"), job.get("optional"))
    version = run_and_publish(fact, dims, rule_pack(job["pack"]), StageArea(spark), AuditTrail(spark, job.get("audit")), job["target"])
    if keep := job.get("keep_versions"):
        sinks.retain(spark, job["target"], keep)
    return version


def read_job(spark: SparkSession, path: str) -> dict[str, Any]:
    """The job file, from any file system that Spark reaches."""
    files, found = file_system(spark, path)
    if not files.exists(found):
        raise FileNotFoundError(path)
    return json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))


def main(arguments: list[str]) -> None:
    if len(arguments) != 1:
        raise SystemExit(__doc__)
    spark = SparkSession.builder.appName("partysieve").getOrCreate()
    print(run_job(spark, read_job(spark, arguments[0])))


if __name__ == "__main__":
    main(sys.argv[1:])
