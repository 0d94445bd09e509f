"""Row-by-row comparison of a Spark result with its SQL counterpart in DuckDB."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def differences(df, con, sql: str) -> str | None:
    """None if both give the same columns and the same multiset of typed values."""
    got_columns = sorted(df.columns)
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    if got_columns != sorted(names):
        return f"columns {got_columns} != {sorted(names)}"
    at = [names.index(c) for c in got_columns]
    want = Counter(tuple(row[i] for i in at) for row in relation.fetchall())
    got = Counter(tuple(r) for r in df.select(*got_columns).collect())
    if got == want:
        return None
    extra, missing = list((got - want).items()), list((want - got).items())
    return (f"{sum(got.values())} rows, expected {sum(want.values())}; columns {got_columns}; "
            f"{len(extra)} only here {extra[:2]}; {len(missing)} only there {missing[:2]}")
