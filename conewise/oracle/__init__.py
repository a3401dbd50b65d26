"""DuckDB oracle SQL for the registered queries.

Output typing is normalised the same way on both sides: exact decimals are
reported as DOUBLE and all integers as BIGINT (``conewise.registry.normalize``
does this for Spark; ``finalize`` wraps an oracle query accordingly).
"""

from __future__ import annotations

import functools
import os

TEST_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
_INTS = {"TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UTINYINT", "USMALLINT", "UINTEGER", "UBIGINT"}


@functools.lru_cache(maxsize=1)
def _describe_con():
    """A DuckDB connection over the smallest test tables, used only to read result types."""
    import duckdb
    con = duckdb.connect()
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        if os.path.exists(f"{sf}/orders.parquet"):
            for t in TEST_TABLES:
                if os.path.exists(f"{sf}/{t}.parquet"):
                    con.execute(f"create or replace view {t} as select * from read_parquet('{sf}/{t}.parquet')")
            return con
    return None


def finalize(sql: str) -> str:
    """Wrap ``sql`` so decimals come out as DOUBLE and integers as BIGINT."""
    con = _describe_con()
    if con is None:
        return sql
    try:
        cols = con.execute(f"describe {sql}").fetchall()
    except Exception:  # noqa: BLE001 - leave the query as written
        return sql
    out = []
    for name, typ, *_ in cols:
        q = '"' + name.replace('"', '""') + '"'
        if typ.startswith("DECIMAL") or typ in ("FLOAT",):
            out.append(f"cast({q} as double) as {q}")
        elif typ in _INTS:
            out.append(f"cast({q} as bigint) as {q}")
        else:
            out.append(q)
    return f"select {', '.join(out)} from (\n{sql}\n) _q"
