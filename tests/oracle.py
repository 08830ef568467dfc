"""Compare registered queries with their SQL on the same tables.

    python tests/oracle.py <data folder> [name prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _rows(table) -> tuple[list[str], list[str], list[tuple]]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    types = [str(table.column(n).type).replace("large_", "").split("[")[0] for n in names]
    rows = [tuple(_plain(v) for v in row) for row in zip(*columns)] if names else []
    return names, types, sorted(rows, key=repr)


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def differences(spark, con, query, sql: str, folder: str) -> list[str]:
    """Empty when names, types, row count and values agree."""
    got = _rows(query(spark, folder).toArrow())
    want = _rows(con.execute(sql).to_arrow_table())
    out = []
    if got[0] != want[0]:
        return [f"columns {got[0]} vs {want[0]}"]
    if got[1] != want[1]:
        out.append(f"types {dict(zip(got[0], zip(got[1], want[1])))}")
    if len(got[2]) != len(want[2]):
        out.append(f"rows {len(got[2])} vs {len(want[2])}")
    left, right = set(map(repr, got[2])), set(map(repr, want[2]))
    if left != right:
        out.append(f"only here {sorted(left - right)[:3]}, only there {sorted(right - left)[:3]}, {len(left - right)} differ")
    return out


def main() -> int:
    from conftest import make_session
    import __spark_entry__ as entry

    folder, prefixes = sys.argv[1], tuple(sys.argv[2:])
    spark, con = make_session(), connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            if name in oracles:
                found = differences(spark, con, query, oracles[name], folder)
                state = "; ".join(found) if found else "ok"
            else:
                found, state = [], f"rows {query(spark, folder).toArrow().num_rows}"
        except Exception as error:
            found = [str(error)]
            state = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += bool(found)
        print(f"{name:32} {time.time() - start:6.1f}s  {state[:900]}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
