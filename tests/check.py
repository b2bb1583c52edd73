"""Compare registered queries with their SQL in DuckDB: columns, types, rows and values.

    python tests/check.py [folder] [query ...]
"""

from __future__ import annotations

import decimal
import glob
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from agorascope.session import build_session

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return repr(v)


def compare(spark, con, name: str, folder: str, queries, oracles) -> str:
    """Empty when equal, else what differs."""
    df = queries[name](spark, folder)
    rows = df.collect()
    if name not in oracles:
        return "" if rows else "no rows"
    result = con.execute(oracles[name])
    theirs = {d[0]: str(d[1]) for d in result.description}
    ours = dict(df.dtypes)
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} vs {sorted(theirs)}"
    kinds = {c: (ours[c], theirs[c]) for c in ours if KINDS.get(ours[c]) != theirs[c]}
    names = list(theirs)
    left = Counter(tuple(_cell(r[c]) for c in names) for r in rows)
    right = Counter(tuple(_cell(v) for v in r) for r in result.fetchall())
    problems = []
    if kinds:
        problems.append(f"types {kinds}")
    if left != right:
        problems.append(
            f"rows {sum(left.values())} vs {sum(right.values())}; only ours {list((left - right))[:2]}; "
            f"only theirs {list((right - left))[:2]}; {names}"
        )
    return "; ".join(problems)


def main() -> int:
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("check", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    chosen = sys.argv[2:] or list(queries)
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            problem = compare(spark, con, name, folder, queries, oracles)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += bool(problem)
        mark = "FAIL" if problem else ("ok" if name in oracles else "rows")
        print(f"{mark:5}{name:34}{time.time() - start:7.2f}s {problem}", flush=True)
    print(f"{len(chosen)} queries, {bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
