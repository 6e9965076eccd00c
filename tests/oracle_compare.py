"""Compare registered queries with their SQL in DuckDB, strictly.

``python tests/oracle_compare.py <data folder> [query ...]``
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

import __spark_entry__ as driver  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)) if isinstance(v, bool) else "", f"{v:.9g}" if isinstance(v, (int, float)) else str(v)) for v in row)


def difference(spark_df, con, sql: str) -> str | None:
    """``None`` when names, row count and every value agree."""
    names = sorted(spark_df.columns)
    rows = [tuple(r[n] for n in names) for r in spark_df.select(*[f"`{n}`" for n in names]).collect()]
    cur = con.execute(sql)
    found = [d[0] for d in cur.description]
    if sorted(found) != names:
        return f"columns: only spark {sorted(set(names) - set(found))}, only sql {sorted(set(found) - set(names))}"
    place = [found.index(n) for n in names]
    other = [tuple(r[i] for i in place) for r in cur.fetchall()]
    if len(rows) != len(other):
        return f"rows: spark {len(rows)}, sql {len(other)}"
    bad: dict[str, list] = {}
    for a, b in zip(sorted(rows, key=_key), sorted(other, key=_key)):
        for n, x, y in zip(names, a, b):
            same = x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
            if not same:
                bad.setdefault(n, []).append((x, y))
    return None if not bad else "; ".join(f"{n}: {len(v)} differ, e.g. {v[0]}" for n, v in bad.items())


def main() -> None:
    from creditloom.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = driver.queries(), driver.oracle_sql()
    failed = 0
    for name in wanted or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name not in oracle:
                print(f"{name:40s} rows only: {df.count()}", flush=True)
                continue
            diff = difference(df, con, oracle[name])
        except Exception as error:
            diff = f"{type(error).__name__}: {str(error)[:300]}"
        failed += diff is not None
        print(f"{name:40s} {'ok' if diff is None else 'DIFF ' + diff[:600]}  {time.time() - start:.1f}s", flush=True)
    print(f"{failed} differences; unknown oracle keys: {sorted(set(oracle) - set(queries))}")


if __name__ == "__main__":
    main()
