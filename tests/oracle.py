"""Run queries beside their SQL on DuckDB and compare names, types and values exactly.

    python tests/oracle.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normalized(table) -> tuple[list[str], list[str], list[tuple]]:
    """Sorted column names, their types, and rows in a fixed order."""
    names = sorted(table.column_names)
    types = [str(table.schema.field(n).type) for n in names]
    columns = [table.column(n).to_pylist() for n in names]
    rows = sorted(zip(*columns), key=repr) if columns else []
    return names, types, rows


def difference(got, want) -> str | None:
    g, w = normalized(got), normalized(want)
    if g[0] != w[0]:
        return f"columns {g[0]} != {w[0]}"
    loose = {"large_string": "string", "large_utf8": "string"}
    gt, wt = ([loose.get(t, t) for t in x[1]] for x in (g, w))
    if gt != wt:
        return f"types {list(zip(g[0], gt, wt))}"
    if len(g[2]) != len(w[2]):
        return f"rows {len(g[2])} != {len(w[2])}"
    bad = [(a, b) for a, b in zip(g[2], w[2]) if repr(a) != repr(b)]
    return f"{len(bad)} rows differ, first {bad[0][0]} != {bad[0][1]}" if bad else None


def check(spark, con, name: str, query, oracle: str | None, sf_dir: str) -> tuple[str | None, float, int]:
    start = time.time()
    got = query(spark, sf_dir).toArrow()
    took = time.time() - start
    if oracle is None:
        return None, took, got.num_rows
    want = con.execute(oracle)
    want = want.to_arrow_table() if hasattr(want, "to_arrow_table") else want.fetch_arrow_table()
    return difference(got, want), took, got.num_rows


def main() -> None:
    import __spark_entry__ as entry
    from tabloom.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--skip", default="")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    queries, oracles = entry.queries(), entry.oracle_sql()
    spark, con = local_session("oracle"), connect(sf_dir)
    failed = 0
    for name in args.names or [q for q in queries if q not in args.skip.split(",")]:
        try:
            problem, took, rows = check(spark, con, name, queries[name], oracles.get(name), sf_dir)
        except Exception as e:  # report and go on with the next query
            problem, took, rows = f"{type(e).__name__}: {str(e)[:600]}", 0.0, -1
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {kind:4} {took:7.2f}s {rows:8d} {name} {problem or ''}", flush=True)
        failed += bool(problem)
    print(f"{failed} failed")
    spark.stop()


if __name__ == "__main__":
    main()
