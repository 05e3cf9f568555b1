"""Runs queries beside their SQL: ``python scripts/compare.py [sf_dir] [names...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemart import build_session  # noqa: E402
from workload.oracles import ORACLES  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

# Tables are registered as views under their file names.
TABLES = "region nation customer supplier part orders lineitem events".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, sf_dir: str, name: str) -> str:
    """Empty if the query equals its SQL value for value, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*(f"`{c}`" for c in columns)).collect()), key=repr)
    relation = con.sql(ORACLES[name])
    if sorted(relation.columns) != columns:
        return f"columns {columns} != {sorted(relation.columns)}"
    expected = sorted(
        relation.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall(), key=repr
    )
    if got == expected:
        return "" if got else "no rows"
    ours, theirs = list(set(got) - set(expected))[:3], list(set(expected) - set(got))[:3]
    return f"rows {len(got)} vs {len(expected)}\n  {columns}\n  ours   {ours}\n  theirs {theirs}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            difference = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            difference = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(difference)
        verdict = "FAIL" if difference else "ok"
        print(f"{verdict:5}{name:32}{time.time() - start:6.1f}s {difference}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
