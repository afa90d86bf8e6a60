"""Compare registered queries with their DuckDB oracles.

``python -m tests.oracle [sf_dir] [name …]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
# Spark type name -> DuckDB type name
TYPES = {
    "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


TIMES: dict = {}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def mismatch(df, con, sql: str) -> str | None:
    """None when both sides agree on columns, types and the multiset of rows."""
    relation = con.sql(sql)
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    actual_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if actual_types != expected_types:
        diff = {k: (actual_types.get(k), expected_types.get(k)) for k in {*actual_types, *expected_types}
                if actual_types.get(k) != expected_types.get(k)}
        return f"columns (spark, oracle): {diff}"
    names = sorted(expected_types)
    began = time.time()
    expected = Counter(map(repr, relation.select(*[f'"{n}"' for n in names]).fetchall()))
    TIMES["oracle"] = time.time() - began
    actual = Counter(repr(tuple(r)) for r in df.select(*[f"`{n}`" for n in names]).collect())
    TIMES["spark"] = time.time() - began - TIMES["oracle"]
    TIMES["rows"] = sum(actual.values())
    if actual != expected:
        only_spark = list((actual - expected).elements())[:2]
        only_oracle = list((expected - actual).elements())[:2]
        return f"rows {sum(actual.values())} vs {sum(expected.values())}; {names}; spark {only_spark}; oracle {only_oracle}"
    return None


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from plumeline.session import build_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session(
        "oracle", "local[8]",
        spark__ui__enabled="false", spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if args[1:] and name not in args[1:]:
            continue
        began = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                problem = mismatch(df, con, oracles[name])
                rows = f"{TIMES.pop('rows', '?')} spark={TIMES['spark']:.2f}s oracle={TIMES['oracle']:.2f}s"
            else:
                rows, problem = df.count(), None
        except Exception as exc:
            rows, problem = -1, f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} rows={rows} {'' if name in oracles else '(no oracle) '}"
              f"{time.time() - began:.2f}s {problem or ''}", flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
