"""Run registered queries against their DuckDB SQL: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as driver  # noqa: E402
from martloom.session import local_session  # noqa: E402

QUERIES, ORACLES = driver.queries(), driver.oracle_sql()

# Time of the Spark side alone.
SECONDS: dict[str, float] = {}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        files = path / "*.parquet" if path.is_dir() else path
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{files}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def kind(name: str) -> str:
    name = name.lower()
    if name.startswith(("timestamp", "datetime")):
        return "timestamp"
    return {
        "integer": "int", "int": "int", "bigint": "long", "long": "long", "varchar": "string", "string": "string",
        "double": "double", "float": "float", "boolean": "boolean", "date": "date",
    }.get(name, name)


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """What differs between the two engines, or None."""
    started = time.time()
    df = QUERIES[name](spark, sf_dir)
    collected = df.collect()
    SECONDS[name] = time.time() - started
    mine = rows_of(df.columns, [tuple(r) for r in collected])
    cur = con.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    theirs = rows_of(columns, cur.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    spark_types = {f.name: kind(f.dataType.simpleString()) for f in df.schema}
    duck_types = {d[0]: kind(str(d[1])) for d in cur.description}
    if spark_types != duck_types:
        return f"types { {c: (spark_types[c], duck_types[c]) for c in columns if spark_types[c] != duck_types[c]} }"
    if mine != theirs:
        return (
            f"{sum(mine.values())} / {sum(theirs.values())} rows, "
            f"only here {list((mine - theirs).items())[:2]}, only there {list((theirs - mine).items())[:2]}"
        )
    return None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(8), duck(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                wrong = difference(spark, con, name, sf_dir)
            else:
                wrong = None if QUERIES[name](spark, sf_dir).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            wrong = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += wrong is not None
        print(f"{'ok  ' if wrong is None else 'FAIL'} {name:34} {SECONDS.get(name, time.time() - start):6.2f}s {wrong or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} ok")
    sys.exit(failed > 0)


if __name__ == "__main__":
    main()
