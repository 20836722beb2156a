"""Run queries beside their SQL: python tests/oracle.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, db, name: str, sf_dir: str, queries, sqls) -> str | None:
    """What differs between a query and its SQL, None when nothing does."""
    df = queries[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if name not in sqls:
        return None if got else "no rows"
    result = db.execute(sqls[name])
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        missing = [r for r in want if r not in set(got)][:2]
        return f"{len(got)} rows != {len(want)}; only here {extra}; only in SQL {missing}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry_points
    from shelfstream.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session(
        "oracle", "local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                "spark.sql.shuffle.partitions": "8"}
    )
    session.sparkContext.setLogLevel("ERROR")
    known, sql = entry_points.queries(), entry_points.oracle_sql()
    bad = 0
    for query in sys.argv[2:] or known:
        started = time.time()
        try:
            problem = compare(session, connect(sf), query, sf, known, sql)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "sql " if query in sql else "rows"
        print(f"{query:24s} {kind} {time.time() - started:6.1f}s {problem or 'ok'}", flush=True)
    sys.exit(1 if bad else 0)
