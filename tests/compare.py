"""Run registered queries on Spark and their SQL on DuckDB, and compare all values."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return repr(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, run, sql, sf_dir) -> str | None:
    """None when equal, else a description of the first difference."""
    df = run(spark, sf_dir)
    left_names, left = table_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    right_names, right = table_of([d[0] for d in cur.description], cur.fetchall())
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if len(left) != len(right):
        extra = sorted(set(left) - set(right))[:2], sorted(set(right) - set(left))[:2]
        return f"rows {len(left)} != {len(right)}; {extra}"
    if left != right:
        extra = sorted(set(left) - set(right)), sorted(set(right) - set(left))
        return f"{len(extra[0])} differ: spark {extra[0][:2]} sql {extra[1][:2]}"
    if not left:
        return "empty"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from vitalflow.session import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = argv or list(queries)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in oracle:
                problem = compare(spark, con, queries[name], oracle[name], sf_dir)
            else:
                n = queries[name](spark, sf_dir).count()
                problem = None if n else "empty"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        kind = "sql" if name in oracle else "rows"
        print(f"{'OK  ' if problem is None else 'FAIL'} {name} [{kind}] {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
