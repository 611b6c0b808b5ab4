"""Compare registered queries with their SQL over the given tables."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted(
        (tuple(_cell(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect()),
        key=repr,
    )


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = cursor.fetchall()
    return [names[i] for i in order], sorted(
        (tuple(_cell(r[i]) for i in order) for r in rows), key=repr
    )


def difference(df, con, sql: str) -> str | None:
    """None when both sides agree, else a short description."""
    names, ours = spark_rows(df)
    sql_names, theirs = sql_rows(con, sql)
    if names != sql_names:
        return f"columns {names} != {sql_names}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"{mine!r:.400} != {other!r:.400}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from clickloom.session import build_session

    spark = build_session(
        "compare", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false",
        spark_driver_memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf = sys.argv[1]
    con = connect(sf)
    queries, oracle = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or queries:
        begin = time.time()
        try:
            if name not in oracle:
                continue
            result = difference(queries[name](spark, sf), con, oracle[name])
        except Exception as error:
            result = f"ERROR {error!s:.800}"
        print(f"{name:32s} {time.time() - begin:6.2f}s {result or 'ok'}", flush=True)
