"""Compares queries with their DuckDB SQL: python tests/parity.py [sf_dir] [name...]"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
from pathlib import Path

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f"{float(v):.6g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(" ", "microseconds")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return str(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def differences(df, sql: str, con) -> list[str]:
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return [f"columns {sorted(df.columns)} against {sorted(rel.columns)}"]
    mine, other = rows_of(df.columns, df.collect()), rows_of(rel.columns, rel.fetchall())
    if mine == other:
        return []
    a, b = [x for x in mine if x not in set(other)][:3], [x for x in other if x not in set(mine)][:3]
    return [f"{len(mine)} rows against {len(other)}; only here {a}; only there {b}"]


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    os.environ["PYTHONPATH"] = sys.path[0]
    import __spark_entry__ as e
    from tallymark.session import session

    sf_dir = next((a for a in sys.argv[1:] if "/" in a), "/root/testdata/sf0.01")
    spark = session("parity", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("OFF")
    con, sqls, queries = duck(sf_dir), e.oracle_sql(), e.queries()
    bad = 0
    for name in [a for a in sys.argv[1:] if "/" not in a] or sqls:
        try:
            found = differences(queries[name](spark, sf_dir), sqls[name], con)
        except Exception as err:  # noqa: BLE001
            found = [f"{type(err).__name__} {str(err)[:600]}"]
        bad += bool(found)
        if found:
            print(name, *found, flush=True)
    print(f"{bad} of {len(sqls)} differ")
