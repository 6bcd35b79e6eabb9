"""Compare registered Spark queries with their DuckDB oracle SQL.

Column names, type families, row counts and the order-insensitive multiset of exact
values must all agree. Usable from pytest and as a script:

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import collections
import contextlib
import datetime as dt
import io
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Spark simpleString -> DuckDB type name.
TYPE_FAMILY = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonMapInArrow")


def python_nodes(df) -> list[str]:
    """Python operators in the physical plan of ``df`` (none expected)."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return [node for node in PYTHON_NODES if node in out.getvalue()]


def _norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def compare(spark, sf_dir: str, name: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    srows = sdf.collect()
    spark_sec = time.time() - t0
    sql = oracle_sql()[name]
    rel = con.execute(sql)
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    otypes = [r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()]
    scols = sdf.columns
    stypes = [TYPE_FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields]
    out = {"query": name, "spark_sec": round(spark_sec, 2), "rows": len(srows), "oracle_rows": len(orows)}
    out["columns_ok"] = sorted(scols) == sorted(ocols)
    out["types_ok"] = sorted(zip(scols, stypes)) == sorted(zip(ocols, otypes))
    if not out["types_ok"]:
        out["types"] = {"spark": dict(zip(scols, stypes)), "oracle": dict(zip(ocols, otypes))}
    order = sorted(range(len(scols)), key=lambda i: scols[i])
    oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
    sbag = collections.Counter(tuple(_norm(r[i]) for i in order) for r in srows)
    obag = collections.Counter(tuple(_norm(r[i]) for i in oorder) for r in orows)
    out["values_ok"] = sbag == obag
    if not out["values_ok"]:
        out["only_spark"] = list((sbag - obag).elements())[:3]
        out["only_oracle"] = list((obag - sbag).elements())[:3]
    out["python_nodes"] = python_nodes(sdf)
    out["ok"] = out["columns_ok"] and out["types_ok"] and out["values_ok"] and len(srows) == len(orows)
    return out


def main(argv: list[str]) -> int:
    from salesflow.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    from __spark_entry__ import oracle_sql

    names = argv[1:] or list(oracle_sql())
    spark = build_session("local[8]")
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, con)
        except Exception as e:  # report and go on with the next query
            r = {"query": n, "ok": False, "error": repr(e)[:500]}
        bad += not r["ok"]
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
