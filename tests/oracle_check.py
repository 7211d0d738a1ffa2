"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names, column types and the multiset of rows
(doubles compared after rounding to 6 digits, order-insensitive).
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pyarrow as pa

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

_SPARK2ARROW = {"bigint": "int64", "int": "int32", "double": "double", "string": "string",
                "boolean": "bool", "float": "float", "smallint": "int16", "tinyint": "int8",
                "timestamp_ntz": "timestamp[us]", "date": "date32[day]"}


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    return v


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    srows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return f"{name}: rows={len(srows)} (no oracle) {t1 - t0:.1f}s"
    tbl = con.sql(sql).arrow()
    if not isinstance(tbl, pa.Table):
        tbl = tbl.read_all()
    dtypes = {f.name: str(f.type) for f in tbl.schema}
    drows = [tuple(_norm(x) for x in r) for r in zip(*[c.to_pylist() for c in tbl.columns])] if tbl.num_columns else []
    problems = []
    if sorted(stypes) != sorted(dtypes):
        problems.append(f"columns spark={list(stypes)} duck={list(dtypes)}")
    else:
        for c in stypes:
            a = _SPARK2ARROW.get(stypes[c], stypes[c])
            if a != dtypes[c]:
                problems.append(f"type {c}: spark={stypes[c]} duck={dtypes[c]}")
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} duck={len(drows)}")
    elif not problems:
        order = sorted(stypes)
        si = [list(stypes).index(c) for c in order]
        di = [tbl.schema.names.index(c) for c in order]
        key = lambda r: tuple((x is None, str(x)) for x in r)
        a = sorted((tuple(r[i] for i in si) for r in srows), key=key)
        b = sorted((tuple(r[i] for i in di) for r in drows), key=key)
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        if bad:
            problems.append(f"{len(bad)} differing rows, e.g. spark={bad[0][0]} duck={bad[0][1]}")
    status = "OK " if not problems else "BAD"
    return f"{status} {name}: rows={len(srows)} {t1 - t0:.1f}s " + "; ".join(problems)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as entry
    from riskloom.session import local_session
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            line = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            line = f"ERR {name}: {type(e).__name__}: {str(e)[:400]}"
        bad += not line.startswith("OK") and "no oracle" not in line
        print(line, flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
