"""Spark query vs DuckDB oracle comparison (row count, columns, values).

Usage: python -m tests.harness [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(norm(r[i]) for i in order) for r in rows], [columns[i] for i in order]


# Spark simple type → DuckDB type name, for the column-type check
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "double": "DOUBLE", "date": "DATE", "timestamp": "TIMESTAMP",
                 "smallint": "SMALLINT", "tinyint": "TINYINT"}


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    s_norm, s_cols = rows_of(sdf.columns, srows)
    d_norm, d_cols = rows_of(dcols, drows)
    d_types = {d[0]: str(d[1]) for d in res.description}
    type_diff = {f.name: (f.dataType.simpleString(), d_types.get(f.name))
                 for f in sdf.schema.fields
                 if SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                 != d_types.get(f.name)}
    ok_cols = s_cols == d_cols
    ok_n = len(s_norm) == len(d_norm)
    ok_v = Counter(s_norm) == Counter(d_norm)
    info = {"name": name, "rows": len(s_norm), "oracle_rows": len(d_norm), "cols": ok_cols,
            "types": not type_diff, "values": ok_v, "spark_s": round(t1 - t0, 2),
            "duck_s": round(t2 - t1, 2)}
    if type_diff:
        info["type_diff"] = type_diff
    if not ok_cols:
        info["spark_cols"], info["oracle_cols"] = s_cols, d_cols
    if ok_cols and not ok_v:
        a, b = Counter(s_norm), Counter(d_norm)
        info["spark_only"] = list((a - b).elements())[:3]
        info["oracle_only"] = list((b - a).elements())[:3]
    info["ok"] = ok_cols and ok_n and ok_v and not type_diff
    return info


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from reelscope.session import get_session
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")]
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in orc:
            t0 = time.time()
            n = qs[name](spark, sf_dir).count()
            print({"name": name, "rows": n, "oracle": None, "spark_s": round(time.time() - t0, 2)})
            continue
        try:
            info = compare(spark, con, name, qs[name], orc[name], sf_dir)
        except Exception as e:  # report and go on
            info = {"name": name, "ok": False, "error": repr(e)[:600]}
        bad += not info["ok"]
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
