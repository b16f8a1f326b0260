"""Run registered Spark queries and their DuckDB oracle side by side.

    python tests/oracle_check.py [sf_dir] [query ...]

Compares, per query: sorted column names, row count and the multiset of rows
(exactly, and with a 1e-9 relative tolerance for doubles).  Used by the test
suite on sf0.001 and by hand on sf0.01.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v, digits=None):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if digits is not None and math.isfinite(v):
            return float(f"{v:.{digits}g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return float(v)
    except Exception:
        pass
    return v


def spark_family(dtype) -> str:
    t = dtype.simpleString()
    if t in ("tinyint", "smallint", "int", "bigint"):
        return "int:" + t
    if t in ("float", "double"):
        return "float"
    return "decimal" if t.startswith("decimal") else t


def duck_family(name: str) -> str:
    t = str(name).upper()
    if t.startswith("DECIMAL"):
        return "decimal"
    return {"TINYINT": "int:tinyint", "SMALLINT": "int:smallint", "INTEGER": "int:int",
            "BIGINT": "int:bigint", "HUGEINT": "int:hugeint", "DOUBLE": "float",
            "FLOAT": "float", "VARCHAR": "string", "BOOLEAN": "boolean"}.get(t, t)


def rows_of(records, columns, digits=None):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i], digits) for i in order) for r in records)


def compare(spark, con, name, query_fn, sql, sf_dir):
    t0 = time.time()
    sdf = query_fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = list(sdf.columns)
    t1 = time.time()
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = [tuple(r) for r in rel.fetchall()]
    res["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS {sorted(s_cols)} != {sorted(d_cols)}"
        return res
    s_types = {f.name: spark_family(f.dataType) for f in sdf.schema.fields}
    d_types = {r[0]: duck_family(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if s_types != d_types:
        diff = {k: (s_types[k], d_types.get(k)) for k in s_types if s_types[k] != d_types.get(k)}
        res["status"] = f"TYPES {diff}"
        return res
    if len(s_rows) != len(d_rows):
        res["status"] = "ROWCOUNT"
        return res
    exact = rows_of(s_rows, s_cols) == rows_of(d_rows, d_cols)
    if exact:
        res["status"] = "ok"
        return res
    loose = rows_of(s_rows, s_cols, 9) == rows_of(d_rows, d_cols, 9)
    res["status"] = "ok~1e-9" if loose else "VALUES"
    if not loose:
        a, b = rows_of(s_rows, s_cols, 9), rows_of(d_rows, d_cols, 9)
        res["only_spark"] = list((a - b).elements())[:3]
        res["only_oracle"] = list((b - a).elements())[:3]
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as entry
    from skuflow.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck_connection(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            res = compare(spark, con, name, qs[name], oracle.get(name), sf_dir)
        except Exception as exc:  # report and continue
            res = {"query": name, "status": f"ERROR {type(exc).__name__}: {str(exc)[:300]}"}
        if not str(res["status"]).startswith(("ok", "no-oracle")):
            bad += 1
        print(res, flush=True)
    print(f"{bad} failing of {len(names or qs)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
