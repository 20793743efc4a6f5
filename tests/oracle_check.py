"""Run registered Spark queries and their DuckDB oracle SQL side by side.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
Compares row count, column names and the multiset of rows (values compared
exactly; floats must agree bit for bit).
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from cinelens.queries import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, repr(float(v)))
    if hasattr(v, "isoformat"):
        s = v.isoformat()
        return (1, s.replace("T", " "))
    if isinstance(v, (list, tuple)):
        return (1, repr([_norm(x) for x in v]))
    if isinstance(v, bool):
        return (1, str(int(v)))
    if isinstance(v, int):
        return (1, str(v))
    return (1, str(v))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of_spark(df):
    cols = df.columns
    data = [tuple(r) for r in df.collect()]
    return cols, data


def rows_of_duck(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted(tuple(_norm(r[i]) for i in order) for r in data)
    return [cols[i] for i in order], out


def compare(spark, con, name, sf_dir):
    sql = E.oracle_sql().get(name)
    t0 = time.time()
    sc, sd = rows_of_spark(E.queries()[name](spark, sf_dir))
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": len(sd), "spark_s": round(t1 - t0, 2)}
    dc, dd = rows_of_duck(con, sql)
    scn, sdn = canon(sc, sd)
    dcn, ddn = canon(dc, dd)
    res = {"name": name, "rows": len(sd), "oracle_rows": len(dd), "spark_s": round(t1 - t0, 2),
           "cols_ok": scn == dcn, "rows_ok": len(sd) == len(dd), "values_ok": sdn == ddn}
    res["ok"] = res["cols_ok"] and res["rows_ok"] and res["values_ok"]
    if not res["ok"]:
        res["spark_cols"], res["oracle_cols"] = scn, dcn
        diff_s = [r for r in sdn if r not in set(ddn)][:3]
        diff_d = [r for r in ddn if r not in set(sdn)][:3]
        res["only_spark"], res["only_oracle"] = diff_s, diff_d
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")] or list(E.queries())
    if os.environ.get("ORACLE_PLAIN_SESSION"):
        # a session with Spark's defaults (200 shuffle partitions, ANSI as set)
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.sql.ansi.enabled", os.environ.get("ORACLE_ANSI", "false"))
                 .config("spark.sql.session.timeZone", os.environ.get("ORACLE_TZ", "UTC"))
                 .getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from cinelens.session import local_session
        spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += r.get("ok") is False
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
