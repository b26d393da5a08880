"""Compare a registered Spark query with its DuckDB oracle the way the driver does:
row count, column names, and an order-insensitive hash of all values."""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "\\N"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(lines), h


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from lotwise.queries import ORACLES, QUERIES

    con = con or duck(sf_dir)
    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if name in ORACLES:
        cur = con.execute(ORACLES[name])
        d_cols = [c[0] for c in cur.description]
        d_rows = cur.fetchall()
        res["oracle_sec"] = round(time.time() - t1, 2)
        res["oracle_rows"] = len(d_rows)
        res["columns_match"] = sorted(s_cols) == sorted(d_cols)
        res["hash_match"] = digest(s_cols, s_rows) == digest(d_cols, d_rows)
        if not res["columns_match"]:
            res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
    return res


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from lotwise.session import local_session
    from lotwise.queries import QUERIES

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # noqa: BLE001
            r = {"query": n, "error": repr(e)[:400]}
        ok = r.get("hash_match", "error" not in r)
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print("failures:", bad)
