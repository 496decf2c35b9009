"""Run registered queries against their SQL twins: python tests/compare.py [prefix ...] [--sf 0.01]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, int):
        return v
    return str(v)


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(name, df, con, sql):
    """None when equal, else a short description."""
    cols, rows = canonical([tuple(r) for r in df.collect()], df.columns)
    rel = con.execute(sql)
    ocols, orows = canonical(rel.fetchall(), [d[0] for d in rel.description])
    if cols != ocols:
        return f"columns {cols} != {ocols}"
    if len(rows) != len(orows):
        extra = [r for r in rows if r not in set(orows)][:2]
        lost = [r for r in orows if r not in set(rows)][:2]
        return f"rows {len(rows)} != {len(orows)}; only spark {str(extra)[:400]}; only sql {str(lost)[:400]}"
    for a, b in zip(rows, orows):
        if a != b:
            return f"first difference: spark {str(a)[:300]} sql {str(b)[:300]}"
    return None if rows else "EMPTY"


def main(argv):
    import __spark_entry__ as entry
    from labelspark.session import get_spark

    sf = "0.01"
    if "--sf" in argv:
        i = argv.index("--sf")
        sf = argv[i + 1]
        argv = argv[:i] + argv[i + 2:]
    spark = get_spark("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sorted(queries):
        if argv and not any(name.startswith(p) for p in argv):
            continue
        t0 = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problem = compare(name, df, con, oracles[name])
                kind = "sql"
            else:
                n = df.count()
                problem, kind = (None if n else "EMPTY"), f"rows={n}"
        except Exception as e:  # noqa: BLE001
            problem, kind = f"{type(e).__name__}: {str(e)[:700]}", "error"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:42s} {time.time() - t0:6.2f}s {kind} {problem or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
