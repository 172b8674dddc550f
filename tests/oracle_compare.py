"""Run queries() against oracle_sql() the way the driver does.

Row count, column names (sorted) and an order-insensitive hash of the
values.  Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if hasattr(v, "asDict"):
        return repr(sorted(v.asDict(recursive=True).items()))
    if isinstance(v, dict):
        return repr(sorted(v.items()))
    if isinstance(v, (list, tuple)):
        return repr([_norm(x) for x in v])
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return repr(round(float(v), 9))
    except Exception:
        pass
    return str(v)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
                 "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT", "smallint": "SMALLINT"}


def type_mismatches(df, con, sql):
    """Columns whose Spark type does not map to the DuckDB result type."""
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    duck_types = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    return {c: (spark_types.get(c), duck_types.get(c)) for c in set(spark_types) | set(duck_types)
            if spark_types.get(c) != duck_types.get(c)}


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as exc:  # pragma: no cover - reporting
            results[name] = ("spark-error", repr(exc)[:400])
            if verbose:
                print(f"{name:28s} SPARK ERROR {repr(exc)[:400]}")
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = ("rows-only", len(rows))
            if verbose:
                print(f"{name:28s} rows-only {len(rows)} ({ts:.1f}s)")
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as exc:
            results[name] = ("sql-error", repr(exc)[:400])
            if verbose:
                print(f"{name:28s} SQL ERROR {repr(exc)[:400]}")
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(dcols, drows)
        ok = sorted(cols) == sorted(dcols) and len(rows) == len(drows) and h1 == h2
        results[name] = ("ok" if ok else "MISMATCH", len(rows), len(drows))
        if verbose:
            print(f"{name:28s} {'ok' if ok else 'MISMATCH'} spark={len(rows)} duck={len(drows)} ({ts:.1f}s)")
            if not ok:
                if sorted(cols) != sorted(dcols):
                    print("   cols", sorted(cols), sorted(dcols))
                s1, s2 = set(l1), set(l2)
                print("   spark-only", list(s1 - s2)[:3])
                print("   duck-only ", list(s2 - s1)[:3])
    return results


if __name__ == "__main__":
    from ledgerlake.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", 8)
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] not in ("ok", "rows-only")]
    print("BAD:", bad)
