"""Run registered queries next to their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return f"{value:.9g}" if value != int(value) or abs(value) > 1e15 else str(int(value))
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return str(value)


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, make, sql):
    """An empty text when both sides agree, else what differs."""
    df = make(spark, folder)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    if sql is None:
        return "" if sum(got.values()) else "no rows"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = normal(cursor.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} but {sorted(names)}"
    if got == want:
        kinds = dict(df.dtypes)
        odd = [d for d in cursor.description if "HUGEINT" in str(d[1]) or "DECIMAL" in str(d[1])]
        return f"wide types {odd}" if odd else ("decimal out" if any("decimal" in k for k in kinds.values()) else "")
    return (
        f"{sum(got.values())} rows but {sum(want.values())}; "
        f"extra {list((got - want).items())[:3]} missing {list((want - got).items())[:3]}"
    )


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = Path(f"{folder}/{t}.parquet")
        files = f"{path}/*.parquet" if path.is_dir() else str(path)
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{files}')")
    return con


def main(folder, names):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from tablewright.plans.catalog import ORACLES, QUERIES
    from tablewright.session import build_session

    spark = build_session("compare", {"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"}, "local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, make in QUERIES.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            result = compare(spark, con, folder, name, make, ORACLES.get(name))
        except Exception as e:  # noqa: BLE001
            result = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(result)
        print(f"{'BAD' if result else 'ok '} {time.time() - start:6.2f}s {name} {result}", flush=True)
    print("failed", bad, "of", len(QUERIES), "with SQL", len(ORACLES))


if __name__ == "__main__":
    main(sys.argv[1], set(sys.argv[2:]))
