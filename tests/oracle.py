"""Compares a registered query with its SQL on DuckDB. Also a script: python tests/oracle.py [keys..]"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(root: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, (dt.date, dt.datetime)):
        return ("time", str(v))
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, _plain(x)) for k, x in v.items())
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    return [names[i].lower() for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    got_names, got = rows_of(df.columns, df.collect())
    res = con.execute(sql)
    want_names, want = rows_of([d[0] for d in res.description], res.fetchall())
    if got_names != want_names:
        return f"columns {got_names} vs {want_names}"
    if got == want:
        return None if got else "both sides are empty"
    more, less = got - want, want - got
    return (f"rows {sum(got.values())} vs {sum(want.values())}; differing {sum(more.values())}/{sum(less.values())}\n"
            f"   {got_names}\n   spark {sorted(more, key=str)[:3]}\n   sql   {sorted(less, key=str)[:3]}")


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession
    root = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    if "HOT_KEY_ROWS" in os.environ:   # force the path for hot keys
        spark.conf.set("spark.ledgerloom.hotKeyRows", os.environ["HOT_KEY_ROWS"])
    import __spark_entry__ as entry
    plans, sqls, con = entry.queries(), entry.oracle_sql(), connect(root)
    picked = [k for k in plans if not argv or any(k.startswith(a) for a in argv)]
    bad = 0
    for key in picked:
        start = time.time()
        try:
            df = plans[key](spark, root)
            note = difference(df, con, sqls[key]) if key in sqls else f"no sql, {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            note = f"{type(e).__name__}: {str(e)[:1500]}"
        ok = note is None or note.startswith("no sql")
        bad += not ok
        if not ok or argv or note:
            print(f"{'ok ' if ok else 'BAD'} {key} {time.time() - start:.1f}s {note or ''}", flush=True)
    print(f"{len(picked) - bad}/{len(picked)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
