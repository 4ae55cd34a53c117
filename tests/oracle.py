"""Run a registered query and its SQL side by side and describe the first difference.

    python -m tests.oracle /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    """Values that both engines give in one form; types stay apart (1 is not '1', nor 1.0 Decimal)."""
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else ("f", v)
    if isinstance(v, Decimal):
        return ("d", str(v))
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when both give the same bag of rows, else what differs."""
    got_names, got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    want_names, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if any(kind == "void" for _, kind in df.dtypes):
        return f"void column in {df.dtypes}"
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} rows vs {sum(want.values())}; only Spark {sum(extra.values())}: "
            f"{list(extra)[:2]}; only SQL {sum(missing.values())}: {list(missing)[:2]}"
        )
    return None


def main(folder: str, names: list[str]) -> int:
    from starloom.queries import REGISTRY
    from starloom.session import build_session

    spark = build_session("oracle", "local[8]", 8, spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names or REGISTRY:
        q = REGISTRY[name]
        start = time.time()
        try:
            df = q.run(spark, folder)
            if q.sql is None:
                note = f"{df.count()} rows, no SQL"
                problem = None
            else:
                problem = compare(df, con, q.sql)
                note = f"ok, {con.execute(f'SELECT count(*) FROM ({q.sql})').fetchone()[0]} rows"
        except Exception as e:  # noqa: BLE001 - report and go on
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'pass'} {name} {time.time() - start:.1f}s {problem or note}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
