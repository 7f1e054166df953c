"""Compare registered queries with their SQL: python tests/check.py SF [key ...]."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 8) + 0.0
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(df, con, sql):
    """None when equal, else a short description of the difference."""
    cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    types = {d[0]: str(d[1]) for d in res.description}
    want_cols, want = rows_of(names, res.fetchall())
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"
    bad = [f"{n}:{t}" for n, t in types.items() if t.upper().startswith(("HUGEINT", "DECIMAL", "INTERVAL"))]
    if bad:
        return f"sql column types {bad}"
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        return f"rows {len(got)} vs {len(want)}; spark only {sorted(a, key=repr)[:3]}; sql only {sorted(b, key=repr)[:3]}"
    if not got:
        return "both sides are empty"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from arena.session import build_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = build_session(
        "check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracles = entry.oracle_sql()
    failed = 0
    for key, fn in entry.queries().items():
        if wanted and not any(key == w or (w.endswith("*") and key.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if key in oracles:
                problem = compare(df, con, oracles[key])
                note = "ok"
            else:
                n = len(df.collect())
                problem, note = (None, f"rows {n}") if n else ("no rows", "")
        except Exception:  # noqa: BLE001
            problem = "\n".join(traceback.format_exc().strip().splitlines()[-6:])[:900]
            note = ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {key} {time.time() - start:.1f}s {problem or note}", flush=True)
    print(f"failed {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
