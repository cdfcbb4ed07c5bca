"""Compare registered queries with their SQL:  python -m tests.oracle [folder] [names...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, db, folder: str, name: str) -> tuple[bool, str]:
    df = contract.queries()[name](spark, folder)
    got_rows = df.collect()
    found = db.execute(contract.oracle_sql()[name])
    names = [d[0] for d in found.description]
    want_rows = found.fetchall()
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    got, want = bag(df.columns, got_rows), bag(names, want_rows)
    if got != want:
        only_got, only_want = list((got - want).items())[:3], list((want - got).items())[:3]
        return False, f"{sorted(names)}\n   rows {len(got_rows)} vs {len(want_rows)}\n   spark {only_got}\n   sql   {only_want}"
    kinds = {d[0]: str(d[1]).lower() for d in found.description}
    same = {"bigint": ("bigint",), "int": ("integer",), "double": ("double",), "string": ("varchar", '"null"', "null")}
    odd = [f"{c}: {t} vs {kinds[c]}" for c, t in df.dtypes if kinds[c] not in same.get(t, (t,))]
    return True, f"{len(got_rows)} rows{' TYPES ' + str(odd) if odd else ''}"


if __name__ == "__main__":
    from tests.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, db = local_session(), connect(folder)
    chosen = sys.argv[2:] or list(contract.queries())
    bad = 0
    for name in chosen:
        if name not in contract.oracle_sql():
            print(f"--   {name}: no SQL, {len(contract.queries()[name](spark, folder).collect())} rows")
            continue
        start = time.time()
        try:
            ok, note = compare(spark, db, folder, name)
        except Exception as failed:  # noqa: BLE001
            ok, note = False, f"{type(failed).__name__}: {str(failed)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'BAD '} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} fine")
