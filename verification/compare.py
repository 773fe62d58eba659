"""Run every query beside its SQL twin: ``python -m verification.compare <sf_dir> [name ...]``."""

from __future__ import annotations

import hashlib
import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

from millrace.session import local_session
from verification.oracle import ORACLE
from verification.queries import QUERIES


def _value(v: object) -> str:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, (float, Decimal)):
        return repr(float(v))
    # Whole numbers and booleans by their value, whatever their width.
    return repr(float(v)) if isinstance(v, int) and abs(v) < 2**53 else str(v)


def _digest(names: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    hashes = Counter(
        hashlib.md5("|".join(_value(row[i]) for i in order).encode()).hexdigest() for row in rows
    )
    return [names[i] for i in order], hashes


def main(sf_dir: str, chosen: list[str]) -> int:
    spark = local_session(8)
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    failed = 0
    for name in chosen or QUERIES:
        begin = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            got = _digest(df.columns, [tuple(r) for r in df.collect()])
            took = time.time() - begin
            cursor = con.execute(ORACLE[name])
            want = _digest([d[0] for d in cursor.description], cursor.fetchall())
            same = got == want
        except Exception as e:  # noqa: BLE001
            print(f"ERROR {name}: {type(e).__name__} {str(e)[:600]}", flush=True)
            failed += 1
            continue
        failed += not same
        rows = sum(got[1].values()), sum(want[1].values())
        print(f"{'ok   ' if same else 'WRONG'} {name} rows {rows[0]} / {rows[1]} {took:.2f}s", flush=True)
        if not same:
            extra, lacking = got[1] - want[1], want[1] - got[1]
            print("   columns", got[0], want[0] if got[0] != want[0] else "same")
            print("   extra", sum(extra.values()), "lacking", sum(lacking.values()))
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
