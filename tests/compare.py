"""Run registered queries next to their SQL in DuckDB and compare the rows.

    python tests/compare.py [sf] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
DATA = Path("/root/testdata")


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) if not isinstance(v, float)
                 else (False, "f", v) for v in row)


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def differences(got_cols, got_rows, want_cols, want_rows) -> list[str]:
    """Empty when both tables hold the same columns and, in any order, the same rows."""
    if sorted(got_cols) != sorted(want_cols):
        return [f"columns {sorted(set(got_cols) ^ set(want_cols))}"]
    if len(got_rows) != len(want_rows):
        return [f"rows {len(got_rows)} != {len(want_rows)}"]
    order = sorted(got_cols)
    gi, wi = [got_cols.index(c) for c in order], [want_cols.index(c) for c in order]
    # sort by text and whole numbers first, so that one odd double does not shift all rows
    plain = [k for k, c in enumerate(order) if not any(isinstance(r[gi[k]], float) for r in got_rows)]
    rest = [k for k in range(len(order)) if k not in plain]
    g = sorted(([normal(r[i]) for i in gi] for r in got_rows), key=lambda r: _key([r[k] for k in plain + rest]))
    w = sorted(([normal(r[i]) for i in wi] for r in want_rows), key=lambda r: _key([r[k] for k in plain + rest]))
    out = []
    for a, b in zip(g, w, strict=True):
        for c, x, y in zip(order, a, b, strict=True):
            if x != y:
                out.append(f"{c}: {x!r} != {y!r} in {dict(zip(order[:6], a))}")
    return out


def check(spark, con, name: str, sf_dir: str) -> list[str]:
    from tidemark.oracle import ORACLE
    from tidemark.queries import QUERIES

    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    want = con.execute(ORACLE[name])
    return differences(df.columns, rows, [c[0] for c in want.description], want.fetchall())


def main() -> None:
    from tidemark.oracle import ORACLE
    from tidemark.queries import QUERIES
    from tidemark.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(QUERIES)
    sf_dir = str(DATA / f"sf{sf}")
    spark, con = local_session(8), connection(sf_dir)
    bad = []
    for name in names:
        start = time.time()
        try:
            if name in ORACLE:
                found = check(spark, con, name, sf_dir)
                status = "ok" if not found else f"DIFFERS ({len(found)}) " + " | ".join(found[:3])
            else:
                status = f"rows {QUERIES[name](spark, sf_dir).count()} (no SQL)"
        except Exception as error:  # noqa: BLE001 - the report goes on with the next query
            status = "ERROR " + str(error)[:600]
        if not status.startswith(("ok", "rows")):
            bad.append(name)
        print(f"{name:26s} {time.time() - start:6.2f}s {status}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
