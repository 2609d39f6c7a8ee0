"""Compare contract queries with their DuckDB oracles: names, row counts, types and values."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE",
}


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(v)) for v in row)


def difference(df, con, sql):
    """None if the results agree, else a description."""
    columns = sorted(df.columns)
    types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    described = {r[0]: str(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(described) != columns:
        return f"columns {columns} / {sorted(described)}"
    if types != described:
        return f"types { {c: (types[c], described[c]) for c in columns if types[c] != described[c]} }"
    picked = ", ".join(f'"{c}"' for c in columns)
    want = sorted(con.execute(f"SELECT {picked} FROM ({sql})").fetchall(), key=_key)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=_key)
    if len(want) != len(got):
        return f"rows {len(got)} / {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} values differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    import __spark_entry__ as contract
    from shelfwatch.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    session = local_session("oracle", cores=8)
    session.sparkContext.setLogLevel("ERROR")
    con, oracles = connect(folder), contract.oracle_sql()
    bad = 0
    for name, query in contract.queries().items():
        if name not in oracles or (chosen and name not in chosen):
            continue
        start = time.time()
        try:
            found = difference(query(session, folder), con, oracles[name])
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        n = con.execute(f"SELECT count(*) FROM ({oracles[name]})").fetchall()[0][0] if not found else ""
        bad += bool(found)
        print(f"{'ok  ' if not found else 'FAIL'} {name:26s} {time.time() - start:6.1f}s {n} {found or ''}", flush=True)
    print(f"{bad} failed")
    sys.exit(bool(bad))
