"""Compare every registered query with its SQL: `python -m contract.check [sf_dir] [name ...]`."""

import sys
import time

import duckdb

from contract.oracles import ORACLES
from contract.queries import QUERIES

TABLES = ("documents", "embeddings", "pages", "labels", "conversations", "benchmark")


def duck_session(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def rows_of(columns, rows) -> list[str]:
    """Rows as text, columns by name, in an order of their own."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    frame = QUERIES[name](spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if name not in ORACLES:
        return len(got) > 0, f"rows only: {len(got)}"
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if got == want:
        return True, f"{len(got)} rows"
    differing = [(a, b) for a, b in zip(got, want) if a != b][:1]
    return False, f"{len(got)} / {len(want)} rows, first difference {str(differing)[:1500]}"


def main() -> None:
    from veilpost.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_session(sf_dir)
    bad = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as failure:
            ok, note = False, f"{type(failure).__name__}: {str(failure)[:900]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{bad} failed; unchecked SQL: {sorted(set(ORACLES) - set(QUERIES))}")


if __name__ == "__main__":
    main()
