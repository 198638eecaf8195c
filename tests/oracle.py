"""Run queries next to their SQL: ``python tests/oracle.py SF_DIR [name …]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET max_temp_directory_size = '4GB'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def rows_of(arrow) -> tuple[list[str], Counter]:
    """Column names in order and the bag of rows; values keep their Python type."""
    names = sorted(arrow.column_names)
    columns = [arrow.column(n).to_pylist() for n in names]
    return names, Counter(zip(*[[repr(v) for v in c] for c in columns])) if columns else Counter()


def differences(spark_df, con, sql: str) -> str | None:
    ours = spark_df.toArrow()
    theirs = con.sql(sql).to_arrow_table()
    if theirs.num_rows == 0:
        return "the SQL gives no rows, so nothing is compared"
    a_names, a = rows_of(ours)
    b_names, b = rows_of(theirs)
    if a_names != b_names:
        return f"columns {a_names} != {b_names}"
    if a != b:
        return f"rows {ours.num_rows} / {theirs.num_rows}; ours only {list((a - b))[:2]}; theirs only {list((b - a))[:2]}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from conftest import session

    sf, wanted = sys.argv[1], sys.argv[2:]
    spark, con = session(), connect(sf)
    queries, oracles, failed = entry.queries(), entry.oracle_sql(), []
    for name in wanted or oracles:
        started = time.time()
        try:
            problem = differences(queries[name](spark, sf), con, oracles[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.2f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
