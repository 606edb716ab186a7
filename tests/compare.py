"""Runs registered queries in Spark and their SQL in DuckDB and compares the rows.

    python tests/compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, relation) -> list[str]:
    """What is not equal: column names, row count, and the first differing rows."""
    names = list(relation.columns)
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    want = _rows(names, relation.fetchall())
    if got == want:
        return []
    missing = sorted(set(want) - set(got))[:3]
    extra = sorted(set(got) - set(want))[:3]
    return [f"rows {len(got)} vs {len(want)}", f"only in SQL {missing}", f"only in Spark {extra}"]


def main() -> None:
    import __spark_entry__ as entry
    from loomcart.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", spark__ui__enabled="false",
                          spark__sql__shuffle__partitions=8, spark__driver__memory="12g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    db, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            found = differences(df, db.sql(sql[name])) if name in sql else [f"no SQL, {df.count()} rows"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s", *found, sep="\n     ",
              flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
