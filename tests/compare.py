"""Run named queries in Spark and their SQL in DuckDB and compare whole results."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def kind(text: str) -> str:
    """One spelling for Spark's and DuckDB's type names."""
    names = {
        "bigint": "bigint", "int": "int", "integer": "int", "string": "text", "varchar": "text",
        "boolean": "bool", "date": "date", "timestamp_ntz": "timestamp", "double": "double",
    }
    text = text.lower()
    return names.get(text, text)


def differences(spark_rows, spark_types, duck) -> list[str]:
    columns = sorted(spark_types)
    duck_types = {n: kind(str(t)) for n, t in zip(duck.columns, duck.types)}
    spark_types = {n: kind(t) for n, t in spark_types.items()}
    if spark_types != duck_types:
        odd = {n: (spark_types.get(n), duck_types.get(n)) for n in {*spark_types, *duck_types}}
        return [f"types differ: { {n: p for n, p in odd.items() if p[0] != p[1]} }"]
    where = [duck.columns.index(c) for c in columns]
    expected = Counter(tuple(str(row[i]) for i in where) for row in duck.fetchall())
    found = Counter(tuple(str(row[c]) for c in columns) for row in spark_rows)
    if expected == found:
        return []
    return [
        f"rows: {sum(found.values())} found, {sum(expected.values())} expected",
        f"only found: {list((found - expected).items())[:3]}",
        f"only expected: {list((expected - found).items())[:3]}",
    ]


def compare(spark, con, folder, query, sql) -> tuple[int, list[str]]:
    df = query(spark, folder)
    rows = df.collect()
    return len(rows), differences(rows, dict(df.dtypes), con.sql(sql))


def main() -> None:
    import __spark_entry__ as entry
    from cartmill.session import build_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": "8",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(folder), entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            count, bad = compare(spark, con, folder, query, sql[name])
        except Exception as error:  # noqa: BLE001 - report and go on
            count, bad = -1, [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{'ok  ' if not bad else 'FAIL'} {name} rows={count} {time.time() - start:.1f}s", flush=True)
        for line in bad:
            print("     ", line, flush=True)


if __name__ == "__main__":
    main()
