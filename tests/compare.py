"""Spark results against the SQL statements, value for value.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


SAME = {
    "long": "BIGINT",
    "integer": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types, row count and every value agree."""
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    kinds = {d[0]: str(d[1]) for d in answer.description}
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if SAME.get(kind) != kinds[field.name]:
            found.append(f"{field.name}: {kind} against {kinds[field.name]}")
    order = sorted(names)
    pick = [names.index(name) for name in order]
    expected = Counter(tuple(_plain(row[i]) for i in pick) for row in answer.fetchall())
    table = df.select(*order).toArrow()
    actual = Counter(
        tuple(_plain(v) for v in row)
        for row in zip(*[column.to_pylist() for column in table.columns])
    )
    if actual != expected:
        more, less = actual - expected, expected - actual
        found.append(
            f"{sum(actual.values())} rows against {sum(expected.values())}; "
            f"{sum(more.values())} only in Spark, {sum(less.values())} only in SQL"
        )
        found += [f"  {order}"]
        found += [f"  spark {row}" for row in sorted(more, key=str)[:3]]
        found += [f"  sql   {row}" for row in sorted(less, key=str)[:3]]
    return found


def _plain(value):
    # the repr tells apart 1 and True and shows every digit of a double
    return repr(value)


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    folder, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name, build in queries().items():
        if names and name not in names or name not in oracle_sql():
            continue
        start = time.time()
        try:
            found = differences(build(spark, folder), con, oracle_sql()[name])
        except Exception as problem:  # report and go on with the next query
            found = [f"{type(problem).__name__}: {str(problem)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("     ", line)
    missing = set(queries()) - set(oracle_sql())
    print("without SQL:", sorted(missing), "failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
