"""Run registered queries in Spark and their SQL in DuckDB and compare schema and values."""

import argparse
import math
import os
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.oracle import ORACLE_SQL  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from skyledger.session import build_session  # noqa: E402

TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def session(cores: str = "8") -> SparkSession:
    spark = build_session(
        "skyledger-checks", f"local[{cores}]",
        **{"spark.sql.shuffle.partitions": cores, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": os.environ.get("SPARK_DRIVER_MEMORY", "8g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def _comparable(row: tuple) -> tuple:
    return tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in row)


def compare(df: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """The differences between both results; none if they agree."""
    answer = db.sql(sql)
    expected_types = dict(zip(answer.columns, map(str, answer.types)))
    actual_types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    problems = []
    if expected_types != actual_types:
        for name in sorted(set(expected_types) | set(actual_types)):
            if expected_types.get(name) != actual_types.get(name):
                problems.append(f"{name}: Spark {actual_types.get(name)}, SQL {expected_types.get(name)}")
    names = sorted(set(expected_types) & set(actual_types))
    if not names:
        return problems
    quoted = ", ".join(f'"{n}"' for n in names)
    left = sorted((_comparable(tuple(r)) for r in df.select(*names).collect()), key=repr)
    right = sorted((_comparable(r) for r in db.sql(f"SELECT {quoted} FROM ({sql})").fetchall()), key=repr)
    if len(left) != len(right):
        problems.append(f"rows: Spark {len(left)}, SQL {len(right)}")
    if not left:
        problems.append("no rows")
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ, first: {dict(zip(names, bad[0][0]))} against {dict(zip(names, bad[0][1]))}")
    return problems


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--folder", default="/root/testdata/sf0.01")
    args = parser.parse_args()
    spark, db, failed = session(), connect(args.folder), 0
    for name in args.names or QUERIES:
        started = time.monotonic()
        try:
            df = QUERIES[name](spark, args.folder)
            sql = ORACLE_SQL.get(name)
            problems = compare(df, db, sql) if sql else ([] if df.count() else ["no rows"])
        except Exception as error:  # report every query, not only the first that breaks
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.monotonic() - started:.1f}s {'' if name in ORACLE_SQL else '(rows only)'}", flush=True)
        for problem in problems:
            print("     ", problem[:1500], flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
