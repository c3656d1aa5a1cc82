"""Run the registered queries and their DuckDB equivalents side by side.

    python -m verification.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from verification.oracle import ORACLES
from verification.registry import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def _family(kind: str) -> str:
    kind = kind.lower().split("(")[0]
    return {"int": "integer", "string": "varchar", "smallint": "integer"}.get(kind, kind)


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> list[str]:
    """What differs between the two results of one query; empty when nothing does."""
    df = QUERIES[name](spark, sf_dir)
    relation = con.sql(ORACLES[name])
    columns = sorted(df.columns)
    if columns != sorted(relation.columns):
        return [f"columns {columns} / {sorted(relation.columns)}"]
    found = []
    theirs_types = dict(zip(relation.columns, map(str, relation.types)))
    for column, kind in df.dtypes:
        if _family(kind) != _family(theirs_types[column]):
            found.append(f"type of {column}: {kind} / {theirs_types[column]}")
    ours = sorted(tuple(_plain(v) for v in row) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    at = [relation.columns.index(c) for c in columns]
    theirs = sorted(tuple(_plain(row[i]) for i in at) for row in relation.fetchall())
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} / {len(theirs)}")
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if different:
        found.append(f"{len(different)} rows differ, first {different[0]}")
    return found


def main(argv: list[str]) -> int:
    from starfold.session import session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in argv[1:] or QUERIES:
        start = time.time()
        try:
            found = differences(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - reported per query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.2f}s", *found, sep="\n     " if found else " ")
    print(f"{bad} of {len(argv[1:] or QUERIES)} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
