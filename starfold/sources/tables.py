"""Parquet tables: read, overwrite, optional load, views, staging, inspection."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterable, Mapping, Sequence
from weakref import WeakKeyDictionary

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Overwrite ``path`` and return the stored table.

    Going on with the stored table, not with ``df``, means counts come from
    Parquet footers and nothing upstream is computed twice.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None when the path does not exist. Any other failure is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def store_of(spark: SparkSession, path: str):
    """A path and the store it lies in, as the cluster's file systems have them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was committed; one cut short leaves no success marker."""
    marker, store = store_of(spark, f"{path}/_SUCCESS")
    return store.exists(marker)


def write_note(spark: SparkSession, path: str, content: dict) -> None:
    """Overwrite a small JSON file in the store of the tables."""
    at, store = store_of(spark, path)
    out = store.create(at, True)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()


def read_note(spark: SparkSession, path: str) -> dict | None:
    """What ``write_note`` stored, or None when there is no such file."""
    at, store = store_of(spark, path)
    if not store.exists(at):
        return None
    source = store.open(at)
    try:
        return json.loads(bytes(source.readAllBytes()).decode())
    finally:
        source.close()


def register_views(tables: Mapping[str, DataFrame | None]) -> list[str]:
    """Register the given tables as temporary views; absent ones (None) are left out."""
    names = []
    for name, df in tables.items():
        if df is not None:
            df.createOrReplaceTempView(name)
            names.append(name)
    return names


_local_dirs: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir``.

    Unset, a temporary folder is used in local mode only: on a cluster a folder
    of one machine would not be seen by the others.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_dirs:  # the setting itself cannot be changed in a running session
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="starfold-")
    return _local_dirs[context.applicationId]


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write to a fresh table in the shared folder and read it back.

    Cuts the lineage in a way that survives the loss of executors, and freezes
    values that a recomputation could change.
    """
    return write_table(df, f"{scratch_dir(df.sparkSession)}/starfold/{label}-{uuid.uuid4().hex}")


_row_counts: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()


def stored_rows(df: DataFrame) -> int:
    """Row count of a stored table, or of a selection of its columns.

    It comes from Parquet footers and is kept for the life of ``df``, whose list
    of files does not change either.
    """
    if df not in _row_counts:
        _row_counts[df] = df.count()
    return _row_counts[df]


def fits(df: DataFrame, rows: int) -> bool:
    """Whether a stored table has at most ``rows`` rows."""
    return stored_rows(df) <= rows


def schema_rows(df: DataFrame) -> DataFrame:
    """The columns of a table as rows: position (from 1), name, type, nullable."""
    fields = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(fields, "position int, name string, type string, nullable boolean")


def inspect(df: DataFrame, rows: int = 20) -> None:
    """Print schema and first rows."""
    df.printSchema()
    df.show(rows, truncate=False)


def to_pandas(df: DataFrame, limit: int, order: Sequence[str | Column] = ()):
    """Collect at most ``limit`` rows to the driver; the bound has to be stated.

    With ``order`` they are the first rows in that order, ties broken by the other
    columns (ascending, NULLs first), so which rows come is determined; at most ``limit``
    rows a task are kept while sorting. Without it any rows may come.
    """
    if not order:
        return df.limit(limit).toPandas()
    ties = [F.col("`" + c.replace("`", "``") + "`").asc_nulls_first() for c, kind in df.dtypes if not kind.startswith("map")]
    return df.orderBy(*order, *ties).limit(limit).toPandas()


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first
