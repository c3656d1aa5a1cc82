"""Delimited-text sources, bound by header name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.rules import RAW_FIELDS


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    fields: Sequence[tuple[str, str]] = RAW_FIELDS,
    **options: object,
) -> DataFrame:
    """Read ``(header name, type)`` fields from CSV files with a header line.

    Columns are found by name, so their order and any extra columns do not
    matter; a missing one raises ``ValueError``. A value that does not parse
    becomes NULL. Header lines are compared across files (``enforceSchema``
    off), so one file with another column order fails instead of being misread.
    Only the wanted columns are parsed.
    """
    text = spark.read.options(header=True, enforceSchema=False, **options).csv(path)
    by_name = {name.strip().lstrip("﻿").lower(): name for name in text.columns}
    missing = [name for name, _ in fields if name.lower() not in by_name]
    if missing:
        raise ValueError(f"columns missing from the header: {', '.join(missing)}")
    columns = []
    for name, kind in fields:
        source = F.col(_quoted(by_name[name.lower()]))
        columns.append((source if kind == "string" else source.try_cast(kind)).alias(name))
    return text.select(*columns)


def write_csv(df: DataFrame, path: str) -> None:
    """Write with a header, keeping outer spaces. An empty string is read back as NULL."""
    df.write.mode("overwrite").options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


DICTIONARY_FIELDS = (
    ("resources.name", "resource"),
    ("resources.schema.fields.name", "field"),
    ("resources.schema.fields.var_class", "var_class"),
    ("resources.schema.fields.description", "description"),
)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Data dictionary: quoted cells over several lines, dotted header names renamed to plain ones."""
    raw = read_csv(spark, path, [(name, "string") for name, _ in DICTIONARY_FIELDS], multiLine=True, escape='"')
    return raw.select(*[F.col(_quoted(name)).alias(plain) for name, plain in DICTIONARY_FIELDS])
