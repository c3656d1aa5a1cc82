"""String helpers: blank handling and ordered pattern classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(col: Column | str) -> Column:
    """Trim spaces; a blank string becomes NULL."""
    return F.nullif(F.trim(col), F.lit(""))


def classify(col: Column, rules: Sequence[tuple[str, str]], default: Column | str | None = None) -> Column:
    """Label of the first ``(pattern, label)`` rule whose pattern occurs in ``col``.

    Without a match: ``default``, or the value itself when there is no default.
    """
    fallback = col if default is None else (F.lit(default) if isinstance(default, str) else default)
    branches: Column | None = None
    for pattern, label in rules:
        hit = col.rlike(pattern)
        branches = F.when(hit, label) if branches is None else branches.when(hit, label)
    return fallback if branches is None else branches.otherwise(fallback)


def joined_name(parts: Sequence[str], unknown: str) -> Column:
    """``", "``-joined parts (NULL parts skipped); ``unknown`` when the first part is NULL."""
    return F.when(F.col(parts[0]).isNull(), unknown).otherwise(F.concat_ws(", ", *parts))
