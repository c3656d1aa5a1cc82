"""Severity from the counts of people killed and injured."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starfold.rules import SEVERITY


def severity(killed: Column, injured: Column, labels: Sequence[str] = SEVERITY) -> Column:
    """Fatal over injury over the rest; unknown (NULL) counts fall to the rest."""
    fatal, hurt, other = labels
    return F.when(killed > 0, fatal).when(injured > 0, hurt).otherwise(other)
