"""Reproducible uniform draws: a hash of (row identity, purpose, seed)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = 2**32


def draw_int(identity: Column, purpose: str, seed: str = "") -> Column:
    """Integer in [0, 2**32), uniform over identities, independent between purposes."""
    text = F.concat(identity, F.lit(f":{purpose}" + (f":{seed}" if seed else "")))
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")


def draw(identity: Column, purpose: str, seed: str = "") -> Column:
    """Uniform double in [0, 1). Unlike ``rand()`` it does not depend on partitioning or retries."""
    return draw_int(identity, purpose, seed) / F.lit(float(SPAN))
