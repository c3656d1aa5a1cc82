"""Helpers shared by the operators: input tables, output folders, and words of texts as numpy arrays."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.sources import scratch_dir

#: Bytes of text that are turned into arrays at once; an array element takes 8 bytes for each.
BLOCK_BYTES = 1 << 20

M64 = (1 << 64) - 1


def ready(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, unless it is installed or shipped there."""
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [here, env.get("PYTHONPATH", "")]))


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are stored by now; it does so when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one; every run writes to its own."""
    return f"{scratch_dir(spark)}/starfold/llm/{label}-{uuid.uuid4().hex}"


def in_fold(key: Column, parts: int = 5) -> Column:
    """Whether crc32 of the key as text leaves no remainder: the held-out fold. A null key is not in it."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == 0, F.lit(False))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64-bit integers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD6E8FEB86659FD93
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_POWERS = {"table": np.ones(1, np.uint64)}


def _powers(n: int) -> np.ndarray:
    if len(_POWERS["table"]) < n:
        step = np.full(max(n, 256), _BASE, np.uint64)
        step[0] = 1
        _POWERS["table"] = np.multiply.accumulate(step)
    return _POWERS["table"]


def _block_words(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(_SPACE[data].view(np.int8), prepend=np.int8(1), append=np.int8(1)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    within = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    terms = table[data[np.repeat(starts, sizes) + within]] * _powers(int(sizes.max()) + 1)[within]
    return starts, ends, mix(np.add.reduceat(terms, first) + sizes.astype(np.uint64))


def words(data: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes.

    Equal words have equal hashes. ``lower`` folds A-Z. Long data are cut
    between words, so memory beyond the result stays bounded by ``BLOCK_BYTES``
    or the longest word.
    """
    table = _BYTE[_LOWER] if lower else _BYTE
    parts, at = [], 0
    while at < len(data):
        end = min(at + BLOCK_BYTES, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            more = np.flatnonzero(_SPACE[data[end : end + 4096]])
            end = end + int(more[0]) if len(more) else min(end + 4096, len(data))
        s, e, h = _block_words(data[at:end], table)
        parts.append((s + at, e + at, h))
        at = end
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive elements."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for k in range(n):
        out = out * np.uint64(_BASE) + hashes[k : k + len(out)]
    return mix(out)


def as_bytes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Texts end to end, a line feed after each, with the offset of each (and of the end)."""
    coded = [b"" if t is None else t.encode() for t in texts]
    offsets = np.zeros(len(coded) + 1, np.int64)
    np.cumsum([len(c) + 1 for c in coded], out=offsets[1:])
    return np.frombuffer(b"\n".join(coded) + b"\n", np.uint8) if coded else np.zeros(0, np.uint8), offsets


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 2 * BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column`` (a longer value is alone).

    At the end the worker, which lives on for other stages, gives back the memory that Arrow keeps for reuse.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()


def packed(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 1)


def unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def quoted(name: str) -> str:
    """A column name as it is, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def own_columns(df: DataFrame, *wanted: str) -> DataFrame:
    """Only the columns an operator reads; others, whatever their names, stay out of it."""
    return df.select(*[F.col(quoted(c)) for c in wanted])


def unused(df: DataFrame, name: str) -> str:
    """A name like ``name`` that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
