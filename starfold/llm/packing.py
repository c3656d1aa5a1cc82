"""Best-fit packing of pieces into sequences, in bulk-synchronous supersteps.

Sizes are divided into a few ranges, each sixteen times the one below; a superstep takes
the documents of one range, from the largest sizes down, and every gap left so far:

1. Documents and gaps are sorted by size over all tasks (range partitions, an offset
   for each), so every row knows its place.
2. The successors are swept: a document, larger ones first, takes the smallest gap
   that holds it, and what it leaves is a gap again; without one it opens a sequence.
   Documents of one size are alike, and so are gaps of one size, so the sweep runs over
   sizes and their numbers of rows, at most ``capacity`` of each however many
   documents there are; it is the one part that is not spread over tasks.
3. Documents that want gaps of one size take them by rank: a place among the documents
   leads to a place among the gaps, and the two tables are joined by it. At most
   ``capacity`` documents meet a gap.
4. Every gap learns by its place what is left of it, and the next superstep sorts them anew.

The packing is that of a sequential best fit over all documents by decreasing size. It does
not depend on partitions or on the ranges; a superstep is a stored table.

Defined cases: a piece fills its sequence if it is as long as the capacity; ties
go by the piece's number; pieces of length 0 take no room and are spread over the
sequences, at offset 0; a longer piece than the capacity is an error; an empty table
gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import own_columns, slices
from starfold.llm.encoding import encoder
from starfold.sources import stage, union_all

#: Ratio of neighbouring ranges of sizes.
STEP = 16
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number within a partition in these low bits


def sweep(docs: list[tuple[int, int, int]], gaps: list[tuple[int, int]], capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Successors of documents among gaps, by sizes.

    ``docs``: (size, place of the first, number) by decreasing size. ``gaps``: (size, number)
    by increasing size; gaps are numbered in this order, opened sequences after them. Returns the moves
    (first place, first gap, documents a gap, size, size of the gap) by place, what is left (first gap, size)
    by gap, and how many sequences were opened.
    """
    at: dict[int, list[tuple[int, int]]] = {}
    ladder: list[int] = []
    full: list[tuple[int, int]] = []  # (first gap, size) of those with nothing left
    moves: list[tuple[int, ...]] = []

    def give(size: int, first: int, number: int) -> None:
        if not number:
            return
        if not size:
            full.append((first, 0))
            return
        if size not in at:
            insort(ladder, size)
            at[size] = []
        at[size].append((first, number))

    known = 0
    for size, number in gaps:
        give(size, known, number)
        known += number
    end = known
    for size, place, n in docs:
        while n:
            k = bisect_left(ladder, size)
            if k < len(ladder):
                gap = ladder[k]
                first, number = at[gap].pop()
                if not at[gap]:
                    del at[gap], ladder[k]
            else:
                gap, first, number = capacity, end, -(-n // (capacity // size))
                end += number
            each = gap // size  # what a document leaves is smaller than any other gap that holds the next one
            whole = min(number, n // each)
            if whole:
                moves.append((place, first, each, size, gap))
                give(gap - each * size, first, whole)
                place, n, first, number = place + whole * each, n - whole * each, first + whole, number - whole
            if number and n:
                moves.append((place, first, n, size, gap))
                give(gap - n * size, first, 1)
                place, n, first, number = place + n, 0, first + 1, number - 1
            give(gap, first, number)
    left = full + [(first, size) for size, parts in at.items() for first, _ in parts]
    return np.array(sorted(moves), np.int64).reshape(-1, 5), np.array(sorted(left), np.int64).reshape(-1, 2), end - known


def _sorted_by(rows: DataFrame, *by: str) -> tuple[DataFrame, np.ndarray]:
    """The rows in range partitions, sorted and stored with ``at`` (partition and row), and how many rows are before each partition."""
    at = F.monotonically_increasing_id().alias("at")
    found = stage(rows.repartitionByRange(*by).sortWithinPartitions(*by).select("*", at), "packing")
    part = F.shiftright("at", _ROW_BITS).alias("part")
    counts = {r["part"]: r["n"] for r in found.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per partition
    return found, np.cumsum([0] + [counts.get(i, 0) for i in range(max(counts, default=0))])


def _numbered(rows: DataFrame, before: np.ndarray, name: str) -> DataFrame:
    """Rows of ``_sorted_by`` with their place in the whole order."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("at").to_numpy()
            place = before[at >> _ROW_BITS] + (at & ((1 << _ROW_BITS) - 1))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns)), pa.array(place, pa.int64())], [*batch.schema.names, name])

    kinds = ", ".join(f"{c} {kind}" for c, kind in rows.dtypes)
    return rows.mapInArrow(number, f"{kinds}, {name} long")


def _places(rows: DataFrame, moves: np.ndarray) -> DataFrame:
    """(number, gap, offset in its sequence less what was taken of it before) of documents."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy()
            first, gap, each, size, room = moves[np.searchsorted(moves[:, 0], place, "right") - 1].T
            own = [gap + (place - first) // each, (place - first) % each * size, room]
            yield pa.RecordBatch.from_arrays([batch.column("number"), *map(pa.array, own)], ["number", "gap", "inside", "room"])

    return rows.select("number", "place").mapInArrow(places, "number long, gap long, inside long, room long")


def _sizes_left(rows: DataFrame, left: np.ndarray) -> DataFrame:
    """(sequence, size) of gaps after the moves; those with nothing left are gone."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = left[np.searchsorted(left[:, 0], batch.column("gap").to_numpy(), "right") - 1, 1]
            yield pa.RecordBatch.from_arrays([batch.column("sequence"), pa.array(own)], ["sequence", "size"])

    return rows.select("sequence", "gap").mapInArrow(sizes, "sequence long, size long").filter("size > 0")


def best_fit(pieces: DataFrame, capacity: int, number: str = "number", size: str = "size") -> DataFrame:
    """(number, sequence, offset) of each piece; ``number`` is distinct, ``size`` at most ``capacity``.

    Sequences are numbered from 0 without a hole.
    """
    spark = pieces.sparkSession
    given = pieces.select(F.col(number).cast("long").alias("number"), F.col(size).cast("long").alias("size"))
    docs, docs_before = _sorted_by(given, "size", "number")
    counts = {r["size"]: r["n"] for r in docs.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per size
    if counts and (min(counts) < 0 or max(counts) > capacity):
        raise ValueError(f"sizes from {min(counts)} to {max(counts)}, but a sequence holds 0 to {capacity}")
    starts = dict(zip(sorted(counts), np.cumsum([0] + [counts[s] for s in sorted(counts)]).tolist(), strict=False))

    placed, opened = [], 0
    gaps: DataFrame | None = None  # sequence, size, gap: its place among the gaps by size
    by_size: dict[int, int] = {}
    high = capacity
    while high:
        low, top = high // STEP, high
        high = low
        wanted = [(s, starts[s], counts[s]) for s in sorted(counts, reverse=True) if low < s <= top]
        if not wanted:
            continue
        moves, left, new = sweep(wanted, sorted(by_size.items()), capacity)
        known, before, opened = sum(by_size.values()), opened, opened + new
        found = _places(_numbered(docs.filter((F.col("size") > low) & (F.col("size") <= top)), docs_before, "place"), moves)
        sequence = F.col("gap") - known + before
        if gaps is not None:
            found = found.join(gaps.select("gap", "sequence").hint("merge"), "gap", "left")
            sequence = F.coalesce("sequence", sequence)
        placed.append(found.select("number", sequence.alias("sequence"), (F.lit(capacity) - F.col("room") + F.col("inside")).alias("offset")))

        ends = np.append(left[1:, 0], known + new)
        by_size = {}
        for gap, n in zip(left[:, 1].tolist(), (ends - left[:, 0]).tolist(), strict=True):
            if gap:
                by_size[gap] = by_size.get(gap, 0) + n
        if low and by_size and min(counts) <= low:
            fresh = spark.range(new).select((F.col("id") + before).alias("sequence"), (F.col("id") + known).alias("gap"))
            rows = fresh if gaps is None else gaps.select("sequence", "gap").unionByName(fresh)
            gaps = _numbered(*_sorted_by(_sizes_left(rows, left), "size", "sequence"), "gap")
        else:
            gaps = None
    if 0 in counts:
        spread = F.pmod("place", F.lit(max(opened, 1)))
        placed.append(_numbered(docs.filter("size = 0"), docs_before, "place").select("number", spread.alias("sequence"), F.lit(0).cast("long").alias("offset")))
    if not placed:
        return docs.select("number", F.col("number").alias("sequence"), F.col("size").alias("offset"))  # no rows
    return union_all(placed)


# --- documents ------------------------------------------------------------------------------

_PIECES = "piece int, start long, length long, ids binary"


def encode_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, key: str = "doc_id", text: str = "text", byte_level: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids (uint32, little-endian) of every document, in order; stored and numbered.

    A null text counts as empty; every document ends with ``end_id``.
    """
    kind = docs.schema[key].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, piece, start, length, ids = [], [], [], [], []
            for i, own in enumerate(encoder(tokenizer, byte_level).encode(batch.column("text").to_pylist())):
                own = np.append(own, np.uint32(end_id))
                for k, a in enumerate(range(0, len(own), capacity)):
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(min(capacity, len(own) - a))
                    ids.append(own[a : a + capacity].tobytes())
            columns = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(row)), *columns], ["key", "piece", "start", "length", "ids"])

    rows = own_columns(docs, key, text).select(F.col(key).alias("key"), F.col(text).alias("text"))
    cut = rows.mapInArrow(encode, f"key {kind}, {_PIECES}").withColumn("number", F.monotonically_increasing_id())
    return stage(cut, "pieces")


def pack_documents(pieces: DataFrame, capacity: int) -> DataFrame:
    """``encode_pieces`` rows with the sequence and the offset of each."""
    room = best_fit(pieces.select("number", "length"), capacity, "number", "length")
    return pieces.join(room, "number")
