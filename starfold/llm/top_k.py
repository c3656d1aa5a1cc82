"""Exact top-k inner products in three phases under a uniform threshold.

The components are divided into lists; a vector's score is the sum of its local
scores, one from each list. For a block of queries:

1. local score lists are gathered from a share of the vectors, chosen by a hash: those of the best local scores of
   each list are scored in full, and the k-th best is a score that at least k candidates reach: the cutoff;
2. the cutoff is sent to all tasks. A candidate that reaches it has a local score of at least cutoff / lists somewhere.
   Lists are scored one after the other; what is known and the most that the other lists can add (the product of
   the lengths of the rest) bound a score, and queries and vectors of which no pair can reach the cutoff any more are left out of the next lists;
3. pairs that have an entry over the threshold and can reach the cutoff are resolved with all lists, and the best k are kept.

Scores are exact integers: products and sums run in the narrowest type that holds the largest possible score (float32 below 2**24,
float64 below 2**53, long below 2**63). Queries go in blocks of at most ``BLOCK`` vectors, the only thing sent to all tasks.

Defined cases: vectors that are null, or hold a null or non-finite component, take no part, nor do rows without a key.
Each row is a candidate, and a query if chosen, by itself, also where keys repeat; only the query's own row is no candidate of it. Ties go to
the smaller key. Vectors of different lengths have no inner product: an error, as are components or scores beyond a long. Fewer than k
candidates give all of them; vectors of no components score 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starfold.llm.common import own_columns
from starfold.sources import stage, union_all

#: Queries sent to all tasks at once; scores held by a task at once; lists of components; one vector in so many gives the cutoff.
BLOCK, TILE, LISTS, SHARE = 4096, 1 << 20, 4, 16


def integer_vectors(table: DataFrame, key: str, vector: str, scale: int = 64) -> DataFrame:
    """(row, key, vector): floor(scale * x) of each component as long; whole, finite vectors only. Stored; ``row`` is distinct."""
    x = F.transform(F.col(f"`{vector}`"), lambda v: v.cast("double"))
    whole = F.col(f"`{vector}`").isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = own_columns(table, key, vector).filter(F.col(f"`{key}`").isNotNull() & F.coalesce(whole, F.lit(False))).select(
        F.col(f"`{key}`").cast("long").alias("key"), F.transform(x, lambda v: F.floor(v * scale)).alias("vector")
    )
    return stage(rows.select(F.monotonically_increasing_id().alias("row"), "key", "vector"), "top-k-vectors")


def exact_type(vectors: DataFrame) -> np.dtype:
    """The narrowest type in which all scores are exact; an error where there is none, or where lengths differ."""
    most = F.array_max(F.transform("vector", F.abs))
    found = vectors.agg(F.min(F.size("vector")), F.max(F.size("vector")), F.max(most)).first()
    short, long, top = found[0] or 0, found[1] or 0, found[2] or 0
    if short != long:
        raise ValueError(f"vectors of {short} and {long} components have no inner product")
    bound = top * top * long
    if bound >= 1 << 63:
        raise ValueError(f"scores of up to {bound} do not fit a long")
    return np.dtype(np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64)


def _matrix(column: pa.Array, kind: np.dtype) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _bounds(width: int, lists: int) -> list[tuple[int, int]]:
    edges = np.linspace(0, width, lists + 1).astype(int).tolist()
    return list(zip(edges, edges[1:], strict=False))


def _rests(vectors: np.ndarray, parts: list[tuple[int, int]]) -> np.ndarray:
    """For each list the length of what comes after it, a little more than it is: a product of two bounds their score there."""
    own = vectors.astype(float)
    return np.stack([np.sqrt((own[:, b:] ** 2).sum(axis=1)) * (1 + 1e-9) for _, b in parts])


def _tiles(batches: Iterator[pa.RecordBatch], queries: int, kind: np.dtype) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    rows = max(1, TILE // max(1, queries))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part.column("row").to_numpy(), part.column("key").to_numpy(), _matrix(part.column("vector"), kind)


_ENTRY = "query long, vec_id long, row long, score long"


def _entries(query: np.ndarray, ids: np.ndarray, rows: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (query, ids, rows, score)], ["query", "vec_id", "row", "score"])


def resolve(queries: np.ndarray, own: np.ndarray, cutoff: np.ndarray, parts: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Pairs (query, vector) that reach the query's cutoff, with their scores; and how many pairs were scored in every list."""
    row, col = np.arange(len(queries)), np.arange(len(own))
    q_rest, v_rest = _rests(queries, parts), _rests(own, parts)
    part = cutoff / len(parts)  # uniform: one list at least has this much
    least = cutoff - np.abs(cutoff) * 1e-12 - 1  # bounds are rounded, scores are not
    known = entry = None
    for i, (a, b) in enumerate(parts):
        local = queries[row, a:b] @ own[col, a:b].T
        over = local >= part[row, None]
        known, entry = (local, over) if known is None else (known + local, entry | over)
        if i + 1 == len(parts):
            break
        can = known + q_rest[i][row, None] * v_rest[i][None, col] >= least[row, None]
        keep_row, keep_col = can.any(axis=1), can.any(axis=0)
        if keep_row.mean() * keep_col.mean() < 0.9:
            row, col = row[keep_row], col[keep_col]
            known, entry = known[np.ix_(keep_row, keep_col)], entry[np.ix_(keep_row, keep_col)]
            if not known.size:
                break
    r, c = np.nonzero(entry & (known >= cutoff[row, None]))
    return row[r], col[c], known[r, c], known.size


def top_k_of_block(vectors: DataFrame, names: np.ndarray, queries: np.ndarray, k: int, kind: np.dtype, lists: int = LISTS, share: int = SHARE) -> DataFrame:
    """The k best (query, vec_id, row, score) of each query (``names``: their rows) of one block."""
    step, parts = 1024, _bounds(queries.shape[1], lists)
    none = np.iinfo(np.int64).min

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((len(names), k), none)
        for rows, _, own in _tiles(batches, step, kind):
            take = min(k, len(rows))
            for a in range(0, len(names), step):
                local = [queries[a : a + step, x:y] @ own[:, x:y].T for x, y in parts]
                same = names[a : a + step, None] == rows[None, :]
                picked = np.zeros(same.shape, bool)
                for scores in local:
                    np.put_along_axis(picked, np.argpartition(scores, len(rows) - take, axis=1)[:, len(rows) - take :], True, 1)
                total = np.where(picked & ~same, sum(local).astype(np.int64), none)
                both = np.concatenate([best[a : a + step], total], axis=1)
                best[a : a + step] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        row, col = np.nonzero(best > none)
        yield _entries(names[row], np.full(len(row), -1), np.full(len(row), -1), best[row, col])

    nth = Window.partitionBy("query").orderBy(F.desc("score"))
    sample = vectors.filter(F.pmod(F.xxhash64("row"), F.lit(share)) == 0)
    gathered = sample.mapInArrow(gather, _ENTRY).withColumn("nth", F.row_number().over(nth)).filter(F.col("nth") == k)
    found = {r["query"]: r["score"] for r in gathered.select("query", "score").collect()}  # a number per query of the block
    low = np.finfo(np.float64).min / 4 if kind.kind == "f" else none // 2
    cutoff = np.array([found.get(q, low) for q in names.tolist()], np.float64 if kind.kind == "f" else np.int64)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, own in _tiles(batches, step, kind):
            for a in range(0, len(names), step):
                q, v, score, _ = resolve(queries[a : a + step], own, cutoff[a : a + step], parts)
                other = names[a + q] != rows[v]
                yield _entries(names[a + q[other]], ids[v[other]], rows[v[other]], score[other])

    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return vectors.mapInArrow(collect, _ENTRY).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def exact_top_k(table: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding", scale: int = 64, lists: int = LISTS, block: int = BLOCK, share: int = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of each row for which ``is_query`` (on ``key``) holds."""
    vectors = integer_vectors(table, key, vector, scale)
    kind = exact_type(vectors)
    asked = vectors.withColumnRenamed("key", key).filter(is_query)
    blocks = max(1, -(-2 * asked.count() // block))  # by a hash, so a block holds half of ``block`` on average
    asked = asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    out = []
    for b in range(blocks):
        got = asked.filter(F.col("block") == b).select("row", F.col(f"`{key}`").alias("key"), "vector").orderBy("row").toPandas()
        if len(got):
            names, queries = got["row"].to_numpy(np.int64), np.stack([np.asarray(v, kind) for v in got["vector"]])
            best = top_k_of_block(vectors, names, queries, k, kind, lists, share)
            own = vectors.sparkSession.createDataFrame(got[["row", "key"]], "query long, query_id long")  # the block's queries
            out.append(stage(best.join(F.broadcast(own), "query"), "top-k-block"))
    if not out:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return union_all(out).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
