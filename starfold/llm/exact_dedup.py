"""Exact dedup against immutable snapshots screened by static binary-fuse filters.

A snapshot holds one entry per distinct text (digest, length, kept key, rows) and,
for each bucket of digests, a binary-fuse filter that never changes once
published. Rows of an incoming batch are grouped by digest first, so a text is
one row however often the batch repeats it. The filters screen these digests;
what they let through joins the snapshot's exact bucket and is compared byte by
byte with the text kept there. The rest is new.

Defined cases: a null text counts as empty; rows equal in key and text are
reported alike (``keep_one`` leaves one of them); a null key is less than any
other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import mix, own_columns, quoted, unused
from starfold.sources import stage

#: Digests in a bucket, about: a filter is built and held by one task.
BUCKET_ROWS = 50_000


# --- binary-fuse filter ---------------------------------------------------------------


def _places(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Three places of each key, in three neighbouring segments, and its 8-bit fingerprint."""
    h = mix(keys ^ np.uint64(seed))
    mask = np.uint64(segment - 1)
    first = ((h >> np.uint64(32)) * np.uint64(segment * segments)) >> np.uint64(32)
    second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64), (h ^ (h >> np.uint64(32))).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Static filter of distinct 64-bit keys: (seed, segment length, segments, fingerprints).

    Keys are peeled in layers: a place used by one remaining key settles that key.
    Fingerprints are then set from the last layer back, so that the three places
    of each key give its own by exclusive or.
    """
    keys = np.unique(keys.astype(np.uint64))
    n = max(len(keys), 2)
    segment = 1 << int(np.log(n) / np.log(3.33) + 2.25)
    slots = int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n))) + 1
    segments = max(1, -(-slots // segment) - 2)
    for attempt in range(1, 1000):
        seed = int(mix(np.array([attempt], np.uint64))[0])
        at, prints = _places(keys, seed, segment, segments)
        size = segment * (segments + 2)
        users, who = np.zeros(size, np.int32), np.zeros(size, np.int64)
        for row in at:
            np.add.at(users, row, 1)
            np.bitwise_xor.at(who, row, np.arange(len(keys)))
        layers, settled, single = [], 0, np.flatnonzero(users == 1)
        while len(single):
            key, pick = np.unique(who[single], return_index=True)
            layers.append((key, single[pick]))
            settled += len(key)
            for row in at[:, key]:
                np.subtract.at(users, row, 1)
                np.bitwise_xor.at(who, row, key)
            touched = np.unique(at[:, key])
            single = touched[users[touched] == 1]
        if settled == len(keys):
            table = np.zeros(size, np.uint8)
            for key, place in reversed(layers):
                table[place] = prints[key] ^ table[at[0, key]] ^ table[at[1, key]] ^ table[at[2, key]]
            return seed, segment, segments, table.tobytes()
        segments += 1  # more room if an unlucky set cannot be peeled
    raise RuntimeError("no filter found")


def probe_filter(keys: np.ndarray, seed: int, segment: int, segments: int, table: bytes) -> np.ndarray:
    """True for every key the filter was built from, and for about one other in 256."""
    at, prints = _places(keys.astype(np.uint64), seed, segment, segments)
    cells = np.frombuffer(table, np.uint8)
    return (cells[at[0]] ^ cells[at[1]] ^ cells[at[2]]) == prints


# --- snapshots -------------------------------------------------------------------------


@dataclass(frozen=True)
class Snapshot:
    """Stored entries (digest, n_bytes, keep, n_rows), their filters, and the number of buckets."""

    entries: DataFrame
    filters: DataFrame
    buckets: int


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, digest, n_bytes); SHA-256 of the UTF-8 text."""
    content = F.coalesce(F.col(text), F.lit(""))
    return own_columns(docs, key, text).select(
        F.col(key).alias("key"),
        F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"),
        F.octet_length(content).cast("long").alias("n_bytes"),
    )


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("hash", F.xxhash64("digest")).withColumn("bucket", F.pmod("hash", F.lit(buckets)).cast("int"))


def publish(entries: DataFrame) -> Snapshot:
    """Store entries as a new immutable snapshot with a filter for each bucket."""
    stored = stage(entries, "dedup-entries")
    buckets = max(1, -(-stored.count() // BUCKET_ROWS))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        seed, segment, segments, table = build_filter(rows["hash"].to_numpy().view(np.uint64))
        return pd.DataFrame(
            {"bucket": rows["bucket"][:1], "seed": [str(seed)], "segment": [segment], "segments": [segments], "cells": [table]}
        )

    filters = (
        _bucketed(stored.select("digest"), buckets).select("bucket", "hash").groupBy("bucket")
        .applyInPandas(build, "bucket int, seed string, segment long, segments long, cells binary")
    )
    return Snapshot(stored, stage(filters, "dedup-filters"), buckets)


def group_batch(rows: DataFrame) -> DataFrame:
    """The duplicates within a batch: one entry per digest, whose largest key is kept."""
    return rows.groupBy("digest", "n_bytes").agg(F.max("key").alias("keep"), F.count(F.lit(1)).alias("n_rows"))


def screen(batch: DataFrame, snapshot: Snapshot, most: int = BUCKET_ROWS) -> DataFrame:
    """Entries of the batch with ``maybe``: whether the filter of their bucket lets them through.

    ``most`` bounds the entries of the batch. Where they outnumber the snapshot's, a bucket is dealt
    to several tasks, each with the bucket's filter, so none probes more than about ``BUCKET_ROWS``.
    """
    shares = max(1, -(-most // (snapshot.buckets * BUCKET_ROWS)))
    schema = batch.schema.simpleString()[7:-1] + ",maybe:boolean"

    def probe(rows: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        hashes = rows["hash"].to_numpy().view(np.uint64)
        rows = rows.drop(columns=["hash", "bucket", "share"])
        if filters.empty:
            return rows.assign(maybe=False)
        f = filters.iloc[0]
        return rows.assign(maybe=probe_filter(hashes, int(f["seed"]), int(f["segment"]), int(f["segments"]), f["cells"]))

    share = F.pmod(F.shiftright("hash", 32), F.lit(shares)).cast("int").alias("share")
    incoming = _bucketed(batch, snapshot.buckets).select("*", share).groupBy("bucket", "share")
    filters = snapshot.filters.select("*", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"))
    return incoming.cogroup(filters.groupBy("bucket", "share")).applyInPandas(probe, schema)


def same_bytes(pairs: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """Digests of ``pairs`` (digest, n_bytes, keep, old_keep) whose two kept texts are equal byte by byte."""
    picked = pairs.select("digest", F.explode(F.array("keep", "old_keep")).alias("key"))
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    texts = own_columns(docs, key, text).select(F.col(key).alias("key"), F.unhex(F.sha2(content, 256)).alias("digest"), content.alias("content"))
    a, b = picked.alias("a"), texts.alias("b")
    # by sort and merge at every size: a text is shuffled once, and neither side is sent to all tasks
    met = b.join(a.hint("merge"), F.col("a.digest").eqNullSafe(F.col("b.digest")) & F.col("a.key").eqNullSafe(F.col("b.key")))
    both = F.count_distinct(F.struct("a.key")) == 2
    return met.groupBy("a.digest").agg((both & (F.min("content") == F.max("content"))).alias("same")).filter("same").select("digest")


def ingest(snapshot: Snapshot | None, rows: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Entries after a batch of ``digests`` rows has met the snapshot; ``docs`` has the texts of both."""
    batch = group_batch(rows)
    if snapshot is None:
        return batch
    screened = stage(screen(batch, snapshot, rows.count()), "dedup-screened")
    old = snapshot.entries.withColumnsRenamed({"keep": "old_keep", "n_rows": "old_rows"})
    pairs = stage(screened.filter("maybe").drop("maybe").join(old, ["digest", "n_bytes"]), "dedup-pairs")
    met = pairs.join(same_bytes(pairs, docs, key, text), "digest", "left_semi").select("digest", "n_bytes", "keep", "n_rows")
    changed = met.withColumnsRenamed({"keep": "new_keep", "n_rows": "new_rows"})
    merged = snapshot.entries.join(changed, ["digest", "n_bytes"], "left").select(
        "digest",
        "n_bytes",
        F.greatest("keep", "new_keep").alias("keep"),
        (F.col("n_rows") + F.coalesce("new_rows", F.lit(0))).alias("n_rows"),
    )
    fresh = screened.drop("maybe").join(met.select("digest", "n_bytes"), ["digest", "n_bytes"], "left_anti")
    return merged.unionByName(fresh)


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", batches: int = 2) -> DataFrame:
    """One row per document: key, digest, n_bytes, keep_id, group_size, kept.

    The rows arrive in ``batches`` by a hash of key and text; each batch meets the
    snapshot that the ones before it made. The result does not depend on it.
    """
    rows = stage(digests(docs, key, text).withColumn("batch", F.pmod(F.xxhash64("key", "digest"), F.lit(batches))), "dedup-digests")
    snapshot = None
    for number in range(batches):
        entries = ingest(snapshot, rows.filter(F.col("batch") == number).drop("batch"), docs, key, text)
        snapshot = publish(entries) if number < batches - 1 else None
    groups = stage(entries.select("digest", "n_bytes", F.col("keep").alias("keep_id"), F.col("n_rows").alias("group_size")), "dedup-groups")
    return rows.join(groups, ["digest", "n_bytes"]).select(
        F.col("key").alias(key), "digest", "n_bytes", "keep_id", "group_size", F.col("key").eqNullSafe(F.col("keep_id")).alias("kept")
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without their duplicates, with the columns they had: the largest key of each text."""
    # key and digest as one string: texts are shuffled by it once, for the join and for repeated rows
    row, name = lambda k, digest: F.concat_ws(" ", digest, F.coalesce(k.cast("string"), F.lit("-"))), unused(docs, "row")
    kept = exact_dedup(docs, key, text).filter("kept").select(row(F.col(quoted(key)), F.lower(F.hex("digest"))).alias(name))
    content = F.coalesce(F.col(quoted(text)), F.lit("")).cast("binary")
    own = docs.withColumn(name, row(F.col(quoted(key)), F.sha2(content, 256)))
    return own_columns(own.join(kept.hint("merge"), name, "left_semi").dropDuplicates([name]), *docs.columns)
