import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starfold.llm import exact_dedup, jaccard_join, substring_dedup
from starfold.llm.components import components
from starfold.operators.skew import Limits


def test_filter_has_every_key_and_few_others():
    keys = np.random.default_rng(3).integers(0, 2**63, 40_000).astype(np.uint64)
    for n in (0, 1, 2, 3, 50, 40_000):
        built = exact_dedup.build_filter(keys[:n])
        assert exact_dedup.probe_filter(keys[:n], *built).all()
        assert n < 50 or exact_dedup.probe_filter(keys[:n] + np.uint64(1), *built).mean() < 0.02


def brute_groups(rows):
    groups = {}
    for key, text, *_ in rows:
        groups.setdefault((text or "").encode(), []).append(key)
    low = lambda k: -1 if k is None else k
    out = []
    for key, text, *_ in rows:
        own = groups[(text or "").encode()]
        keep = max(own, key=low)
        out.append((key, hashlib.sha256((text or "").encode()).hexdigest(), keep, len(own), key == keep))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches", [1, 2, 4])
def test_exact_dedup(docs, rows, table, batches):
    found = exact_dedup.exact_dedup(docs, batches=batches)
    assert table(found.select("doc_id", F.lower(F.hex("digest")), "keep_id", "group_size", "kept")) == brute_groups(rows)


def test_equal_digests_of_different_bytes_stay_apart(spark, docs):
    rows = exact_dedup.digests(docs).cache()
    batch = exact_dedup.group_batch(rows)
    other = batch.withColumn("keep", F.lit(0).cast("long"))  # an entry whose kept text is another one
    snapshot = exact_dedup.publish(other.filter("n_bytes = 35"))
    after = exact_dedup.ingest(snapshot, rows.filter("n_bytes = 35"), docs)
    assert after.count() == 2


def test_keep_one(docs, rows, nothing):
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["text"] or "" for r in kept.collect()) == sorted({r[1] or "" for r in rows})
    assert exact_dedup.keep_one(nothing).count() == 0 == exact_dedup.exact_dedup(nothing).count()


def brute_classes(rows, n, percent):
    sets = []
    for _, text, *_ in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    least = {}
    for i, (key, *_) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((k, len(sets[i]), least.get(find(i)) if sets[i] else k) for i, (k, *_) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("n,percent,group", [(4, 85, 2_000_000), (5, 80, 2_000_000), (3, 60, 2_000_000), (4, 85, 150), (2, 50, 150)])
def test_similarity_classes(docs, rows, table, n, percent, group):
    found = jaccard_join.similarity_classes(docs, n=n, percent=percent, group_grams=group)
    assert table(found.select("doc_id", "n_grams", "component_id")) == brute_classes(rows, n, percent)


@pytest.mark.parametrize("lanes", [3, 50, 1 << 20])
def test_buckets_of_any_number(docs, rows, table, lanes):
    found = jaccard_join.similarity_classes(docs, n=4, percent=85, bucket_bytes=400, lanes=lanes, hot_copies=4)
    assert table(found.select("doc_id", "n_grams", "component_id")) == brute_classes(rows, 4, 85)


def test_rows_sent_do_not_grow_with_the_buckets(docs):
    def sent(buckets, lanes=16):
        rows = docs.selectExpr("cast(doc_id as long) as key", "text").repartition(3)
        return rows.mapInArrow(lambda it: jaccard_join._send(it, 4, buckets, min(buckets, lanes), {}), jaccard_join._ENTRIES)

    many = sent(1 << 20)
    size = lambda df: df.agg(F.sum(F.octet_length("grams") + F.octet_length("owners") + F.octet_length("classes"))).first()[0]
    assert many.count() <= sent(16).count() <= 3 * 2 * 16
    assert size(many) < 2 * size(sent(16))
    dealt = jaccard_join._by_place(many, 1 << 20, 16)
    places = dealt.groupBy("place").count()
    assert dealt.filter("place >= 0").count() <= 3 * places.filter("place >= 0").count()


def test_classes_that_share_half_a_name_stay_apart():
    row = lambda grams, names: (0, np.array(grams, np.uint64), np.arange(len(grams)), np.array(names, np.int64), np.full(len(names), 9))
    gram, owner, names, sizes = jaccard_join._merged([row([1, 2], [[5, 1], [5, 2]]), row([1, 2], [[5, 2], [6, 1]])])
    assert names.tolist() == [[5, 1], [5, 2], [6, 1]] and owner.tolist() == [0, 1, 1, 2]
    table = jaccard_join._as_table(jaccard_join._deal(np.zeros(4, np.int64), gram, owner, names, sizes))
    told = [r for r in jaccard_join._read(jaccard_join._told(table, 1, 1))]
    assert sorted((g, *c) for _, gs, o, cs, _ in told for g, c in zip(gs.tolist(), cs[o].tolist(), strict=True)) == [(1, 5, 1), (1, 5, 2), (2, 5, 2), (2, 6, 1)]


def test_linked_classes_against_all_pairs():
    rnd = np.random.default_rng(5)
    base = rnd.integers(0, 1 << 60, (6, 60)).astype(np.uint64)
    sets = [np.unique(np.where(rnd.random(60) < rnd.random() * 0.25, rnd.integers(0, 1 << 60, 60).astype(np.uint64), base[i % 6])) for i in range(150)]
    for percent in (60, 85, 95):
        found = jaccard_join.linked_classes(list(range(150)), sets, percent)
        parent = list(range(150))
        for i in range(150):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    a, b = parent[i], parent[j]
                    parent = [min(a, b) if p in (a, b) else p for p in parent]
        assert [found[i] for i in range(150)] == parent


def test_keep_one_of_each(docs, rows, nothing):
    kept = jaccard_join.keep_one_of_each(docs, n=4, percent=85)
    assert kept.columns == docs.columns
    classes = brute_classes(rows, 4, 85)
    assert {r["doc_id"] for r in kept.collect()} == {k for k, _, c in classes if k == c}
    assert jaccard_join.keep_one_of_each(nothing).count() == 0


def test_components(spark, table):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7), (200, 200)], "a long, b long")
    assert table(components(edges)) == sorted([(i, 0) for i in range(41)] + [(100, 100), (101, 100), (103, 100), (200, 200)], key=repr)
    assert components(edges.limit(0)).count() == 0


def test_components_of_hubs(spark, table):
    star = [(5, i) for i in range(20, 400)] + [(i, 1000 + i % 7) for i in range(300, 390)] + [(2000 + i, 3000) for i in range(300)]
    edges = spark.createDataFrame(star, "a long, b long").repartition(6)
    found = components(edges, Limits(hot_rows=50, hot_keys=8))
    assert table(found) == table(components(edges))
    assert {r["root"] for r in found.collect()} == {5, 2000}


def brute_removal(rows, window):
    first = {}
    for key, text, *_ in rows:
        w = (text or "").encode().split()
        for i in range(len(w) - window + 1 if key is not None else 0):
            g = tuple(w[i : i + window])
            first[g] = min(first.get(g, key), key)
    out = []
    for key, text, *_ in rows:
        w = (text or "").encode().split()
        gone = set()
        for i in range(len(w) - window + 1 if key is not None else 0):
            if first[tuple(w[i : i + window])] < key:
                gone.update(range(i, i + window))
        out.append((key, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [13, 5])
def test_remove_repeats(docs, rows, table, window):
    found = substring_dedup.remove_repeats(docs, window=window)
    assert sorted(found.columns) == sorted(docs.columns)
    assert table(found.select("doc_id", "passages.n_words", "passages.n_removed", "passages.kept_text")) == brute_removal(rows, window)


def test_crowded_buckets_are_split(docs, rows, table, monkeypatch):
    monkeypatch.setattr(substring_dedup, "PACK_BYTES", 1 << 12)
    whole = substring_dedup.repeated_windows(docs)
    split = substring_dedup.repeated_windows(docs, bucket_bytes=16)
    spots = lambda df: {(r["key"], r["mark"], r["at"] + i) for r in df.collect() for i in range(r["n"])}
    assert spots(whole) == spots(split) != set()


def test_no_documents(nothing):
    assert substring_dedup.remove_repeats(nothing).count() == 0


def test_a_large_batch_meets_a_small_snapshot_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BUCKET_ROWS", 50)
    docs = spark.createDataFrame([(i, f"text {max(i, 3) % 900}") for i in range(1000)], "doc_id long, text string").repartition(3)
    rows = exact_dedup.digests(docs)
    old = exact_dedup.publish(exact_dedup.group_batch(rows.filter("key = 5")))
    batch = exact_dedup.group_batch(rows.filter("key <> 5"))
    assert old.buckets == 1
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = exact_dedup.screen(batch, old, 999)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == batch.count() and max(sizes) < 0.5 * sum(sizes)
        assert found.filter("maybe").count() >= 1 and found.filter("maybe").select("digest").subtract(old.entries.select("digest")).count() < 20
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
