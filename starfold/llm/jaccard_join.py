"""Exact near-duplicate join on sets of word n-grams, as classes of linked documents.

1. One pass describes each document: size and fingerprint of its set. Sets with
   equal grams are one class from here on, so copies cost nothing.
2. A second pass sends grams to buckets, where those of two or more classes are
   told. A gram that a block of documents has twice is known to be shared at once: its
   bucket gets it once for the whole block, and its entries go straight to the parts of
   their classes, so a gram of all documents is spread over all parts. Of a class with very many copies
   one document is sent. A block is sent as a row per lane; buckets beyond the number of lanes get their rows
   from many blocks of a lane together, so rows stay long however many buckets there are. Grams of one class come
   first in the order of every set. Only a class whose shared grams alone could
   reach the similarity goes on, with these grams and its size; they are all
   that an overlap can consist of.
3. These sets are listed under the shared grams of their prefixes. Two sets that link
   share one and have close sizes. Within a list sorted by size, neighbours of
   compatible size are chained; the chains' connected components hold every link.
4. A component (many small ones together, a large one as pairs of chunks) is
   joined exactly. Index lists are kept in blocks by set relation: the sets of one
   class. A block is skipped when its sizes or positions rule it out, or when its
   class is already the answer; and where a set is linked to a similar one, the
   overlaps computed for that one bound its own, so they are not computed again.

Grams are 64-bit hashes; a class is named by both halves of a 128-bit fingerprint of its set.

Defined cases: null, empty and blank texts have an empty set and link with
nothing; a text of fewer words than a gram is one gram of all its words; null
keys are ignored in the least key; repeated rows are reported each; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import as_bytes, mix, own_columns, packed, quoted, release, rolled, slices, unpacked, unused, words
from starfold.llm.components import components
from starfold.sources import stage

#: Bytes of text whose grams are compared and sent together, and of the text whose grams share a bucket.
BLOCK, BUCKET_BYTES = 8 << 20, 8 << 20
#: Grams in the sets that one task joins, about, and entries of a lane that are dealt to its buckets together.
GROUP_GRAMS, LOT_GRAMS = 2_000_000, 2_000_000
#: Rows that a block is sent in, for each of its two kinds; beyond so many buckets these get theirs by a second step.
LANES = 2048
#: A class has very many copies if it has at least HOT_COPIES and one in HOT_CLASSES of all documents, so there are no more such classes.
HOT_COPIES, HOT_CLASSES = 1000, 2048


def gram_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted distinct gram hashes of each text; A-Z count as a-z."""
    data, offsets = as_bytes(texts)
    starts, _, hashes = words(data, lower=True)
    first = np.searchsorted(starts, offsets)
    grams = rolled(hashes, n)
    out = []
    for a, b in zip(first.tolist(), first[1:].tolist(), strict=False):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        else:
            out.append(mix(rolled(hashes[a:b], b - a) ^ np.uint64(b - a)) if b > a else np.zeros(0, np.uint64))
    return out


def prefix_length(size, percent: int):
    """Grams among which a set must share one with any set it links to."""
    return size - (percent * size + 99) // 100 + 1


# --- 1: description -----------------------------------------------------------------------

_DESCRIBED = "key long, mark long, n long, class long, other long"


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fingerprint(grams: np.ndarray) -> tuple[int, int]:
    """The name of a class: both halves of a 128-bit hash of its grams."""
    both = xxhash.xxh3_128_intdigest(grams.tobytes())
    return _signed(both & ((1 << 64) - 1)), _signed(both >> 64)


def _describe(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, limit=BLOCK):
        sets = gram_sets(batch.column("text").to_pylist(), n)
        prints = [_fingerprint(s) for s in sets]
        known = [pa.array([len(s) for s in sets], pa.int64()), *(pa.array([p[i] for p in prints], pa.int64()) for i in (0, 1))]
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("mark"), *known], _columns(_DESCRIBED))


# --- 2: shared grams ----------------------------------------------------------------------

#: A row of entries. Places from 0 are buckets of grams; place -1 - p is part p of the classes, whose grams are known to be shared.
_ENTRIES = "place long, grams binary, owners binary, classes binary, sizes binary"


def _buckets(gram: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(gram ^ np.uint64(0xA7)) % np.uint64(buckets)).astype(np.int64)


def _parts(names: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(names[:, 0].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _small(numbers: np.ndarray, classes: int) -> np.ndarray:
    """Numbers of owners in the type that both sides take for so many classes."""
    return numbers.astype(np.uint16 if classes < 65535 else np.uint32)


def _deal(place: np.ndarray, gram: np.ndarray, owner: np.ndarray, names: np.ndarray, sizes: np.ndarray) -> list[tuple]:
    """A row per place: grams, the numbers of their owners (-1, for several: the number after the last), and the owners' classes and sizes."""
    order = np.lexsort((gram, place))
    place, gram, owner = place[order], gram[order], owner[order]
    cuts = [*np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])).tolist(), len(place)] if len(place) else []
    rows = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        own = owner[a:b]
        used = np.unique(own[own >= 0])
        number = _small(np.where(own < 0, len(used), np.searchsorted(used, own)), len(used))
        rows.append((int(place[a]), *map(packed, (gram[a:b], number, names[used], sizes[used]))))
    return rows


def _as_table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * 5
    return pa.table([pa.array(c, pa.int64() if i == 0 else pa.binary()) for i, c in enumerate(columns)], _columns(_ENTRIES))


def _read(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for place, grams, owners, classes, sizes in zip(*(table.column(c).to_pylist() for c in _columns(_ENTRIES)), strict=True):
        names = unpacked(classes, np.int64).reshape(-1, 2)
        number = unpacked(owners, np.uint16 if len(names) < 65535 else np.uint32).astype(np.int64)
        yield place, unpacked(grams, np.uint64), np.where(number == len(names), -1, number), names, unpacked(sizes, np.int64)


def _merged(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Grams, owners, classes and sizes of rows together; classes are equal only if both halves of their names are."""
    every, size = np.concatenate([r[3] for r in rows]), np.concatenate([r[4] for r in rows])
    order = np.lexsort((every[:, 1], every[:, 0]))
    every = every[order]
    new = np.ones(len(every), bool)
    new[1:] = (every[1:] != every[:-1]).any(axis=1)
    number = np.empty(len(every), np.int64)
    number[order] = np.cumsum(new) - 1
    base = np.cumsum([0] + [len(r[3]) for r in rows])
    owner = [np.append(number[a:b], -1)[r[2]] for r, a, b in zip(rows, base, base[1:], strict=False)]  # -1 is the last
    return np.concatenate([r[1] for r in rows]), np.concatenate(owner), every[new], size[order][new]


def _distinct(gram: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries by owner, then gram, each once."""
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    return gram[new], owner[new]


def _send(batches: Iterator[pa.RecordBatch], n: int, buckets: int, lanes: int, hot: dict) -> Iterator[pa.RecordBatch]:
    """Grams of a block by bucket, once each, with the class that has them (nobody's if several have); entries of the latter by class.

    Of a class with very many copies (``hot``: its least key) only that document is sent.
    """
    for batch in slices(batches, limit=BLOCK):
        own: dict[tuple[int, int], np.ndarray] = {}
        for key, s in zip(batch.column("key").to_pylist(), gram_sets(batch.column("text").to_pylist(), n), strict=True):
            if len(s):
                name = _fingerprint(s)
                if hot.get(name, key) == key:
                    own.setdefault(name, s)
        if not own:
            continue
        names, sizes = np.array(list(own), np.int64), np.array([len(s) for s in own.values()], np.int64)
        gram, owner = np.concatenate(list(own.values())), np.repeat(np.arange(len(own)), sizes)
        order = np.argsort(gram, kind="stable")
        gram, owner = gram[order], owner[order]
        first = np.ones(len(gram), bool)
        first[1:] = gram[1:] != gram[:-1]
        several = ~first
        several[:-1] |= ~first[1:]
        rows = _deal(_buckets(gram[first], buckets) % lanes, gram[first], np.where(several, -1, owner)[first], names, sizes)
        rows += _deal(-1 - _parts(names[owner[several]], buckets) % lanes, gram[several], owner[several], names, sizes)
        yield from _as_table(rows).to_batches(max_chunksize=64)


def _split(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of lanes, many blocks of one lane together, as rows of the buckets and parts in it."""
    held: list[tuple] = []
    entries = 0

    def dealt() -> Iterator[pa.RecordBatch]:
        gram, owner, names, sizes = _merged(held)
        gram, owner = _distinct(gram, owner)
        place = _buckets(gram, buckets) if held[0][0] >= 0 else -1 - _parts(names[owner], buckets)
        yield from _as_table(_deal(place, gram, owner, names, sizes)).to_batches(max_chunksize=1024)

    for batch in batches:
        for row in _read(batch):
            if held and (row[0] != held[0][0] or entries + len(row[1]) > LOT_GRAMS):
                yield from dealt()
                held, entries = [], 0
            held.append(row)
            entries += len(row[1])
    if held:
        yield from dealt()


def _by_place(rows: DataFrame, buckets: int, lanes: int) -> DataFrame:
    """Rows of lanes as rows of buckets and parts; the same thing as long as there are no more of these than lanes."""
    if buckets <= lanes:
        return rows
    return rows.repartition("place").sortWithinPartitions("place").mapInArrow(lambda it: _split(it, buckets), _ENTRIES)


def _told(table: pa.Table, buckets: int, lanes: int) -> pa.Table:
    """The shared grams of one bucket, each with its class and the class's size, dealt by class; those known before go on as they are."""
    rows = list(_read(table))
    gram, owner, names, sizes = _merged(rows)
    if rows[0][0] >= 0:
        order = np.argsort(gram, kind="stable")
        gram, owner = gram[order], owner[order]
        start = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
        low, high = np.minimum.reduceat(owner, start), np.maximum.reduceat(owner, start)
        # several of a block have it, or two entries are of different classes
        shared = np.repeat((low < 0) | (low != high), np.diff(np.append(start, len(gram))))
        gram, owner = gram[shared & (owner >= 0)], owner[shared & (owner >= 0)]
    return _as_table(_deal(-1 - _parts(names[owner], buckets) % lanes, gram, owner, names, sizes))


_SETS = "class long, other long, n long, grams binary"


def _gather(table: pa.Table, percent: int) -> pa.Table:
    """The classes of one part whose shared grams could make up a link, with these grams."""
    gram, owner, names, sizes = _merged(list(_read(table)))
    gram, owner = _distinct(gram, owner)  # copies in several blocks tell the same
    cuts = np.searchsorted(owner, np.arange(len(names) + 1)).tolist()
    rows = [
        (*names[i].tolist(), int(sizes[i]), gram[a:b].tobytes())
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if 100 * (b - a) >= percent * sizes[i]
    ]
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.table([pa.array(c, pa.binary() if i == 3 else pa.int64()) for i, c in enumerate(columns)], _columns(_SETS))


# --- 3: candidates ------------------------------------------------------------------------

#: A class that goes on: its number, the size of its set and its shared grams.
_MEMBER = ["id", "n", "grams"]
_LISTED = "bucket long, grams binary, reps binary, lows binary, highs binary, a binary, b binary"


def _chains(gram: np.ndarray, low: np.ndarray, high: np.ndarray, percent: int) -> np.ndarray:
    """Whether each element, sorted by gram and low, goes on the chain of the one before it."""
    on = np.zeros(len(gram), bool)
    same = np.flatnonzero(gram[1:] == gram[:-1]) + 1
    if (low == high).all():
        on[same] = percent * low[same] <= 100 * low[same - 1]
        return on
    top = high.copy()
    for i in same.tolist():
        if percent * low[i] <= 100 * top[i - 1]:
            on[i], top[i] = True, max(top[i], top[i - 1])
    return on


def _list(batches: Iterator[pa.RecordBatch], percent: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """A row per bucket and batch: chains of the sets listed under each gram (gram, least class, sizes at the ends), and their links."""
    for batch in batches:
        grams, sizes, classes = [], [], []
        for cls, n, own in zip(*(batch.column(c).to_pylist() for c in _MEMBER), strict=True):
            own = np.frombuffer(own, np.uint64)
            own = own[: prefix_length(n, percent) - (n - len(own))]  # grams of one class come first
            grams.append(own)
            sizes.append(np.full(len(own), n, np.int64))
            classes.append(np.full(len(own), cls, np.int64))
        if not grams:
            continue
        gram, size, cls = (np.concatenate(x) for x in (grams, sizes, classes))
        bucket = _buckets(gram, buckets)
        order = np.lexsort((cls, size, gram, bucket))
        gram, size, cls, bucket = gram[order], size[order], cls[order], bucket[order]
        on = _chains(gram, size, size, percent)
        head = np.flatnonzero(~on)
        chain = np.cumsum(~on) - 1
        rep, low, high = cls[head], size[head], size[np.append(head[1:], len(gram)) - 1]
        linked = np.flatnonzero(on & (cls != rep[chain]))
        cuts = np.flatnonzero(np.diff(bucket[head], prepend=-1))
        out: list[list] = [[] for _ in _columns(_LISTED)]
        for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(head)], strict=True):
            own = linked[np.searchsorted(linked, head[i]) : np.searchsorted(linked, head[j] if j < len(head) else len(gram))]
            pairs = np.unique(np.stack([rep[chain[own]], cls[own]]), axis=1) if len(own) else np.zeros((2, 0), np.int64)
            row = [int(bucket[head[i]]), *map(packed, (gram[head[i:j]], rep[i:j], low[i:j], high[i:j], pairs[0], pairs[1]))]
            for column, value in zip(out, row, strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64() if i == 0 else pa.binary()) for i, v in enumerate(out)], _columns(_LISTED))


def _connect(table: pa.Table, percent: int) -> pa.Table:
    """Candidate pairs of one bucket: chains made before, and those that the blocks' chains form together."""

    def whole(name: str, kind) -> np.ndarray:
        return np.concatenate([unpacked(x.as_py(), kind) for x in table.column(name)])

    gram, rep, low, high = whole("grams", np.uint64), whole("reps", np.int64), whole("lows", np.int64), whole("highs", np.int64)
    order = np.lexsort((low, gram))
    gram, rep, low, high = gram[order], rep[order], low[order], high[order]
    on = np.flatnonzero(_chains(gram, low, high, percent))
    pairs = np.concatenate([np.stack([rep[on - 1], rep[on]]), np.stack([whole("a", np.int64), whole("b", np.int64)])], axis=1)
    pairs = np.unique(np.sort(pairs[:, pairs[0] != pairs[1]], axis=0), axis=1)
    return pa.table({"a": pa.array(pairs[0], pa.int64()), "b": pa.array(pairs[1], pa.int64())})


# --- 4: links ------------------------------------------------------------------------------


def linked_classes(names: list[int], sets: list[np.ndarray], percent: int, whole: list[int] | None = None) -> dict[int, int]:
    """Least name of the class of each set, over all links among the sets.

    ``whole`` gives the sizes of the sets where ``sets`` leaves out grams that no other set has.
    """
    whole = whole or [len(s) for s in sets]
    order = sorted(range(len(sets)), key=lambda i: (whole[i], names[i]))
    sizes = [whole[i] for i in order]
    every, inverse, count = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True, return_counts=True)
    rank = np.empty(len(every), np.int64)
    rank[np.lexsort((every, count))] = np.arange(len(every))  # rare grams first
    alone = int((count == 1).sum())  # grams of one set only have the lowest ranks
    ranked = [np.sort(x) for x in np.split(rank[inverse], np.cumsum([len(sets[i]) for i in order])[:-1])]
    parent = list(range(len(order)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    lists: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(dict)
    overlaps: list[dict[int, int]] = [{} for _ in order]
    marked = np.zeros(len(every), bool)
    for y, own in enumerate(ranked):
        size = sizes[y]
        smallest = (percent * size + 99) // 100
        marked[own] = True
        similar, apart = -1, 0  # a set that y is linked to, and the grams of y that it lacks
        missing = size - len(own)  # come before the others
        prefix = list(enumerate(own[: max(0, prefix_length(size, percent) - missing)].tolist(), missing))
        for i, gram in prefix:
            if gram < alone:
                continue
            for root, block in list(lists[gram].items()):
                if find(root) == find(y):
                    continue  # the whole block is in y's class
                if sizes[block[-1][0]] < smallest:
                    continue  # sizes rise along a block
                for x, j in reversed(block):
                    if sizes[x] < smallest:
                        break
                    need = -(-percent * (size + sizes[x]) // (100 + percent))
                    if min(size - i, sizes[x] - j) < need or x in overlaps[y]:
                        continue
                    known = overlaps[similar].get(x, overlaps[x].get(similar)) if similar >= 0 else None
                    if known is not None and known + apart < need:
                        continue
                    common = int(marked[ranked[x]].sum())
                    overlaps[y][x] = common
                    if common >= need:
                        parent[max(find(x), find(y))] = min(find(x), find(y))
                        similar, apart = x, size - common
                        break
        for i, gram in prefix:
            if gram >= alone:
                blocks = lists[gram]
                for root in [r for r in blocks if find(r) != r]:  # classes that met since
                    block = blocks.pop(root)
                    top = find(root)
                    blocks[top] = sorted(blocks[top] + block) if top in blocks else block
                blocks.setdefault(find(y), []).append((y, i))
        marked[own] = False
    least: dict[int, int] = {}
    for y in range(len(order)):
        root = find(y)
        least[root] = min(least.get(root, names[order[y]]), names[order[y]])
    return {names[order[y]]: least[find(y)] for y in range(len(order))}


def _join_group(table: pa.Table, percent: int) -> pa.Table:
    rows = {c: (n, np.frombuffer(g, np.uint64)) for c, n, g in zip(*(table.column(c).to_pylist() for c in _MEMBER), strict=True)}
    roots = linked_classes(list(rows), [g for _, g in rows.values()], percent, [n for n, _ in rows.values()])
    return pa.table({"a": pa.array(list(roots), pa.int64()), "b": pa.array(list(roots.values()), pa.int64())})


# --- the join ------------------------------------------------------------------------------


def similarity_classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80,
    group_grams: int = GROUP_GRAMS, bucket_bytes: int = BUCKET_BYTES, lanes: int = LANES, hot_copies: int = HOT_COPIES,
) -> DataFrame:
    """One row per document: key, mark (xxhash64 of the text), n_grams, component_id, root.

    ``component_id`` is the least key reachable by links; ``root`` names the
    component itself, null for an empty set.
    """
    rows = own_columns(docs, key, text).select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("mark"))
    described = stage(rows.mapInArrow(lambda it: _describe(it, n), _DESCRIBED), "jaccard-sets")
    name = ["class", "other"]
    classes = described.filter("n > 0").groupBy(*name).agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = stage(classes, "jaccard-classes")
    often = max(hot_copies, (classes.agg(F.sum("copies")).first()[0] or 0) / HOT_CLASSES)
    hot = {(r["class"], r["other"]): r["least"] for r in classes.filter(F.col("copies") >= often).collect()}  # at most HOT_CLASSES
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, total // bucket_bytes)
    lanes = min(buckets, lanes)
    sent = _by_place(rows.select("key", "text").mapInArrow(lambda it: _send(it, n, buckets, lanes, hot), _ENTRIES), buckets, lanes)
    shared = _by_place(sent.groupBy("place").applyInArrow(lambda t: _told(t, buckets, lanes), _ENTRIES), buckets, lanes)
    near = shared.groupBy("place").applyInArrow(lambda t: _gather(t, percent), _SETS).withColumn("id", F.monotonically_increasing_id())
    near = stage(near, "jaccard-shared")
    del sent, shared
    release(rows.sparkSession)
    listed = near.select(*_MEMBER).mapInArrow(lambda it: _list(it, percent, buckets), _LISTED)
    pairs = listed.groupBy("bucket").applyInArrow(lambda t: _connect(t, percent), "a long, b long").distinct()
    candidates = stage(components(stage(pairs, "jaccard-pairs")), "jaccard-candidates")

    members = candidates.join(near, candidates["node"] == near["id"]).select("root", *_MEMBER)
    sizes = candidates.join(near.select("id", "n"), candidates["node"] == near["id"]).groupBy("root").agg(F.sum("n").alias("sum"))
    sizes = stage(sizes.withColumn("chunks", F.ceil(F.col("sum") / (4 * group_grams))), "jaccard-sizes")
    small = max(1, (sizes.filter("chunks = 1").agg(F.sum("sum")).first()[0] or 0) // group_grams)
    own = F.pmod(F.xxhash64("id"), "chunks")
    dealt = members.join(sizes, "root").withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))})
    one = F.concat(F.lit("s"), F.pmod(F.xxhash64("root"), F.lit(small)))
    several = F.concat_ws(" ", "root", F.least("own", "other"), F.greatest("own", "other"))
    dealt = dealt.withColumn("group", F.when(F.col("chunks") == 1, one).otherwise(several)).select("group", *_MEMBER)
    found = stage(dealt.groupBy("group").applyInArrow(lambda t: _join_group(t, percent), "a long, b long"), "jaccard-links")
    if sizes.filter("chunks > 1").isEmpty():
        roots = found.select(F.col("a").alias("id"), F.col("b").alias("root"))
    else:
        roots = components(found).withColumnRenamed("node", "id")
    linked = roots.join(near.select("id", *name), "id").select(*name, F.col("root").cast("string").alias("root"))
    in_class = classes.join(linked, name, "left").withColumn("root", F.coalesce("root", F.concat_ws(" ", *name)))
    least = in_class.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(in_class.join(least, "root").select(*name, "root", "component_id"), "jaccard-components")
    return described.join(named, name, "left").select(
        F.col("key").alias(key), "mark", F.col("n").alias("n_grams"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("root")).alias("root"),
    )


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """The documents, with the columns they had, less all but the least key of each component."""
    found = similarity_classes(docs, key, text, n, percent).filter(F.col(key).eqNullSafe(F.col("component_id")))
    # key and mark as one string: texts are shuffled by it once, for the join and for repeated rows
    row, name = lambda k, mark: F.concat_ws(" ", mark.cast("string"), F.coalesce(k.cast("long").cast("string"), F.lit("-"))), unused(docs, "row")
    first = found.groupBy("root", F.col(quoted(key)).alias("key")).agg(F.min("mark").alias("mark")).select(row(F.col("key"), F.col("mark")).alias(name))
    own = docs.withColumn(name, row(F.col(quoted(key)), F.xxhash64(F.col(quoted(text)))))
    return own_columns(own.join(first.hint("merge"), name, "left_semi").dropDuplicates([name]), *docs.columns)
