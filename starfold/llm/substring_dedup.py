"""Repeated passages: windows of words that an earlier document has, found through super-k-mers.

A window is a run of ``window`` words. Its minimiser is the least hash among its
runs of ``gram`` words; consecutive windows that share one are a super-k-mer and
travel together, as one packed string, to the bucket of that minimiser, so all
equal windows meet there. In the bucket the windows are sorted and equal ones,
compared by their words, get the least key among their documents. A window is
repeated where that key is less than its document's own.

A bucket with many rows is dealt to several tasks. Each finds the windows that
are repeated within its share; the few left at a share's least key are compared
across shares by a window function over (words, share), one row for each.

Defined cases: a null text has no words; a row with a null key keeps all words
and repeats nobody's; rows equal in key and text are treated alike, and rows of
one key never repeat each other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starfold.llm.common import as_bytes, mix, own_columns, packed, quoted, release, rolled, slices, unpacked, unused, words
from starfold.sources import stage

#: Words in the runs whose hashes are compared for the minimiser.
GRAM = 3
#: Bytes of text that should meet in a bucket, and rows of packed strings beyond which it is split.
BUCKET_BYTES = 1 << 20
#: Text packed at once by a task.
PACK_BYTES = 8 << 20
#: Windows in a super-k-mer at most; a longer one goes on in a second string.
LONGEST = 4096

_SPACES = bytes(range(9, 14))
_SINGLE = bytes.maketrans(_SPACES, b" " * len(_SPACES))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` elements."""
    span = 1
    while span < width:
        step = min(span, width - span)
        x = np.minimum(x[:-step], x[step:])
        span += step
    return x


def _super_kmers(texts: list[str | None], window: int, gram: int):
    """Of each super-k-mer: row of its text, first word (counted in the text), minimiser, bytes."""
    data, offsets = as_bytes(texts)
    starts, ends, hashes = words(data)
    if len(hashes) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), []
    first_word = np.searchsorted(starts, offsets)
    owner = np.repeat(np.arange(len(texts)), np.diff(first_word))
    least = _least(rolled(hashes, gram), window - gram + 1)
    at = np.arange(len(least))
    at = at[owner[: len(least)] == owner[window - 1 :]]
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), []
    row, low = owner[at], least[at]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (low[1:] != low[:-1]) | (row[1:] != row[:-1]) | (at[1:] % LONGEST == 0)
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(at)) - 1
    a, b = at[begin], at[last] + window - 1
    plain = data.tobytes().translate(_SINGLE)
    strings = [plain[i:j] for i, j in zip(starts[a].tolist(), ends[b].tolist(), strict=True)]
    if (starts[1:] - ends[:-1] > 1).any():
        strings = [b" ".join(s.split()) if b"  " in s else s for s in strings]
    return row[begin], a - first_word[row[begin]], low[begin], strings


def _bucket(least: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(least ^ np.uint64(0xB5)) % np.uint64(buckets)).astype(np.int64)


def _bucket_sizes(batches: Iterator[pa.RecordBatch], window: int, gram: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """A row per slice of text and bucket that it has strings for, however many buckets there are."""
    for batch in slices(batches, limit=PACK_BYTES):
        _, _, least, strings = _super_kmers(batch.column("text").to_pylist(), window, gram)
        used, which = np.unique(_bucket(least, buckets), return_inverse=True)
        size = np.bincount(which, weights=[len(s) for s in strings], minlength=len(used)).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(used, pa.int64()), "bytes": pa.array(size, pa.int64())})


_PACKED = "bucket long, part long, texts binary, sizes binary, which binary, keys binary, marks binary, at binary"


def _pack(batches: Iterator[pa.RecordBatch], window: int, gram: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """A row per bucket and batch: its distinct strings, and for each occurrence string, key, mark and first word."""
    for batch in slices(batches, limit=PACK_BYTES):
        row, at, least, strings = _super_kmers(batch.column("text").to_pylist(), window, gram)
        if not len(row):
            continue
        keys, marks = (batch.column(c).to_numpy() for c in ("key", "mark"))
        bucket = _bucket(least, buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(bucket[order])) + 1).tolist(), len(order)]
        out: dict[str, list] = {c.split()[0]: [] for c in _PACKED.split(", ")}
        for a, b in zip(cuts, cuts[1:], strict=False):
            own = order[a:b]
            number: dict[bytes, int] = {}
            which = [number.setdefault(strings[i], len(number)) for i in own.tolist()]
            out["bucket"].append(int(bucket[own[0]]))
            out["part"].append(int(mix(np.array([keys[row[own[0]]]]).view(np.uint64))[0] >> np.uint64(1)))
            out["texts"].append(packed(np.frombuffer(b"".join(number), np.uint8)))
            out["sizes"].append(packed(np.fromiter(map(len, number), np.uint32, len(number))))
            out["which"].append(packed(np.array(which, np.uint32)))
            out["keys"].append(packed(keys[row[own]]))
            out["marks"].append(packed(marks[row[own]]))
            out["at"].append(packed(at[own].astype(np.uint32)))
        kinds = {"bucket": pa.int64(), "part": pa.int64()}
        yield pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.binary())) for c, v in out.items()})


_FOUND = "key long, mark long, at long, n long, words binary"


def _meet(table: pa.Table, window: int) -> pa.Table:
    """Repeated runs of windows of one share of a bucket; if it is split, also the windows left at the least key."""
    shared = bool(table.num_rows) and table.column("parts")[0].as_py() > 1
    text, size, which, keys, marks, at, seen = [], [], [], [], [], [], 0
    for r in range(table.num_rows):
        get = lambda name, kind, r=r: unpacked(table.column(name)[r].as_py(), kind)
        sizes = get("sizes", np.uint32)
        text.append(get("texts", np.uint8))
        size.append(sizes.astype(np.int64))
        which.append(get("which", np.uint32).astype(np.int64) + seen)
        keys.append(get("keys", np.int64))
        marks.append(get("marks", np.int64))
        at.append(get("at", np.uint32).astype(np.int64))
        seen += len(sizes)
    size, which, keys, marks, at = (np.concatenate(x) for x in (size, which, keys, marks, at))
    data = np.full(int(size.sum()) + seen, 32, np.uint8)  # a blank after each string
    begin = np.cumsum(size + 1) - size - 1
    data[np.arange(int(size.sum())) + np.repeat(np.arange(seen), size)] = np.concatenate(text)
    starts, ends, hashes = words(data)
    first = np.searchsorted(starts, np.append(begin, len(data)))
    counts = np.diff(first) - window + 1  # windows of each string
    base = np.cumsum(counts) - counts
    string = np.repeat(np.arange(seen), counts)
    place = np.arange(len(string)) - base[string] + first[:-1][string]  # first word of each window
    one, two = rolled(hashes, window)[place], rolled(mix(hashes ^ np.uint64(0x5C5C)), window)[place]
    least = np.full(seen, np.iinfo(np.int64).max)
    np.minimum.at(least, which, keys)
    most = np.full(seen, np.iinfo(np.int64).min)
    np.maximum.at(most, which, keys)
    order = np.lexsort((two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    raw = data.tobytes()
    a, b = starts[place], ends[place + window - 1]
    for i in np.flatnonzero(~new).tolist():  # equal hashes: the words decide
        x, y = order[i - 1], order[i]
        if raw[a[x] : b[x]] != raw[a[y] : b[y]]:
            raise ValueError("two windows share a 128-bit hash; run with another gram")
    low = np.zeros(len(order), np.int64)
    low[order] = np.repeat(np.minimum.reduceat(least[string[order]], np.flatnonzero(new)), np.diff(np.append(np.flatnonzero(new), len(order))))
    may = np.zeros(seen, bool)
    np.logical_or.at(may, string, low < most[string])
    hit = np.flatnonzero(may[which] | shared)
    each = np.repeat(hit, counts[which[hit]])  # occurrence of each of its windows
    within = np.arange(len(each)) - np.repeat(np.cumsum(counts[which[hit]]) - counts[which[hit]], counts[which[hit]])
    window_of = base[which[each]] + within
    later = keys[each] > low[window_of]
    on, spot = each[later], (at[each] + within)[later]
    head = np.ones(len(on), bool)
    head[1:] = (on[1:] != on[:-1]) | (np.diff(spot) != 1)
    runs = np.flatnonzero(head)
    out = {
        "key": keys[on[runs]], "mark": marks[on[runs]], "at": spot[runs],
        "n": np.diff(np.append(runs, len(on))), "words": [None] * len(runs),
    }
    if shared:
        left = np.flatnonzero(~later)
        w = window_of[left]
        extra = {
            "key": keys[each[left]], "mark": marks[each[left]], "at": (at[each] + within)[left], "n": np.ones(len(left), np.int64),
            "words": [raw[i:j] for i, j in zip(a[w].tolist(), b[w].tolist(), strict=True)],
        }
        out = {c: np.concatenate([out[c], extra[c]]) if c != "words" else out[c] + extra[c] for c in out}
    return pa.table({c: pa.array(v, pa.binary() if c == "words" else pa.int64()) for c, v in out.items()})


def repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 13, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Runs of repeated windows: (key, mark, at, n), the first word and the number of windows.

    ``mark`` is xxhash64 of the text; with the key it tells rows apart. A window
    may be in several runs.
    """
    rows = own_columns(docs, key, text).filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("mark")
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, total // bucket_bytes)
    sizes = rows.select("text").mapInArrow(lambda it: _bucket_sizes(it, window, gram, buckets), "bucket long, bytes long")
    # a super-k-mer of windows sharing a minimiser repeats each word about three times, so a mean bucket holds 3 * bucket_bytes
    crowded = sizes.groupBy("bucket").agg(F.sum("bytes").alias("bytes")).filter(F.col("bytes") > 12 * bucket_bytes)
    split = stage(crowded.select("bucket", F.ceil(F.col("bytes") / (6 * bucket_bytes)).alias("parts")), "passages-crowded")
    strings = rows.mapInArrow(lambda it: _pack(it, window, gram, buckets), _PACKED)
    dealt = strings.join(F.broadcast(split) if split.count() <= 100_000 else split, "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod("part", "parts"))
    found = stage(dealt.groupBy("bucket", "part").applyInArrow(lambda t: _meet(t, window), _FOUND), "passages-found")
    del strings, dealt
    release(rows.sparkSession)
    across = found.filter("words is not null").withColumn("low", F.min("key").over(Window.partitionBy("words")))
    return found.filter("words is null").drop("words").unionByName(across.filter("key > low").drop("words", "low"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 13, into: str = "passages") -> DataFrame:
    """Every document with a struct ``into``: n_words, n_removed, kept_text (the words kept, joined by one space) and spans.

    Spans are [first word, number of words) removed. A column called like ``into`` is replaced.
    """
    found = repeated_windows(docs, key, text, window).groupBy("key", "mark").agg(F.collect_set(F.struct("at", "n")).alias("runs"))

    @F.pandas_udf("n_words long, n_removed long, kept_text string, spans array<struct<at:long,n:long>>")
    def remove(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
        out = []
        for t, r in zip(texts, runs, strict=True):
            own = t.encode().split() if t is not None else []
            spans: list[list[int]] = []
            for x in sorted(r, key=lambda x: x["at"]) if r is not None else []:
                at, end = x["at"], x["at"] + x["n"] + window - 1
                if spans and at <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], end)
                else:
                    spans.append([at, end])
            kept, done = [], 0
            for at, end in spans:
                kept += own[done:at]
                done = end
            kept += own[done:]
            out.append((len(own), len(own) - len(kept), b" ".join(kept).decode(), [{"at": i, "n": j - i} for i, j in spans]))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept_text", "spans"])

    mark, *names = (unused(docs, name) for name in ("own_mark", "found_key", "found_mark", "found_runs"))
    found = found.select(*[F.col(c).alias(n) for c, n in zip(("key", "mark", "runs"), names, strict=True)])
    own = docs.withColumn(mark, F.xxhash64(F.col(quoted(text))))
    met = own.join(found, (F.col(quoted(key)).cast("long") == F.col(names[0])) & (F.col(mark) == F.col(names[1])), "left")
    kept = [F.col(quoted(c)) for c in docs.columns if c != into]
    return met.select(*kept, remove(F.col(quoted(text)), F.col(names[2])).alias(into))
