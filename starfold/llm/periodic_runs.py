"""Runs: stretches of words that repeat with a smallest period and cannot be extended.

Words are appended one by one to a suffix automaton, whose suffix links form a
tree held as link-cut paths (splay trees). All states of such a path have the
same last occurrence. Appending a word opens the path from the new prefix to the root: the path falls into
segments by last occurrence. Where a segment's longest string, ``longest`` words, ended before at distance ``d``, the
last ``longest + d`` words have period ``d``: a square once ``longest >= d``. Then the whole path is recoloured with
the new end. The longest such stretch of each start and period is a run; its ``d`` is its smallest period, since a
smaller one would be the distance of a later occurrence.

Before that, words that no wanted run can hold are left out: within a run of at least ``length`` words and
``exponent`` periods, each ``gram(length, exponent)`` consecutive words occur again one period on. So stretches in which
every gram occurs twice, taken over and over within themselves, hold all wanted runs whole; only these go through the
automaton. Grams are compared by hash here: equal ones have equal hashes, so nothing is lost.

Defined cases: a null or empty text, or one of blanks, has no words and no runs. Each row is a document by itself, repeated
ids and texts included. An empty table gives an empty result; extra columns stay out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import as_bytes, own_columns, rolled, slices, words


def gram(length: int, exponent: int) -> int:
    """Words of the longest gram that occurs again one period on wherever it lies in a wanted run."""
    return min(max(length, exponent * q) - 2 * q + 1 for q in range(1, length + 1))


def live_stretches(hashes: np.ndarray, document: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Stretches (start, end) of words, each within one document, in which every n-gram occurs at least twice."""
    places = np.arange(len(hashes))
    group = document.astype(np.int64)
    while len(places) >= n:
        # grams of n neighbouring words of one stretch; a stretch is a group
        grams = rolled(hashes[places], n)
        inside = group[: len(grams)] == group[n - 1 :]
        at = np.flatnonzero(inside)
        if not len(at):
            return []
        marks = grams[at] ^ (group[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, back, counts = np.unique(marks, return_inverse=True, return_counts=True)
        twice = at[counts[back] > 1]
        cover = np.zeros(len(places) + 1, np.int64)
        np.add.at(cover, twice, 1)
        np.add.at(cover, twice + n, -1)
        stays = np.cumsum(cover[:-1]) > 0
        if stays.all():
            break
        # a new stretch begins where a word was left out or the stretch before ended, or no gram reaches across
        reach = np.zeros(len(places) + 1, np.int64)
        np.add.at(reach, twice + 1, 1)
        np.add.at(reach, twice + n, -1)
        joined = np.cumsum(reach[:-1]) > 0  # this word and the one before lie in one repeated gram
        if n == 1:  # a gram does not reach a neighbour
            joined = np.append(False, (group[1:] == group[:-1]) & stays[:-1])
        places, joined = places[stays], joined[stays]
        group = np.cumsum(~joined)
    if len(places) < n:
        return []
    edges = np.flatnonzero(np.diff(group)) + 1
    firsts, lasts = np.append(0, edges), np.append(edges, len(places))
    return [(int(places[a]), int(places[b - 1]) + 1) for a, b in zip(firsts, lasts, strict=True)]


def runs_of(word: list[int], length: int, exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence, by start and period."""
    longest = {}  # (start, period) -> end
    # suffix automaton: states by number; a state's first way on in two lists, further ones in a dict
    size, link, on_word, on_state, more = [0], [-1], [-1], [0], {}
    # link-cut paths: splay trees over states by depth; the colour (last end) of a path is at its root and is pushed down
    left, right, parent, colour = [-1], [-1], [-1], [-1]

    def step(state: int, c: int) -> int:
        if on_word[state] == c:
            return on_state[state]
        own = more.get(state)
        return own.get(c, -1) if own else -1

    def put(state: int, c: int, to: int) -> None:
        if on_word[state] in (-1, c):
            on_word[state], on_state[state] = c, to
        else:
            more.setdefault(state, {})[c] = to

    def splay(x: int) -> None:
        """Make x the root of its splay tree; colours on the way are uniform within a tree and stay at its root."""
        p = parent[x]
        if p < 0 or (left[p] != x and right[p] != x):
            return
        top, r = x, p
        while r >= 0 and (left[r] == top or right[r] == top):
            top, r = r, parent[r]
        colour[x] = colour[top]
        while True:
            p = parent[x]
            if p < 0 or (left[p] != x and right[p] != x):
                return
            g = parent[p]
            if g >= 0 and (left[g] == p or right[g] == p):
                if (left[g] == p) == (left[p] == x):
                    _rotate(p, left, right, parent)
                else:
                    _rotate(x, left, right, parent)
            _rotate(x, left, right, parent)

    last = 0
    for end, c in enumerate(word):
        # extend the automaton
        cur = len(size)
        size.append(size[last] + 1), link.append(0), on_word.append(-1), on_state.append(0)
        left.append(-1), right.append(-1), parent.append(-1), colour.append(end)
        p = last
        while p >= 0:
            q = step(p, c)
            if q >= 0:
                break
            put(p, c, cur)
            p = link[p]
        if p < 0:
            above = 0
        elif size[q] == size[p] + 1:
            above = q
        else:
            above = len(size)
            size.append(size[p] + 1), link.append(link[q]), on_word.append(on_word[q]), on_state.append(on_state[q])
            if q in more:
                more[above] = dict(more[q])
            while p >= 0 and step(p, c) == q:
                put(p, c, above)
                p = link[p]
            # the clone comes between q and its parent in the tree, with q's colour: q becomes the top of its path
            splay(q)
            left.append(-1), right.append(-1), parent.append(-1), colour.append(colour[q])
            if left[q] >= 0:
                # states above q on its path: they get the clone as their lower end, q hangs below it on the same path
                upper = left[q]
                left[q] = -1
                left[above] = upper
                parent[upper] = above
                parent[above] = parent[q]
                right[above] = q
                parent[q] = above
            else:
                parent[above] = parent[q]
                right[above] = q
                parent[q] = above
            link[q] = above
        link[cur] = above
        parent[cur] = above
        last = cur
        # open the path from cur to the root: segments by last occurrence, then one colour
        below, x = -1, cur
        while x >= 0:
            splay(x)
            if right[x] >= 0:  # the part of this path below x goes on by itself, with its own colour
                colour[right[x]] = colour[x]
            if x != cur and x != 0:
                d, n = end - colour[x], size[x]
                if n >= d * (exponent - 1) and n + d >= length:
                    longest[end - n - d + 1, d] = end
            right[x] = below
            below, x = x, parent[x]
        splay(cur)
        colour[cur] = end
    return [(s, e - s + 1, d) for (s, d), e in sorted(longest.items())]


def _rotate(x: int, left: list, right: list, parent: list) -> None:
    p = parent[x]
    g = parent[p]
    if left[p] == x:
        inner = right[x]
        left[p], right[x] = inner, p
    else:
        inner = left[x]
        right[p], left[x] = inner, p
    if inner >= 0:
        parent[inner] = p
    if g >= 0:
        if left[g] == p:
            left[g] = x
        elif right[g] == p:
            right[g] = x
    parent[p], parent[x] = x, g


def repeated_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words lie in a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) > 0


def periodic_runs(docs: DataFrame, length: int = 6, exponent: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, runs, collapsed): the runs of at least ``length`` words and ``exponent`` periods of each whole text.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. ``runs`` are (start, length, period) by start, then period; ``collapsed`` has the
    words that lie in no run after its first period, joined by one space. One pass, no shuffle.
    """
    if exponent < 2 or length < 2:
        raise ValueError("a run has at least two words and two periods")
    kind, n = docs.schema[key].dataType.simpleString(), gram(length, exponent)
    fields = ("start", "length", "period")
    run_type = pa.list_(pa.struct([(f, pa.int64()) for f in fields]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            data, offsets = as_bytes(texts)
            starts, _, hashes = words(data)
            document = np.searchsorted(offsets, starts, "right") - 1
            firsts = np.searchsorted(document, np.arange(len(texts) + 1))
            stretches: dict[int, list] = {}
            for a, b in live_stretches(hashes, document, n):
                doc = int(document[a])
                stretches.setdefault(doc, []).append((a - int(firsts[doc]), b - int(firsts[doc])))
            all_runs, collapsed = [], []
            for i, t in enumerate(texts):
                own, runs = (t or "").encode().split(), []
                for a, b in stretches.get(i, ()):
                    numbers: dict[bytes, int] = {}
                    runs += [(s + a, k, q) for s, k, q in runs_of([numbers.setdefault(w, len(numbers)) for w in own[a:b]], length, exponent)]
                if runs:
                    gone = repeated_words(len(own), runs)
                    own = [w for w, g in zip(own, gone.tolist(), strict=True) if not g]
                all_runs.append([dict(zip(fields, r, strict=True)) for r in sorted(runs, key=lambda r: (r[0], r[2]))])
                collapsed.append(b" ".join(own).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(np.diff(firsts), pa.int64()), pa.array(all_runs, run_type), pa.array(collapsed, pa.string())],
                names=["k", "n_words", "runs", "collapsed"],
            )

    rows = own_columns(docs, key, text).select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
