"""Personal data: identifiers of fixed form, and unseen ones found by the words around them.

Entities that match the fixed forms are seeds. The words around a seed are its lexical
patterns: two before, one on each side, two after. Other strings that look like identifiers, but match
no form, are candidates; they have patterns too. Patterns and instances (entities and candidates by their normal
form) make a graph, scored in rounds by Spark:

- a pattern's score for a kind is the part of its distinct instances that are of the kind, accepted candidates by their own
  scores, ``known / (all + 1)``; it is trusted with ``support`` known instances and a score of ``trust``;
- a candidate's score is ``1 - prod(1 - score)`` over its trusted patterns; with ``accept`` it counts as known from then on.

Rounds end when nothing changes, or after ``rounds``. All occurrences of accepted candidates are spans; a candidate that is
a seed elsewhere, such as a telephone number without its plus, is accepted at once. Seeds always stay.

Edges are distinct before they are counted, so copies of a text weigh once, and sums are partial before they are
shuffled. Trusted patterns and accepted candidates are broadcast up to ``BROADCAST_ROWS`` rows of 28 bytes each, and joined by sort and merge beyond.

Defined cases: a null or empty text has no spans. Positions are code points. Each row is a document by itself, also where ids
repeat or are null. An empty table gives an empty result; extra columns stay out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import fresh_path, own_columns, slices
from starfold.sources import write_table

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
BROADCAST_ROWS = 1_000_000
#: Digits of a score: the order in which sums are added up does not show.
DIGITS = 9
#: Characters on each side of a span in which its neighbouring words are looked for.
WINDOW = 60

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# possessive: a run that does not match is read once, not once from each of its characters
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_QUAD = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CHAIN = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_DIAL = re.compile(r"\+[0-9][ ().0-9-]++")
_GROUPED = re.compile(r"\(?[0-9][ ().0-9/-]*+")
_COLONS = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_AROUND = re.compile(r"[^\s@,;:<>\"'()\[\]{}]++")
_BREAK = frozenset(" \t\n\r\x0b\x0c@,;:<>\"'()[]{}")
_OUTER = re.compile(r"^\W+|\W+$")
_DIGIT, _NO_DIGIT = re.compile(r"[0-9]"), re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _DOMAIN.finditer(text):
        start = at = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            yield start, m.end()
            done = m.end()


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in _QUAD.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (q.lstrip("0") or "0" for q in m.group().split("."))):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CHAIN.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NO_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _DIAL.finditer(text):
        end = m.end()
        while not "0" <= text[end - 1] <= "9":
            end -= 1
        if end - m.start() >= 4 and 9 <= len(_NO_DIGIT.sub("", text[m.start() : end])) <= 15:
            yield m.start(), end


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed forms, by kind, then start."""
    finders = (emails, addresses, cards, phones)
    return [(kind, s, e) for kind, find in enumerate(finders) for s, e in find(text)]


def candidate_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(kinds as bits, start, end) of strings that look like an identifier and touch no taken span, by start."""
    found = []
    at = text.find("@")
    while at >= 0:
        start, after = at, _AROUND.match(text, at + 1)
        while start > 0 and text[start - 1] not in _BREAK and not text[start - 1].isspace():
            start -= 1
        if after and start < at:
            found.append((1 << EMAIL, start, after.end()))
        at = text.find("@", after.end() if after else at + 1)
    for m in _GROUPED.finditer(text):
        start, end = m.start(), m.end()
        if end - start < 7:
            continue
        while not "0" <= text[end - 1] <= "9":
            end -= 1
        n = len(_NO_DIGIT.sub("", text[start:end]))
        kinds = (7 <= n <= 15) << PHONE | (12 <= n <= 19) << CARD | bool(_QUAD.fullmatch(text, start, end)) << IP
        if kinds and not text[max(0, start - 1) : start].isalnum() and not text[end : end + 1].isalnum():
            found.append((kinds, start, end))
    found += [(1 << IP, *m.span()) for m in _COLONS.finditer(text)]
    if not found:
        return []
    edges = sorted([(s, e) for _, s, e in taken])
    out, i, last = [], 0, 0
    for kinds, s, e in sorted(found, key=lambda c: (c[1], -c[2])):
        while i < len(edges) and edges[i][1] <= s:
            i += 1
        if s >= last and not (i < len(edges) and edges[i][0] < e):
            out.append((kinds, s, e))
            last = e
    return out


def _word(raw: str) -> str:
    return _DIGIT.sub("0", _OUTER.sub("", raw).lower()) or raw[:8]


def patterns(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of the place of a span."""
    before = ["^", "^", *text[max(0, start - WINDOW) : start].split()][-2:]
    after = [*text[end : end + WINDOW].split()[:2], "$", "$"][:2]
    (b2, b1), (a1, a2) = map(_word, before), map(_word, after)
    return [f"{b2} {b1} _", f"{b1} _ {a1}", f"_ {a1} {a2}"]


def normal_form(span: str) -> str:
    return span.lower() if "@" in span or ":" in span else _NO_DIGIT.sub("", span)


def _digest(text: str) -> bytes:
    return blake2b(text.encode(), digest_size=16).digest()


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_CANDIDATE = pa.struct([("instance", pa.binary()), ("kinds", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_EDGE = pa.struct([("pattern", pa.binary()), ("instance", pa.binary()), ("seed", pa.int32()), ("kinds", pa.int32())])


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: key, row, base spans, candidates, and edges of the graph. Rows are numbered by task: store the result before use."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            bases, candidates, edges = [], [], []
            for t in batch.column("text").to_pylist():
                base = base_spans(t) if t else []
                others = candidate_spans(t, base) if t else []
                spots = [(k, 0, s, e, _digest(normal_form(t[s:e]))) for k, s, e in base]
                spots += [(-1, ks, s, e, _digest(normal_form(t[s:e]))) for ks, s, e in others]
                bases.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
                candidates.append([{"instance": i, "kinds": ks, "start": s, "end": e} for k, ks, s, e, i in spots if k < 0])
                edges.append(
                    [{"pattern": _digest(p), "instance": i, "seed": k, "kinds": ks} for k, ks, s, e, i in spots for p in patterns(t, s, e)]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), pa.array(range(row, row + batch.num_rows), pa.int64()),
                    pa.array(bases, pa.list_(_SPAN)), pa.array(candidates, pa.list_(_CANDIDATE)), pa.array(edges, pa.list_(_EDGE)),
                ],
                names=["key", "row", "base", "candidates", "edges"],
            )
            row += batch.num_rows

    rows = own_columns(docs, key, text).select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(
        run,
        f"key {kind}, row long, base array<struct<kind:int,start:long,end:long>>, "
        "candidates array<struct<instance:binary,kinds:int,start:long,end:long>>, "
        "edges array<struct<pattern:binary,instance:binary,seed:int,kinds:int>>",
    )


def _sent(df: DataFrame) -> DataFrame:
    """A stored table of narrow rows as the side of a join: to all tasks while it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df.hint("merge")


def trusted_patterns(counts: DataFrame, gained: DataFrame | None, support: float, trust: float) -> DataFrame:
    """(pattern, kind, score) of trusted patterns. ``counts``: pattern, n, seeds by kind; ``gained``: pattern, kind, known."""
    by_kind = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"seeds_{k}").cast("double").alias("known")) for k in range(len(KINDS))])
    known = counts.select("pattern", "n", F.explode(by_kind).alias("e")).select("pattern", "n", "e.*").filter("known > 0")
    if gained is not None:
        known = known.unionByName(gained.join(counts.select("pattern", "n"), "pattern").select("pattern", "n", "kind", "known"))
        known = known.groupBy("pattern", "kind").agg(F.max("n").alias("n"), F.round(F.sum("known"), DIGITS).alias("known"))
    scored = known.filter(F.col("known") >= support).select("pattern", "kind", F.round(F.col("known") / (F.col("n") + 1), DIGITS).alias("score"))
    return scored.filter(F.col("score") >= trust)


def bootstrap(edges: DataFrame, support: float = 3, trust: float = 0.5, accept: float = 0.8, rounds: int = 6) -> DataFrame:
    """(instance, kind, score) of accepted candidates, from a stored table of edges, distinct by (pattern, instance, seed), with their kinds."""
    spark = edges.sparkSession
    seeds = [F.count_if(F.col("seed") == k).alias(f"seeds_{k}") for k in range(len(KINDS))]
    counts = write_table(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), *seeds), fresh_path(spark, "patterns"))
    free = edges.filter("seed < 0").select("pattern", "instance", "kinds")
    fits = F.expr("shiftright(kinds, kind) & 1 = 1")
    met = free.select("instance", "kinds").distinct().join(
        edges.filter("seed >= 0").select("instance", F.col("seed").alias("kind")).distinct(), "instance"
    )
    same = met.filter(fits).select("instance", "kind", F.lit(1.0).alias("score")).distinct()
    accepted = same = write_table(same, fresh_path(spark, "accepted"))
    state = None
    for _ in range(rounds):
        now = accepted.agg(F.count(F.lit(1)), F.round(F.sum("score"), 6)).first()
        if now == state:
            break
        state = now
        gained = None
        if now[0]:
            gained = free.join(_sent(accepted), "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("known"))
        trusted = write_table(trusted_patterns(counts, gained, support, trust), fresh_path(spark, "trusted"))
        told = free.join(_sent(trusted), "pattern").filter(fits)
        told = told.groupBy("instance", "kind").agg(F.round(1 - F.exp(F.sum(F.log(1 - F.col("score")))), DIGITS).alias("score"))
        grown = told.filter(F.col("score") >= accept).unionByName(same)
        grown = grown.groupBy("instance", "kind").agg(F.max("score").alias("score"))
        accepted = write_table(grown, fresh_path(spark, "accepted"))
    return accepted


def personal_data(
    docs: DataFrame, key: str = "doc_id", text: str = "text", support: float = 3, trust: float = 0.5, accept: float = 0.8, rounds: int = 6
) -> DataFrame:
    """(key, base, spans): fixed forms, and all spans, as arrays of (kind, start, end) by kind, then start. ``KINDS`` names the kinds."""
    spark = docs.sparkSession
    found = write_table(find_spans(docs, key, text), fresh_path(spark, "spans"))
    edges = found.select(F.explode("edges").alias("e")).groupBy("e.pattern", "e.instance", "e.seed").agg(F.bit_or("e.kinds").alias("kinds"))
    accepted = bootstrap(write_table(edges, fresh_path(spark, "edges")), support, trust, accept, rounds)
    best = accepted.groupBy("instance").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind"))
    best = write_table(best, fresh_path(spark, "kinds"))
    places = found.select("row", F.explode("candidates").alias("c")).select("row", "c.instance", "c.start", "c.end")
    told = places.join(_sent(best), "instance").groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    whole = found.select("key", "row", "base").join(told, "row", "left")
    none = F.array().cast("array<struct<kind:int,start:long,end:long>>")
    spans = F.array_sort(F.concat("base", F.coalesce("more", none)))
    return whole.select(F.col("key").alias(key), F.array_sort("base").alias("base"), spans.alias("spans"))


def as_text(spans: str) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
