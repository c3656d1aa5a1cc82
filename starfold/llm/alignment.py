"""Alignment of two tokenizers on the same text: byte ranges, common cuts, links, and how many documents hold each linked pair.

Tokenizer A is a byte-level file of the tokenizers library, B a sentencepiece model that writes a
space before the text; A is given that space. Character offsets (A) and the spans of the proto (B) are coarse
cuts: they hold for tokens that cover whole characters one after the other. Others (parts of a multibyte
character, byte-fallback tokens, the added space) are refined by their decoded bytes.

Texts are aligned piece by piece: a cut between two pieces is one of both tokenizers. Such
are the cuts before a blank that follows no white space, and between a Latin letter and a mark or line end that
no entry of B holds after a letter; what both libraries give for a piece is kept per worker. A text with
a piece whose bytes do not come out is encoded again as a whole.

Counts go out and back by block, a few MB of texts: a block sends each of its pairs once, with the number of its documents that hold it,
and gets the corpus-wide counts of these pairs back. So a pair that every document has is a row a block, and nothing is sent per document and pair.
The best count of each A id, at most one row for each entry of A, is broadcast.

Defined cases: a null or empty text, and one whose joined A or B bytes are not space+text, has no tokens: zeros and empty
groups. Rows are documents: repeated rows count each. An empty table gives an empty result; extra columns stay out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import fresh_path, own_columns, packed, release, slices, unpacked
from starfold.llm.encoding import _LETTER
from starfold.sources import write_table

#: Bytes of text whose pairs are counted together.
BLOCK = 8 << 20
#: Characters of pieces that a worker keeps (twice that with the store before), and of the longest one kept; characters of texts split at a time.
KEPT_CHARS, LONGEST_KEPT, AT_ONCE = 2_500_000, 200, 1_000_000

_LATIN = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
_MARKS = ',.;:!?"()[]{}#$%&*+/<=>@\\^`|~\n\r\t'  # ends of words, unless an entry of B has one after a letter
_COMMA, _BAR, _END = b",", b"|", b";"


class Aligner:
    """Both tokenizers, and what is kept of pieces: piece -> (pairs, groups, A tokens), or None where bytes do not come out."""

    def __init__(self, byte_level: str, piece_model: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        letters = {letter: byte for byte, letter in enumerate(_LETTER)}
        self.a_bytes = {
            i: bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
            for entry, i in self.a.get_vocab(with_added_tokens=True).items()
        }
        entries = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(entry[3:-1], 16)]) if self.b.is_byte(i) else entry.replace("▁", " ").encode() for i, entry in enumerate(entries)
        ]
        self.a_len = np.array([len(self.a_bytes.get(i, b"")) for i in range(max(self.a_bytes) + 1)])
        self.b_len = np.array([len(b) for b in self.b_bytes])
        # texts of ids: within the tokens of a group, and last of them
        digits = len(str(max(len(self.a_len), len(self.b_len)))) + 1
        self.a_text, self.b_text = (
            np.array([[f"{i}{mark}" for i in range(len(n))] for mark in marks], f"S{digits}") for n, marks in ((self.a_len, ",|"), (self.b_len, ",;"))
        )
        inside = {pair for entry in entries for pair in zip(entry, entry[1:])}
        self.cuts = all(y != "▁" or x == "▁" for x, y in inside)  # no entry goes on after a blank
        marks = [m for m in _MARKS if not any(y == m and re.match(f"[{_LATIN}]", x) for x, y in inside)]
        ends = "".join(map(re.escape, marks))
        self.split = re.compile(f" *[{_LATIN}]+(?=[{ends} ]|\\Z)| *[^ ]+(?:(?<=\\s) +[^ ]*)*| +")
        self.kept: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}
        self.chars = 0

    def pieces(self, text: str) -> list[str]:
        """Pieces of space+text."""
        return self.split.findall(" " + text) if self.cuts else [" " + text]

    def align(self, pieces: list[str]) -> list[tuple | None]:
        """(pairs, groups, A tokens) of each piece: linked ids in order as bytes, groups as text, and a number."""
        a_all = self.a.encode_batch(pieces, add_special_tokens=False)
        # B writes a space before what it gets: it stands for the first of the piece, or goes with a line end put before
        given = [p[1:] if p[0] == " " else "\n" + p for p in pieces]
        b_all = self.b.encode(given, return_type="proto", num_threads=1)
        a_own = [e.ids for e in a_all]
        b_own = [[(t.id, t.begin, t.end) for t in proto.pieces][0 if p[0] == " " else 2 :] for p, proto in zip(pieces, b_all, strict=True)]
        coded = [p.encode() for p in pieces]
        good = [
            b"".join([self.a_bytes[i] for i in a]) == text == b"".join([self.b_bytes[t[0]] for t in b])
            for text, a, b in zip(coded, a_own, b_own, strict=True)
        ]
        if all(good):
            return self._linked(pieces, coded, a_own, [e.offsets for e in a_all], b_own)
        some = [i for i, ok in enumerate(good) if ok]
        out: list[tuple | None] = [None] * len(pieces)
        if some:
            pick = lambda own: [own[i] for i in some]
            for i, found in zip(some, self._linked(pick(pieces), pick(coded), pick(a_own), [a_all[i].offsets for i in some], pick(b_own)), strict=True):
                out[i] = found
        return out

    def _linked(self, pieces: list[str], coded: list[bytes], a_own: list, spans: list, b_own: list) -> list[tuple]:
        """All pieces end to end: where both tokenizers end is the end of a group, and a stretch between two neighbouring cuts is a link."""
        a_ids, b_all = np.array([i for own in a_own for i in own]), np.array([t for own in b_own for t in own])
        b_ids = b_all[:, 0]
        chars, sizes = np.array([len(p) for p in pieces]), np.array([len(c) for c in coded])
        a_n, b_n = np.array([len(own) for own in a_own]), np.array([len(own) for own in b_own])
        a_first, b_first = np.cumsum(a_n) - a_n, np.cumsum(b_n) - b_n

        # A: characters to bytes; a token that touches its neighbours and shares no character with them has the bytes of its characters
        points = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        at = np.zeros(len(points) + 1, np.int64)
        np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000), out=at[1:])
        span = np.array([t for own in spans for t in own]) + np.repeat(np.cumsum(chars) - chars, a_n)[:, None]
        before, after = np.roll(span[:, 1], 1), np.roll(span[:, 0], -1)
        before[a_first], after[a_first + a_n - 1] = np.cumsum(chars) - chars, np.cumsum(chars)
        whole = (span[:, 0] == before) & (span[:, 1] == after)
        a_sizes = np.where(whole, at[span[:, 1]] - at[span[:, 0]], self.a_len[a_ids])
        # B: spans are in bytes; the added space, and bytes of a character that is not in the vocabulary, are decoded
        before = np.roll(b_all[:, 2], 1)
        before[b_first] = -1
        extent = b_all[:, 2] - b_all[:, 1]
        whole = (b_all[:, 1] == before) & (extent == self.b_len[b_ids])
        b_sizes = np.where(whole, extent, self.b_len[b_ids])

        a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
        cuts = np.union1d(a_ends, b_ends)
        a_at, b_at = np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts)
        pairs = (a_ids[a_at] << 32 | b_ids[b_at]).astype(np.int64)
        common = cuts[(a_ends[a_at] == cuts) & (b_ends[b_at] == cuts)]
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        text = np.empty(len(a_ids) + len(b_ids), self.a_text.dtype)
        a_last = np.append(a_group[1:] != a_group[:-1], True)
        b_last = np.append(b_group[1:] != b_group[:-1], True)
        text[np.arange(len(a_ids)) + np.searchsorted(b_group, a_group, "left")] = self.a_text[a_last.astype(np.int64), a_ids]
        text[np.arange(len(b_ids)) + np.searchsorted(a_group, b_group, "right")] = self.b_text[b_last.astype(np.int64), b_ids]
        pair_ends = np.searchsorted(cuts, np.cumsum(sizes), "right") * 8
        text_ends = np.cumsum(a_n + b_n) * text.itemsize
        all_pairs, all_text, out, p, t = pairs.tobytes(), text.tobytes(), [], 0, 0
        for p_end, t_end, n in zip(pair_ends.tolist(), text_ends.tolist(), a_n.tolist(), strict=True):
            out.append((all_pairs[p:p_end], all_text[t:t_end].replace(b"\0", b""), n))
            p, t = p_end, t_end
        return out

    def all_texts(self, column: pa.Array) -> Iterator[tuple[bytes, bytes, int]]:
        """``texts`` of a column, a part at a time."""
        part, chars = [], 0
        for value in column:
            part.append(value.as_py())
            chars += len(part[-1] or "")
            if chars >= AT_ONCE:
                yield from self.texts(part)
                part, chars = [], 0
        yield from self.texts(part)

    def texts(self, texts: list[str | None]) -> list[tuple[bytes, bytes, int]]:
        """(pairs, groups, A tokens) of each whole text; all empty where it has no tokens."""
        if self.chars > KEPT_CHARS:
            self.older, self.kept, self.chars = self.kept, {}, 0
        split = [self.pieces(t) if t else [] for t in texts]
        new = {}
        for piece in set().union(*split):
            if piece not in self.kept:
                if piece in self.older:
                    self.kept[piece] = self.older[piece]
                    self.chars += len(piece)
                else:
                    new[piece] = None
        fresh = list(new)
        for i in range(0, len(fresh), 2000):
            part = fresh[i : i + 2000]
            new.update(zip(part, self.align(part), strict=True))
        short = {p: v for p, v in new.items() if len(p) <= LONGEST_KEPT}
        self.kept.update(short)
        self.chars += sum(map(len, short))
        long = {p: v for p, v in new.items() if len(p) > LONGEST_KEPT}
        out = []
        for text, own in zip(texts, split, strict=True):
            found = [self.kept[p] if p in self.kept else long[p] for p in own] if long else list(map(self.kept.__getitem__, own))
            if None in found:
                found = self.align([" " + text])
                if None in found:
                    found = []
            pairs, groups, a_tokens = zip(*found, strict=True) if found else ((), (), ())
            out.append((b"".join(pairs), b"".join(groups)[:-1], sum(a_tokens)))
        return out


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(byte_level: str, piece_model: str) -> Aligner:
    """The worker's aligner for two files; loaded once."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
    if (byte_level, piece_model) not in _aligners:
        _aligners[byte_level, piece_model] = Aligner(byte_level, piece_model)
    return _aligners[byte_level, piece_model]


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def token_groups(docs: DataFrame, byte_level: str, piece_model: str, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """A row per document: key, n_a, n_b, n_groups, n_links, groups, and its links as places in the pairs of its block.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``; with ``digest`` its SHA-256 in hex (empty stays empty). The first row of a block has its
    distinct pairs, and how many of its documents hold each. Blocks are numbered by task, so the result has to be stored before it is used.
    """
    from hashlib import sha256

    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = aligner(byte_level, piece_model)
        block = TaskContext.get().partitionId() << 32
        for batch in slices(batches, limit=BLOCK):
            sizes, texts, places, counts, held = [], [], [], [], []
            for pairs, groups, n_a in coder.all_texts(batch.column("text")):
                own, times = np.unique(np.frombuffer(pairs, np.int64), return_counts=True)
                n_groups = groups.count(_END) + bool(groups)
                n_all = groups.count(_COMMA) + groups.count(_BAR) + n_groups
                sizes.append((n_a, n_all - n_a, n_groups, len(pairs) // 8))
                texts.append(sha256(groups).hexdigest() if digest and groups else groups.decode())
                held.append(own)
                counts.append(packed(times.astype(np.uint32)))
            distinct, n_docs = np.unique(np.concatenate(held), return_counts=True)
            places = [packed(np.diff(np.searchsorted(distinct, own), prepend=0).astype(np.uint32)) for own in held]
            first = [None] * (batch.num_rows - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), pa.array([block] * batch.num_rows, pa.int64()), *[pa.array(c, pa.int64()) for c in zip(*sizes)],
                    pa.array(texts, pa.string()), pa.array(places, pa.binary()), pa.array(counts, pa.binary()),
                    pa.array([packed(distinct), *first], pa.binary()), pa.array([packed(n_docs.astype(np.uint32)), *first], pa.binary()),
                ],
                names=["key", "block", *_COUNTS, "groups", "places", "times", "pairs", "docs"],
            )
            block += 1

    rows = own_columns(docs, key, text).select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    numbers = ", ".join(f"{n} long" for n in _COUNTS)
    return rows.mapInArrow(run, f"key {kind}, block long, {numbers}, groups string, places binary, times binary, pairs binary, docs binary")


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            pairs, n = unpacked(row["pairs"], np.int64), unpacked(row["docs"], np.uint32)
            for i in range(0, len(pairs), 1 << 16):
                part = pairs[i : i + (1 << 16)]
                own = [np.full(len(part), row["block"]), part, n[i : i + (1 << 16)].astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in own], ["block", "pair", "n"])


def _weighed(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums over the links of each document of a block, whose pairs come with their corpus-wide counts."""
    order = np.argsort(counts.column("pair").to_numpy())
    count = counts.column("count").to_numpy()[order]
    best = counts.column("best").to_numpy()[order].astype(np.int64)
    sums = []
    for row in docs.select(["places", "times"]).to_pylist():
        at = np.cumsum(unpacked(row["places"], np.uint32), dtype=np.int64)
        times = unpacked(row["times"], np.uint32).astype(np.int64)
        sums.append((int(times @ best[at]) if len(at) else 0, int(times @ count[at]) if len(at) else 0))
    kept = docs.select(["key", *_COUNTS, "groups"])
    for i, name in enumerate(("n_best", "count_sum")):
        kept = kept.append_column(name, pa.array([s[i] for s in sums], pa.int64()))
    return kept


def align_tokenizers(docs: DataFrame, byte_level: str, piece_model: str, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, groups, n_best, count_sum) of every document.

    A pair's count is the number of documents that hold it linked. ``count_sum`` adds the counts of all links of a document, ``n_best``
    is the number of its links whose count is the highest that their A id has with any B id.
    """
    spark = docs.sparkSession
    found = write_table(token_groups(docs, byte_level, piece_model, key, text, digest), fresh_path(spark, "token-groups"))
    blocks = found.filter(F.col("pairs").isNotNull()).select("block", "pairs", "docs").mapInArrow(_block_pairs, "block long, pair long, n long")
    counts = write_table(blocks.groupBy("pair").agg(F.sum("n").alias("count")), fresh_path(spark, "pair-counts"))
    release(spark)
    a_id = F.shiftright("pair", 32)
    best = counts.groupBy(a_id.alias("a")).agg(F.max("count").alias("most"))  # at most a row for each entry of A
    marked = counts.select("pair", "count", a_id.alias("a")).join(F.broadcast(best), "a")
    marked = marked.select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = blocks.select("block", "pair").join(marked.hint("merge"), "pair")
    kind = docs.schema[key].dataType.simpleString()
    numbers = ", ".join(f"{n} long" for n in _COUNTS)
    own = found.select("block", "key", *_COUNTS, "groups", "places", "times")
    whole = own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _weighed, f"key {kind}, {numbers}, groups string, n_best long, count_sum long"
    )
    return whole.withColumnRenamed("key", key)


__all__ = ["Aligner", "align_tokenizers", "aligner", "token_groups"]
