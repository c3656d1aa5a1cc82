"""Byte-level BPE by the tiktoken library and a local rank file: encoding, and decoding to raw bytes.

A long text is cut where the splitting pattern cannot reach across: before a
blank or line end that follows a letter or digit, and around a long run of white
space, less its last character. Each part is encoded by itself, so memory and the
pattern's stack stay bounded by the part; ids are those of the whole text. A part without
such a place stays whole.

Defined cases: a null text counts as empty and has no ids; an id outside the
ranks cannot be decoded and raises; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starfold.llm.common import own_columns, slices

#: Characters of text encoded at once, about.
PART = 100_000

_LONG_WHITE = re.compile(r"[^\S\x1c-\x1f]{1000,}")  # of what the pattern's \s matches
_encodings: dict[tuple[str, str], object] = {}


def encoding(path: str, pattern: str):
    """The worker's encoding for a rank file (lines of base64 bytes and rank) and a pattern."""
    if (path, pattern) not in _encodings:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encodings[path, pattern] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path, pattern]


def safe_parts(text: str, part: int = PART) -> Iterator[tuple[str, bool]]:
    """Parts of a text whose ids, one after the other, are those of the text; and whether a part is one match as it is.

    A long run of white space is one match but for its last character, which may
    belong to what follows. Elsewhere parts have about ``part`` characters.
    """
    done = 0
    for run in _LONG_WHITE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        for cut in _cut(text[done : run.start()], part):
            yield cut, False
        yield text[run.start() : end], True
        done = end
    for cut in _cut(text[done:], part):
        yield cut, False


def _cut(text: str, part: int) -> Iterator[str]:
    at = 0
    while len(text) - at > part:
        cut = at + part
        while cut < len(text) and not (text[cut] in " \n" and text[cut - 1].isalnum()):
            cut += 1
        yield text[at:cut]
        at = cut
    if at < len(text):
        yield text[at:]


def encode_text(coder, text: str | None, part: int = PART) -> np.ndarray:
    """Ids of one text."""
    ids: list[int] = []
    for cut, one in safe_parts(text or "", part):
        ids += coder._encode_single_piece(cut) if one else coder.encode_ordinary(cut)
    return np.array(ids, np.uint32)


def encode_documents(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text", part: int = PART) -> DataFrame:
    """(key, ids): the ids of each whole text, a binary of little-endian unsigned 32-bit integers."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks, pattern)
        for batch in slices(batches):
            ids = [encode_text(coder, t, part).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(ids, pa.binary())], names=["k", "ids"])

    rows = own_columns(docs, key, text).select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, ids binary")


def decode_documents(encoded: DataFrame, ranks: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``encoded`` (key and ids) with ``content``, the raw bytes of the ids; they need not be valid UTF-8 where ids were cut."""
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks, pattern)
        for batch in slices(batches, "ids"):
            content = [coder.decode_bytes(np.frombuffer(b or b"", np.uint32).tolist()) for b in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("ids"), pa.array(content, pa.binary())], ["k", "ids", "content"])

    rows = own_columns(encoded, key, ids).select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, f"`{key}` {kind}, ids binary, content binary")


def decimal_ids(encoded: DataFrame, ids: str = "ids") -> DataFrame:
    """The same rows with ``decimal``: the ids in decimal, joined by commas."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ids):
            decimal = [None if b is None else ",".join(map(str, np.frombuffer(b, np.uint32).tolist())) for b in batch.column(ids).to_pylist()]
            yield batch.append_column("decimal", pa.array(decimal, pa.string()))

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("decimal", StringType())]))
