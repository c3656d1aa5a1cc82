"""Token ids in Arrow stream files of equal record batches, with zero-copy random access.

Documents are dealt by ranges of their key; each task writes one file, its
documents in ascending order, as sequences of equal length. A record batch holds
a fixed number of sequences as fixed-size lists: ``ids``, ``mask`` (a bit that is set where an id
is and not for the padding of a file's last sequences) and ``ends`` (a bit set on the last id
of a document). All batches of a file have the same number of bytes, so batch k
starts at ``head + k * step`` and is read from a memory map without a copy.
Which document is where stands in an index file of the same kind (key, n_tokens).

A file's name is drawn anew by each attempt of a task, and the manifest, a table
that Spark commits, names the files that count: lost executors and repeated
attempts leave no wrong file in it.

Defined cases: a null text counts as empty and holds only its end id; rows of one
key are ordered by a hash of the text, a null key comes first; an empty table gives no
file; other columns are not read.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starfold.llm.common import own_columns, slices
from starfold.llm.encoding import encoder
from starfold.llm.files import beside, filesystem
from starfold.sources import read_table, write_table

#: Ids in a sequence, and sequences in a record batch.
LENGTH, ROWS = 1024, 64
#: Bytes of text that one file should hold.
FILE_BYTES = 32 << 20

_MANIFEST = "shard int, path string, docs long, tokens long, head long, step long, batches long"


def _lists(values: np.ndarray, length: int) -> pa.FixedSizeListArray:
    return pa.FixedSizeListArray.from_arrays(pa.array(values), length)


def sequence_schema(kind: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length)), ("ends", pa.list_(pa.bool_(), length))])


class _Writer:
    """Collects ids and writes a batch whenever one is full."""

    def __init__(self, sink, kind: np.dtype, length: int, rows: int):
        self.sink, self.size, self.length, self.rows = sink, length * rows, length, rows
        self.schema = sequence_schema(kind, length)
        self.ids, self.ends = np.zeros(self.size, kind), np.zeros(self.size, bool)
        self.filled = self.batches = self.tokens = 0
        self.stream = pa.ipc.new_stream(sink, self.schema)
        empty = pa.BufferOutputStream()
        pa.ipc.new_stream(empty, self.schema).close()
        self.head, self.step = empty.tell() - 8, 0  # less the mark of the end

    def add(self, ids: np.ndarray) -> None:
        self.tokens += len(ids)
        done = 0
        while done < len(ids):
            n = min(len(ids) - done, self.size - self.filled)
            self.ids[self.filled : self.filled + n] = ids[done : done + n]
            done, self.filled = done + n, self.filled + n
            if done == len(ids):
                self.ends[self.filled - 1] = True
            if self.filled == self.size:
                self.flush()

    def flush(self) -> None:
        mask = np.arange(self.size) < self.filled
        columns = [_lists(x.copy(), self.length) for x in (self.ids, mask, self.ends)]
        self.stream.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.step = self.step or self.sink.tell() - self.head
        self.batches += 1
        self.filled = 0
        self.ids[:], self.ends[:] = 0, False

    def close(self) -> None:
        if self.filled:
            self.flush()
        self.stream.close()


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text",
                      byte_level: bool = True, kind: str = "uint16", length: int = LENGTH, rows: int = ROWS) -> DataFrame:
    """Encode every document, append ``end_id``, write the files below ``path``; returns the manifest.

    ``kind`` is the stored integer; it has to hold every id of the vocabulary.
    """
    kind = np.dtype(kind)
    texts = own_columns(docs, key, text).select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(8, total // FILE_BYTES)
    dealt = texts.repartitionByRange(files, "key", F.xxhash64("text")).sortWithinPartitions("key", F.xxhash64("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer, index, keys, sizes = None, None, [], []
        for batch in slices(batches):
            if writer is None:
                fs, folder = filesystem(path)
                fs.create_dir(folder, recursive=True)
                name = uuid.uuid4().hex
                sink = fs.open_output_stream(f"{folder}/{name}.arrows")
                writer = _Writer(sink, kind, length, rows)
                index_sink = fs.open_output_stream(f"{folder}/{name}.index.arrows")
                index = pa.ipc.new_stream(index_sink, pa.schema([("key", pa.int64()), ("n_tokens", pa.int64())]))
                docs_written = 0
            keys, sizes = batch.column("key"), []
            for ids in encoder(tokenizer, byte_level, kind).encode(batch.column("text").to_pylist()):
                writer.add(np.append(ids, kind.type(end_id)))
                sizes.append(len(ids) + 1)
            index.write_batch(pa.RecordBatch.from_arrays([keys, pa.array(sizes, pa.int64())], names=["key", "n_tokens"]))
            docs_written += len(sizes)
        if writer is not None:
            writer.close()
            index.close()
            sink.close()
            index_sink.close()
            row = [TaskContext.get().partitionId(), beside(path, name), docs_written, writer.tokens, writer.head, writer.step, writer.batches]
            yield pa.RecordBatch.from_pylist([dict(zip([c.split()[0] for c in _MANIFEST.split(", ")], row, strict=True))], pa.schema(
                [("shard", pa.int32()), ("path", pa.string()), *[(c, pa.int64()) for c in ("docs", "tokens", "head", "step", "batches")]]))

    return write_table(dealt.mapInArrow(write, _MANIFEST), f"{path.rstrip('/')}/manifest")


class TokenFile:
    """Random access to the sequences of one file; nothing is copied where the file can be mapped."""

    def __init__(self, row: dict):
        fs, at = filesystem(row["path"] + ".arrows")
        self.row = row
        self.source = pa.memory_map(at) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(at)
        self.schema = pa.ipc.open_stream(io.BytesIO(self.source.read(row["head"]))).schema

    def batch(self, k: int) -> pa.RecordBatch:
        """Record batch k."""
        self.source.seek(self.row["head"] + k * self.row["step"])
        return pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)

    def sequence(self, i: int) -> dict[str, np.ndarray]:
        """ids, mask and ends of sequence i of the file."""
        first = self.batch(0)
        at = self.batch(i // first.num_rows) if i >= first.num_rows else first
        r = i % first.num_rows
        length = at.schema.field("ids").type.list_size
        flat = {c: at.column(c).flatten().to_numpy(zero_copy_only=c == "ids") for c in ("ids", "mask", "ends")}
        return {c: v[r * length : (r + 1) * length] for c, v in flat.items()}

    def index(self) -> Iterator[pa.RecordBatch]:
        fs, at = filesystem(self.row["path"] + ".index.arrows")
        with fs.open_input_stream(at) as source:
            yield from pa.ipc.open_stream(source)


def read_documents(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Documents of the files that the manifest below ``path`` names: key, start (ids of all before), n_tokens, ids (uint32, little-endian).

    The index must agree with the marks of document ends in the sequences.
    """
    manifest = read_table(spark, f"{path.rstrip('/')}/manifest")
    before = F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))  # one row per file
    placed = manifest.withColumn("base", F.coalesce(before, F.lit(0)))
    files = max(1, placed.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _documents(row)

    spread = placed.repartition(files, "shard")
    return spread.mapInArrow(read, f"`{key}` long, start long, n_tokens long, ids binary")


def _documents(row: dict) -> Iterator[pa.RecordBatch]:
    file = TokenFile(row)
    ids, ends, k, start = np.zeros(0, np.uint32), np.zeros(0, bool), 0, row["base"]
    for part in file.index():
        keys, sizes, out, total = part.column("key"), part.column("n_tokens").to_numpy(), [], 0
        first = start
        for size in sizes.tolist():
            pieces = [ids]
            tails = [ends]
            have = len(ids)
            while have < size:
                batch = file.batch(k)
                k += 1
                real = batch.column("mask").flatten().to_numpy(zero_copy_only=False)
                pieces.append(batch.column("ids").flatten().to_numpy()[real].astype(np.uint32))
                tails.append(batch.column("ends").flatten().to_numpy(zero_copy_only=False)[real])
                have += len(pieces[-1])
            if len(pieces) > 1:
                ids, ends = np.concatenate(pieces), np.concatenate(tails)
            if not ends[size - 1] or ends[: size - 1].any():
                raise ValueError(f"{row['path']}: index and sequences differ")
            out.append(ids[:size].tobytes())
            ids, ends = ids[size:], ends[size:]
            total += size
        start += total
        starts = first + np.cumsum(sizes) - sizes
        yield pa.RecordBatch.from_arrays(
            [keys, pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(out, pa.binary())], ["k", "start", "n_tokens", "ids"]
        )


