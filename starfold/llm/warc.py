"""Content-addressed WARC archive: payload bytes once, exact headers apart, records rebuilt by joins.

A payload's address is its SHA-256. Of the records with one payload the one with
the largest id is written as a ``response`` with the bytes, the others as
``revisit`` records that refer to it. Records go to gzip files, a member each,
and the exact headers to a table beside them, with the address, the file and the
place in it. That table is committed by Spark: files of repeated attempts are not in it.

Reading parses the files, checks every payload against its address and its
digest, and joins the headers to the payloads by address, so each record has its
whole payload again.

Defined cases: a null payload counts as empty; payloads of fewer than
``least_bytes`` are all responses; a null id is less than any other; rows of one id
and payload are written alike; a null URI is left out,
line ends in it are escaped; an empty table gives an empty archive.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm.common import own_columns
from starfold.llm.files import beside, filesystem
from starfold.sources import read_table, stage, write_table

DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(content: Column) -> Column:
    """SHA-1 of binary content in upper-case base32, without a prefix."""
    digits = F.sha1(content)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _headers(date: str) -> tuple[Column, Column]:
    """WARC and HTTP header of a record, as text."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n_bytes").cast("string"), F.lit("\r\n\r\n")
    )
    response = F.col("record_type") == "response"
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    uri = F.regexp_replace(F.regexp_replace("uri", "\r", "%0D"), "\n", "%0A")
    name = lambda c: F.concat(F.lit("<urn:record:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    warc = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", name(F.col("id"))),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(response, F.lit("")).otherwise(F.concat(line("WARC-Profile", F.lit(_PROFILE)), line("WARC-Refers-To", name(F.col("keeper"))))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (F.octet_length(http) + F.when(response, F.col("n_bytes")).otherwise(0)).cast("string")),
        F.lit("\r\n"),
    )
    return warc, http


_INDEX = "record_type string, address string, warc_header binary, http_header binary, path string, offset long, length long"


def write_archive(records: DataFrame, path: str, key: str = "page_id", uri: str = "url", payload: str = "html", least_bytes: int = 0, date: str = DATE) -> DataFrame:
    """Write a record for every row below ``path``; returns the stored headers, a row per record."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    rows = own_columns(records, key, uri, payload).select(F.col(key).cast("long").alias("id"), F.col(uri).cast("string").alias("uri"), body.alias("body"))
    rows = rows.withColumns({"address": F.sha2("body", 256), "n_bytes": F.octet_length("body").cast("long")})
    slim = stage(rows.select("id", "address", "n_bytes"), "warc-addresses")  # a row per payload and task before any shuffle
    keeper = slim.filter(F.col("n_bytes") >= least_bytes).groupBy("address").agg(F.max("id").alias("keeper"), F.lit(True).alias("shared"))
    role = slim.select("id", "address").distinct().join(keeper, "address", "left")
    role = stage(role.select(
        F.col("id").alias("__id"), F.col("address").alias("__address"), "keeper",
        F.when(F.col("shared").isNull() | F.col("keeper").eqNullSafe(F.col("id")), "response").otherwise("revisit").alias("record_type"),
    ), "warc-roles")
    told = rows.join(role, (F.col("address") == F.col("__address")) & F.col("id").eqNullSafe(F.col("__id")))
    told = told.withColumn("digest", base32_sha1(F.col("body")))
    warc, http = _headers(date)
    ready = told.select(
        "record_type", "address", warc.cast("binary").alias("warc_header"), http.cast("binary").alias("http_header"),
        F.when(F.col("record_type") == "response", F.col("body")).otherwise(F.lit(b"")).alias("body"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, at = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if sink is None:
                fs, folder = filesystem(path)
                fs.create_dir(folder, recursive=True)
                name = f"{uuid.uuid4().hex}.warc.gz"
                sink = fs.open_output_stream(f"{folder}/{name}", compression=None)
            offsets, lengths = [], []
            for head, http_head, content in zip(*(batch.column(c).to_pylist() for c in ("warc_header", "http_header", "body")), strict=True):
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = packer.compress(head + http_head + content + b"\r\n\r\n") + packer.flush()
                sink.write(member)
                offsets.append(at)
                lengths.append(len(member))
                at += len(member)
            known = [batch.column(c) for c in ("record_type", "address", "warc_header", "http_header")]
            place = [pa.array([beside(path, name)] * batch.num_rows), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())]
            yield pa.RecordBatch.from_arrays([*known, *place], names=[c.split()[0] for c in _INDEX.split(", ")])
        if sink is not None:
            sink.close()

    return write_table(ready.mapInArrow(write, _INDEX), beside(path, "headers"))


def parse_record(content: bytes) -> tuple[bytes, bytes, bytes]:
    """WARC header, HTTP header (each with its blank line) and payload of one record."""
    head, _, rest = content.partition(b"\r\n\r\n")
    size = int(next(x.split(b":", 1)[1] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")))
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("a record is cut short")
    http, mark, payload = block.partition(b"\r\n\r\n")
    return head + b"\r\n\r\n", http + mark, payload


def _field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header.cast("string"), rf"(?m)^{name}: ([^\r\n]*)", 1)
    return F.when(found == "", None).otherwise(found)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Records parsed from the files of an archive: warc_header, http_header, payload. Each member is read at its own place."""
    places = read_table(spark, beside(path, "headers")).groupBy("path").agg(F.count(F.lit(1)).alias("records"))
    files = max(1, places.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("warc_header", pa.binary()), ("http_header", pa.binary()), ("payload", pa.binary())])
        for batch in batches:
            for row in batch.to_pylist():
                out, held, seen = [], 0, 0
                for record in _members(row["path"]):
                    out.append(parse_record(record))
                    held, seen = held + len(record), seen + 1
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*out, strict=True)], schema=schema)
                        out, held = [], 0
                if seen != row["records"]:
                    raise ValueError(f"{row['path']} has {seen} records, the headers name {row['records']}")
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*out, strict=True)], schema=schema)

    return places.repartition(files, "path").mapInArrow(read, "warc_header binary, http_header binary, payload binary")


def _members(path: str) -> Iterator[bytes]:
    """Content of each gzip member of a file."""
    fs, at = filesystem(path)
    with fs.open_input_stream(at, compression=None) as source:
        data = b""
        while True:
            if not data and not (data := source.read(1 << 20)):
                return
            member, parts = zlib.decompressobj(31), []
            while not member.eof:
                if not data and not (data := source.read(1 << 20)):
                    raise ValueError(f"{path} ends within a record")
                parts.append(member.decompress(data))
                data = member.unused_data
            yield b"".join(parts)


def read_archive(spark: SparkSession, path: str, content: bool = True) -> tuple[DataFrame, DataFrame]:
    """Headers and payloads of an archive.

    Headers, from the files: id, record_type, refers_to, digest, address, and both headers as they are.
    Payloads: address, payload_digest, payload_bytes, payload; one row each, checked
    against the address and against the digest in the header. Without ``content`` the column payload is left out, and
    the files are parsed once, into a stored table of headers and digests; with it each of both results parses them.
    """
    own = read_table(spark, beside(path, "headers")).select("warc_header", "http_header", "address").distinct()
    response = F.col("record_type") == "response"
    parsed = read_files(spark, path).select(
        "warc_header", "http_header", "payload",
        _field(F.col("warc_header"), "WARC-Type").alias("record_type"),
        F.regexp_extract(F.col("warc_header").cast("string"), r"WARC-Record-ID: <urn:record:(-?\d+)>", 1).try_cast("long").alias("id"),
        F.regexp_extract(F.col("warc_header").cast("string"), r"WARC-Refers-To: <urn:record:(-?\d+)>", 1).try_cast("long").alias("refers_to"),
        F.substring_index(_field(F.col("warc_header"), "WARC-Payload-Digest"), ":", -1).alias("digest"),
    ).withColumns({
        "found": F.when(response, F.sha2("payload", 256)),
        "payload_digest": F.when(response, base32_sha1(F.col("payload"))),
        "payload_bytes": F.octet_length("payload").cast("long"),
    })
    facts = ["found", "payload_digest", "payload_bytes"]
    if not content:
        parsed = stage(parsed.drop("payload"), "warc-parsed")
    wrong = F.raise_error(F.lit("a payload does not match its digest"))
    payloads = parsed.filter(response).select(
        F.when(F.col("payload_digest") == F.col("digest"), F.col("found")).otherwise(wrong).alias("address"),
        "payload_digest", "payload_bytes", *(["payload"] if content else []),
    )
    # by sort and merge: the planner takes what mapInArrow makes for much smaller than it is, and would send it to all tasks
    headers = parsed.drop("payload", *facts).join(own.hint("merge"), ["warc_header", "http_header"])
    return headers, payloads


def rebuild(headers: DataFrame, payloads: DataFrame, *columns: str) -> DataFrame:
    """Every record with its payload's columns, by a join on the verified address; a missing payload is an error."""
    one = payloads.groupBy("address").agg(*[F.first(c).alias(c) for c in columns])
    met = headers.join(one.hint("merge"), "address", "left")
    check = F.when(F.col(columns[0]).isNull(), F.raise_error(F.lit("a payload is missing"))).otherwise(F.col(columns[0]))
    return met.withColumn(columns[0], check)


