import base64
import gzip
import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starfold.llm import warc
from starfold.llm.common import fresh_path
from starfold.llm.files import filesystem

PAGES = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>two</p>\r\n\r\nmore"), (3, None, "<p>one</p>"), (4, "http://a/\r\nX: y", None),
    (5, "http://a/5", ""), (6, "http://a/6", "<p>one</p>"), (7, "http://é", "é" * 50_000), (8, "u", "\r\n\r\n"), (None, "u", "<p>three</p>"),
    (9, "http://a/9", "WARC/1.1\r\nWARC-Type: revisit\r\n\r\n"),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, h, "x", "y", 1) for i, u, h in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, address string, id string, record_type int").repartition(3)


@pytest.mark.parametrize("least", [0, 12])
def test_archive(spark, pages, least):
    path = fresh_path(spark, "test-warc")
    index = warc.write_archive(pages, path, least_bytes=least).collect()
    headers, payloads = warc.read_archive(spark, path)
    found = {r["id"]: r for r in warc.rebuild(headers, payloads, "payload_bytes", "payload_digest", "payload").collect()}
    assert len(found) == len(PAGES) == len(index)
    for key, _, html in PAGES:
        body, r = (html or "").encode(), found[key]
        same = [k for k, _, h in PAGES if (h or "") == (html or "")]
        keeper = max(same, key=lambda k: -1 if k is None else k) if len(body) >= least else key
        assert bytes(r["payload"]) == body and r["payload_bytes"] == len(body)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert (r["record_type"], r["refers_to"]) == (("response", None) if keeper == key else ("revisit", keeper))
    fs, _ = filesystem(path)
    for row in index:  # every record can be read by itself
        with fs.open_input_file(filesystem(row["path"])[1], ) as file:
            file.seek(row["offset"])
            head, http, _ = warc.parse_record(gzip.decompress(file.read(row["length"])))
        assert head == bytes(row["warc_header"]) and http == bytes(row["http_header"])
    facts = ("id", "record_type", "refers_to", "payload_bytes", "payload_digest")
    slim = warc.rebuild(*warc.read_archive(spark, path, content=False), *facts[3:])
    assert sorted(map(tuple, slim.select(*facts).collect()), key=repr) == sorted((tuple(r[f] for f in facts) for r in found.values()), key=repr)
    by_address = {hashlib.sha256((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h in PAGES}
    assert {row["address"] for row in index} == set(by_address)
    assert all(bytes(r["payload"]) == by_address[r["address"]] for r in found.values())


@pytest.mark.parametrize("copies", [1, 200])
@pytest.mark.parametrize("content", [True, False])
def test_records_are_not_sent_to_all_tasks(spark, pages, copies, content):
    path = fresh_path(spark, "test-warc")
    many = pages.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(copies)))).withColumn("page_id", F.col("page_id") * 1000 + F.col("n"))
    warc.write_archive(many, path)
    whole = warc.rebuild(*warc.read_archive(spark, path, content), "payload_bytes", "payload_digest")
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and plan.count("SortMergeJoin") == 2 and whole.count() == many.count()


def test_payload_bytes_are_stored_once(spark, pages):
    path = fresh_path(spark, "test-warc")
    warc.write_archive(pages, path)
    _, payloads = warc.read_archive(spark, path)
    assert payloads.count() == payloads.select("address").distinct().count() == len({h or "" for _, _, h in PAGES})


def test_wrong_bytes_are_noticed(spark, pages):
    path = fresh_path(spark, "test-warc")
    row = warc.write_archive(pages.filter("page_id = 7").repartition(1), path).first()
    at = filesystem(row["path"])[1]
    with open(at, "rb") as file:
        content = gzip.decompress(file.read())
    with open(at, "wb") as file:
        file.write(gzip.compress(content.replace("éé".encode(), "éè".encode(), 1)))
    headers, payloads = warc.read_archive(spark, path)
    with pytest.raises(PySparkException, match="digest"):
        warc.rebuild(headers, payloads, "payload_bytes").collect()


def test_empty_archive(spark, pages):
    path = fresh_path(spark, "test-warc")
    warc.write_archive(pages.limit(0), path)
    headers, payloads = warc.read_archive(spark, path)
    assert warc.rebuild(headers, payloads, "payload_bytes").count() == 0


def test_base32(spark):
    got = spark.createDataFrame([(b"",), (b"abc",)], "b binary").select(warc.base32_sha1(F.col("b"))).collect()
    assert [r[0] for r in got] == [base64.b32encode(hashlib.sha1(b).digest()).decode() for b in (b"", b"abc")]
