import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from starfold.llm.oracle import ORACLES
from starfold.llm.queries import QUERIES
from tests.llm.test_dedup import brute_classes, brute_removal

SF = "/root/testdata/sf0.01"
TABLES = ("documents", "pages", "embeddings", "labels")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, found.select(columns).collect()), key=repr) == sorted(want, key=repr)


@pytest.fixture(scope="module")
def texts(spark):
    return sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())


def ids_by_library(name, end):
    coder = Tokenizer.from_file(public_tokenizers.path(name))
    coder.encode_special_tokens = True
    return lambda t: np.array(coder.encode(t or "", add_special_tokens=False).ids + [end], np.uint32)


def test_op1(spark, texts):
    encode, at, want = ids_by_library("byte_bpe_50k.json", 2), 0, []
    for key, text in texts:
        ids = encode(text)
        want.append((key, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, QUERIES["op1_token_files"](spark, SF).collect())) == want


def test_op3(spark, texts):
    import base64

    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for key, text in texts:
        ids = coder.encode_ordinary(text)
        want.append((key, len(ids), sha(",".join(map(str, ids)).encode()), sha(text.encode())))
    assert sorted(map(tuple, QUERIES["op3_byte_bpe"](spark, SF).collect())) == want


def packed_pieces(texts):
    encode, want = ids_by_library("word_bpe_49k.json", 1), []
    for key, text in texts:
        ids = encode(text)
        want += [(key, i // 4096, i, len(ids[i : i + 4096]), zlib.crc32(ids[i : i + 4096].tobytes())) for i in range(0, len(ids), 4096)]
    return sorted(want)


def test_op5(spark, texts):
    found, want = QUERIES["op5_best_fit_packing"](spark, SF).toPandas(), packed_pieces(texts)
    assert sorted(found[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == want
    found = found.sort_values(["sequence_id", "offset"])
    length = found.groupby("sequence_id")["length"]
    assert (length.cumsum() - found["length"] == found["offset"]).all() and length.sum().max() <= 4096
    assert found["sequence_id"].nunique() <= 1.01 * -(-sum(w[3] for w in want) // 4096) + 1


def test_op6_and_op10_have_every_document(spark, texts):
    for name in ("op6_quality", "op10_language_id"):
        found = QUERIES[name](spark, SF).toPandas()
        assert sorted(found["doc_id"]) == [k for k, _ in texts]
        assert [zlib.crc32(str(k).encode()) % 5 == 0 for k in found["doc_id"]] == found["held_out"].tolist()


def test_pipeline_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.quality(spark, docs, SF)
    assert good.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    last = {}
    for key, text in rows:
        last[text] = max(last.get(text, key), key)
    rows = sorted((k, t) for t, k in last.items())
    keep = {k for k, _, c in brute_classes_fast(rows, 5, 80) if k == c}
    rows = [(k, t) for k, t in rows if k in keep]
    rows = [(k, t if not gone else left) for (k, t), (_, _, gone, left) in zip(rows, sorted(brute_removal(rows, 13)), strict=True)]
    found = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(r["ids"])) for r in found) == packed_pieces(rows)


def brute_classes_fast(rows, n, percent):
    """brute_classes, for documents that share a shingle with another only."""
    seen, shared = {}, set()
    for i, (_, text) in enumerate(rows):
        w = text.encode().lower().split()
        for j in range(max(1, len(w) - n + 1)):
            other = seen.setdefault(tuple(w[j : j + n]), i)
            if other != i:
                shared |= {i, other}
    some = [rows[i] for i in sorted(shared)]
    alone = [(rows[i][0], 0, rows[i][0]) for i in range(len(rows)) if i not in shared]
    return brute_classes(some, n, percent) + alone


def test_stages_of_odd_rows(spark, docs, nothing):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/odd-rows"
    labels.write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    for given in (docs, nothing):
        for name, stage in corpus_pipeline.STAGES:
            columns = given.columns
            given = spark.createDataFrame(stage(spark, given, folder).collect(), stage(spark, given, folder).schema)
            assert name == "packing" or given.columns == columns
    assert given.count() == 0


def test_stages_leave_other_columns_as_they_are(spark, rows):
    """Names with dots and backticks, names of helpers inside the operators, and documents without n_chars."""
    names = ["a.b", "__row", "row", "__mark", "own_mark", "found_key", "__passages", "passages", "a", "b", "key", "text.x", "`q`"]
    some = [r for r in rows if r[0] is not None and (r[1] is None or len(r[1]) < 5000)]
    schema = "doc_id long, text string, " + ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    given = spark.createDataFrame([(i, t, *[f"{n} of {i} {len(t or '')}" for n in names]) for i, t, *_ in some], schema)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/odd-columns"
    labels.write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    told = {tuple(r)[2:] for r in given.collect()}
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, given, folder)
        if name != "packing":
            assert found.columns == given.columns
            got = found.collect()
            assert got and {tuple(r)[2:] for r in got} <= told, name
            given = spark.createDataFrame(got, found.schema)
    assert found.count() > 0
