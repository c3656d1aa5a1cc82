import bisect
import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starfold.llm import byte_bpe, packing, token_files
from starfold.llm.common import fresh_path
from starfold.llm.encoding import Encoder

ODD = "ab'sS \n\t\r\xa0\x1c\x0b\u0301" + "\u00e91\u00bd,!<|>\u3000\u2003\u2028\u0130\u03a3\u00c5\u212b\u00df\u4e2d"
BYTES, LOWER, MULTI = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "byte_bpe_multi_50k.tiktoken"))


def odd_texts(n, longest):
    rnd = random.Random(n)
    return ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, longest))) for _ in range(n)]


@pytest.fixture(scope="module")
def plain():
    out = {}
    for path in (BYTES, LOWER):
        out[path] = Tokenizer.from_file(path)
        out[path].encode_special_tokens = True
    return out


@pytest.mark.parametrize("path,byte_level", [(BYTES, True), (LOWER, False)])
def test_pieces_give_the_ids_of_the_whole_text(plain, rows, path, byte_level):
    texts = odd_texts(1500, 50) + [r[1] or "" for r in rows] + ["  two  blanks \n\n", "It's we'LL", "<|endoftext|>x"]
    got = Encoder(path, byte_level).encode(texts)
    want = plain[path].encode_batch(texts, add_special_tokens=False)
    assert [g.tolist() for g in got] == [w.ids for w in want]


def test_words_are_kept_without_case_and_marks(plain):
    texts = ["Word### word*** WORD, \xc9t\xe9's (\xe9t\xe9) word\u2019s 3rd_word", "word### \xc9T\xc9"]
    coder, asked = Encoder(LOWER, False), []
    coder.kept.direct = lambda piece: asked.append(piece) or coder.direct(piece)
    got = coder.encode(texts)
    assert [g.tolist() for g in got] == [w.ids for w in plain[LOWER].encode_batch(texts, add_special_tokens=False)]
    assert asked == ["word", "###", "***", ",", "\xe9t\xe9", "'s", "(\xe9t\xe9)", "word\u2019s", "3rd_word"]


def test_a_mark_or_character_after_a_word(plain):
    marks = [*map(chr, range(256)), *map(chr, range(0x2010, 0x2028)), "\u0301", "\u0338", "=\u0338", "'s", "'Ve", "\u017f", "\u0130", "\u03a3"]
    texts = [f"{a}{m}{b}" for m in marks for a in ("It", "\xc5E", "") for b in ("", "s", "S's", "9", " \xdcb")]
    got = Encoder(LOWER, False).encode(texts)
    assert [g.tolist() for g in got] == [w.ids for w in plain[LOWER].encode_batch(texts, add_special_tokens=False)]


def test_the_store_may_start_anew(plain, monkeypatch):
    monkeypatch.setattr("starfold.llm.encoding.KEPT_BYTE_LEVEL", (5, 12_000_000))
    monkeypatch.setattr("starfold.llm.encoding.KEPT_WORDS", (5, 12_000_000))
    texts = odd_texts(200, 30)
    got = Encoder(BYTES, True).encode(texts)
    assert [g.tolist() for g in got] == [w.ids for w in plain[BYTES].encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("length,per_batch", [(1024, 64), (7, 3)])
def test_token_files(spark, docs, rows, plain, table, length, per_batch):
    path = fresh_path(spark, "test-tokens")
    manifest = token_files.write_token_files(docs, path, BYTES, 2, length=length, rows=per_batch)
    read = token_files.read_documents(spark, path).cache()
    got = read.orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda k: -1 if k is None else k)
    sizes = np.array([r["n_tokens"] for r in got])
    assert [r["start"] for r in got] == (np.cumsum(sizes) - sizes).tolist()
    want = sorted((k, plain[BYTES].encode(t or "", add_special_tokens=False).ids + [2]) for k, t, *_ in rows if k is not None)
    assert sorted((r["doc_id"], np.frombuffer(r["ids"], np.uint32).tolist()) for r in got if r["doc_id"] is not None) == want
    for row in manifest.collect():
        file = token_files.TokenFile(row.asDict())
        parts = [file.sequence(i) for i in range(row["batches"] * per_batch)]
        assert {len(p["ids"]) for p in parts} == {length}
        assert sum(int(p["mask"].sum()) for p in parts) == row["tokens"]
        assert sum(int(p["ends"].sum()) for p in parts) == row["docs"]


def test_no_tokens(spark, nothing):
    path = fresh_path(spark, "test-tokens")
    token_files.write_token_files(nothing, path, BYTES, 2)
    assert token_files.read_documents(spark, path).count() == 0


def test_parts_give_the_ids_of_the_whole_text():
    coder = byte_bpe.encoding(MULTI, public_tokenizers.PATTERN)
    rnd = random.Random(4)
    for text in odd_texts(2000, 60):
        assert byte_bpe.encode_text(coder, text, rnd.randint(1, 9)).tolist() == coder.encode_ordinary(text)
    gaps = "x" + " " * 1500 + "\n" * 1200 + "y z" + "\t" * 1100
    assert byte_bpe.encode_text(coder, gaps).tolist() == coder.encode_ordinary(gaps)
    for text in ("a" * 300_000, " " * 300_000 + "b", "\n " * 200_000):
        assert coder.decode_bytes(byte_bpe.encode_text(coder, text).tolist()) == text.encode()


def test_byte_bpe(docs, rows, nothing):
    coder = byte_bpe.encoding(MULTI, public_tokenizers.PATTERN)
    ranks, pattern = MULTI, public_tokenizers.PATTERN
    done = byte_bpe.decimal_ids(byte_bpe.decode_documents(byte_bpe.encode_documents(docs, ranks, pattern), ranks, pattern)).collect()
    want = sorted(((k, ",".join(map(str, coder.encode_ordinary(t or ""))), (t or "").encode()) for k, t, *_ in rows), key=repr)
    assert sorted(((r["doc_id"], r["decimal"], bytes(r["content"])) for r in done), key=repr) == want
    assert byte_bpe.encode_documents(nothing, ranks, pattern).count() == 0


def check_packing(found, capacity):
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r["sequence"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def plain_best_fit(sizes, capacity):
    """What is left of each sequence after a best fit by decreasing size, one piece after the other."""
    gaps = []
    for size in sorted(sizes, reverse=True):
        k = bisect.bisect_left(gaps, size)
        bisect.insort(gaps, (gaps.pop(k) if k < len(gaps) else capacity) - size)
    return gaps


def left_over(found, capacity):
    taken = collections.Counter()
    for r in found:
        taken[r["sequence"]] += r["length"]
    return sorted(capacity - n for n in taken.values())


def test_packing(docs, rows, plain):
    pieces = packing.encode_pieces(docs, LOWER, 1, 256)
    found = packing.pack_documents(pieces, 256).collect()
    want = []
    for key, text, *_ in rows:
        ids = plain[LOWER].encode(text or "", add_special_tokens=False).ids + [1]
        want += [(key, k, a, min(256, len(ids) - a), zlib.crc32(np.array(ids[a : a + 256], np.uint32).tobytes())) for k, a in enumerate(range(0, len(ids), 256))]
    got = [(r["key"], r["piece"], r["start"], r["length"], zlib.crc32(r["ids"])) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    check_packing(found, 256)
    assert left_over(found, 256) == plain_best_fit([w[3] for w in want], 256)


@pytest.mark.parametrize("capacity", [1, 7, 64, 300])
def test_sweep_leaves_what_a_plain_best_fit_leaves(capacity):
    rnd = random.Random(capacity)
    for _ in range(100):
        sizes = [min(capacity, 1 + int(rnd.expovariate(8 / capacity))) if rnd.random() < 0.7 else min(capacity, 3) for _ in range(rnd.randint(1, 300))]
        count = collections.Counter(sizes)
        starts = {s: sum(n for t, n in count.items() if t < s) for s in count}
        _, left, new = packing.sweep([(s, starts[s], count[s]) for s in sorted(count, reverse=True)], [], capacity)
        ends = [*left[1:, 0].tolist(), new]
        assert sorted(g for (first, g), end in zip(left.tolist(), ends, strict=True) for _ in range(end - first)) == plain_best_fit(sizes, capacity)


def test_packing_does_not_depend_on_partitions(spark):
    rnd = random.Random(3)
    sizes = [1 + int(rnd.paretovariate(0.7)) % 100 if rnd.random() < 0.7 else 9 for _ in range(2000)]
    given = spark.createDataFrame(list(enumerate(sizes)), "number long, length long")
    one, many = (packing.best_fit(given.repartition(n), 100, "number", "length").join(given, "number").collect() for n in (1, 23))
    assert sorted((r["number"], r["sequence"], r["offset"]) for r in one) == sorted((r["number"], r["sequence"], r["offset"]) for r in many)
    check_packing(one, 100)
    assert left_over(one, 100) == plain_best_fit(sizes, 100)
    assert {r["sequence"] for r in one} == set(range(len(plain_best_fit(sizes, 100))))


def test_packing_of_ties_and_nothing(spark, nothing):
    same = spark.range(1000).select(F.col("id").alias("number"), F.lit(3).alias("length"))
    found = packing.best_fit(same, 10, "number", "length").join(same, "number").collect()
    assert len(found) == 1000 and check_packing(found, 10) == 334
    assert packing.best_fit(same.limit(0), 10, "number", "length").count() == 0
    assert packing.encode_pieces(nothing, LOWER, 1, 64).count() == 0
    empty = spark.range(5).select(F.col("id").alias("number"), F.when(F.col("id") < 3, 0).otherwise(7).alias("length"))
    found = packing.best_fit(empty, 10, "number", "length").orderBy("number").collect()
    assert [r["offset"] for r in found] == [0] * 5 and {r["sequence"] for r in found[3:]} == {0, 1} and {r["sequence"] for r in found[:3]} <= {0, 1}
    assert packing.best_fit(empty.filter("length = 0"), 10, "number", "length").count() == 3
    with pytest.raises(ValueError):
        packing.best_fit(empty, 6, "number", "length")
