import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from starfold.llm import language, quality, top_k

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def real(spark):
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")


def held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 5 == 0


def test_risk_is_that_of_the_formula():
    rnd = np.random.default_rng(1)
    zp, zu = rnd.normal(1, 1, 50), rnd.normal(0, 1, 80)
    loss = lambda z: math.log1p(math.exp(-z))
    positive = 0.4 * sum(map(loss, zp)) / 50
    negative = sum(loss(-z) for z in zu) / 80 - 0.4 * sum(loss(-z) for z in zp) / 50
    assert np.allclose(quality.nn_risk(zp, zu, 0.4), (positive, negative))


def test_classifier_learns_from_positives_and_unlabelled():
    rnd = np.random.default_rng(2)
    good, bad = rnd.normal(1, 1, (3000, 4)), rnd.normal(-1, 1, (2000, 4))
    model = quality.fit(good[:1000], np.concatenate([good[1000:2000], bad[:1000]]), 0.5)
    assert (model.score(good[2000:]) > 0.5).mean() > 0.9 and (model.score(bad[1000:]) < 0.5).mean() > 0.9


def test_quality_on_held_out_rows(real):
    found = quality.quality_scores(real("documents"), real("labels")).join(real("labels"), "doc_id").toPandas()
    own = found[found.held_out]
    assert [held(k) for k in found.doc_id] == found.held_out.tolist()
    assert found.score.between(0, 1).all()
    assert ((own.score >= 0.3) == (own.quality == 1)).mean() > 0.93
    assert (own[own.quality == 1].score >= 0.3).mean() > 0.98


def test_quality_of_odd_rows(spark, docs, rows, nothing):
    labels = spark.createDataFrame([(i, 1 if i < 100 else 0, 0) for i in range(180)] + [(3, 0, 0), (None, 1, 1), (5, None, 0)], "doc_id long, quality int, toxic int")
    found = quality.quality_scores(docs, labels).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    assert sorted((r["doc_id"], r["held_out"]) for r in found if r["doc_id"] is not None) == sorted((k, held(k)) for k, *_ in rows if k is not None)
    assert {r["score"] for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(nothing, labels).count() == 0
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["score"] >= 0.3 for r in found)
    assert quality.keep_good(nothing, labels).count() == 0


def test_forward_sums_all_segmentations():
    pieces = {"\u2581": 1, "a": 2, "b": 3, "ab": 4, "\u2581a": 5, "\u2581ab": 6}
    table = np.array([[0], [0.1], [0.2], [0.3], [0.25], [0.15], [0.05], [1e-7]])

    def brute(s):
        return 1.0 if not s else sum(table[pieces[s[:k]], 0] * brute(s[k:]) for k in range(1, len(s) + 1) if s[:k] in pieces)

    lattice = language.Lattice(pieces)
    words = ["a", "b", "ab", "abab", "bbaab"]
    assert np.allclose(np.exp(lattice.log_probability(words, table))[:, 0], [brute("\u2581" + w) for w in words])
    uses = lattice.expected(["ab"], np.array([2.0]), table)
    whole = brute("\u2581ab")
    assert np.isclose(uses[6], 2 * table[6, 0] / whole)
    assert np.isclose(uses[4], 2 * table[1, 0] * table[4, 0] / whole)


def test_language_on_held_out_rows(real):
    docs = real("documents")
    found = language.predict_language(docs, PIECES).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (found[found.held_out].lang == found[found.held_out].lang_pred).mean() > 0.97
    assert found.score.between(0, 1).all()


def test_language_of_odd_rows(docs, rows, nothing):
    found = language.predict_language(docs, PIECES, rounds=1).collect()
    assert len(found) == len(rows)
    learnt = {r[2] for r in rows if r[2] and r[1] is not None and not held(r[0])}
    assert {r["lang_pred"] for r in found} <= learnt | {"und"}
    by_key = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert [(by_key[i]["lang_pred"], by_key[i]["score"]) for i in (190, 191, 192)] == [("und", 0.0)] * 3
    assert language.predict_language(nothing, PIECES).count() == 0
    unknown = language.predict_language(docs.withColumn("lang", F.lit(None).cast("string")), PIECES)
    assert {(r["lang_pred"], r["score"]) for r in unknown.collect()} == {("und", 0.0)}


def test_language_words():
    assert language.letter_words("Don't 4² x_y ÉTÉ") == ["don", "t", "x", "y", "été"]
    assert [len(w) for w in language.letter_words("a" * 100)] == [100]


def test_long_words_are_summed_whole(monkeypatch):
    """A word of 100 letters against the sum over all its segmentations, and against the arrays that shorter words use."""
    pieces = {p: i for i, p in enumerate([language.START, language.START + "a", "a", "b", "ab", "ba", "aab", "bb"], 1)}
    lattice, rnd = language.Lattice(pieces), np.random.default_rng(3)
    table = np.concatenate([np.zeros((1, 2)), rnd.uniform(0.05, 0.3, (len(pieces), 2)), np.full((1, 2), language.FLOOR)])
    word = "".join(rnd.choice(["a", "b", "é"], 100, p=[0.5, 0.45, 0.05]))

    def enumerated(left, c):  # probability of all segmentations, by recursion over what is left
        if left not in seen[c]:
            seen[c][left] = 1.0 if not left else sum(
                (table[pieces[left[:k]], c] if left[:k] in pieces else language.FLOOR) * enumerated(left[k:], c)
                for k in range(1, len(left) + 1) if left[:k] in pieces or k == 1
            )
        return seen[c][left]

    seen = [{}, {}]
    want = [math.log(enumerated(language.START + word, c)) for c in (0, 1)]
    assert np.allclose(lattice.log_probability([word], table)[0], want)
    some, counts = [word, word[:50], "ab"], np.array([2.0, 1.0, 3.0])
    by_logs = lattice.expected(some, counts, table[:, :1])
    monkeypatch.setattr(language, "LONGEST", 200)
    assert np.allclose(by_logs, lattice.expected(some, counts, table[:, :1]))
    scorer = language.Scorer.__new__(language.Scorer)
    scorer.lattice, scorer.table, scorer.row, scorer.logs = lattice, table, {}, np.zeros((0, 2))
    whole = scorer(["ab " + word + " ba ab", word[:40]])[0]
    monkeypatch.setattr(language, "LONGEST", 10)
    scorer.row, scorer.logs = {}, np.zeros((0, 2))
    for _ in range(2):
        assert np.allclose(scorer(["ab " + word + " ba ab", word[:40]])[0], whole) and set(scorer.row) == {"ab", "ba"}


def brute_top(vectors, k):
    """Each row by itself: as query, and as candidate of every other."""
    own = [(key, [math.floor(64 * x) for x in v]) for key, v in vectors if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, (q, a) in enumerate(own):
        if q % 20 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), c) for j, (c, b) in enumerate(own) if j != i)
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scores[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block,lists,k", [(4096, 4, 20), (8, 3, 5), (4096, 1, 1000)])
def test_top_k(spark, table, block, lists, k):
    rnd = np.random.default_rng(9)
    vectors = [(i, [float(x) for x in np.float32(rnd.normal(0, 0.3, 10) + (i % 3))]) for i in range(300)]
    vectors += [(i, vectors[40][1]) for i in range(300, 340)]  # ties
    vectors += [(400, None), (420, [None] * 10), (421, [float("nan")] * 10), (440, [float("inf")] + [0.0] * 9), (None, vectors[0][1])]
    vectors += [vectors[20], vectors[21], (22, vectors[23][1]), (460, [-1.0] * 10), (480, [0.0] * 10)]
    frame = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in vectors], "vec_id long, embedding array<float>, score int, key int, `row` int").repartition(4)
    found = top_k.exact_top_k(frame, F.col("vec_id") % 20 == 0, k, lists=lists, block=block)
    assert table(found.select("query_id", "rank", "vec_id", "score")) == brute_top(vectors, k)


@pytest.mark.parametrize("size,kind", [(3.0, "float32"), (1e5, "float64"), (1e7, "int64")])
def test_top_k_is_exact_for_large_components(spark, table, size, kind):
    rnd = np.random.default_rng(4)
    vectors = [(i, (np.rint(rnd.uniform(-size, size, 8) * 64) / 64).tolist()) for i in range(120)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    assert top_k.exact_type(top_k.integer_vectors(frame, "vec_id", "embedding")) == np.dtype(kind)
    assert table(top_k.exact_top_k(frame, F.col("vec_id") % 20 == 0, 7)) == brute_top(vectors, 7)


def test_top_k_of_what_has_no_score(spark):
    some = spark.createDataFrame([(0, [1.0]), (5, [2.0, 3.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="1 and 2 components"):
        top_k.exact_top_k(some, F.col("vec_id") == 0, 1)
    large = spark.createDataFrame([(0, [1e9]), (5, [1e8])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="do not fit"):
        top_k.exact_top_k(large, F.col("vec_id") == 0, 1)


def test_lists_are_left_out_once_no_pair_can_reach_the_cutoff():
    rnd = np.random.default_rng(5)
    centres = np.rint(rnd.normal(0, 100, (40, 32)))
    vectors = np.repeat(centres, 25, axis=0) + np.rint(rnd.normal(0, 3, (1000, 32)))
    vectors = vectors.astype(np.float64)  # neighbours lie together, as in a table sorted by cluster
    queries, parts, resolved, right = vectors[::100], top_k._bounds(32, 4), 0, 0
    scores = queries @ vectors.T
    cutoff = np.sort(scores, axis=1)[:, -20]
    for at in range(0, 1000, 25):
        q, v, score, size = top_k.resolve(queries, vectors[at : at + 25], cutoff, parts)
        assert (scores[q, at + v] == score).all()
        resolved, right = resolved + size, right + len(q)
    assert right == (scores >= cutoff[:, None]).sum() and resolved < 0.2 * scores.size


def test_top_k_of_few(spark):
    frame = spark.createDataFrame([(0, [1.0]), (5, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in top_k.exact_top_k(frame, F.col("vec_id") % 20 == 0, 20).collect()] == [(0, 1, 5, 8192)]
    assert top_k.exact_top_k(frame.limit(0), F.col("vec_id") % 20 == 0, 20).count() == 0
