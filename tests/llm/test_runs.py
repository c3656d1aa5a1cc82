import random

import numpy as np
import pytest

from starfold.llm.periodic_runs import gram, live_stretches, periodic_runs, repeated_words, runs_of


def brute_runs(word, length, exponent):
    """By definition: maximal stretches of every period, without those of a smaller one."""
    n, out = len(word), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and word[j] == word[j + q]:
                j += 1
            size = j + q - i
            own = word[i : i + size]
            if j > i and size >= max(length, exponent * q) and not any(own[r:] == own[:-r] for r in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequences(n, longest):
    rnd = random.Random(n)
    for _ in range(n):
        word = [rnd.randrange(rnd.choice([1, 2, 3, 5])) for _ in range(rnd.randint(0, longest))]
        if word and rnd.random() < 0.5:
            a = rnd.randrange(len(word))
            p = rnd.randint(1, len(word) - a)
            word = [w if i < a else word[a + (i - a) % p] for i, w in enumerate(word)]
        yield word


@pytest.mark.parametrize("length,exponent", [(6, 4), (2, 2), (4, 3), (6, 2)])
def test_runs_and_the_screen_before_them(length, exponent):
    for word in sequences(1500, 40):
        want = brute_runs(word, length, exponent)
        assert runs_of(word, length, exponent) == want
        hashes, found = np.array(word, np.uint64) * np.uint64(7919) + np.uint64(3), []
        for a, b in live_stretches(hashes, np.zeros(len(word), np.int64), gram(length, exponent)):
            found += [(s + a, k, q) for s, k, q in runs_of(word[a:b], length, exponent)]
        assert sorted(found, key=lambda r: (r[0], r[2])) == want


def test_runs_of_fibonacci_words():
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    assert runs_of(b, 2, 2) == brute_runs(b, 2, 2)


def test_stretches_of_several_documents():
    """Words that repeat in another document do not count, nor ones of another stretch."""
    one = [1, 2, 3, 4, 5, 6, 7]
    hashes = np.array([*one, *one, 9, *one, 9, 9, 9, 9, 9, 9], np.uint64)
    document = np.array([0] * 7 + [1] * (len(hashes) - 7))
    assert live_stretches(hashes, document, gram(6, 4)) == [(22, 28)]


def brute(text, length=6, exponent=4):
    words = (text or "").encode().split()
    runs = brute_runs(words, length, exponent) if len(words) < 500 else []
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    return len(words), runs, b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def test_documents(spark, docs, rows, nothing):
    got = periodic_runs(docs).collect()
    want = [(k, *brute(t)) for k, t, *_ in rows]
    assert sorted(((r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in got), key=repr) == sorted(want, key=repr)
    assert any(w[2] for w in want) and periodic_runs(nothing).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(docs, exponent=1)


def test_repeated_words():
    assert repeated_words(8, [(1, 5, 1), (3, 4, 2)]).tolist() == [False, False, True, True, True, True, True, False]
