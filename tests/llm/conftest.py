import random

import pytest

from starfold.llm.common import ready

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, mark int, ids string, size int, n int, words string, passages string, score string"
WORDS = ["der", "the", "of", "Le", "une", "casa", "Été", "x1", "(a)", "don't", "1,234", "中文", "end."]


def make(spark, rows):
    """Documents with columns whose names clash with those inside the operators; only the first five vary."""
    return spark.createDataFrame([(i, t, l, s, None, "k", 1, "i", 2, 3, "w", "p", "s") for i, t, l, s in rows], SCHEMA)


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    ready(spark)


@pytest.fixture(scope="session")
def rows():
    """Nulls in any column, empty, blank and very long texts, ties, copies, near copies, shared passages, repeated rows."""
    rnd = random.Random(7)
    say = lambda n: " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 400)) for _ in range(n))
    passage, long = say(60), say(30_000)
    out = []
    for i in range(120):
        out.append((i, say(rnd.choice([1, 2, 3, 4, 12, 13, 14, 40, 200])), rnd.choice(["en", "de", None]), "s"))
    base = say(150)
    for i in range(120, 150):  # near copies
        own = base.split()
        for _ in range(rnd.randint(0, 3)):
            own[rnd.randrange(len(own))] = "new" + str(rnd.randint(0, 99))
        out.append((i, rnd.choice(["  ", "\n", ""]) + " ".join(own), "en", "s"))
    out += [(i, f"{say(20)}\t{passage}\n{say(20)}", "en", "hot") for i in range(150, 170)]
    out += [(i, "same text, many times the same text", "en", "hot") for i in range(170, 190)]
    out += [(190, None, None, None), (191, "", "en", "s"), (192, " \t\n ", "en", "s"), (193, long, "en", "s"), (194, long + " more", None, "s")]
    out += [(195, "a a a a a a a a a a a a a a a a a a a a", "de", "s"), (196, "é" * 3000, "fr", "s"), (197, " " * 3000 + "x", "fr", "s")]
    out += [(None, base, "en", "s"), (None, None, None, None), (7, base + " seven", "en", "s"), (150, "another text with the id 150", "en", "s")]
    return out + out[:3] + [(198, "<|endoftext|>   it's \x1c  it'S İΣ", "en", "s")]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return make(spark, rows).repartition(5).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return make(spark, []).repartition(2)


@pytest.fixture(scope="session")
def table():
    """Rows of a frame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
