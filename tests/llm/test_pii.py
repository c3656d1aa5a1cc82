import random
import re

import pytest

from starfold.llm import pii
from starfold.llm.common import fresh_path
from starfold.sources import write_table


def plain_spans(text):
    """The fixed forms as their patterns say."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = digits(m.group())
        if 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def test_fixed_forms():
    rnd = random.Random(3)
    for _ in range(30_000):
        letters = rnd.choice(["a@.b-+ 1", "0123. +()-9 ", "12.3 a@.", "+1 (23) -45é", "4111 -", "٣1.²"])
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("unit", ["a", "1", "1 ", "+1", "a@", "1.", "(", "1:", "@"])
def test_long_runs_take_linear_time(unit):
    text = unit * 200_000  # minutes, if each character started a search anew
    taken = pii.base_spans(text)
    spans = pii.candidate_spans(text, taken)
    assert all(a[2] <= b[1] for a, b in zip(spans, spans[1:]))


def test_candidates_touch_no_taken_span():
    rnd = random.Random(4)
    for _ in range(3000):
        text = "".join(rnd.choice("12 .@a(+-)/:") for _ in range(60))
        taken = pii.base_spans(text)
        for _, s, e in pii.candidate_spans(text, taken):
            assert 0 <= s < e <= len(text) and not any(a < e and s < b for _, a, b in taken)


def test_patterns():
    text = "Please call Anna: +1 (743) 555-3824, today"
    (_, s, e), = pii.base_spans(text)
    assert pii.patterns(text, s, e) == ["call anna _", "anna _ ,", "_ , today"]
    assert pii.patterns("x", 0, 1) == ["^ ^ _", "^ _ $", "_ $ $"]


def plain_bootstrap(edges, support, trust, accept, rounds):
    """The rounds over dictionaries."""
    same = {}
    for _, i, k, _ in edges:
        for _, j, own, kinds in edges:
            if i == j and k >= 0 and own < 0 and kinds >> k & 1:
                same[i, k] = 1.0
    known, state = dict(same), None
    for _ in range(rounds):
        now = (len(known), round(sum(known.values()), 6))
        if now == state:
            break
        state, trusted = now, {}
        for p in {e[0] for e in edges}:
            own = [e for e in edges if e[0] == p]
            for k in range(4):
                have = sum(e[2] == k for e in own) + sum(known.get((e[1], k), 0) for e in own if e[2] < 0)
                have = round(have, 9)
                if have >= support and round(have / (len(own) + 1), 9) >= trust:
                    trusted[p, k] = round(have / (len(own) + 1), 9)
        left = {}
        for p, i, k, kinds in edges:
            for own in range(4):
                if k < 0 and kinds >> own & 1 and (p, own) in trusted:
                    left[i, own] = left.get((i, own), 1) * (1 - trusted[p, own])
        known = {**{at: round(1 - v, 9) for at, v in left.items() if round(1 - v, 9) >= accept}, **same}
    return known


@pytest.mark.parametrize("seed,sent", [(1, 10**6), (3, 0)])
def test_rounds(spark, monkeypatch, seed, sent):
    monkeypatch.setattr(pii, "BROADCAST_ROWS", sent)
    rnd = random.Random(seed)
    edges = set()
    for i in range(2, 60):
        kind = rnd.choice([-1, -1, 0, 3])
        kinds = 0 if kind >= 0 else rnd.choice([1, 8, 12])
        for _ in range(rnd.randint(1, 3)):
            edges.add((b"p%d" % rnd.randint(0, 5 if i % 2 else 12), b"i%d" % i, kind, kinds))
    edges |= {(b"p1", b"i1", 3, 0), (b"p2", b"i1", -1, 8)}
    table = write_table(spark.createDataFrame(list(edges), "pattern binary, instance binary, seed int, kinds int"), fresh_path(spark, "edges"))
    options = {"support": 2, "trust": 0.15, "accept": 0.3, "rounds": 4}
    got = {(bytes(r["instance"]), r["kind"]): r["score"] for r in pii.bootstrap(table, **options).collect()}
    want = plain_bootstrap(sorted(edges), **options)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-7 for k in want) and len(want) > 1


def names(df):
    return {r["doc_id"]: (r["base"], r["spans"]) for r in df.select("doc_id", pii.as_text("base").alias("base"), pii.as_text("spans").alias("spans")).collect()}


def test_contexts_find_unseen_identifiers(spark):
    said = [f"word{i} please phone me at +1 (743) 555-38{i:02d} any day" for i in range(12)]
    said += [f"we saw please phone me at 743-555-99{i:02d} any day" for i in range(2)]  # no plus: no fixed form
    said += ["lot 743-555-1234 was sold"]  # the same shape in another place
    said += [f"mail to bob{i}@host.example.com for news" for i in range(12)] + ["mail to bob@localhost for news", "see bob@here now"]
    said += ["call 17435553801 now"]  # the digits of a seed
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")
    got = names(pii.personal_data(docs))
    assert [got[i][0] for i in range(12)] == [got[i][1] for i in range(12)]
    assert got[12] == ("", "phone:26:38") and got[13] == ("", "phone:26:38")
    assert got[14] == ("", "")
    at = said.index("mail to bob@localhost for news")
    assert got[at] == ("", "email:8:21") and got[at + 1] == ("", "")
    assert got[at + 2] == ("", "phone:5:16")


def test_odd_rows(spark, docs, rows, nothing):
    got = pii.personal_data(docs).select("doc_id", pii.as_text("base").alias("base")).collect()
    want = [(k, ",".join(f"{pii.KINDS[a]}:{s}:{e}" for a, s, e in plain_spans(t or ""))) for k, t, *_ in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert pii.personal_data(nothing).count() == 0
