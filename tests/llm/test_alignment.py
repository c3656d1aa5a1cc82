import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from starfold.llm import alignment

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = "ab'sS \n\t\r\xa0\x1c\x0b́" + "é1½,!<|>　  İΣÅÅß中▁.\U0001f600 0x"


@pytest.fixture(scope="module")
def coder():
    return alignment.Aligner(*FILES)


def brute(coder, text):
    """Whole texts by both libraries, byte ranges compared with each other: links, groups, tokens of A."""
    if not text:
        return [], "", 0
    a, b = coder.a.encode(" " + text, add_special_tokens=False).ids, coder.b.encode(text)
    ranges = []
    for table, ids in ((coder.a_bytes, a), (coder.b_bytes, b)):
        ends = np.cumsum([len(table[i]) for i in ids]).tolist()
        ranges.append(list(zip([0, *ends], ends)))
        if b"".join(table[i] for i in ids) != (" " + text).encode():
            return [], "", 0
    links, first = [], 0
    for i, (s, e) in enumerate(ranges[0]):
        while ranges[1][first][1] <= s:
            first += 1
        j = first
        while j < len(b) and ranges[1][j][0] < e:
            links.append(a[i] << 32 | b[j])
            j += 1
    groups, own_a, own_b = [], list(zip(a, ranges[0])), list(zip(b, ranges[1]))
    for end in sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]}):
        part = []
        for own in (own_a, own_b):
            n = sum(1 for _ in iter(lambda own=own: bool(own) and own[0][1][1] <= end and part.append(own.pop(0)[0]) is None, False))
            part[-n:] = [",".join(map(str, part[-n:]))]
        groups.append("|".join(part))
    return links, ";".join(groups), len(a)


def test_pieces_give_the_links_of_whole_texts(coder, rows):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    texts += [r[1] for r in rows if r[1] is None or len(r[1]) < 3000]
    texts += ["<s> </s> <|endoftext|> <0x41> it's we'LL don't", "a  b   c", "\n x", " ", "word\n  next", "tab\tand  \t x", "e.g. a,b;c", "x" * 500]
    got = coder.texts(texts)
    for text, (pairs, groups, n) in zip(texts, got, strict=True):
        assert (np.frombuffer(pairs, np.int64).tolist(), groups.decode(), n) == brute(coder, text), text
    assert coder.texts(texts) == got  # by what was kept
    coder.chars = alignment.KEPT_CHARS + 1
    assert coder.texts(texts) == got


def test_sizes_come_from_spans_where_they_can(coder):
    """A file that tells wrong lengths would change nothing for whole characters, and does for parts of them."""
    plain, split = " abc def", " 中\U0001f600"
    want = coder.align([plain, split])
    coder.a_len += 1
    changed = coder.align([plain])
    coder.a_len -= 1
    assert changed == want[:1] and coder.align([split]) == want[1:]


@pytest.mark.parametrize("block", [1, 8 << 20])
def test_documents(spark, docs, rows, nothing, coder, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK", block)
    found = [(k, *brute(coder, t)) for k, t, *_ in rows]
    counts = Counter(p for _, links, *_ in found for p in set(links))
    best = {}
    for p, n in counts.items():
        best[p >> 32] = max(n, best.get(p >> 32, 0))
    want = []
    for key, links, groups, n_a in found:
        n_groups = groups.count(";") + bool(groups)
        n_b = groups.count(",") + groups.count("|") + n_groups - n_a
        want.append((key, n_a, n_b, n_groups, len(links), sum(counts[p] == best[p >> 32] for p in links), sum(counts[p] for p in links), groups))
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    got = alignment.align_tokenizers(docs, *FILES).select(*columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert alignment.align_tokenizers(nothing, *FILES).count() == 0
