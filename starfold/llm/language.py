"""Language identification by unigrams over a fixed vocabulary, summed over all segmentations.

A word (a run of letters, lower case, with the vocabulary's mark of a word's
start) is produced piece by piece; each language has its own probabilities of the
pieces of one public vocabulary. A forward pass gives the probability of a word as
the sum over all its segmentations, so no segmentation is preferred. A text's
score is the product over its words and the language's share of the training rows.

The probabilities are learnt by expectation-maximisation: a task runs forward and
backward over its share of the counted words and gives the expected number of
uses of each piece, which Spark adds up. ``sample`` bounds the documents of
each language that are counted, picked by a hash of the key from all of them.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so
is every text when nothing could be learnt; letters outside the vocabulary count as pieces
of a small fixed probability; a word of any length is summed whole; a null key is never held out; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import in_fold, own_columns, slices
from starfold.sources import stage

#: Documents of each language that the model is fitted on, about; rounds of expectation-maximisation.
SAMPLE, ROUNDS = 1000, 2
#: Probability of a letter that is no piece; letters of the longest word summed in one array (FLOOR to this power is still a number),
#: longer ones by logarithms; words kept by a worker.
FLOOR, LONGEST, KEPT_WORDS = 1e-7, 36, 300_000
START = "\u2581"
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
_vocabularies: dict[str, dict[str, int]] = {}


def vocabulary(path: str) -> dict[str, int]:
    """Ordinary pieces of a sentencepiece model, numbered from 1."""
    if path not in _vocabularies:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        own = [model.id_to_piece(i) for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        _vocabularies[path] = {p: i for i, p in enumerate(dict.fromkeys(own), 1)}
    return _vocabularies[path]


def letter_words(text: str | None) -> list[str]:
    """Words of a text: runs of letters, lower case."""
    out = []
    for w in _LETTERS.findall(text.lower()) if text else []:
        if not w.isalpha():
            w = "".join(c for c in w if c.isalpha())
        if w:
            out.append(w)
    return out


class Lattice:
    """Piece numbers of all substrings, and sums over all segmentations of words of one length."""

    def __init__(self, pieces: dict[str, int]):
        self.pieces, self.reach = pieces, max(map(len, pieces), default=1)
        self.unknown = len(pieces) + 1

    def edges(self, words: list[str]) -> np.ndarray:
        """[word, start, length - 1]: the number of the piece there, 0 for none; a lone letter always has one."""
        n = len(words[0]) + 1
        reach = min(self.reach, n)
        get, flat = self.pieces.get, []
        for w in words:
            w = START + w
            for i in range(n):
                flat += [get(w[i : i + k], 0) if i + k <= n else 0 for k in range(1, reach + 1)]
        out = np.array(flat, np.int32).reshape(len(words), n, reach)
        lone = out[:, :, 0]
        lone[lone == 0] = self.unknown
        return out

    @staticmethod
    def forward(edges: np.ndarray, table: np.ndarray) -> np.ndarray:
        """[word, position, language]: total probability of all segmentations up to each position."""
        words, n, reach = edges.shape
        alpha = np.zeros((words, n + 1, table.shape[1]))
        alpha[:, 0] = 1
        for j in range(1, n + 1):
            for k in range(1, min(reach, j) + 1):
                alpha[:, j] += alpha[:, j - k] * table[edges[:, j - k, k - 1]]
        return alpha

    @staticmethod
    def backward(edges: np.ndarray, table: np.ndarray) -> np.ndarray:
        words, n, reach = edges.shape
        beta = np.zeros((words, n + 1, table.shape[1]))
        beta[:, n] = 1
        for i in range(n - 1, -1, -1):
            for k in range(1, min(reach, n - i) + 1):
                beta[:, i] += beta[:, i + k] * table[edges[:, i, k - 1]]
        return beta

    def ending_at(self, word: str, j: int) -> list[tuple[int, int]]:
        """(letters, number) of the pieces that end at position j of a marked word."""
        found = [(k, self.pieces.get(word[j - k : j], 0)) for k in range(1, min(self.reach, j) + 1)]
        return [(k, piece or self.unknown) for k, piece in found if piece or k == 1]

    def long_forward(self, word: str, table: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """Log probability of a long word by language; with ``keep`` also the logs of the sums up to each position."""
        word, logs = START + word, np.log(table[1:])
        sums: list[np.ndarray] = [np.zeros(table.shape[1])]  # all positions, or as many as a piece reaches back
        for j in range(1, len(word) + 1):
            terms = np.stack([sums[-k] + logs[piece - 1] for k, piece in self.ending_at(word, j)])
            sums.append(np.logaddexp.reduce(terms, axis=0))
            if not keep and len(sums) > 2 * self.reach + 64:
                del sums[: -self.reach]
        return sums[-1], sums

    def add_long(self, out: np.ndarray, word: str, count: float, table: np.ndarray) -> None:
        """Add the expected uses of each piece in a long word of one language: the sums from the end, walked back over those from the start."""
        total, before = self.long_forward(word, table, keep=True)
        word, logs, n = START + word, np.log(table[1:, 0]), len(word) + 1
        after = np.full(n + 1, -np.inf)
        after[n] = 0
        for j in range(n, 0, -1):  # all pieces that start at j were met at the ends they have
            for k, piece in self.ending_at(word, j):
                step = logs[piece - 1] + after[j]
                out[piece] += count * np.exp(before[j - k][0] + step - total[0])
                after[j - k] = np.logaddexp(after[j - k], step)

    def log_probability(self, words: list[str], table: np.ndarray) -> np.ndarray:
        """[word, language]."""
        out = np.zeros((len(words), table.shape[1]))
        by_length = defaultdict(list)
        for i, w in enumerate(words):
            if len(w) > LONGEST:
                out[i] = self.long_forward(w, table)[0]
            else:
                by_length[len(w)].append(i)
        for rows in by_length.values():
            for a in range(0, len(rows), 4096):
                some = rows[a : a + 4096]
                alpha = self.forward(self.edges([words[i] for i in some]), table)
                out[some] = np.log(np.maximum(alpha[:, -1], 1e-300))
        return out

    def expected(self, words: list[str], counts: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in the words of one language (``table`` has one column)."""
        out = np.zeros(self.unknown + 1)
        by_length = defaultdict(list)
        for i, w in enumerate(words):
            if len(w) > LONGEST:
                self.add_long(out, w, counts[i], table)
            else:
                by_length[len(w)].append(i)
        for rows in by_length.values():
            for a in range(0, len(rows), 4096):
                some = rows[a : a + 4096]
                edges = self.edges([words[i] for i in some])
                alpha, beta = self.forward(edges, table)[:, :, 0], self.backward(edges, table)[:, :, 0]
                weight = counts[some] / np.maximum(alpha[:, -1], 1e-300)
                n, reach = edges.shape[1:]
                for k in range(1, reach + 1):
                    own = edges[:, : n - k + 1, k - 1]
                    use = alpha[:, : n - k + 1] * table[own, 0] * beta[:, k:] * weight[:, None]
                    out += np.bincount(own.ravel(), use.ravel(), minlength=len(out))
        out[0] = 0
        return out


def _table(uses: dict[str, np.ndarray], languages: list[str], pieces: int) -> np.ndarray:
    """Probabilities [piece, language] from expected uses, smoothed; row 0 is no piece, the last an unknown letter."""
    out = np.zeros((pieces + 2, len(languages)))
    for c, language in enumerate(languages):
        own = uses[language][1 : pieces + 1] + 0.01
        out[1 : pieces + 1, c] = np.maximum(own / own.sum(), 1e-12)
    out[pieces + 1] = FLOOR
    return out


def learn(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", language: str = "lang", sample: int = SAMPLE, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, their piece probabilities and their shares, from rows that are not held out and have a language."""
    rows = own_columns(docs, key, text, language).filter(F.col(text).isNotNull() & F.col(language).isNotNull() & ~in_fold(F.col(key)))
    shares = {r["lang"]: r["n"] for r in rows.groupBy(F.col(language).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per language
    languages = sorted(shares)
    if not languages:
        return [], np.zeros((0, 0)), np.zeros(0)
    rate = F.lit(0.0)
    for name, n in shares.items():
        rate = F.when(F.col(language) == name, F.lit(sample / n)).otherwise(rate)
    draw = F.pmod(F.xxhash64(key, text), F.lit(1 << 20)) / F.lit(1 << 20)
    some = rows.filter(draw < rate).select(F.col(language).alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found: Counter = Counter()
            for name, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found.update((name, w) for w in letter_words(t))
            names, own = [k[0] for k in found], [k[1] for k in found]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(own, pa.string()), pa.array(list(found.values()), pa.int64())], ["lang", "word", "n"])

    counted = some.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = stage(counted, "language-words")
    pieces = len(vocabulary(model))
    uses = {name: np.ones(pieces + 2) for name in languages}
    for _ in range(rounds):
        table = _table(uses, languages, pieces)

        def expect(batches: Iterator[pa.RecordBatch], table=table) -> Iterator[pa.RecordBatch]:
            lattice, total = Lattice(vocabulary(model)), {}
            for batch in batches:
                names, own, n = (batch.column(c).to_pylist() for c in ("lang", "word", "n"))
                for c, name in enumerate(languages):
                    at = [i for i, x in enumerate(names) if x == name]
                    if at:
                        got = lattice.expected([own[i] for i in at], np.array([n[i] for i in at], float), table[:, c : c + 1])
                        total[name] = total.get(name, 0) + got
            for name, got in total.items():
                at = np.flatnonzero(got)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(got[at])], ["lang", "piece", "uses"])

        added = counted.mapInArrow(expect, "lang string, piece int, uses double").groupBy("lang", "piece").agg(F.sum("uses").alias("uses"))
        uses = {name: np.zeros(pieces + 2) for name in languages}
        for name, own in added.toPandas().groupby("lang"):  # at most the vocabulary for each language
            uses[name][own["piece"].to_numpy()] = own["uses"].to_numpy()
    share = np.array([shares[name] for name in languages], float)
    return languages, _table(uses, languages, pieces), share / share.sum()


class Scorer:
    """Log probabilities of words by language, kept for the words a worker has met."""

    def __init__(self, model: str, table: np.ndarray):
        self.lattice, self.table = Lattice(vocabulary(model)), table
        self.row: dict[str, int] = {}
        self.logs = np.zeros((0, table.shape[1]))

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Of each text: summed log probabilities, and the number of its words."""
        own = [letter_words(t) for t in texts]
        if len(self.row) > KEPT_WORDS:
            self.row, self.logs = {}, np.zeros((0, self.table.shape[1]))
        new = list({w for words in own for w in words if w not in self.row})
        kept = len(self.row)
        if new:
            new.sort(key=len)
            self.row.update(zip(new, range(kept, kept + len(new)), strict=True))
            self.logs = np.concatenate([self.logs, self.lattice.log_probability(new, self.table)])
        get = self.row.__getitem__
        sums = [self.logs[np.fromiter(map(get, w), np.int64, len(w))].sum(0) for w in own]
        while new and len(new[-1]) > LONGEST:  # long words are not kept: they come last
            del self.row[new.pop()]
        self.logs = self.logs[: kept + len(new)]
        return np.array(sums).reshape(len(texts), -1), np.array([len(w) for w in own])


_scorer: list = []  # the last one of this worker, by its model and probabilities


def scorer(model: str, table: np.ndarray) -> Scorer:
    """The worker's scorer; tasks of one query go on with the words that the ones before have met."""
    if not _scorer or _scorer[0][0] != model or not np.array_equal(_scorer[0][1], table):
        _scorer[:] = [(model, table, Scorer(model, table.astype(float)))]
    return _scorer[0][2]


def predict_language(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", language: str = "lang", sample: int = SAMPLE, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: key, held_out, lang_pred, score (the probability of the prediction among the languages learnt)."""
    languages, table, share = learn(docs, model, key, text, language, sample, rounds)
    kind = docs.schema[key].dataType.simpleString()
    small = table.astype(np.float32)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model, small) if languages else None
        for batch in slices(batches):
            names, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if score is not None:
                sums, n = score(batch.column("text").to_pylist())
                z = sums + np.log(share)
                best = z.argmax(1)
                names = [languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), n.tolist(), strict=True)]
                scores = np.where(n > 0, 1 / np.exp(z - z.max(1, keepdims=True)).sum(1), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["key", "lang_pred", "score"])

    rows = own_columns(docs, key, text).select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = rows.mapInArrow(predict, f"key {kind}, lang_pred string, score double")
    return found.select(F.col("key").alias(key), in_fold(F.col("key")).alias("held_out"), "lang_pred", "score")
