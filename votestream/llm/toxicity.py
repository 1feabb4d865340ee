"""Toxicity by a weighted lexicon.

Texts are folded: small letters, look-alike letters of other scripts and digits or signs
that stand for letters become the plain letter, marks that cannot be seen go, and all
else between letters becomes one space. Entries of the lexicon are words, beginnings of
words, and exception phrases. All are found in one pass by an Aho-Corasick automaton. A word
counts with the largest weight of its entries, and not at all if it lies in an exception
phrase. The sum of weights, alone and by the length of the text, gives the score.

Entries, weights and the scale of the score are learned from labelled documents, at most
``TRAIN_ROWS`` of them. Only the text and the label are used. Every term that is frequent and telling
enough is kept; how many there can be is bounded by the rows they are learned from.
"""

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..operators import materialise
from .shipping import in_arrow, ship

#: Labelled documents to learn from: those with the smallest hashes of their ids.
TRAIN_ROWS = 20_000
#: An entry must be in so many toxic documents, and this much more often than in others (log).
LEAST_DOCUMENTS = 5
LEAST_WEIGHT = 2.5
#: A phrase around an entry that so many other documents have, and no toxic one, is an exception.
LEAST_EXCEPTION = 3
STEM_LENGTHS = (4, 5, 6)
THRESHOLD = 0.3

# Characters that are written for a plain letter.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ј": "j",
    "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t",
    "у": "y", "ԝ": "w", "х": "x", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɡ": "g",
}
SUBSTITUTIONS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b",
                 "@": "a", "$": "s", "!": "i"}

_UNSEEN = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
_PLAIN = str.maketrans({**LOOK_ALIKES, **{k: v for k, v in SUBSTITUTIONS.items() if k != "!"}}) | _UNSEEN
_INNER_MARK = re.compile(r"(?<=[^\W\d_])!(?=[^\W\d_])")
_BETWEEN = re.compile(r"[\W_]+")


def folded(text: str) -> str:
    """``text`` as plain words, with a space before, between and behind them.

    ``!`` stands for a letter only between letters, elsewhere it ends a sentence.
    """
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if "!" in text:
        text = _INNER_MARK.sub(SUBSTITUTIONS["!"], text)
    return _BETWEEN.sub(" ", f" {text.translate(_PLAIN)} ")


def held_out(doc_id: Column) -> Column:
    """The quarter of documents that is never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


@dataclass
class Lexicon:
    """Weights by folded word (" word ") or beginning (" stem"), exceptions, and the scale."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    scale: tuple[float, float, float] = (-3.0, 1.0, 1.0)
    automaton: object = field(default=None, repr=False, compare=False)

    def _built(self):
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for term, weight in self.weights.items():
                self.automaton.add_word(term, (len(term), weight))
            for phrase in self.exceptions:
                term = f" {phrase.strip()} "
                self.automaton.add_word(term, (len(term), None))
            if len(self.automaton):
                self.automaton.make_automaton()
        return self.automaton

    def __getstate__(self):
        return {**self.__dict__, "automaton": None}

    def weigh(self, text: str) -> tuple[float, int]:
        """The sum of weights in a folded text, and its number of words."""
        words = text.count(" ") - 1
        automaton = self._built()
        if not len(automaton):
            return 0.0, max(words, 0)
        found: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (length, weight) in automaton.iter(text):
            begin = end - length + 1
            if weight is None:
                spared.append((begin, end))
            elif weight > found.get(begin, 0.0):
                found[begin] = weight
        for begin, end in spared:  # the space behind a phrase begins the next word
            for at in [at for at in found if begin <= at < end]:
                del found[at]
        return sum(found.values()), max(words, 0)

    def score(self, text: str | None) -> float:
        total, words = self.weigh(folded(text or ""))
        base, by_sum, by_share = self.scale
        x = base + by_sum * np.log1p(total) + by_share * np.log1p(100 * total / max(words, 1))
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def _terms(text: str) -> set[str]:
    words = set(folded(text).split())
    stems = {f" {w[:n]}" for w in words for n in STEM_LENGTHS if len(w) > n}
    return {f" {w} " for w in words if len(w) > 2} | stems


def training_rows(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``text`` and ``toxic`` of at most ``rows`` labelled documents that are not held out."""
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    own = known.select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows)
    # At most `rows` pairs of numbers, so they may be sent to every task.
    return documents.select("doc_id", "text").join(F.broadcast(own), "doc_id").select(
        F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic")
    )


def _counts(rows: DataFrame, terms_of) -> DataFrame:
    """How many toxic and other documents each term is in."""

    def count(batches):
        for batch in batches:
            found = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[1 if toxic else 0].update(terms_of(text))
            terms = [*found[0], *(t for t in found[1] if t not in found[0])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array([found[1][t] for t in terms], pa.int64()),
                 pa.array([found[0][t] for t in terms], pa.int64())], ["term", "toxic", "other"])

    counted = in_arrow(rows.select("text", "toxic"), count, "term string, toxic bigint, other bigint")
    return counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def learn(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Lexicon:
    """A lexicon and a scale from labelled documents.

    Without labels of both kinds there is nothing to learn: the lexicon is empty and the
    score is the share of toxic labels, or 0.
    """
    train = materialise(training_rows(documents, labels, rows))
    sizes = dict(train.groupBy("toxic").count().collect())  # two rows
    toxic, other = sum(n for k, n in sizes.items() if k), sizes.get(0, 0)
    if not toxic or not other:
        return Lexicon({}, scale=(-30.0 if not toxic else 30.0, 0.0, 0.0))
    often = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("other") + 0.5) / (other + 1.0))
    best = (
        _counts(train, _terms).where(F.col("toxic") >= LEAST_DOCUMENTS)
        .withColumn("weight", often).where(F.col("weight") >= LEAST_WEIGHT)
    )
    weights = {row.term: row.weight for row in best.select("term", "weight").collect()}
    plain = Lexicon(weights)

    def phrases(text):
        words = folded(text).split()
        hit = [i for i, w in enumerate(words) if _weight(weights, w)]
        return {" ".join(words[a:b]) for i in hit for a, b in ((i - 1, i + 1), (i, i + 2))
                if a >= 0 and b <= len(words)}

    spared = _counts(train, phrases).where((F.col("toxic") == 0) & (F.col("other") >= LEAST_EXCEPTION))
    lexicon = Lexicon(weights, tuple(sorted(row.term for row in spared.select("term").collect())))
    return Lexicon(weights, lexicon.exceptions, _scale(train, lexicon))


def _weight(weights: dict, word: str) -> float:
    stems = (weights.get(f" {word[:n]}", 0.0) for n in STEM_LENGTHS if len(word) > n)
    return max(weights.get(f" {word} ", 0.0), *stems, 0.0)


def _scale(train: DataFrame, lexicon: Lexicon) -> tuple[float, float, float]:
    """A logistic regression on two figures of at most ``TRAIN_ROWS`` texts."""

    def weigh(batches):
        for batch in batches:
            found = [lexicon.weigh(folded(text)) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([t for t, _ in found]), pa.array([n for _, n in found], pa.int64()),
                 batch.column(1)], ["total", "words", "toxic"])

    rows = in_arrow(train.select("text", "toxic"), weigh, "total double, words bigint, toxic int")
    total, words, toxic = np.array([tuple(r) for r in rows.collect()], float).T
    x = np.stack([np.ones_like(total), np.log1p(total), np.log1p(100 * total / np.maximum(words, 1))], 1)
    y, found, ridge = (toxic > 0).astype(float), np.zeros(3), np.diag([1e-3, 1e-1, 1e-1])
    for _ in range(30):  # Newton's steps
        p = 1 / (1 + np.exp(-np.clip(x @ found, -30, 30)))
        slope = x.T @ (y - p) - ridge @ found
        found = found + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, slope)
    return tuple(map(float, found))


def with_scores(documents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``documents`` with ``score``, 0 to 1. A NULL text is scored as an empty one.

    Columns pass through, but an older ``score`` is replaced.
    """
    rows = documents.drop("score")
    at = rows.columns.index("text")
    ship(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])

    def score(batches):
        own = shared.value
        for batch in batches:
            scores = [own.score(text.as_py()) for text in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], schema.names)

    return in_arrow(rows, score, schema)
