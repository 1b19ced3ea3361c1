"""Toxicity by a counterfactually regularised classifier.

A text's features are those of its distinct words: each word and its first
letters, hashed. A logistic model with sparse weights is fitted on labelled
texts. Every sentence of a labelled text that names a group is copied with
other groups' names in its place, and the fit is charged for each difference
that a swap makes to the score. So a group's mere name cannot carry a weight
of its own, and neutral mentions are not taken for insults.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framequarry.llm._shared import CACHE_LIMIT, CACHE_WORD, class_weights, labelled_sample, remainder, slices, table

#: Labelled texts of each class that the model is fitted on, at most; a longer one counts as several texts of up to so many characters.
PER_CLASS = 2000
PIECE = 40_000
FEATURES = 1 << 18
PREFIXES = (4, 5, 6)
EPOCHS = 16
BATCH = 16
RATE = 0.2
#: Charges for absolute weights, for squared weights, and for squared differences between a sentence's score and its swapped copies'.
SPARSITY = 2.0
DECAY = 0.1
SWAP_CHARGE = 1.0
LEAST_SHARE = 0.3
#: Texts of the sample that a feature must occur in.
LEAST_TEXTS = 4
THRESHOLD = 0.7

#: Names of groups, by what they tell apart; a swap stays within a line.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("black", "white", "asian", "latino", "arab", "indigenous"),
    ("african", "european", "american", "mexican", "chinese", "indian", "german", "french", "spanish"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "heterosexual", "homosexual"),
    ("immigrant", "immigrants", "refugee", "refugees", "native", "natives"),
    ("disabled", "blind", "deaf", "autistic"),
    ("old", "young", "elderly", "teenage"),
    ("frauen", "männer"),
    ("mujeres", "hombres"),
    ("femmes", "hommes"),
)

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"(?<=[.!?\n])\s*")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def word_features(word: str) -> list[int]:
    """Hashed features of a word: itself and its first letters."""
    names = [f"={word}", *(word[:n] for n in PREFIXES if len(word) >= n)]
    return [xxhash.xxh3_64_intdigest(x) % FEATURES for x in names]


def _rows(groups: Iterable[set[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all groups of words, one after another, and how many each has."""
    known: dict[str, bytes] = {}
    flat = bytearray()  # 4 bytes a number, as the driver has to hold those of the whole sample
    sizes = []
    for group in groups:
        before = len(flat)
        for w in sorted(group):
            if w not in known:
                if len(known) >= CACHE_LIMIT:
                    known.clear()
                known[w] = np.array(word_features(w), np.int32).tobytes()
            flat += known[w]
        sizes.append((len(flat) - before) // 4)
    return np.frombuffer(flat, np.int32), np.array(sizes, np.int64)


def _frequent(flat: np.ndarray, sizes: np.ndarray, least: int) -> np.ndarray:
    """The features, sorted, that occur in ``least`` rows at least; row by row, so that nothing but the counts is held."""
    rows_with = np.zeros(FEATURES, np.int64)
    at = 0
    for size in sizes.tolist():
        rows_with[np.unique(flat[at : at + size])] += 1
        at += size
    return np.flatnonzero(rows_with >= least)


def _only(flat: np.ndarray, sizes: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows' features among ``kept`` (sorted), by their places there."""
    place = np.full(FEATURES, -1, np.int32)
    place[kept] = np.arange(len(kept))
    found = place[flat]
    good = found >= 0
    ends = np.append(0, np.cumsum(sizes)).tolist()
    return found[good], np.array([np.count_nonzero(good[a:b]) for a, b in zip(ends, ends[1:])], np.int64)


def swapped_pairs(texts: list[str]) -> list[tuple[str, str | None]]:
    """(name, other name) for every sentence with a group's name and each other name of its line; None where the sentence has that one already.

    A sentence and its copy differ in these two words alone, so all the other
    words' weights cancel out and none need be kept.
    """
    others = {t: [x for x in line if x != t] for line in IDENTITY_TERMS for t in line}
    out = []
    for text in texts:
        for sentence in _SENTENCE.split(text):
            own = set(words(sentence))
            for term in sorted(own & others.keys()):
                out += [(term, None if x in own else x) for x in others[term]]
    return out


class Model:
    """A bias and the weights of features; remembers the weights of words."""

    def __init__(self, bias: float, features: np.ndarray, weights: np.ndarray):
        self.bias, self.features, self.values = bias, features, weights
        self.words = _WordWeights(dict(zip(features.tolist(), weights.tolist(), strict=True)))

    def __reduce__(self):
        return Model, (self.bias, self.features, self.values)

    def score(self, text: str | None) -> float:
        """Probability of label 1; an empty text has that of a text without known words."""
        # sorted, so that equal texts have the same score to the last bit
        z = self.bias + sum(sorted(map(self.words.__getitem__, set(words(text)))))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


class _WordWeights(dict):
    def __init__(self, weights: dict[int, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        value = sum(self.weights.get(k, 0.0) for k in word_features(word))
        if len(word) <= CACHE_WORD:
            if len(self) >= CACHE_LIMIT:
                self.clear()
            self[word] = value
        return value


def fit(texts: list[str], labels: np.ndarray, share: float, swap_charge: float = SWAP_CHARGE) -> Model:
    """Fit by follow-the-regularised-leader steps; without both classes the model is the share alone.

    ``share`` is raised to ``LEAST_SHARE`` at least, so that a rare label still counts.
    """
    share = max(share, LEAST_SHARE) if len(texts) and labels.any() else share
    if not len(texts) or labels.min() == labels.max():
        p = min(max(share, 1e-3), 1 - 1e-3)
        return Model(float(np.log(p / (1 - p))), np.empty(0, np.int64), np.empty(0))
    flat, sizes = _rows(set(words(t)) for t in texts)
    pairs = swapped_pairs(texts)
    kinds = sorted(set(pairs), key=str)
    number = {pair: k for k, pair in enumerate(kinds)}
    pairs = np.array([number[pair] for pair in pairs], np.int64)
    sides, pair_sizes = _rows([{x} if x else set() for pair in kinds for x in pair])
    # a feature of too few texts would only learn them by heart
    kept = _frequent(flat, sizes, LEAST_TEXTS)
    flat, sizes = _only(flat, sizes, kept)
    sides, pair_sizes = _only(sides, pair_sizes, kept)
    ends, pair_ends = np.append(0, np.cumsum(sizes)), np.append(0, np.cumsum(pair_sizes))
    weight, count = class_weights(labels, share), len(kept)
    rng = np.random.default_rng(0)
    # follow-the-regularised-leader: each feature has a step of its own, which shrinks as its slopes add up
    z, squares, w = np.zeros(count), np.zeros(count), np.zeros(count)
    bias, bias_squares = float(np.log(share / (1 - share))), 1.0

    def update(slope: np.ndarray) -> None:
        at = np.flatnonzero(slope)
        g = slope[at]
        root = np.sqrt(squares[at])
        squares[at] += g * g
        new = np.sqrt(squares[at])
        z[at] += g - (new - root) / RATE * w[at]
        w[at] = -np.sign(z[at]) * np.maximum(0, np.abs(z[at]) - SPARSITY) / ((1 + new) / RATE + DECAY)

    pair_batch = -(-len(pairs) * BATCH // len(texts))
    for _ in range(EPOCHS):
        order, pair_order, pair_at = rng.permutation(len(texts)), rng.permutation(len(pairs)), 0
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            features = np.concatenate([flat[ends[i] : ends[i + 1]] for i in own])
            owner = np.repeat(np.arange(len(own)), sizes[own])
            logit = bias + np.bincount(owner, weights=w[features], minlength=len(own))
            rest = weight[own] * (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - labels[own])
            slope = np.bincount(features, weights=rest[owner], minlength=count)
            for i in pairs[pair_order[pair_at : pair_at + pair_batch]]:
                x, y = (sides[pair_ends[k] : pair_ends[k + 1]] for k in (2 * i, 2 * i + 1))
                gap = swap_charge * (w[x].sum() - w[y].sum())
                np.add.at(slope, x, gap)
                np.add.at(slope, y, -gap)
            pair_at += pair_batch
            update(slope)
            bias_squares += rest.sum() ** 2
            bias -= RATE * rest.sum() / np.sqrt(bias_squares)
    used = np.flatnonzero(w)
    return Model(float(bias), kept[used], w[used])


def train(docs: DataFrame, labels: DataFrame, in_fold=None) -> Model:
    """A model from ``docs`` (doc_id, text) and the ``toxic`` column of ``labels`` (doc_id, toxic)."""
    fold = remainder(F.col("doc_id"), 3) != 1 if in_fold is None else in_fold
    return fit(*labelled_sample(docs, labels, "toxic", fold, PER_CLASS, PIECE))


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every row of ``docs``; whole texts count, a null text as an empty one."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([sent.value.score(t) for t in batch.column(1).to_pylist()], pa.float64())], names=["doc_id", "score"])

    return _narrow(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose text scores ``threshold`` or more.

    Rows go by their text alone: null ids and repeated rows stay or go like
    any, a null text counts as empty, an empty table stays empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([sent.value.score(t) < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, train(_narrow(docs, "doc_id", "text"), table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
