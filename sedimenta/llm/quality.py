"""Quality: ordinal cumulative-link regression on graded ratings.

Grades 0 < 1 < .. < K share one weighted sum of hashed text features and have ordered
thresholds: P(grade >= g) = sigmoid(sum - threshold of g). That gives an expected grade
and, for selection, the tail probability of a grade. Features are the words of a text
and their shapes (letters by case, digits, repeated signs), as shares of the text, plus
classes of its length, of the share of different words and of repeated lines.

Defined cases: null and empty texts have only the class of length zero; with no rated
row every expected grade is 0 and nothing is rejected; with one grade only, that grade is
certain; repeated rows get equal results; other columns are not read by the model and are
kept as they are by ``select_good``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.common import fresh, held_out, map_texts
from sedimenta.llm.linear import AdaGrad, collected, gather, labelled_sample, sigmoid

BITS = 22
ROWS = 8_000
LEAST_ROWS = 10
EPOCHS = 15
BATCH = 256
CUT = 0.5
CACHE = 400_000
SLICE = 500
KEPT_TOKEN = 64

REPEATED = re.compile(r"(.)\1+")
LETTERS = re.compile(r"[^\W\d_]+")


def shape(token: str) -> str:
    """Letters become one a, A or Aa by case, digits one 0, and repeated signs one pair."""
    def letters(m: re.Match) -> str:
        word = m.group()
        return "a" if word.islower() else "A" if word.isupper() else "Aa"

    return REPEATED.sub(r"\1\1", re.sub(r"\d+", "0", LETTERS.sub(letters, token)))


class Features(dict):
    """Tokens to the hashes of their word and shape."""

    def __init__(self, bits: int):
        self.mask = (1 << bits) - 1

    def of(self, name: str) -> int:
        return zlib.crc32(name.encode("utf-8", "replace")) & self.mask

    def __missing__(self, token: str) -> tuple[int, int]:
        if len(self) >= CACHE:
            self.clear()
        found = self.of("w" + token.lower()), self.of("s" + shape(token))
        # Runs without white space may be as long as a text; they do not come again.
        if len(token) <= KEPT_TOKEN:
            self[token] = found
        return found

    def read(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers and values of a text, each feature once."""
        tokens = (text or "").split()
        n = len(tokens)
        counts: Counter[int] = Counter()
        different = Counter(tokens)
        for token, times in different.items():
            for f in self[token]:
                counts[f] += times
        values = {f: (c / n) ** 0.5 for f, c in counts.items()}
        values[self.of(f"n{n.bit_length()}")] = 1.0
        if n:
            lines = [x for x in (text or "").split("\n") if x]
            values[self.of(f"u{10 * len(different) // n}")] = 1.0
            values[self.of(f"l{10 * len(set(lines)) // max(1, len(lines))}")] = 1.0
        return np.fromiter(values.keys(), np.int32, len(values)), np.fromiter(values.values(), np.float32, len(values))


@dataclass(frozen=True)
class Ordinal:
    bits: int
    known: np.ndarray
    weights: np.ndarray
    """Weights of the known features, in their order; the others have none."""
    grades: tuple[int, ...]
    thresholds: np.ndarray

    def tails(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """n x (grades - 1): probabilities of each grade but the lowest, or better."""
        at = np.searchsorted(self.known, feature)
        at[at == len(self.known)] = 0
        weight = self.weights[at] * (self.known[at] == feature) if len(self.known) else np.zeros(len(feature))
        return sigmoid(np.bincount(row, weight * value, n)[:, None] - self.thresholds[None, :])

    def expected(self, tails: np.ndarray) -> np.ndarray:
        if not self.grades:
            return np.zeros(len(tails))
        return self.grades[0] + tails @ np.diff(np.array(self.grades, dtype=float))


def fit(features: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray,
        bits: int = BITS, epochs: int = EPOCHS, decay: float = 1e-5, seed: int = 1) -> Ordinal:
    grades = tuple(int(g) for g in np.unique(labels))
    if len(grades) < 2:
        return Ordinal(bits, np.zeros(0, dtype=np.int64), np.zeros(0), grades, np.zeros(0))
    rows, known = gather(features, values, LEAST_ROWS)
    rank = np.searchsorted(grades, labels)
    cuts = len(grades) - 1
    size = max(1, len(known))
    # Ordered by construction: a first threshold, then the logarithms of the gaps.
    share = np.array([np.clip((rank > k).mean(), 1e-3, 1 - 1e-3) for k in range(cuts)])
    start = np.log((1 - share) / share)
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    w = np.zeros(size)
    steps = AdaGrad(size, 0.3), AdaGrad(cuts, 0.05)
    random = np.random.default_rng(seed)
    order = np.arange(len(rows))
    for _ in range(epochs):
        random.shuffle(order)
        for i in range(0, len(order), BATCH):
            at = order[i:i + BATCH]
            row, feature, value = rows.take(at)
            n = len(at)
            threshold = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
            tail = sigmoid(np.bincount(row, w[feature] * value, n)[:, None] - threshold)
            edge = np.concatenate([np.ones((n, 1)), tail, np.zeros((n, 1))], axis=1)
            here = np.arange(n)
            high, low = edge[here, rank[at]], edge[here, rank[at] + 1]
            p = np.maximum(high - low, 1e-9)
            # d log p / d sum; a threshold moves only the tail that it bounds.
            up, down = high * (1 - high), low * (1 - low)
            slope = -(up - down) / p / n
            steps[0].step(w, np.bincount(feature, slope[row] * value, size) + decay * w)
            moved = np.zeros(cuts)
            np.add.at(moved, rank[at][rank[at] > 0] - 1, (up / p / n)[rank[at] > 0])
            np.add.at(moved, rank[at][rank[at] < cuts], -(down / p / n)[rank[at] < cuts])
            after = np.cumsum(moved[::-1])[::-1]
            steps[1].step(free, np.concatenate([after[:1], after[1:] * np.exp(free[1:])]))
    return Ordinal(bits, known, w, grades, np.cumsum(np.concatenate([free[:1], np.exp(free[1:])])))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows: int = ROWS, bits: int = BITS) -> Ordinal:
    sample = labelled_sample(docs, labels, label_col, id_col, text_col, rows)

    def start():
        features = Features(bits)

        def work(texts):
            read = [features.read(t) for t in texts]
            return [[f for f, _ in read], [v for _, v in read]]

        return work

    found = map_texts(sample, ["label", "order"], "text",
                      [("features", "array<int>"), ("worth", "array<float>")], start)
    given, (features, values) = collected(found, "features", "worth")
    return fit(features, values, given, bits)


def _judge(model: Ordinal, texts, features: Features) -> tuple[np.ndarray, np.ndarray]:
    """Expected grades and tails; the features of a slice of the batch are held at a time."""
    slices = [_judge_slice(model, texts[i: i + SLICE], features) for i in range(0, max(1, len(texts)), SLICE)]
    return np.concatenate([expected for expected, _ in slices]), np.concatenate([tails for _, tails in slices])


def _judge_slice(model: Ordinal, texts, features: Features) -> tuple[np.ndarray, np.ndarray]:
    read = [features.read(t) for t in texts]
    sizes = [len(f) for f, _ in read]
    row = np.repeat(np.arange(len(read)), sizes)
    feature = np.concatenate([f for f, _ in read]) if read else np.zeros(0, dtype=np.int32)
    value = np.concatenate([v for _, v in read]) if read else np.zeros(0, dtype=np.float32)
    tails = model.tails(row, feature, value, len(read))
    return model.expected(tails), tails


def _tail_of(model: Ordinal, grade: int, tails: np.ndarray) -> np.ndarray:
    """Probability of the grade or better, which is the next grade that was rated."""
    k = sum(g < grade for g in model.grades)
    if k == 0 or not model.grades:
        return np.ones(len(tails))
    return tails[:, k - 1] if k <= tails.shape[1] else np.zeros(len(tails))


def grade(docs: DataFrame, model: Ordinal, id_col: str = "doc_id", text_col: str = "text",
          least_grade: int = 1, cut: float = CUT) -> DataFrame:
    """One row per document: doc_id, held_out, expected_grade, tail_prob, kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        features = Features(shared.value.bits)

        def work(texts):
            expected, tails = _judge(shared.value, texts, features)
            tail = _tail_of(shared.value, least_grade, tails)
            return [expected, tail, tail >= cut]

        return work

    made = map_texts(docs.select(F.col(id_col).alias("doc_id"), text_col), ["doc_id"], text_col,
                     [("expected_grade", "double"), ("tail_prob", "double"), ("kept", "boolean")], start)
    return made.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "expected_grade", "tail_prob", "kept")


def select_good(docs: DataFrame, model: Ordinal, text_col: str = "text", least_grade: int = 1, cut: float = CUT) -> DataFrame:
    """The documents that are at least of the grade with the probability ``cut``; all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    cache: list[Features] = []

    def judge(texts: pd.Series) -> pd.Series:
        if not cache:
            cache.append(Features(shared.value.bits))
        _, tails = _judge(shared.value, [t if isinstance(t, str) else None for t in texts], cache[0])
        return pd.Series(_tail_of(shared.value, least_grade, tails))

    tail = F.pandas_udf(judge, T.DoubleType())
    name = fresh(docs, "tail")
    return docs.withColumn(name, tail(F.col(text_col))).filter(F.col(name) >= cut).drop(name)
