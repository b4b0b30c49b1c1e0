"""Toxicity: a factorization machine over hashed terms.

A document is the set of its hashed words. Its logit is a bias, a weight for each term
and a weight for each pair of its terms, where pair weights are products of short
vectors, one per term: an insult counts differently beside a group than alone, which
a sum of weights cannot say. A term takes part if it tells something alone or in a pair
with any other term; all pairs of terms that occur together are counted, and a pair tells
something if chance would not show the like once among all of them. Terms are chosen and the
model is fitted by mini-batch descent on a bounded sample of labelled rows; it is calibrated
on a fifth of the sample that neither has seen (on none where the rest has one label only).

Defined cases: null and empty texts have no terms and get the score of the bias; scores
do not depend on the length of a text except through its set of terms; documents without
label are scored like any other; with no labelled row every score is 0; repeated rows
get equal scores; columns other than the id and the text are not read.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import held_out, map_texts
from sedimenta.llm.linear import SAMPLE_ROWS, AdaGrad, Rows, collected, gather, labelled_sample, sigmoid

BITS = 22
FACTORS = 8
LEAST_ROWS = 5
# Terms that fall on either label like any others, alone and in pairs, only add noise.
LEAST_Z = 4.0
EPOCHS = 30
BATCH = 256
CUT = 0.3
CACHE = 100_000

WORDS = re.compile(r"\w+")


def terms(text: str | None, bits: int = BITS) -> list[int]:
    mask = (1 << bits) - 1
    return sorted({zlib.crc32(w.encode()) & mask for w in set(WORDS.findall((text or "").lower()))})


@dataclass(frozen=True)
class Machine:
    bits: int
    number: dict[int, int]
    """Hashed term to its row in weights and factors; absent terms have no weight."""
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    scale: float
    shift: float

    def logits(self, row, feature, n) -> np.ndarray:
        v = self.factors[feature]
        k = v.shape[1]
        flat = row[:, None] * k + np.arange(k)
        total = np.bincount(flat.ravel(), v.ravel(), n * k).reshape(n, k)
        square = np.bincount(row, (v * v).sum(axis=1), n)
        return self.bias + np.bincount(row, self.weights[feature], n) + 0.5 * ((total**2).sum(axis=1) - square)

    def scores(self, row, feature, n) -> np.ndarray:
        return sigmoid(self.scale * self.logits(row, feature, n) + self.shift)


def telling(rows: Rows, labels: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` terms fall on label 1 unlike others, alone or together with another term."""
    share = labels.mean()
    sizes = np.diff(rows.ends)
    term = rows.features
    count = np.bincount(term, minlength=size)
    hits = np.bincount(term, np.repeat(labels, sizes), size)
    keep = np.abs(hits - count * share) >= LEAST_Z * np.sqrt(count * share * (1 - share))
    own = (hits + share) / (count + 1)
    odds, base = np.log(own / (1 - own)), np.log(share / (1 - share))
    # A pair's log-likelihood ratio beyond this is expected less than once among all pairs.
    least = np.log(max(2, size * (size - 1) // 2))
    # Terms that reach it with no other term, whatever rows they share, need not be paired.
    able, before = np.ones(size, dtype=bool), -1
    low = high = odds
    while able.any() and able.sum() != before:
        before = able.sum()
        low, high = odds + odds[able].min() - base, odds + odds[able].max() - base
        # -log p and -log(1 - p) of the logit x.
        bound = [hits * np.logaddexp(0, -x) + (count - hits) * np.logaddexp(0, x) for x in (low, high)]
        able &= np.maximum(*bound) >= least
    most = np.maximum(np.logaddexp(0, -low), np.logaddexp(0, high))
    # Able terms from the most frequent to the rarest; a pair is counted at the more frequent one.
    name = np.flatnonzero(able)
    name = name[np.argsort(-count[name], kind="stable")]
    rank = np.full(size, -1)
    rank[name] = np.arange(len(name))
    row, flat = np.repeat(np.arange(len(rows)), sizes), rank[term]
    row, flat = row[flat >= 0], flat[flat >= 0]
    order = np.lexsort((flat, row))
    row, flat = row[order], flat[order]
    stop = np.searchsorted(row, row, "right")
    places = np.argsort(flat, kind="stable")
    ends = np.searchsorted(flat[places], np.arange(len(name) + 1))
    good = labels[row] > 0
    found = keep.copy()
    for i, a in enumerate(name.tolist()):
        at = places[ends[i]: ends[i + 1]]
        counted = []
        for part in (at, at[good[at]]):
            shares = [flat[x:y] for x, y in zip((part + 1).tolist(), stop[part].tolist())]
            counted.append(np.concatenate(shares) if shares else flat[:0])
        if len(counted[0]) < len(name) // 4:
            b, n = np.unique(counted[0], return_counts=True)
            can = n * most[a] >= least
            b, n = b[can], n[can]
            inside = np.sort(counted[1])
            k = np.searchsorted(inside, b, "right") - np.searchsorted(inside, b, "left")
        else:
            both, hit = (np.bincount(x, minlength=len(name)) for x in counted)
            b = np.flatnonzero(both * most[a] >= least)
            n, k = both[b], hit[b]
        rest, b = n - k, name[b]
        # The odds that the two terms alone would give.
        x = odds[a] + odds[b] - base
        ratio = (k * (np.log(np.maximum(k, 1) / n) + np.logaddexp(0, -x))
                 + rest * (np.log(np.maximum(rest, 1) / n) + np.logaddexp(0, x)))
        hit = b[ratio >= least]
        if keep[a]:
            hit = hit[~keep[hit]]
        found[hit] = True
        found[a] |= len(hit) > 0
    return found


def fit(
    sets: list[np.ndarray], labels: np.ndarray, bits: int = BITS, factors: int = FACTORS,
    epochs: int = EPOCHS, decay: float = 3e-5, seed: int = 1,
) -> Machine:
    labels = np.asarray(labels, dtype=float)
    if not len(labels) or labels.min() == labels.max():
        level = -40.0 if not len(labels) or labels[0] == 0 else 40.0
        return Machine(bits, {}, level, np.zeros(1), np.zeros((1, factors)), 1.0, 0.0)
    rows, known = gather(sets, [np.ones(len(s)) for s in sets], LEAST_ROWS)
    random = np.random.default_rng(seed)
    order = random.permutation(len(rows))
    apart, used = order[: len(order) // 5], order[len(order) // 5:]
    if labels[used].min() == labels[used].max():
        apart, used = order[:0], order
    # Terms are chosen on the rows of the fit: chance terms look good where they were chosen.
    keep = telling(rows.part(used), labels[used], len(known))
    rows, known = rows.only(keep), known[keep]
    size = max(1, len(known))
    number = {int(t): i for i, t in enumerate(known)}
    share = labels[used].mean()
    # Both classes weigh the same in the fit; calibration restores their shares.
    weight = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
    bias, w, v = np.zeros(1), np.zeros(size), random.normal(0, 0.02, (size, factors))
    steps = AdaGrad(1, 0.1), AdaGrad(size, 0.2), AdaGrad((size, factors), 0.02)
    for _ in range(epochs):
        random.shuffle(used)
        for i in range(0, len(used), BATCH):
            at = used[i:i + BATCH]
            row, feature, _ = rows.take(at)
            n = len(at)
            vf = v[feature]
            total = np.zeros((n, factors))
            np.add.at(total, row, vf)
            square = np.bincount(row, (vf * vf).sum(axis=1), n)
            logit = bias[0] + np.bincount(row, w[feature], n) + 0.5 * ((total**2).sum(axis=1) - square)
            error = weight[at] * (sigmoid(logit) - labels[at]) / n
            steps[0].step(bias, np.array([error.sum()]))
            steps[1].step(w, np.bincount(feature, error[row], size) + decay * w)
            pull = error[row][:, None] * (total[row] - vf)
            slope = np.stack([np.bincount(feature, pull[:, f], size) for f in range(factors)], axis=1)
            steps[2].step(v, slope + decay * v)
    plain = Machine(bits, number, float(bias[0]), w, v, 1.0, 0.0)
    row, feature, _ = rows.take(apart)
    return Machine(bits, number, float(bias[0]), w, v, *_calibrate(plain.logits(row, feature, len(apart)), labels[apart]))


def _calibrate(logit: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the logit that make its sigmoid a probability."""
    if not len(label) or label.min() == label.max():
        return 1.0, 0.0
    scale, shift = 1.0, float(np.log(label.mean() / (1 - label.mean())))
    steps = AdaGrad(2, 0.1)
    at = np.array([scale, shift])
    for _ in range(2000):
        p = sigmoid(at[0] * logit + at[1])
        # A pull to scale 1 keeps classes that the logit separates from being driven apart.
        steps.step(at, np.array([((p - label) * logit).sum() + at[0] - 1.0, (p - label).sum()]))
    return max(float(at[0]), 0.1), float(at[1])


class _Known(dict):
    """Words to the numbers of their terms, -1 for terms without weight."""

    def __init__(self, machine: Machine):
        self.mask, self.number = (1 << machine.bits) - 1, machine.number

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = found = self.number.get(zlib.crc32(word.encode()) & self.mask, -1)
        return found


def learn(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic",
          rows: int = SAMPLE_ROWS, bits: int = BITS) -> Machine:
    sample = labelled_sample(docs, labels, label_col, id_col, text_col, rows)
    found = map_texts(sample, ["label", "order"], "text", [("terms", "array<int>")],
                      lambda: lambda texts: [[terms(t, bits) for t in texts]])
    given, (sets,) = collected(found, "terms")
    return fit(sets, given, bits)


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def start():
        model = shared.value
        known = _Known(model)

        def work(texts):
            row, feature = [], []
            for i, text in enumerate(texts):
                if text:
                    found = set(map(known.__getitem__, set(WORDS.findall(text.lower()))))
                    found.discard(-1)
                    feature.extend(sorted(found))
                    row.extend([i] * len(found))
            p = model.scores(np.array(row, dtype=np.int64), np.array(feature, dtype=np.int64), len(texts))
            return [p, (p >= cut).astype(np.int32)]

        return work

    made = map_texts(docs.select(F.col(id_col).alias("doc_id"), text_col), ["doc_id"], text_col,
                     [("score", "double"), ("predicted", "int")], start)
    return made.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
