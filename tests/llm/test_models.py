"""Models: gradients, exact code lengths, learnt interactions, held-out accuracy."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sedimenta.llm import language, quality, toxicity
from sedimenta.llm.common import table
from sedimenta.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_machine_keeps_a_pair_of_neutral_words(seed):
    rng = random.Random(seed)
    texts, labels = [], []
    for _ in range(4000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        texts.append(" ".join([f"w{rng.randrange(60)}" for _ in range(6)] + ["fool"] * insult + ["people"] * group))
        labels.append(int(insult == group))
    model = toxicity.fit([np.array(toxicity.terms(t)) for t in texts], np.array(labels))
    known = toxicity._Known(model)
    assert known["fool"] >= 0 and known["people"] >= 0
    right = 0
    for t, y in list(zip(texts, labels))[:500]:
        f = np.array(sorted({known[w] for w in t.split()} - {-1}), dtype=np.int64)
        right += (model.scores(np.zeros(len(f), dtype=np.int64), f, 1)[0] >= 0.5) == (y == 1)
    assert right >= 450


def test_rows_kept_for_calibration_choose_no_terms(monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "telling", lambda rows, labels, size, real=toxicity.telling: (
        seen.append(len(rows)), real(rows, labels, size))[1])
    toxicity.fit([np.array(toxicity.terms(f"a{i % 7} b{i % 5}")) for i in range(1000)], np.arange(1000) % 2)
    assert seen == [800]


def test_machine_of_noise_is_not_sure_of_itself():
    """Labels that no word tells: scores stay near the share of the label."""
    rng = random.Random(5)
    sets = [np.array(toxicity.terms(" ".join(f"w{rng.randrange(3000)}" for _ in range(30)))) for _ in range(4000)]
    labels = np.array([int(rng.random() < 0.2) for _ in sets])
    model = toxicity.fit(sets, labels)
    scores = []
    for _ in range(500):
        number = [model.number.get(t, -1) for t in toxicity.terms(" ".join(f"w{rng.randrange(3000)}" for _ in range(30)))]
        f = np.array(sorted({x for x in number if x >= 0}), dtype=np.int64)
        scores.append(model.scores(np.zeros(len(f), dtype=np.int64), f, 1)[0])
    assert abs(np.mean(scores) - 0.2) < 0.05 and np.quantile(scores, 0.99) < 0.4


def test_machine_of_few_rows_has_scores():
    for n in (0, 1, 2, 4, 6):
        sets = [np.array(toxicity.terms(f"word{i} x")) for i in range(n)]
        model = toxicity.fit(sets, np.arange(n) % 2)
        score = model.scores(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 1)
        assert 0 <= score[0] <= 1


def test_machine_matches_the_double_sum():
    rng = np.random.default_rng(3)
    model = toxicity.Machine(22, {}, 0.3, rng.normal(size=9), rng.normal(size=(9, 4)), 1.0, 0.0)
    f = np.array([1, 4, 5, 8])
    direct = 0.3 + model.weights[f].sum() + sum(
        model.factors[a] @ model.factors[b] for i, a in enumerate(f) for b in f[i + 1:])
    assert np.isclose(model.logits(np.zeros(4, dtype=np.int64), f, 1)[0], direct)


def test_ordinal_recovers_grades():
    rng = random.Random(2)
    texts, grades = [], []
    for _ in range(3000):
        good = rng.random()
        texts.append(" ".join("fine" if rng.random() < good else "poor" for _ in range(30)))
        grades.append(min(3, int(4 * good)))
    read = quality.Features(22).read
    pairs = [read(t) for t in texts]
    model = quality.fit([f for f, _ in pairs], [v for _, v in pairs], np.array(grades))
    assert model.grades == (0, 1, 2, 3) and all(np.diff(model.thresholds) > 0)
    expected, tails = quality._judge(model, texts, quality.Features(22))
    assert (np.diff(tails, axis=1) <= 0).all()
    assert np.corrcoef(expected, grades)[0, 1] > 0.9
    assert (quality._tail_of(model, 2, tails) == tails[:, 1]).all()
    assert (quality._tail_of(model, 9, tails) == 0).all() and (quality._tail_of(model, 0, tails) == 1).all()


def brute_bits(samples, text):
    """PPM by the book: method C, no exclusions, one language."""
    counts = defaultdict(Counter)
    for s in samples:
        data = language.PAD + s.lower().encode()
        for i in range(3, len(data)):
            for k in range(4):
                counts[data[i - k:i]][data[i]] += 1
    data, bits = language.PAD + text.lower().encode(), 0.0
    for i in range(3, len(data)):
        for k in (3, 2, 1, 0):
            seen = counts.get(data[i - k:i])
            if not seen:
                continue
            total, kinds = sum(seen.values()), len(seen)
            if data[i] in seen:
                bits -= math.log2(seen[data[i]] / (total + kinds))
                break
            bits -= math.log2(kinds / (total + kinds))
        else:
            bits += 8
    return bits


@pytest.mark.parametrize("text", ["the cat sat", "zzz é new", "", "a", "der hund und die katze"])
def test_exact_code_lengths(spark, text):
    samples = {"en": ["the cat sat on the mat", "a cat and a hat"], "de": ["der hund und die katze", "die maus"]}
    rows = [(i, t, lang) for lang, ts in samples.items() for i, t in zip((0, 1, 2, 3), ts)]
    trees = language.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    held = {i for i in range(4) if zlib.crc32(str(i).encode()) % 4 == 2}
    data = language.padded(text)
    found = trees.bits(data, np.array([0, len(data)]))[0]
    for k, lang in enumerate(trees.languages):
        used = [t for i, t, x in rows if x == lang and i not in held]
        assert np.isclose(found[k], brute_bits(used, text))


def test_pieces_do_not_change_codes(spark, monkeypatch):
    docs = table(spark, SF, "documents").limit(40)
    trees = language.learn(docs)
    whole = sorted(map(tuple, language.identify(docs, trees).select("doc_id", "lang_pred").collect()))
    monkeypatch.setattr(language, "PIECE", 64)
    assert sorted(map(tuple, language.identify(docs, trees).select("doc_id", "lang_pred").collect())) == whole


def test_language_held_out(spark):
    rows = QUERIES["op7_language_id"](spark, SF).join(table(spark, SF, "documents"), "doc_id").filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.97 * len(rows)


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op5_quality"](spark, sf).join(table(spark, sf, "labels"), "doc_id").filter("held_out").collect()
    assert sum(r["kept"] == (r["quality"] == 1) for r in rows) >= 0.98 * len(rows)
    good = [r for r in rows if r["quality"] == 1]
    assert sum(r["kept"] for r in good) >= 0.99 * len(good)
    assert all(0 <= r["tail_prob"] <= 1 for r in rows)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op4_toxicity"](spark, sf).join(table(spark, sf, "labels"), "doc_id").filter("held_out").collect()
    bad = [r for r in rows if r["toxic"] == 1]
    clean = [r for r in rows if r["toxic"] == 0]
    assert sum(r["predicted"] for r in bad) >= 0.8 * len(bad)
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
