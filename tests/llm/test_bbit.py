"""b-bit MinHash components against all pairs."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from sedimenta.llm import bbit
from sedimenta.llm.common import table
from tests.llm import fixtures
from tests.llm.test_pairs import near_copies

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """(doc_id, n, component, kept) of every row of (doc_id, text), by an inverted index of shingles."""
    sets = [shingle_set(t) for _, t in rows]
    distinct = sorted(set(sets), key=len)
    where, parent = defaultdict(list), list(range(len(distinct)))

    def root(a):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        return a

    for i, s in enumerate(distinct):
        common = defaultdict(int)
        for g in s:
            for j in where[g]:
                common[j] += 1
            where[g].append(i)
        for j, both in common.items():
            if 100 * both >= 85 * (len(s) + len(distinct[j]) - both):
                parent[root(i)] = root(j)
    number = {s: i for i, s in enumerate(distinct)}
    least = {}
    for (doc, _), s in zip(rows, sets):
        if s and doc is not None:
            r = root(number[s])
            least[r] = min(least.get(r, doc), doc)
    out = []
    for (doc, _), s in zip(rows, sets):
        component = least.get(root(number[s])) if s else doc
        out.append((doc, len(s), component, doc == component))
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus():
    rng = random.Random(8)
    texts = near_copies(150, fixtures.sentence(1, 150), 5, rng) + near_copies(40, fixtures.sentence(2, 60), 3, rng)
    texts += [fixtures.sentence(3, 80)] * 90 + [fixtures.sentence(3, 80).upper(), fixtures.sentence(3, 80).replace(" ", "\x0b\n")]
    texts += ["one two three", "One two  three", "one two", None, "", " \t", "?", "É e", "é e"]
    texts += [fixtures.sentence(i, 30) for i in range(100, 160)]
    texts += [fixtures.sentence(i, 6) for i in range(200, 220)] * 2
    return list(enumerate(texts))


@pytest.mark.parametrize("sizes", [(2000, 400), (12, 5)])
def test_components(spark, monkeypatch, sizes):
    monkeypatch.setattr(bbit, "SIGNATURE_BLOCK", sizes[0])
    monkeypatch.setattr(bbit, "SET_BLOCK", sizes[1])
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert found(bbit.near_components(docs)) == brute(rows)


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(bbit.near_components(docs)) == brute(rows)


def test_blocks_find_what_pivots_leave_open(spark, monkeypatch):
    """Without any link from pivots, the blocks alone tie the same components."""
    rng = random.Random(6)
    texts = [t for seed in (1, 2, 3) for t in near_copies(40, fixtures.sentence(seed, 150), 3, rng)]
    rows = list(enumerate(texts + [fixtures.sentence(i, 30) for i in range(20)]))
    confirmed, cross, handed = bbit.confirmed, bbit.cross_links, []

    def watched(members, sets):
        handed.append(cross(members, sets).collect())
        return cross(members, sets)

    monkeypatch.setattr(bbit, "confirmed", lambda pairs, sets: confirmed(pairs, sets).where("x < 0"))
    monkeypatch.setattr(bbit, "cross_links", watched)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(bbit, "SET_BLOCK", 15)
    assert found(bbit.near_components(docs)) == brute(rows)
    # A pair is looked at in one bucket only, and a block of one hands on a tree.
    pairs = [tuple(r) for r in handed[0]]
    assert len(pairs) == len(set(pairs)) < 40 * 39 * 3 / 2


def test_awkward_ids(spark):
    text = fixtures.sentence(3, 40)
    rows = [(None, text), (None, text), (5, text), (5, text), (5, "other words"), (None, "no id here"), (None, None), (7, "")]
    docs = spark.createDataFrame([(*r, 1, "k", 2, 3) for r in rows],
                                 "doc_id bigint, text string, rid int, key string, n int, tid int")
    assert found(bbit.near_components(docs)) == brute(rows)


def test_signatures():
    rng = np.random.default_rng(1)
    low = rng.integers(0, 1 << 63, (2, bbit.HASHES), dtype=np.uint64)
    low[1, :100] = low[0, :100]
    a, b = (bbit.packed(x) for x in low)
    mask = np.uint64((1 << bbit.BITS) - 1)
    assert bbit.equal_places(a[None, :], b)[0] == ((low[0] & mask) == (low[1] & mask)).sum()
    assert len(a) * 64 == bbit.HASHES * bbit.BITS


def test_estimate_is_corrected_for_chance():
    rng = random.Random(2)
    known, mix = bbit.Words(), bbit.mixers()
    errors = []
    for seed in range(60):
        words = fixtures.sentence(seed, 300).encode().split()
        copy = [w if rng.random() > 0.03 else b"x%d" % rng.randrange(10**6) for w in words]
        a, b = bbit.shingles(words, known), bbit.shingles(copy, known)
        both = len(np.intersect1d(a, b))
        true = both / (len(a) + len(b) - both)
        equal = bbit.equal_places(bbit.packed(bbit.minima(a, mix))[None, :], bbit.packed(bbit.minima(b, mix)))[0]
        errors.append(bbit.estimate(equal) - true)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_bounds_of_the_method():
    assert (1 - 0.85**bbit.ROWS) ** bbit.BANDS < 3e-7
    least = bbit.least_matches()
    assert 0.6 < bbit.estimate(least) < 0.75
    rng = np.random.default_rng(3)
    p = 0.85 + 0.15 / 16
    assert rng.binomial(bbit.HASHES, p, 1_000_000).min() >= least - 1
