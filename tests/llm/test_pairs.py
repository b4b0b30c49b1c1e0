"""Near-duplicate join and decontamination against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sedimenta.llm import near_join as nj
from sedimenta.llm.common import table
from sedimenta.llm.templates import contaminated_texts, decontaminate
from tests.llm import fixtures


def brute(texts):
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        words = tuple(re.findall(r"\w+", (t or "").lower()))
        groups[words, None if words else t or ""].append(i)
    keys = list(groups)
    sets = [{k[i:i + 5] for i in range(max(1, len(k) - 4))} if k else set() for k, _ in keys]
    parent, degree = list(range(len(keys))), Counter()

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(keys)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                degree[i] += 1
                degree[j] += 1
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i, k in enumerate(keys):
        members[root(i)] += groups[k]
    return {d: (min(members[root(i)]), len(members[root(i)]), len(groups[k]), degree[i])
            for i, k in enumerate(keys) for d in groups[k]}


def near_copies(n, base, edits, rng):
    words = base.split()
    out = []
    for _ in range(n):
        copy = list(words)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(1000)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("block", [10, 400])
def test_classes_and_links(spark, monkeypatch, block):
    monkeypatch.setattr(nj, "BLOCK_TEXTS", block)
    rng = random.Random(8)
    texts = near_copies(120, fixtures.sentence(1, 150), 6, rng)
    texts += near_copies(20, fixtures.sentence(2, 60), 2, rng) + [fixtures.sentence(3, 80)] * 90
    texts += [fixtures.sentence(3, 80).upper() + "!", "one two three", "One, two three.", "one two", None, "", "?", "?", "!!! ???", "\U0001f600", "\U0001f600\U0001f680", "-- ++ =="]
    texts += [fixtures.sentence(i, 30) for i in range(100, 160)]
    expected = brute(texts)
    for r in nj.near_join(fixtures.plain(spark, texts)).collect():
        found = (r["class_id"], r["class_size"], r["copies"], r["n_links"])
        assert found == expected[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["class_id"])


def test_texts_without_words_are_kept_apart(spark):
    texts = ["!!! ???", "\U0001f600", "\U0001f680", "", None, "-- ++ ==", "\U0001f680", "words here", "Words, here!"]
    kept = {r["doc_id"] for r in nj.keep_one(fixtures.plain(spark, texts)).collect()}
    assert kept == {0, 1, 2, 3, 5, 7}


def test_chain_is_one_class(spark):
    words = fixtures.sentence(5, 100).split()
    texts = []
    for i in range(12):
        texts.append(" ".join(words))
        words[8 * i] = f"new{i}"
    expected = brute(texts)
    rows = nj.near_join(fixtures.plain(spark, texts)).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == {d: e[0] for d, e in expected.items()}
    assert len({r["class_id"] for r in rows}) == 1


def test_bands_reach_the_recall():
    bands, rows = nj.choose_bands(0.8)
    assert bands * rows <= nj.MAX_HASHES and 1 - (1 - 0.8**rows) ** bands >= nj.RECALL
    # Texts that share half or less of their n-grams mostly stay out of each other's buckets.
    assert 1 - (1 - 0.5**rows) ** bands < 0.4 and 1 - (1 - 0.3**rows) ** bands < 0.03


def test_recall_of_pairs_at_the_threshold():
    """Sets of similarity 0.8 share a band; of 0.5, seldom."""
    bands, rows = nj.choose_bands(0.8)
    random_ = np.random.default_rng(4)
    mix = (random_.integers(0, 1 << 63, bands * rows, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)

    def share(common, own, pairs):
        met = 0
        for _ in range(pairs):
            grams = random_.integers(0, 1 << 32, common + 2 * own, dtype=np.uint64).astype(np.uint32)
            a, b = (nj.signature(np.unique(g), mix).reshape(bands, rows)
                    for g in (grams[: common + own], np.concatenate([grams[:common], grams[common + own:]])))
            met += (a == b).all(axis=1).any()
        return met / pairs

    assert share(80, 10, 2000) >= 0.999 and share(50, 25, 500) < 0.5


def test_recall_on_documents(spark):
    """Every pair of different texts from 0.8 up is a link, and no other is."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    groups = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        words = tuple(re.findall(r"\w+", (r["text"] or "").lower()))
        if words:
            groups[words].append(r["doc_id"])
    sets = [{k[i:i + 5] for i in range(max(1, len(k) - 4))} for k in groups]
    holders, links = defaultdict(list), Counter()
    for i, grams in enumerate(sets):
        both = Counter()
        for g in grams:
            both.update(holders[g])
            holders[g].append(i)
        for j, n in both.items():
            if n >= 0.8 * (len(grams) + len(sets[j]) - n):
                links[i] += 1
                links[j] += 1
    expected = {d: links[i] for i, ids in enumerate(groups.values()) for d in ids}
    assert sum(links.values()) > 0
    found = {r["doc_id"]: r["n_links"] for r in nj.near_join(docs).collect()}
    assert {d: found[d] for d in expected} == expected


ITEM = ("A train leaves Boston at 7 with 120 seats and travels 30 miles before it stops. Later the same train "
        "with 120 seats travels 45 miles to Albany. How many miles did it travel in all?")


def check(spark, texts, items=(ITEM,)):
    rows = decontaminate(fixtures.plain(spark, texts), fixtures.items(spark, items)).collect()
    return {r["doc_id"]: r["contaminated"] for r in rows}


def test_templates(spark):
    changed = ITEM.replace("120", "88").replace("30", "12").replace("Boston", "Dayton").replace("miles", "km")
    torn = changed.replace("with 88 seats travels", "with 99 seats travels").replace("88 seats and", "88 seats and")
    texts = [
        ITEM,
        "before. " + ITEM.upper().lower() + " after",
        "Some words first. " + changed + " And more words.",
        fixtures.sentence(9, 200),
        " ".join(ITEM.split()[:9]),
        None,
        "",
        "7 120 30 120 45 miles 7 120 30 45 12 11 9 miles",
    ]
    found = check(spark, texts)
    assert [found[i] for i in range(len(texts))] == [True, True, True, False, False, False, False, False]
    rows = contaminated_texts(fixtures.plain(spark, [ITEM, changed]), fixtures.items(spark, [ITEM])).collect()
    assert sorted(r["changed"] for r in rows) == [False, True]
    # The two mentions of the seats must change together.
    torn_rows = contaminated_texts(fixtures.plain(spark, [torn]), fixtures.items(spark, [ITEM])).collect()
    whole = contaminated_texts(fixtures.plain(spark, [changed]), fixtures.items(spark, [ITEM])).collect()
    assert not torn_rows or torn_rows[0]["n_windows"] < whole[0]["n_windows"]


def test_short_items_and_no_items(spark):
    assert check(spark, ["we say that blue cats sing songs here", "blue cats"], ["blue cats sing songs"]) == {0: True, 1: False}
    assert check(spark, ["anything"], []) == {0: False}


def test_full_bitmap_changes_nothing(spark):
    texts = [ITEM, fixtures.sentence(9, 200), "x " + ITEM]
    docs, items = fixtures.plain(spark, texts), fixtures.items(spark, [ITEM, fixtures.sentence(10, 500)])
    small = decontaminate(docs, items, bitmap_bits=6).collect()
    large = decontaminate(docs, items).collect()
    assert sorted(map(str, small)) == sorted(map(str, large))


VERBATIM = [
    "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16", "3 plus 4", "Anna Bob Carl Dora Emil Fritz Gerd Hans Ida Jan",
    "Compute 12 34 56 78 90 11 13 15 17 19 21 23 25 27 and then say which of them is largest",
    "Birds sing songs", "Birds over the old river sing their songs", "Horses over the old river sing their songs again",
    "River 7 8 Anna", "Which of the numbers 4 7 19 23 51 88 91 97 102 is prime",
]


def test_verbatim_items_are_found(spark):
    plain = fixtures.sentence(9, 30)
    texts = [t for x in VERBATIM for t in (x, f"{plain} {x} {plain}", f"{plain}. {x} {plain}")]
    # An item without windows needs all its words, along one alignment.
    texts += [plain, VERBATIM[0].replace("16", "17"), "1 2 3 4 5 6 7 8 9 x 8 9 10 11 12 13 14 15 16"]
    rows = decontaminate(fixtures.plain(spark, texts), fixtures.items(spark, VERBATIM)).collect()
    found = {r["doc_id"]: r["item_ids"] or [] for r in rows}
    last = 3 * len(VERBATIM)
    assert [i for i in range(last) if i // 3 not in found[i]] == []
    assert [found[last + i] for i in range(3)] == [[], [], []]
