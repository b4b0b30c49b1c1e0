"""Mixing, block naming and sharding against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np

from sedimenta.llm import mixing
from sedimenta.llm.mixing import mix, mixed_documents, taken_words
from sedimenta.llm.naming import exact_groups, identities
from sedimenta.llm.shards import assign, difference, shard
from tests.llm import fixtures


def brute_targets(sizes, weights=(3, 1, 2), share=1.5):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    budget, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if budget * weight[s] / total > 2 * sizes[s] + 1e-9}
        if not over:
            target.update({s: budget * weight[s] / total for s in open_})
            break
        for s in over:
            target[s] = 2 * sizes[s]
            budget -= target[s]
        open_ -= over
    return target


def corpus(spark):
    rng = random.Random(3)
    data = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 400])), "en",
             "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None]), 0) for i in range(900)]
    return spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_mix_meets_its_targets(spark):
    docs = corpus(spark)
    rows = taken_words(mix(docs, block_words=64)).collect()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    sizes = Counter()
    for r in rows:
        sizes[source[r["doc_id"]]] += r["size"]
    wanted, taken = brute_targets(sizes), Counter()
    for r in rows:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - wanted[s]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert {s: taken[s] for s in sizes} == {s: int(wanted[s] + 1e-9) for s in sizes}
    assert sorted(map(tuple, rows)) == sorted(map(tuple, taken_words(mix(docs, block_words=64)).collect()))


def test_schedule_is_low_discrepancy(spark):
    made = mix(corpus(spark), block_words=64)
    counts = {r["sid"]: r["blocks"] for r in made.sources.collect()}
    slots = sorted((r["slot"], r["sid"], r["rank"]) for r in made.schedule.collect())
    seen = Counter()
    for i, (_, sid, rank) in enumerate(slots, 1):
        assert rank == seen[sid]
        seen[sid] += 1
        for s, n in counts.items():
            assert abs(seen[s] - i * n / len(slots)) <= 12
    assert dict(seen) == {s: n for s, n in counts.items() if n}


def test_schedule_by_brute_force(spark, monkeypatch):
    """The slots of a source are the bit-reversed points of its range; chunks change nothing."""
    monkeypatch.setattr(mixing, "CHUNK", 7)
    made = mix(corpus(spark), block_words=64)
    sources = sorted((r["sid"], r["first_block"], r["blocks"]) for r in made.sources.collect())
    total = sum(n for _, _, n in sources)
    bits = (total - 1).bit_length()
    want = []
    for sid, first, n in sources:
        slots = sorted(int(f"{p:0{bits}b}"[::-1], 2) for p in range(first, first + n))
        want += [(slot, sid, rank) for rank, slot in enumerate(slots)]
    assert sorted((r["slot"], r["sid"], r["rank"]) for r in made.schedule.collect()) == sorted(want)
    first = {}
    for r in made.pieces.collect():
        first[r["doc_id"]] = min(r["slot"], first.get(r["doc_id"], r["slot"]))
    rows = taken_words(made).collect()
    assert {r["doc_id"]: r["first_slot"] for r in rows if r["taken"]} == first
    assert all(r["first_slot"] is None for r in rows if not r["taken"])


def test_blocks_are_filled_once(spark):
    made = mix(corpus(spark), block_words=64)
    words = {r["sid"]: r["words"] for r in made.sources.collect()}
    filled = Counter()
    for r in made.pieces.collect():
        assert r["words"] > 0 and r["offset"] >= 0
        filled[r["sid"], r["rank"]] += r["words"]
    for sid, n in words.items():
        got = [filled[sid, k] for k in range(-(-n // 64))]
        assert got == [64] * (n // 64) + ([n % 64] if n % 64 else [])


def test_mixed_documents_repeat_whole_documents(spark):
    docs = corpus(spark)
    times = Counter(tuple(r) for r in mixed_documents(docs, block_words=64).collect())
    assert set(times) <= {tuple(r) for r in docs.collect()} and max(times.values()) == 2


def test_mixed_documents_are_interleaved(spark, tmp_path):
    """Every stretch of the written mix has a source's words in nearly its share of the whole."""
    docs = corpus(spark)
    mixed_documents(docs, block_words=64).write.parquet(str(tmp_path / "mix"))
    rows = []
    for part in sorted((tmp_path / "mix").glob("part-*.parquet")):
        rows += [(r["source"], len((r["text"] or "").split())) for r in spark.read.parquet(str(part)).collect()]
    total = sum(n for _, n in rows)
    share = Counter()
    for source, n in rows:
        share[source] += n / total
    tenths, at = [Counter() for _ in range(10)], 0
    for source, n in rows:
        tenths[min(9, at * 10 // total)][source] += n * 10 / total
        at += n
    for source, whole in share.items():
        assert all(abs(t[source] - whole) < 0.12 for t in tenths), (source, whole, [t[source] for t in tenths])


def test_names_are_identities(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(0, 14))) for _ in range(400)] + ["", None] * 40
    texts += ["abab" * 30] * 300 + ["abab" * 30 + "a", "abab" * 29 + "abba"]
    docs = fixtures.plain(spark, texts)
    same = defaultdict(set)
    for r in identities(docs, block_bytes=4).collect():
        same[r["level"], r["name"]].add(texts[r["id"]] or "")
    assert all(len(x) == 1 for x in same.values())
    assert len(same) == len({t or "" for t in texts})


def test_exact_groups_by_brute_force(spark):
    texts = [fixtures.sentence(i % 37, 5 + i % 900) for i in range(300)] + [None, "", "x"]
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[t or ""].append(i)
    for r in exact_groups(fixtures.plain(spark, texts)).collect():
        text = texts[r["doc_id"]] or ""
        ids = groups[text]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(ids), len(ids), r["doc_id"] == max(ids))
        assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def spread(sizes, parts, k):
    loads = np.zeros(k, dtype=np.int64)
    np.add.at(loads, parts, sizes)
    return loads.max() - loads.min()


def test_differencing_beats_greedy():
    rng = np.random.default_rng(2)
    better = 0
    for _ in range(20):
        sizes = rng.integers(1, 10_000, 300)
        loads = np.zeros((300, 4), dtype=np.int64)
        loads[:, 0] = sizes
        to = difference(loads)
        assert all(sorted(row) == [0, 1, 2, 3] for row in to)
        greedy, parts = np.zeros(4, dtype=np.int64), np.zeros(300, dtype=int)
        for i in np.argsort(-sizes):
            parts[i] = greedy.argmin()
            greedy[parts[i]] += sizes[i]
        better += spread(sizes, to[:, 0], 4) <= spread(sizes, parts, 4)
    assert better >= 18


def test_differencing_known_case():
    loads = np.array([[8, 0], [7, 0], [6, 0], [5, 0], [4, 0]])
    assert spread(loads[:, 0], difference(loads)[:, 0], 2) == 2


def test_cells_of_cells(spark):
    rng = random.Random(4)
    sizes = {f"g{i}": rng.randrange(1, 5000) for i in range(700)}
    groups = spark.createDataFrame(list(sizes.items()), "grp string, bytes bigint")
    found = {r["grp"]: r["shard"] for r in assign(groups, 5, cell=8).collect()}
    assert set(found) == set(sizes)
    loads = Counter()
    for g, s in found.items():
        loads[s] += sizes[g]
    assert max(loads.values()) - min(loads.values()) < 100


def test_shards_keep_groups_and_slots(spark):
    texts = [fixtures.sentence(i % 250, 20 + i % 50) for i in range(600)] + ["copy of one"] * 300
    rows = shard(fixtures.plain(spark, texts)).collect()
    where, slots, loads = defaultdict(set), defaultdict(list), Counter()
    for r in rows:
        where[texts[r["doc_id"]]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
        assert 0 <= r["shard"] < 24 and r["law"] == "bytes" and r["grown_shard"] is None
    assert all(len(s) == 1 for s in where.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(loads.values()) - min(loads.values()) < 300
