"""N-gram Jaccard self-join: MinHash banding, verified on full n-gram sets.

Links are pairs of different texts whose sets of word n-grams have a Jaccard similarity
of at least the threshold. Texts of equal words (case and signs aside) are one text with
copies; links are between texts, and copies are never paired.

Band and row counts are chosen for the target recall at the threshold. Texts are shuffled
on their band hashes. The members of a bucket are not paired with one another. Instead:

1. Each member is compared with one pivot of each of its buckets, on the full sets.
2. The links found make components. In a bucket that still holds members of several
   components, members outside of its largest are compared with all others, in blocks
   of bounded size, and only links between components are handed on.
3. Within a component, links are counted in blocks in the same way: numbers leave a
   block, not pairs.

So no link between texts that share a bucket is missed and no task holds more than two
blocks, while near copies of one text, however many, are joined through pivots.

N-grams are hashed to 32 bits within sets; for a pair of n-gram counts a and b that makes
a*b / 2^32 false matches likely, below one in ten thousand of the union up to 400,000 words.

Defined cases: a null text counts as empty; texts without words are copies only if they are
the same character by character, and have no links; a text of fewer than n words is one n-gram; null ids, ties and repeated
rows are rows like others; an empty table gives an empty result; other columns are not
read by the join and are kept by ``keep_one``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from sedimenta.llm.common import fresh, map_texts, passing_tables, small_batches, small_join, staged

WORDS = re.compile(r"\w+")
GRAM = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 192
BLOCK_TEXTS = 400
BLOCK_GRAMS = 400_000
CACHE = 50_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective banding that finds a pair at the threshold with this recall."""
    best = None
    for rows in range(1, most + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows > most:
            break
        best = bands, rows
    if best is None:
        raise ValueError("no banding reaches this recall with so few hashes")
    return best


class Grams(dict):
    """Words to 64-bit hashes, and texts to sorted 32-bit n-gram hashes."""

    def __init__(self, size: int):
        self.size = size

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = found = xxh3_64_intdigest(word.encode("utf-8", "replace"))
        return found

    def of(self, words: list[str]) -> np.ndarray:
        code = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(code))
        n = len(code) - size + 1
        total = np.full(n, size, dtype=np.uint64)
        for j in range(size):
            total = (total ^ code[j: j + n]) * MULTIPLIER
            total ^= total >> np.uint64(29)
        return np.unique((total >> np.uint64(32)).astype(np.uint32))


def signature(grams: np.ndarray, mix: np.ndarray, slice_: int = 4096) -> np.ndarray:
    """The least value of each mixing of the n-gram hashes."""
    low = np.full(len(mix), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(grams), slice_):
        x = grams[i: i + slice_].astype(np.uint64)[None, :] * mix[:, None]
        x ^= x >> np.uint64(32)
        x *= MULTIPLIER
        np.minimum(low, x.min(axis=1), out=low)
    return low


def profiles(docs: DataFrame, text_col: str, gram: int, bands: int, rows: int, keep: list[str]) -> DataFrame:
    """Kept columns, key (digest of the words, or of a text without any), grams (sorted set), bands (hashes)."""
    mix = (np.random.default_rng(7).integers(0, 1 << 63, bands * rows, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)

    def start():
        grams = Grams(gram)

        def work(texts):
            keys, sets, hashes = [], [], []
            for text in texts:
                words = WORDS.findall((text or "").lower())
                # No word holds the first character, so a text without words is no other's copy.
                named = " ".join(words) if words else "\0" + (text or "")
                keys.append(hashlib.sha256(named.encode("utf-8", "replace")).digest())
                found = grams.of(words) if words else np.zeros(0, dtype=np.uint32)
                sets.append(found.view(np.int32))
                total = np.arange(bands, dtype=np.uint64) if words else np.zeros(0, dtype=np.uint64)
                if words:
                    for column in signature(found, mix).reshape(bands, rows).T:
                        total = (total ^ column) * MULTIPLIER
                        total ^= total >> np.uint64(31)
                hashes.append(total.view(np.int64))
            return [keys, _lists(sets, pa.int32()), _lists(hashes, pa.int64())]

        return work

    return map_texts(docs, keep, text_col, [("key", "binary"), ("grams", "array<int>"), ("bands", "array<long>")], start)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def linked(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    small, large = sorted((len(a), len(b)))
    return small >= threshold * large and similarity(a, b) >= threshold - 1e-12


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The (x, y) whose sets are similar enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            la, lv, ra, rv = _flat(left) + _flat(right)
            ok = [linked(lv[la[i]: la[i + 1]], rv[ra[i]: ra[i + 1]], threshold) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], names=["x", "y"]).filter(pa.array(ok, pa.bool_()))

    both = (
        pairs.join(sets.select(F.col("tid").alias("x"), F.col("grams").alias("a")), "x")
        .join(sets.select(F.col("tid").alias("y"), F.col("grams").alias("b")), "y")
        .select("x", "y", "a", "b")
    )
    return both.mapInArrow(check, "x long, y long")


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Ends and uint32 values of a list column."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int32).view(np.uint32)
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), flat


def components(links: DataFrame) -> DataFrame:
    """(tid, comp) of every text with a link; comp is the least tid that it is linked with.

    Large and small stars in turn: every text's neighbours above it, then those below it,
    are tied to the least of them, until nothing moves. A hub is a heavy key of a join
    of written tables, which AQE splits; the least neighbour is a combined aggregate.
    """
    edges = staged(links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")), "least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.filter("u <> v").distinct(), "edges")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u")
        edges = staged(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct(), "edges")
        # Equal stars twice in a row: nothing is left to move.
        state = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v") % (1 << 31)), F.lit(0))).first()
        if state == before or not state[0]:
            break
        before = state
    return edges.select(F.col("u").alias("tid"), F.col("v").alias("comp")).unionByName(
        edges.select(F.col("v").alias("tid"), F.col("v").alias("comp")).distinct())


def _in_blocks(members: DataFrame, group: str, sets: DataFrame, work, schema: str) -> DataFrame:
    """Run ``work`` on all pairs of blocks of each group of (group, tid, ..).

    A group is dealt into blocks by hash so that none is large in texts or n-grams, and a
    row goes to every pair of blocks that its own is part of.
    """
    rows = staged(members.join(sets.select("tid", "grams"), "tid"), "block-rows")
    sizes = staged(rows.groupBy(group).agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_TEXTS, F.sum(F.size("grams")) / BLOCK_GRAMS)).alias("blocks")), "block-sizes")
    own = F.pmod(F.xxhash64("tid"), F.col("blocks"))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda other: F.struct(F.least("own", other).alias("i"), F.greatest("own", other).alias("j")))
    dealt = (
        rows.join(sizes, group).withColumn("own", own).withColumn("pair", F.explode(pairs))
        .select(*members.columns, "grams", "own", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"))
    )
    return dealt.groupBy(group, "i", "j").applyInPandas(work, schema)


class _Block:
    """Sets of one block, ready to be intersected with one set after the other."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        self.known, self.at = np.unique(flat, return_inverse=True)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.flags = np.zeros(len(self.known), dtype=np.int32)

    def linked(self, one: np.ndarray, threshold: float) -> np.ndarray:
        place = np.searchsorted(self.known, one)
        place[place == len(self.known)] = 0
        place = place[self.known[place] == one]
        self.flags[place] = 1
        both = np.add.reduceat(self.flags[self.at], self.starts)
        self.flags[place] = 0
        return both >= (threshold - 1e-12) * (self.sizes + len(one) - both)


def _sets(pdf: pd.DataFrame) -> list[np.ndarray]:
    return [np.asarray(g, dtype=np.int32).view(np.uint32) for g in pdf["grams"]]


def _cross_links(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links between members of a bucket that are of different components."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        comps = pdf["comp"].to_numpy()
        names, count = np.unique(comps, return_counts=True)
        x, y = [], []
        if len(names) > 1:
            tids, own, found = pdf["tid"].to_numpy(), pdf["own"].to_numpy(), _sets(pdf)
            apart = pdf["i"].iloc[0] != pdf["j"].iloc[0]
            block = _Block(found)
            for k in np.flatnonzero(comps != names[count.argmax()]):
                hits = block.linked(found[k], threshold) & (comps != comps[k])
                if apart:
                    hits &= own != own[k]
                # One link ties two components.
                _, first = np.unique(comps[hits], return_index=True)
                for other in tids[hits][first]:
                    x.append(tids[k])
                    y.append(other)
        return pd.DataFrame({"x": np.array(x, dtype=np.int64), "y": np.array(y, dtype=np.int64)})

    return _in_blocks(members, "bucket", sets, work, "x long, y long")


def _degrees(comps: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(tid, n_links): the number of other texts that each is linked with."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        own, found = pdf["own"].to_numpy(), _sets(pdf)
        apart = pdf["i"].iloc[0] != pdf["j"].iloc[0]
        block = _Block(found)
        n = []
        for k in range(len(found)):
            hits = block.linked(found[k], threshold)
            n.append(int((hits & (own != own[k])).sum()) if apart else int(hits.sum()) - 1)
        return pd.DataFrame({"tid": pdf["tid"], "n_links": np.array(n, dtype=np.int64)})

    return _in_blocks(comps, "comp", sets, work, "tid long, n_links long").groupBy("tid").agg(F.sum("n_links").alias("n_links"))


def near_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rid_col: str | None = None,
    gram: int = GRAM, threshold: float = THRESHOLD, recall: float = RECALL, count_links: bool = True,
) -> DataFrame:
    """One row per document: rid, doc_id, tid, comp, copies, n_links.

    tid: row id of the first document with the same words; comp: least tid that the text
    is linked with over any number of links; copies: documents with the same words.
    """
    bands, rows = choose_bands(threshold, recall)
    with small_batches(docs.sparkSession):
        return _near_classes(docs, id_col, text_col, rid_col, gram, threshold, bands, rows, count_links)


def _near_classes(docs, id_col, text_col, rid_col, gram, threshold, bands, rows, count_links) -> DataFrame:
    rid = F.col(rid_col) if rid_col else F.monotonically_increasing_id()
    base = docs.select(rid.alias("rid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    base = staged(profiles(base, "text", gram, bands, rows, ["rid", "doc_id"]), "profiles")
    texts = staged(base.groupBy("key").agg(F.min("rid").alias("tid"), F.count(F.lit(1)).alias("copies")), "texts")
    firsts = base.join(texts.select(F.col("tid").alias("rid")), "rid", "left_semi")
    banded = staged(firsts.select(F.col("rid").alias("tid"), F.explode("bands").alias("bucket")), "banded")

    # The pivot is drawn anew in each bucket, so a text meets several of its likes.
    draw = F.struct(F.xxhash64("bucket", "tid").alias("draw"), "tid")
    buckets = staged(
        banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min(draw)["tid"].alias("pivot")).filter("n > 1"), "buckets")
    shared = staged(banded.join(buckets, "bucket"), "shared-buckets")
    pairs = staged(
        shared.filter("tid <> pivot").select(F.least("tid", "pivot").alias("x"), F.greatest("tid", "pivot").alias("y")).distinct(),
        "pairs")
    wanted = staged(shared.select("tid").distinct(), "wanted")
    sets = small_join(base.select(F.col("rid").alias("tid"), "grams"), wanted, "tid", "left_semi", 96)
    sets = staged(sets, "sets")
    links = staged(verified(pairs, sets, threshold), "links")

    comps = staged(components(links), "components")
    held = shared.filter("n > 2").join(comps, "tid", "left").select("bucket", "tid", F.coalesce("comp", "tid").alias("comp"))
    held = staged(held, "held-buckets")
    mixed = staged(held.groupBy("bucket").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a <> b").select("bucket"), "mixed")
    more = staged(_cross_links(held.join(mixed, "bucket"), sets, threshold), "cross-links")
    comps = staged(components(links.unionByName(more)), "components")

    if count_links:
        degrees = staged(_degrees(comps, sets, threshold), "degrees")
        comps = staged(comps.join(degrees, "tid"), "components")
    else:
        comps = comps.withColumn("n_links", F.lit(None).cast("long"))
    known = staged(
        texts.join(comps, "tid", "left").select(
            "key", "tid", "copies", F.coalesce("comp", "tid").alias("comp"),
            F.coalesce("n_links", F.lit(0)).alias("n_links")), "known-texts")
    return base.select("rid", "doc_id", "key").join(known, "key").drop("key")


def near_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, copies, n_links, kept.

    class_id is the least id in the document's class (texts tied by links, and their
    copies); the row with that id, or the first of several, is the one to keep.
    """
    rows = staged(near_classes(docs, id_col, text_col, **options), "near-rows")
    classes = staged(_classes(rows), "near-classes")
    return rows.join(classes, "comp").select(
        "doc_id", F.col("first.doc_id").alias("class_id"), "class_size", "copies", "n_links",
        (F.col("rid") == F.col("first.rid")).alias("kept"))


def _classes(rows: DataFrame) -> DataFrame:
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    return rows.groupBy("comp").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("class_size"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The document with the least id of each class; all columns."""
    name = fresh(docs, "rid")
    held = staged(docs.withColumn(name, F.monotonically_increasing_id()), "near-docs")
    with passing_tables(docs.sparkSession) as keep:
        rows = near_classes(held, id_col, text_col, rid_col=name, count_links=False, **options)
        kept = keep(staged(_classes(rows).select(F.col("first.rid").alias(name)), "near-kept"))
    return small_join(held, kept, name, "left_semi", 96).drop(name)
