"""Near-duplicate components by b-bit MinHash.

A document's set is that of its 5-word shingles; documents are linked if the intersection of
their sets is at least ``THRESHOLD`` percent of the union, and components are what links tie.

Every set gets ``HASHES`` minima. Bands of whole minima give candidates: texts that share a
bucket. Of each minimum the lowest ``BITS`` bits are packed into a signature, and the number
of equal places of two signatures, one exclusive or and a count of bits, estimates their
similarity: places agree by chance with probability C = 2^-BITS, so the estimate is
(equal / HASHES - C) / (1 - C). Candidates that a linked pair would have as few equal places
as only once in ``1 / MISS`` cases are passed over; all others are confirmed on full sets of
64-bit shingle hashes. A pair at the threshold shares no bucket once in about four million.

Texts of equal words are one text. Members of a bucket are not paired with one another:

1. Each is compared with the bucket's pivot (by signature, then on full sets); links make
   components.
2. In buckets that still hold several components, members are compared by signature in blocks
   of bounded size, and those with a candidate in another component are marked.
3. Marked members are confirmed in blocks on full sets; a block hands on a spanning set of
   links, one row per member at most, and skips pairs that are tied already.

A pair is looked at in the first bucket that both share and in no other, and no link between
different texts that share a bucket is missed. Full sets are made again from the texts that
need them, so they are not kept for all.

Defined cases: a null or wordless text has an empty set and is linked with nothing; a text of
fewer than five words is one shingle; null ids count as greater than all others, so they get
the least id of their component, or null where there is none, and are kept then; ties and
repeated rows are rows like others; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import math
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from sedimenta.llm.common import map_texts, small_join, staged
from sedimenta.llm.near_join import components

GRAM = 5
THRESHOLD = 85
ROWS, BANDS = 6, 32
HASHES = ROWS * BANDS
BITS = 4
MISS = 1e-7
CACHE = 50_000
# Members of a block compared by signature, and those (and their shingles) compared on full sets.
SIGNATURE_BLOCK = 2000
SET_BLOCK, SET_BLOCK_GRAMS = 400, 400_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def least_matches(threshold: int = THRESHOLD, hashes: int = HASHES, bits: int = BITS, miss: float = MISS) -> int:
    """The fewest equal places that a linked pair has, but for a chance of ``miss``."""
    p = threshold / 100 + (1 - threshold / 100) * 2.0**-bits
    total, k = 0.0, 0
    while True:
        total += math.exp(math.lgamma(hashes + 1) - math.lgamma(k + 1) - math.lgamma(hashes - k + 1)
                          + k * math.log(p) + (hashes - k) * math.log1p(-p))
        if total > miss:
            return k
        k += 1


def estimate(equal: np.ndarray | int, hashes: int = HASHES, bits: int = BITS) -> np.ndarray | float:
    """Similarity from the number of equal places, corrected for those that agree by chance."""
    chance = 2.0**-bits
    return (equal / hashes - chance) / (1 - chance)


class Words(dict):
    """Words to 64-bit hashes, a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = found = xxh3_64_intdigest(word)
        return found


def words_of(text: bytes | None) -> list[bytes]:
    """A-Z in lower case, cut at the six ASCII white-space characters."""
    return (text or b"").lower().split()


def shingles(words: list[bytes], known: Words) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    code = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(GRAM, len(code))
    n = len(code) - size + 1
    total = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        total = (total ^ code[j: j + n]) * MULTIPLIER
        total ^= total >> np.uint64(29)
    return np.unique(total)


def minima(grams: np.ndarray, mix: np.ndarray, slice_: int = 1024) -> np.ndarray:
    low = np.full(len(mix), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(grams), slice_):
        x = grams[i: i + slice_][None, :] * mix[:, None]
        x ^= x >> np.uint64(32)
        x *= MULTIPLIER
        np.minimum(low, x.min(axis=1), out=low)
    return low


def packed(low: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The lowest bits of the minima, side by side in 64-bit words."""
    places = 64 // bits
    words = np.zeros(-(-len(low) // places) * places, dtype=np.uint64)
    words[: len(low)] = low & np.uint64((1 << bits) - 1)
    shifts = np.arange(places, dtype=np.uint64) * np.uint64(bits)
    return np.bitwise_or.reduce(words.reshape(-1, places) << shifts, axis=1)


def equal_places(a: np.ndarray, b: np.ndarray, hashes: int = HASHES, bits: int = BITS) -> np.ndarray:
    """Equal places of signatures, by one exclusive or and a count of bits; rows of a against b."""
    x = a ^ b
    step = 1
    while step < bits:
        x |= x >> np.uint64(step)
        step *= 2
    x &= np.uint64(sum(1 << i for i in range(0, 64, bits)))
    return hashes - np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


def mixers() -> np.ndarray:
    return (np.random.default_rng(12).integers(0, 1 << 63, HASHES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def profiles(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """rid, doc_id, raw (digest of the text), key (digest of its words, null without), n, bands, signature."""
    base = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).cast("binary").alias("text"))
    base = base.select("rid", "doc_id", F.unhex(F.sha2("text", 256)).alias("raw"), "text")

    def start():
        known, mix = Words(), mixers()

        def work(texts):
            keys, sizes, bands, signatures = [], [], [], []
            for text in texts:
                words = words_of(text)
                grams = shingles(words, known)
                sizes.append(len(grams))
                if not words:
                    keys.append(None)
                    bands.append([])
                    signatures.append(None)
                    continue
                keys.append(hashlib.sha256(b" ".join(words)).digest())
                low = minima(grams, mix)
                total = np.arange(BANDS, dtype=np.uint64)
                for column in low.reshape(BANDS, ROWS).T:
                    total = (total ^ column) * MULTIPLIER
                    total ^= total >> np.uint64(31)
                bands.append(total.view(np.int64))
                signatures.append(packed(low).tobytes())
            return [keys, sizes, bands, signatures]

        return work

    fields = [("key", "binary"), ("n", "long"), ("bands", "array<long>"), ("signature", "binary")]
    return map_texts(base, ["rid", "doc_id", "raw"], "text", fields, start)


def full_sets(docs: DataFrame, text_col: str, wanted: DataFrame) -> DataFrame:
    """(tid, grams) of the wanted (tid, raw); texts are read again and found by their digest."""
    text = F.col(text_col).cast("binary")
    source = docs.select(F.unhex(F.sha2(text, 256)).alias("raw"), text.alias("text"))
    source = small_join(source, wanted.select("raw"), "raw", "left_semi", 64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = Words(), OrderedDict()
        for batch in batches:
            raws, sets = [], []
            for raw, text in zip(batch.column(0), batch.column(1)):
                raw = raw.as_py()
                # Copies of a text that this task has just met; the rest are folded below.
                if raw in seen:
                    continue
                seen[raw] = None
                if len(seen) > CACHE:
                    seen.popitem(last=False)
                raws.append(raw)
                sets.append(shingles(words_of(text.as_py()), known).view(np.int64))
                if sum(map(len, sets)) > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(raws, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["raw", "grams"])
                    raws, sets = [], []
            yield pa.RecordBatch.from_arrays([pa.array(raws, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["raw", "grams"])

    made = small_join(source.mapInArrow(work, "raw binary, grams array<long>"), wanted, "raw", "inner", 72)
    # One of several equal rows: copies in different tasks are told apart by a number.
    made = staged(made.select("tid", "grams", F.monotonically_increasing_id().alias("one")), "some-sets")
    ones = staged(made.groupBy("tid").agg(F.min("one").alias("one")).select("one"), "ones")
    return small_join(made, ones, "one", "left_semi", 32).drop("one")


def _size_ok(a, b):
    return 100 * F.least(a, b) >= THRESHOLD * F.greatest(a, b)


def promising(pairs: DataFrame, firsts: DataFrame) -> DataFrame:
    """The (x, y) whose sizes and signatures do not speak against a link."""
    least = least_matches()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (_signatures(batch.column(i)) for i in (2, 3))
            ok = equal_places(a, b) >= least
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["x", "y"]).filter(pa.array(ok, pa.bool_()))

    def side(name: str) -> DataFrame:
        return firsts.select(F.col("tid").alias(name), F.col("n").alias(f"n{name}"), F.col("signature").alias(f"s{name}"))

    both = pairs.join(side("x"), "x").join(side("y"), "y").where(_size_ok(F.col("nx"), F.col("ny")))
    return both.select("x", "y", "sx", "sy").mapInArrow(work, "x long, y long")


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64).reshape(len(column), -1)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (x, y) that are linked, on their full sets."""
    both = (
        pairs.join(sets.select(F.col("tid").alias("x"), F.col("grams").alias("a")), "x")
        .join(sets.select(F.col("tid").alias("y"), F.col("grams").alias("b")), "y")
    )
    common = F.size(F.array_intersect("a", "b")).cast("long")
    return both.select("x", "y", common.alias("both"), (F.size("a") + F.size("b")).alias("sum")).where(
        f"100 * both >= {THRESHOLD} * (sum - both)").select("x", "y")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= THRESHOLD * (len(a) + len(b) - both)


def in_blocks(rows: DataFrame, work: Callable[[pa.Table], pa.Table], schema: str, texts: int, weight: str, most: int) -> DataFrame:
    """Run ``work`` on all pairs of blocks of each bucket; a block is bounded in texts and in weight."""
    rows = staged(rows, "block-rows")
    sizes = staged(rows.groupBy("bucket").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / texts, F.sum(weight) / most)).alias("blocks")), "block-sizes")
    own = F.pmod(F.xxhash64("tid"), F.col("blocks"))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda other: F.struct(F.least("own", other).alias("i"), F.greatest("own", other).alias("j")))
    dealt = rows.join(sizes, "bucket").withColumn("own", own).withColumn("pair", F.explode(pairs))
    dealt = dealt.select("*", F.col("pair.i").alias("i"), F.col("pair.j").alias("j")).drop("pair", "blocks")
    return dealt.groupBy("bucket", "i", "j").applyInArrow(work, schema)


class Block:
    """Members of two blocks of a bucket (or of one), as arrays."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.bucket = table.column("bucket")[0].as_py()
        self.tid, self.comp, self.n, self.own = (
            table.column(c).to_numpy().astype(np.int64) for c in ("tid", "comp", "n", "own"))
        self.apart = table.column("i")[0].as_py() != table.column("j")[0].as_py()
        self.bands = np.stack([np.asarray(x, dtype=np.int64) for x in table.column("bands").to_pylist()])
        self.signatures = _signatures(table.column("signature").combine_chunks())
        names, count = np.unique(self.comp, return_counts=True)
        self.outside = np.flatnonzero(self.comp != names[count.argmax()]) if len(names) > 1 else np.zeros(0, dtype=int)
        self.least = least_matches()

    def candidates(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Members that k may be linked with in another component, and their equal places."""
        small, large = np.minimum(self.n, self.n[k]), np.maximum(self.n, self.n[k])
        ok = (self.comp != self.comp[k]) & (100 * small >= THRESHOLD * large)
        if self.apart:
            ok &= self.own != self.own[k]
        at = np.flatnonzero(ok)
        equal = equal_places(self.signatures[at], self.signatures[k])
        at, equal = at[equal >= self.least], equal[equal >= self.least]
        # The first band that both share is the one to look at the pair in.
        same = self.bands[at] == self.bands[k]
        here = self.bands[k][same.argmax(axis=1)] == self.bucket if len(at) else np.zeros(0, dtype=bool)
        return at[here], equal[here]


def marked(members: DataFrame) -> DataFrame:
    """(bucket, tid) of members that signatures put near a member of another component."""

    def work(table: pa.Table) -> pa.Table:
        block = Block(table)
        near = np.zeros(len(block.tid), dtype=bool)
        for k in block.outside:
            at, _ = block.candidates(k)
            near[at] = True
            near[k] |= bool(len(at))
        found = block.tid[near]
        return pa.table({"bucket": pa.array([block.bucket] * len(found), pa.int64()), "tid": pa.array(found, pa.int64())})

    one = members.withColumn("weight", F.lit(0))
    return in_blocks(one, work, "bucket long, tid long", SIGNATURE_BLOCK, "weight", 1).distinct()


def cross_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links that tie the components of a bucket, a spanning set of them per pair of blocks."""

    def work(table: pa.Table) -> pa.Table:
        block = Block(table)
        lists = table.column("grams").combine_chunks()
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        sets_ = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
        tied = {c: c for c in block.comp.tolist()}

        def root(c: int) -> int:
            while tied[c] != c:
                tied[c] = c = tied[tied[c]]
            return c

        x, y = [], []
        for k in block.outside:
            at, equal = block.candidates(k)
            for other in at[np.argsort(-equal, kind="stable")]:
                a, b = root(int(block.comp[k])), root(int(block.comp[other]))
                if a != b and linked(sets_[k], sets_[other]):
                    tied[a] = b
                    x.append(int(block.tid[k]))
                    y.append(int(block.tid[other]))
        return pa.table({"x": pa.array(x, pa.int64()), "y": pa.array(y, pa.int64())})

    rows = members.join(sets, "tid").withColumn("weight", F.size("grams"))
    return in_blocks(rows, work, "x long, y long", SET_BLOCK, "weight", SET_BLOCK_GRAMS)


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    base = staged(profiles(docs, id_col, text_col), "bbit-profiles")
    texts = staged(base.where("key IS NOT NULL").groupBy("key").agg(
        F.min("rid").alias("tid"), F.min("doc_id").alias("least_id")), "bbit-texts")
    firsts = staged(base.join(texts.select(F.col("tid").alias("rid")), "rid", "left_semi").select(
        F.col("rid").alias("tid"), "raw", "n", "bands", "signature"), "bbit-firsts")

    banded = staged(firsts.select("tid", F.explode("bands").alias("bucket")), "banded")
    # One order of texts for all buckets: a text is the pivot of most buckets that its copies share.
    draw = F.struct(F.xxhash64("tid").alias("draw"), "tid")
    buckets = staged(banded.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"), F.min(draw)["tid"].alias("pivot")).where("members > 1"), "buckets")
    shared = staged(banded.join(buckets, "bucket"), "shared-buckets")
    pairs = shared.where("tid <> pivot").select(F.least("tid", "pivot").alias("x"), F.greatest("tid", "pivot").alias("y"))
    close = staged(promising(pairs.distinct(), firsts), "promising")
    wanted = close.select(F.col("x").alias("tid")).unionByName(close.select(F.col("y").alias("tid"))).distinct()
    raws = firsts.select("tid", "raw")
    sets = staged(full_sets(docs, text_col, staged(raws.join(wanted, "tid", "left_semi"), "wanted")), "sets")
    links = staged(confirmed(close, sets), "links")
    comps = staged(components(links), "components")

    held = shared.where("members > 2").select("bucket", "tid").join(comps, "tid", "left").select(
        "bucket", "tid", F.coalesce("comp", "tid").alias("comp"))
    held = staged(held, "held-buckets")
    mixed = held.groupBy("bucket").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("bucket")
    members = held.join(staged(mixed, "mixed-buckets"), "bucket").join(firsts.select("tid", "n", "bands", "signature"), "tid")
    near = staged(marked(members), "marked")
    again = staged(raws.join(near.select("tid").distinct(), "tid", "left_semi"), "wanted-again")
    late = staged(full_sets(docs, text_col, again), "sets-again")
    more = staged(cross_links(members.join(near, ["bucket", "tid"], "left_semi"), late), "cross-links")
    comps = staged(components(links.unionByName(more)), "components")

    known = staged(texts.join(comps, "tid", "left").select("key", "least_id", F.coalesce("comp", "tid").alias("comp")), "known-texts")
    ids = staged(known.groupBy("comp").agg(F.min("least_id").alias("component_id")), "component-ids")
    named = staged(known.join(ids, "comp").select("key", "component_id", F.lit(True).alias("named")), "named-texts")
    rows = base.select("doc_id", "n", "key").join(named, "key", "left")
    component = F.when(F.col("named"), F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
