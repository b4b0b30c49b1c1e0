"""Benchmark decontamination by template canonicalisation.

Numbers, units and names in a text become typed placeholders, so that a question and
the same question with other figures give the same template. Windows of ``WINDOW`` template
tokens of the documents are hash-joined with those of the benchmark. A match along one
alignment of document and item is consistent if every slot value of the item stands for
one value throughout; where it is not, only windows with unchanged values count. A
document is contaminated by an item of which at least ``LEAST_TOKENS`` tokens (or all, if
it has fewer) are matched.

Only windows that may be in the benchmark leave the scan: they are tested against a
bitmap of fixed size (``BITMAP_BITS``) that is made of all benchmark windows. A benchmark
of any size gives a bitmap of that size; a fuller one lets more windows through to the
join and changes nothing else.

Defined cases: null and empty texts are clean; items of fewer than ``SHORTEST`` tokens and
windows with fewer literal tokens than placeholders say nothing and are not matched; an item
with too few other windows needs all of those, and one with none is found if all its words
are; an item's first word is read as at a sentence start and as within a sentence;
copies of a text get one verdict; a null item id is reported as null only through
``contaminated``; an empty documents or benchmark table gives clean or no rows; other
columns than id and text are not read and are kept by ``drop_contaminated``.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from sedimenta.llm.common import fresh, map_texts, small_join, staged

WINDOW = 8
SHORTEST = 3
LEAST_TOKENS = 13
BITMAP_BITS = 26
CACHE = 300_000

NUMBER = re.compile(r"\d+(?:[.,:/]\d+)*(?:st|nd|rd|th|[a-zA-Z%°]{0,4})")
EDGE = re.compile(r"^[\W_]+|[\W_]+$")

# Words that count as numbers or units.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million "
    "billion".split())
UNITS = frozenset(
    "mm cm km kg mg ml cl kw kwh mph kmh hz khz mhz ghz kb mb gb tb inch inches foot feet yard yards mile miles "
    "metre metres meter meters kilometre kilometres kilometer kilometers centimetre centimetres centimeter "
    "centimeters gram grams kilogram kilograms ounce ounces pound pounds ton tons tonne tonnes litre litres liter "
    "liters gallon gallons second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars euro euros cent cents percent degree degrees watt watts volt volts joule joules".split())
SLOT_NUMBER, SLOT_UNIT, SLOT_NAME = 1, 2, 3
# Codes of literal tokens have the highest bit; placeholders are below.
LITERAL = 1 << 63
# Positions of windows of the words themselves start here.
EXACT = 1 << 30
STOPS = frozenset(".!?:")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Tokens(dict):
    """Raw tokens to row numbers of arrays that say what they are."""

    def __init__(self):
        self._reset(1024)

    def _reset(self, size: int) -> None:
        self.clear()
        # At a sentence start and elsewhere (a capital makes a name only there); 0 is no token.
        self.first = np.zeros(size, dtype=np.uint64)
        self.later = np.zeros(size, dtype=np.uint64)
        self.value = np.zeros(size, dtype=np.int64)
        self.stops = np.zeros(size, dtype=bool)

    def __missing__(self, raw: str) -> int:
        at = len(self)
        if at == len(self.first):
            for name in ("first", "later", "value", "stops"):
                setattr(self, name, np.concatenate([getattr(self, name), np.zeros_like(getattr(self, name))]))
        if raw.isalpha() and raw.islower():
            low = core = raw
        else:
            core = EDGE.sub("", raw)
            low = core.lower()
            self.stops[at] = raw[-1] in STOPS or raw[-2:-1] in STOPS and not raw[-1].isalnum()
        if core:
            word = xxh3_64_intdigest(low.encode("utf-8", "replace")) | LITERAL
            self.value[at] = word - LITERAL
            if core[0].isdigit() and NUMBER.fullmatch(core) or low in NUMBER_WORDS:
                word = SLOT_NUMBER
            elif low in UNITS:
                word = SLOT_UNIT
            self.first[at] = self.later[at] = word
            if word >= LITERAL and len(core) > 1 and core.istitle():
                self.later[at] = SLOT_NAME
        self[raw] = at
        return at

    def read(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Template codes and values of the tokens of a text."""
        code, value, _ = self.variants(text)
        return code, value

    def variants(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Codes and values, and the codes within a sentence if the first word has another one there."""
        if len(self) >= CACHE:
            self._reset(1024)
        raw = text.split()
        at = np.fromiter(map(self.__getitem__, raw), np.int64, len(raw))
        start = np.ones(len(at), dtype=bool)
        start[1:] = self.stops[at[:-1]]
        code = np.where(start, self.first[at], self.later[at])
        real = code != 0
        inner = None
        if len(at) and self.first[at[0]] != self.later[at[0]]:
            inner = code[real]
            inner[0] = self.later[at[0]]
        return code[real], self.value[at][real], inner


def _hashes(code: np.ndarray, width: int) -> np.ndarray:
    n = len(code) - width + 1
    total = np.full(n, width, dtype=np.uint64)
    for j in range(width):
        total *= MULTIPLIER
        total += code[j: j + n]
    total ^= total >> np.uint64(32)
    total *= MULTIPLIER
    total ^= total >> np.uint64(29)
    return total


def _mostly_literal(code: np.ndarray, width: int) -> np.ndarray:
    literal = np.concatenate([[0], np.cumsum(code >= LITERAL)])
    return 2 * (literal[width:] - literal[:-width]) >= width


def windows(code: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the windows that are literal for the most part."""
    if len(code) < width:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    at = np.flatnonzero(_mostly_literal(code, width))
    return at, _hashes(code, width)[at]


def exact_windows(code: np.ndarray, value: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes, of the words themselves, of the other windows."""
    if len(code) < width:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    at = np.flatnonzero(~_mostly_literal(code, width))
    if not len(at):
        return at, np.zeros(0, dtype=np.uint64)
    word = value[at[:, None] + np.arange(width)].astype(np.uint64)
    total = np.full(len(at), ~width & 0xFFFF, dtype=np.uint64)
    for j in range(width):
        total *= MULTIPLIER
        total += word[:, j]
    total ^= total >> np.uint64(32)
    total *= MULTIPLIER
    total ^= total >> np.uint64(29)
    return at, total


def _through(at: np.ndarray, key: np.ndarray, bitmap: np.ndarray | None):
    if bitmap is not None and len(at):
        bit = key & np.uint64((len(bitmap) << 6) - 1)
        keep = (bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        at, key = at[keep], key[keep]
    return zip(at.tolist(), key.view(np.int64).tolist())


def _template(code, value, width: int, bitmap: np.ndarray | None = None):
    """(position, hash, slot values) of the windows of a text that the bitmap lets through."""
    for i, h in _through(*windows(code, width), bitmap):
        yield i, h, value[i: i + width][code[i: i + width] < LITERAL].tolist()


def _exact(code, value, width: int, bitmap: np.ndarray | None = None):
    for i, h in _through(*exact_windows(code, value, width), bitmap):
        yield EXACT + i, h, []


def _found(tokens: Tokens, text: str | None, widths, exact, bitmap: np.ndarray):
    if not text:
        return
    code, value = tokens.read(text)
    for width in widths:
        yield from _template(code, value, width, bitmap)
        if width in exact:
            yield from _exact(code, value, width, bitmap)


def _of_item(tokens: Tokens, text: str | None, window: int):
    """Tokens, usable windows and windows of an item.

    The first word may stand at a sentence start in a document or not, so both forms of its
    window are emitted; usable are those that there are either way. If there are none, the
    windows of the words themselves are emitted too.
    """
    code, value, inner = tokens.variants(text or "")
    n = len(code)
    if n < SHORTEST:
        return n, 0, []
    width = min(n, window)
    out = list(_template(code, value, width))
    usable, plain = len(out), code
    if inner is not None:
        other = list(_template(inner, value, width))
        if len(other) < usable:
            usable, plain = len(other), inner
        out += [w for w in other if w[0] == 0]
    if not usable:
        out += _exact(plain, value, width)
    return n, usable, out


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """item_id, n (tokens of the item), usable (windows of the item), ipos, hash, slots."""

    def start():
        tokens = Tokens()

        def work(texts):
            made = [_of_item(tokens, text, window) for text in texts]
            out = [w for _, _, w in made]
            return [[n for n, _, _ in made],
                    [usable for _, usable, _ in made],
                    [[x[0] for x in w] for w in out],
                    [[x[1] for x in w] for w in out],
                    [[len(x[2]) for x in w] for w in out],
                    [[v for x in w for v in x[2]] for w in out]]

        return work

    made = map_texts(items.select(F.col(id_col).alias("item_id"), text_col), ["item_id"], text_col,
                     [("n", "long"), ("usable", "long"), *_FIELDS[1:]], start)
    return _unpacked(made, "item_id", "n", "usable").withColumnRenamed("pos", "ipos")


_FIELDS = [("n", "long"), ("pos", "array<int>"), ("hash", "array<long>"), ("sizes", "array<int>"), ("values", "array<long>")]


def _unpacked(made: DataFrame, *keys: str) -> DataFrame:
    """One row per window; each takes its part of the text's slot values."""
    ends = F.aggregate("sizes", F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    zipped = F.transform(
        F.arrays_zip("pos", "hash", "sizes"),
        lambda w, i: F.struct(
            w["pos"].alias("pos"), w["hash"].alias("hash"),
            F.slice(F.col("values"), F.element_at(F.col("ends"), i + 1) + 1, w["sizes"]).alias("slots")))
    return made.withColumn("ends", ends).select(*keys, F.explode(zipped).alias("w")).select(*keys, "w.*")


def _bitmap(windows_: DataFrame, bits: int) -> np.ndarray:
    """At most 2^(bits - 6) words reach the driver, whatever the number of windows."""
    bit = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63).cast("int"))
    words = (
        windows_.select(F.shiftright(bit, 6).alias("word"), mask.alias("mask"))
        .groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    )
    bitmap = np.zeros(1 << (bits - 6), dtype=np.uint64)
    bitmap[words["word"].to_numpy(dtype=np.int64)] = words["mask"].to_numpy(dtype=np.int64).view(np.uint64)
    return bitmap


def contaminated_texts(
    docs: DataFrame, items: DataFrame, text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, least_tokens: int = LEAST_TOKENS, bitmap_bits: int = BITMAP_BITS,
) -> DataFrame:
    """One row per contaminated text and item: text_sha256, item_id, n_windows, changed.

    ``changed`` says whether the match needed other slot values than the item's.
    """
    bench = staged(benchmark_windows(items, item_id_col, item_text_col, window), "bench-windows")
    width = F.least("n", F.lit(window)).cast("int").alias("width")
    kinds = bench.select(width, (F.col("ipos") >= EXACT).alias("exact")).distinct().collect()
    widths, exact = {r["width"] for r in kinds}, {r["width"] for r in kinds if r["exact"]}
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(bench, bitmap_bits))

    def start():
        tokens, bitmap = Tokens(), shared.value

        def work(texts):
            out = [list(_found(tokens, t, sorted(widths), exact, bitmap)) for t in texts]
            return [[hashlib.sha256(t.encode()).hexdigest() if w else None for t, w in zip(texts, out)],
                    [[x[0] for x in w] for w in out],
                    [[x[1] for x in w] for w in out],
                    [[len(x[2]) for x in w] for w in out],
                    [[v for x in w for v in x[2]] for w in out]]

        return work

    scanned = map_texts(docs.select(text_col), [], text_col, [("key", "string"), *_FIELDS[1:]], start)
    found = staged(_unpacked(scanned.filter("key IS NOT NULL"), "key"), "doc-windows")
    matched = found.join(bench.withColumnRenamed("slots", "given"), "hash").filter(
        F.size("slots") == F.size("given")
    ).select("key", "item_id", "n", "usable", "ipos", (F.col("pos") - F.col("ipos")).alias("shift"),
             F.arrays_zip(F.col("given").alias("b"), F.col("slots").alias("d")).alias("pairs"))
    matched = staged(matched, "matched-windows")
    line = ["key", "item_id", "shift"]
    pair = matched.select(*line, F.explode("pairs").alias("p")).select(*line, "p.b", "p.d")
    torn = (
        pair.groupBy(*line, "b").agg(F.min("d").alias("low"), F.max("d").alias("high"))
        .filter("low <> high").select(*line).distinct().withColumn("torn", F.lit(True))
    )
    same = F.forall("pairs", lambda p: p["b"] == p["d"])
    on = [F.col(f"m.{c}").eqNullSafe(F.col(f"t.{c}")) for c in line]
    judged = (
        matched.alias("m").join(torn.alias("t"), on, "left")
        .filter(F.col("t.torn").isNull() | same)
        # Windows of the words themselves count along one alignment, as the whole item.
        .groupBy("m.key", "m.item_id", F.when(F.col("m.ipos") >= EXACT, F.col("m.shift")).alias("whole")).agg(
            F.count_distinct("m.ipos").alias("n_windows"), F.max("m.n").alias("n"), F.max("m.usable").alias("usable"),
            F.bool_or(~same).alias("changed"))
    )
    every = F.greatest(F.lit(1), F.col("n") - window + 1)
    need = F.greatest(F.lit(1), F.least(F.least(F.col("n"), F.lit(least_tokens)) - window + 1, F.col("usable")))
    return judged.filter(F.col("n_windows") >= F.when(F.col("whole").isNotNull(), every).otherwise(need)).groupBy(
        F.col("key").alias("text_sha256"), "item_id").agg(
        F.max("n_windows").alias("n_windows"), F.bool_or("changed").alias("changed"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, contaminated, n_windows (of the best item), item_ids, kept."""
    verdicts = staged(
        contaminated_texts(docs, items, text_col, **options).groupBy("text_sha256").agg(
            F.max("n_windows").alias("n_windows"), F.sort_array(F.collect_set("item_id")).alias("item_ids")),
        "verdicts")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.sha2(F.col(text_col), 256).alias("text_sha256"))
    hit = F.col("n_windows").isNotNull()
    return rows.join(verdicts, "text_sha256", "left").select(
        "doc_id", hit.alias("contaminated"), F.coalesce("n_windows", F.lit(0)).alias("n_windows"), "item_ids",
        (~hit).alias("kept"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that no benchmark item is found in; all columns."""
    name = fresh(docs, "text_sha256")
    bad = staged(contaminated_texts(docs, items, text_col, **options).select(F.col("text_sha256").alias(name)).distinct(),
                 "contaminated")
    return small_join(docs.withColumn(name, F.sha2(F.col(text_col), 256)), bad, name, "left_anti", 256).drop(name)
