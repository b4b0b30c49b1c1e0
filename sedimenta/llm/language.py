"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of 0 to ``ORDER`` bytes with the counts of the
bytes that followed. A byte costs -log2 of its probability in the longest known context;
if it has not followed there, the context's escape probability is paid and the next
shorter context asked, down to all 256 bytes alike (escape method C, no exclusions).
The language with the shortest exact code for the whole text wins; the counts are frozen
while texts are read.

The trees are flattened: every (context, byte) that was seen in some language has one row
of costs, one column per language, so a text is looked up with a sorted search per
order, and only the bytes that no language has seen go on to a shorter context.

Defined cases: a text that is null or has no letter is ``und`` with score 0; ties go to
the first language by code point; with no labelled row every text is ``und``. Every language
that a row to learn from has is learnt, from its part of ``SAMPLE_ROWS`` rows (one at least);
of a row longer than ``MAX_BYTES`` a slice is learnt, at a place that its id's hash says. A
text may be of any length when it is judged (it is read in pieces); columns other than id,
text and, for learning, lang are not read. A letter is a character of a letter category.

The trees are as large as the contexts seen times the languages: at 8,000 rows of a few
kilobytes and tens of languages some hundred megabytes on the driver. For many hundreds of
languages ``rows`` has to be lowered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.common import held_out, map_texts

ORDER = 3
SAMPLE_ROWS = 8_000
MAX_BYTES = 32_768
PIECE = 1 << 19
UNKNOWN = "und"
PAD = b" " * ORDER

# A slice of this many characters never has more bytes than MAX_BYTES.
SLICE = MAX_BYTES // 4


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """For each byte after the padding, the byte and the ``order`` bytes before it as one number."""
    code = np.zeros(len(data) - ORDER, dtype=np.int64)
    for back in range(order, -1, -1):
        code = (code << 8) | data[ORDER - back: len(data) - back]
    return code


def padded(text: str) -> np.ndarray:
    return np.frombuffer(PAD + text.lower().encode("utf-8", "replace"), dtype=np.uint8)


@dataclass(frozen=True)
class Trees:
    languages: tuple[str, ...]
    codes: tuple[np.ndarray, ...]
    """By order: sorted (context, byte) numbers that some language has seen."""
    costs: tuple[np.ndarray, ...]
    """By order: bits for those, a column per language."""
    contexts: tuple[np.ndarray, ...]
    """By order: sorted context numbers that some language has seen."""
    escapes: tuple[np.ndarray, ...]
    """By order: bits for an escape from those, a column per language."""

    def bits(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Code lengths of texts laid out one after the other, each with its padding."""
        total = np.zeros((len(ends) - 1, len(self.languages)))
        row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[ORDER:]
        place = np.arange(ORDER, len(data))
        place = place[place - ends[row] >= ORDER]
        left = place - ORDER
        row = row[left]
        for order in range(ORDER, -1, -1):
            code = np.zeros(len(place), dtype=np.int64)
            for back in range(order, -1, -1):
                code = (code << 8) | data[place - back]
            at, known = _find(self.codes[order], code)
            _add(total, row[known], self.costs[order], at[known])
            place, row, code = place[~known], row[~known], code[~known]
            if not len(place):
                return total
            at, known = _find(self.contexts[order], code >> 8)
            _add(total, row[known], self.escapes[order], at[known])
        total += 8.0 * np.bincount(row, minlength=len(total))[:, None]
        return total


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


def _add(total: np.ndarray, row: np.ndarray, table: np.ndarray, at: np.ndarray) -> None:
    for k in range(total.shape[1]):
        total[:, k] += np.bincount(row, table[at, k], len(total))


def plant(languages: tuple[str, ...], counts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Trees:
    """Trees from, for each order, (language number, (context, byte) number, count)."""
    n = len(languages)
    codes, costs, contexts, escapes = [], [], [], []
    for order in range(ORDER + 1):
        lang, code, count = counts[order]
        known = np.unique(code)
        seen = np.zeros((len(known), n))
        seen[np.searchsorted(known, code), lang] = count
        context, inside = np.unique(known >> 8, return_inverse=True)
        total, kinds = np.zeros((len(context), n)), np.zeros((len(context), n))
        np.add.at(total, inside, seen)
        np.add.at(kinds, inside, seen > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            # A context that a language has not seen passes on for nothing.
            escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
            cost = -np.log2(seen / (total + kinds)[inside])
        if order:
            # In the next shorter context the same byte is known to the same languages or more.
            at, _ = _find(codes[-1], known & ((1 << 8 * order) - 1))
            shorter = costs[-1][at]
        else:
            shorter = np.full((len(known), n), 8.0)
        cost = np.where(seen > 0, cost, escape[inside] + shorter)
        codes.append(known)
        costs.append(cost)
        contexts.append(context)
        escapes.append(escape)
    return Trees(languages, tuple(codes), tuple(costs), tuple(contexts), tuple(escapes))


def sampled(able: DataFrame, sizes: list[tuple[str, int]], each: int) -> DataFrame:
    """(id, lang) of about ``each`` rows per language, those with the least hashes of their ids."""
    spark = able.sparkSession
    # Ten standard deviations above the part: fewer come through once in 10^20 times.
    most = each + 10 * each**0.5 + 50
    shares = spark.createDataFrame([(lang, min(1.0, most / n)) for lang, n in sizes], "lang string, share double")
    unit = F.shiftrightunsigned(F.xxhash64("id"), 11) / float(1 << 53)
    least = able.join(F.broadcast(shares), "lang").filter(unit < F.col("share")).select("id", "lang").distinct()
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    return least.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= each).select("id", "lang")


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rows: int = SAMPLE_ROWS) -> Trees:
    """Count on a bounded sample of labelled rows that are not held out.

    The rows are shared out evenly among all languages and taken in the order of a hash of the
    id. Only rows whose hash is below a bound are ordered at all; it lets through a few more
    than a language's part, by its number of rows, so no language is sorted as a whole.
    """
    able = docs.filter(
        F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))
    ).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sizes = able.groupBy("lang").count().collect()
    names = tuple(sorted((r["lang"] for r in sizes), key=lambda x: x.encode()))
    if not names:
        empty = np.zeros(0, dtype=np.int64)
        return plant((), {o: (empty, empty, empty) for o in range(ORDER + 1)})
    each = max(1, rows // len(names))
    chosen = sampled(able.select("id", "lang"), [(r["lang"], r["count"]) for r in sizes], each)
    # At most a row of an id and a language for each row to learn from.
    texts = able.join(F.broadcast(chosen), ["id", "lang"], "left_semi")
    start = F.pmod(F.xxhash64("id"), F.greatest(F.length("text") - SLICE, F.lit(1))).cast("int") + 1
    texts = texts.withColumn("text", F.when(F.octet_length("text") <= MAX_BYTES, F.col("text")).otherwise(
        F.col("text").substr(start, F.lit(SLICE))))
    number = {name: i for i, name in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                data = [padded(t) for x, t in zip(langs, texts) if x == lang]
                for o in range(ORDER + 1):
                    code, times = np.unique(np.concatenate([grams(d, o) for d in data]), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(code), number[lang], np.int32)), pa.array(np.full(len(code), o, np.int32)),
                         pa.array(code), pa.array(times.astype(np.int64))], names=["lang", "o", "code", "times"])

    counted = (
        texts.select("lang", "text").mapInArrow(count, "lang int, o int, code long, times long")
        .groupBy("lang", "o", "code").agg(F.sum("times").alias("times")).toPandas()
    )
    counts = {}
    for o in range(ORDER + 1):
        part = counted[counted["o"] == o]
        counts[o] = tuple(part[c].to_numpy(dtype=np.int64) for c in ("lang", "code", "times"))
    return plant(names, counts)


def identify(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (the winner's posterior)."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def start():
        model = shared.value

        def work(texts):
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if not model.languages:
                return [names, scores]
            total = np.zeros((len(texts), len(model.languages)))
            held, rows, size = [], [], 0

            def settle():
                ends = np.concatenate([[0], np.cumsum([len(d) for d in held])])
                np.add.at(total, rows, model.bits(np.concatenate(held), ends))

            judged = [i for i, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))]
            for i in judged:
                data = padded(texts[i])
                # Pieces of a long text overlap by the padding, so its code is the same.
                for at in range(0, max(1, len(data) - ORDER), PIECE):
                    piece = data[at: at + PIECE + ORDER]
                    held.append(piece)
                    rows.append(i)
                    size += len(piece)
                    if size >= PIECE:
                        settle()
                        held, rows, size = [], [], 0
            if held:
                settle()
            best = total.argmin(axis=1)
            gap = np.clip(total - total.min(axis=1, keepdims=True), 0, 1000)
            posterior = 1.0 / np.exp2(-gap).sum(axis=1)
            for i in judged:
                names[i] = model.languages[best[i]]
                scores[i] = posterior[i]
            return [names, scores]

        return work

    made = map_texts(docs.select(F.col(id_col).alias("doc_id"), text_col), ["doc_id"], text_col,
                     [("lang_pred", "string"), ("score", "double")], start)
    return made.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
