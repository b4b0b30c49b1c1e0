"""Mixing sources to target weights with a low-discrepancy schedule.

Every source is a stream of words: its documents in shuffled order, read again from
the start when the target is larger than the source. The streams are cut into blocks
of equally many words. A schedule of slots says which source gives the next block: the
points of the van der Corput sequence (bit-reversed slot numbers) fall on the sources'
cumulative block counts, so at every point of the schedule each source has had its
share to within a few blocks, and the k-th slot of a source takes its k-th block. The
last block of a source is cut so that it gives its target to the word.

Only built-in functions are used. Positions in a stream and ranks of slots are prefix
sums in two steps (within runs of about ``RUN`` rows, then over the runs), so a source
with a third of all rows is never one task.

Defined cases: a null text has no words; a document without words is never taken; a
null source is a source of its own; equal rows are placed one after the other; an empty
table gives an empty result; columns other than id, text and source are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.common import fresh, passing_tables, small_join, staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
BLOCK_WORDS = 1024
RUN = 1000
CHUNK = 1 << 16
SEED = "mix"


@dataclass(frozen=True)
class Mix:
    sources: DataFrame
    """source, sid, n_docs, source_size, weight, target, words, blocks, first_block"""
    rows: DataFrame
    """rid, doc_id, sid, size, start: documents with words at their place in the stream"""
    wordless: DataFrame
    """rid, doc_id, sid: documents without words"""
    schedule: DataFrame
    """slot, sid, rank: which source gives its next block at which slot"""
    pieces: DataFrame
    """slot, sid, rank, rid, doc_id, pass, begin, offset, words: what the blocks hold"""


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = MAX_REPEATS) -> DataFrame:
    """Add sid, weight, target and words to (source, n_docs, source_size).

    The share of all words goes to the sources by weight; none gets more than
    ``repeats`` times its size, and what is over goes to the others by weight. That
    fixed point is a water level: sources are capped in the order of cap / weight, and
    the level is what is left over the weights that are left. One row per source.
    """
    # One row per source: a mix names each of its sources, so this table is small.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    given = F.array(*[F.lit(float(w)) for w in weights])
    df = sizes.withColumn("sid", F.row_number().over(by_name) - 1)
    df = df.withColumn("weight", F.get(given, F.col("sid") % len(weights)))
    df = df.withColumn("cap", F.col("source_size").cast("double") * repeats)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    budget = F.sum(F.col("source_size")).over(everything) * F.lit(float(share))
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    df = df.withColumn("level", level)
    # The first source that the level does not cap sets it for all that follow.
    level = F.min(F.when(F.col("cap") >= F.col("level") * F.col("weight"),
                         F.struct(F.col("cap") / F.col("weight"), "sid", "level"))).over(everything)["level"]
    df = df.withColumn("target", F.coalesce(F.least(F.col("cap"), level * F.col("weight")), F.col("cap")))
    return df.withColumn("words", F.floor(F.col("target")).cast("long")).drop("cap", "level")


def _streams(thin: DataFrame, sources: DataFrame, run: int) -> DataFrame:
    """Each document's first word in the shuffled stream of its source."""
    digits = F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("double") / float(1 << 32)
    rows = (
        thin.filter("size > 0")
        .join(sources.select("source", "sid", "n_docs"), thin["source"].eqNullSafe(sources["source"]))
        .select("rid", "doc_id", "sid", "size", "shuffle",
                F.floor(digits * F.ceil(F.col("n_docs") / run)).cast("long").alias("run"))
    )
    rows = staged(rows, "mix-rows")
    runs = rows.groupBy("sid", "run").agg(F.sum("size").alias("run_size"))
    earlier = Window.partitionBy("sid").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("sid", "run", F.coalesce(F.sum("run_size").over(earlier), F.lit(0)).alias("base"))
    within = (Window.partitionBy("sid", "run").orderBy("shuffle", "doc_id", "size", "rid")
              .rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(F.sum("size").over(within), F.lit(0))
    return (
        rows.withColumn("within", start).join(runs, ["sid", "run"])
        .select("rid", "doc_id", "sid", "size", (F.col("base") + F.col("within")).alias("start"))
    )


def _schedule(sources: DataFrame, blocks: int, run: int) -> DataFrame:
    """Slots in order, each with the source it falls on and the source's count so far.

    The slots are 0 .. 2^m - 1 with 2^m the least power that holds all blocks; a slot's
    point is its number with the bits reversed, and points beyond the cumulative counts
    fall on no source. Each source lists the points of its own range, and reversing a
    point's bits gives its slot, so nothing is searched, however many sources there are.
    Ranges are cut into chunks first: a source with most blocks is not one task.
    """
    bits = max(1, (max(blocks, 1) - 1).bit_length())
    end = F.col("first_block") + F.col("blocks")
    chunks = sources.filter("blocks > 0").select(
        "sid", end.alias("end"), F.explode(F.sequence("first_block", end - 1, F.lit(CHUNK).cast("long"))).alias("low"))
    last = F.least(F.col("low") + CHUNK, F.col("end")) - 1
    points = chunks.repartition("low").select("sid", F.explode(F.sequence("low", last)).alias("point"))
    slot = F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long")
    slots = points.select(slot.alias("slot"), "sid", F.floor(slot / run).alias("run"))
    slots = staged(slots, "mix-slots")
    counts = slots.groupBy("sid", "run").count()
    earlier = Window.partitionBy("sid").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("sid", "run", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("sid", "run").orderBy("slot")) - 1
    return (
        slots.withColumn("within", within).join(counts, ["sid", "run"])
        .select("slot", "sid", (F.col("base") + F.col("within")).alias("rank"))
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    seed: str = SEED,
    rid_col: str | None = None,
) -> Mix:
    """Lay out the mix; ``rid_col`` names a unique row id if the table has one."""
    rid = F.col(rid_col) if rid_col else F.monotonically_increasing_id()
    doc_id = F.col(id_col)
    thin = staged(docs.select(
        rid.alias("rid"),
        doc_id.alias("doc_id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary")).alias("shuffle"),
    ), "mix-thin")
    sizes = thin.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    counts = F.ceil(F.col("words") / block_words)
    before = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    sources = targets(sizes, weights, share, repeats).withColumn("blocks", counts)
    sources = staged(sources.withColumn(
        "first_block", F.coalesce(F.sum("blocks").over(before), F.lit(0))), "mix-sources")
    blocks = sources.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    rows = staged(_streams(thin, sources, RUN), "mix-streams")
    schedule = _schedule(sources, int(blocks), RUN)

    # A document's words at every pass through its source, cut at block ends and target.
    begin = F.col("pass") * F.col("source_size") + F.col("start")
    laid = (
        rows.join(sources.select("sid", "source_size", "words"), "sid")
        .select("rid", "doc_id", "sid", "size", "words", "source_size", "start",
                F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("pass"))
        .select("rid", "doc_id", "sid", "pass", begin.alias("begin"),
                F.least(begin + F.col("size"), F.col("words")).alias("end"))
        .filter(F.col("begin") < F.col("end"))
    )
    ranks = F.sequence(F.floor(F.col("begin") / block_words), F.floor((F.col("end") - 1) / block_words))
    low = F.greatest(F.col("begin"), F.col("rank") * block_words)
    high = F.least(F.col("end"), (F.col("rank") + 1) * block_words)
    pieces = (
        laid.withColumn("rank", F.explode(ranks))
        .select("sid", "rank", "rid", "doc_id", "pass", "begin",
                (low - F.col("begin")).alias("offset"), (high - low).alias("words"))
        .join(schedule, ["sid", "rank"])
    )
    wordless = (
        thin.filter("size = 0")
        .join(sources.select("source", "sid"), thin["source"].eqNullSafe(sources["source"]))
        .select("rid", "doc_id", "sid")
    )
    return Mix(sources, rows, wordless, schedule, pieces)


def taken_words(made: Mix) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, first_slot.

    ``first_slot`` is where the schedule first takes words of the document; null if it never does.
    """
    taken = made.pieces.groupBy("rid").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    rows = made.rows.select("rid", "doc_id", "sid", "size").unionByName(
        made.wordless.select("rid", "doc_id", "sid", F.lit(0).cast("long").alias("size")))
    return (
        rows.join(taken, "rid", "left")
        .join(made.sources.select("sid", "source_size", "target"), "sid")
        .select("doc_id", "size", "source_size", "target",
                F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, whole, once for every pass that takes words of them, in slot order.

    Cutting only at the end of a source's share would split one document per source and
    pass; that one is kept whole. All columns are kept, and no others added. Partitions are
    ranges of slots and sorted within, so every stretch of the output has the sources in
    nearly the shares of the whole; a copy stands where its pass begins to take words.
    """
    name = fresh(docs, "rid")
    held = staged(docs.withColumn(name, F.monotonically_increasing_id()), "mix-docs")
    slot, offset = fresh(held, "slot"), fresh(held, "offset")
    with passing_tables(docs.sparkSession) as keep:
        made = mix(held, rid_col=name, **options)
        # Slots and offsets of a pass rise together, so the first piece has the least of both.
        taken = keep(staged(
            made.pieces.groupBy(F.col("rid").alias(name), "pass")
            .agg(F.min("slot").alias(slot), F.min("begin").alias(offset)).drop("pass"), "mix-taken"))
    order = [slot, offset, name]
    return (
        small_join(held, taken, name, "inner", 96)
        .repartitionByRange(*order).sortWithinPartitions(*order).drop(*order)
    )
