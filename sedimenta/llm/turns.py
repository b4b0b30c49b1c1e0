"""Conversation structure repair: Wagner-Fischer alignment of turns with an alternating grammar.

Roles, by their initials, have to spell ``(s?(ua)+)?``. A turn is kept (0), given another
role (1) or deleted (2, which blank and repeated turns must be); an empty turn may be
inserted anywhere (5); a cut-off turn that stays adds 5. Of the cheapest repairs the one
whose audit (the initials K, R, D, I of its edits in order) comes first in ASCII is taken.

Turns are aligned with every length that the grammar's string can have. The strings of one
kind are prefixes of one another, so one Wagner-Fischer table holds the costs of all
lengths, and each length whose cost is least is traced back and the audits are compared.
A left-to-right repair gives the incumbent cost; cells that cannot be part of a repair as
cheap are outside of the Ukkonen band and not worked out.

Conversations of any length are handled. Turns are sorted over all conversations and cut
into blocks of ``BLOCK`` rows. A conversation within one block is aligned as it is. A part
of a longer one is aligned with the grammar's strings from every letter that may precede it
to every letter that it may end on, and parts are joined in a tree: costs add up, and the
least pair (cost, audit) of two parts makes the least of both, since edits of the same
turns at the same cost never are a prefix of one another. Texts take no part in this; the
letters come back to the turns by a join, and texts are hashed as a sorted stream, turn by
turn, so no task holds a conversation's texts.

Defined cases: a null role or text counts as one space, so the text is blank and the role
has to be replaced; null turns come first; turns of the same number are ordered by role,
then by a hash of the text; a null conversation id is a conversation; an empty table gives
an empty result; other columns are not read. A gap count beyond a long is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import small_join, staged
from sedimenta.operators.numbering import dense_ids

SPACE = " \t\n\x0b\f\r"
BLOCK = 64
# Parts of a conversation joined by one task at a time.
FAN_IN = 64
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
FAR = 1 << 60
# What the repaired turns so far end on: nothing yet, s, u or a; only nothing and a may be the end.
NONE, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"u": "user", "a": "assistant"}


class Turn:
    """A turn's initial and fault, and the cost and audit letter of standing for each letter of the grammar."""

    def __init__(self, initial: str, fault: int):
        self.initial, self.fault = initial, fault
        extra = CUT_OFF if fault == 3 else 0
        self.costs = {letter: (FAR, "") for letter in "sua"}
        if fault not in (1, 2):
            self.costs |= {letter: (REROLE + extra, "R") for letter in ROLES}
            if initial in self.costs:
                self.costs[initial] = KEEP + extra, "K"


def targets(start: int) -> list[tuple[str, str]]:
    """(head, cycle) of the endless strings that may follow; every feasible target is a prefix of one."""
    if start == NONE:
        return [("", "ua"), ("s", "ua")]
    return [("", "au" if start == USER else "ua")]


def letter_at(target: tuple[str, str], j: int) -> str:
    head, cycle = target
    return head[j] if j < len(head) else cycle[(j - len(head)) % 2]


def end_of(start: int, target: tuple[str, str], length: int) -> int:
    return {"s": SYSTEM, "u": USER, "a": ASSISTANT}[letter_at(target, length - 1)] if length else start


def incumbent(turns: list[Turn], start: int) -> tuple[int, int]:
    """(cost, letter it ends on) of a plain left-to-right repair."""
    cost, state = 0, start
    for turn in turns:
        if state == NONE and turn.costs["s"][0] < DELETE:
            want, then = "s", SYSTEM
        elif state == USER:
            want, then = "a", ASSISTANT
        else:
            want, then = "u", USER
        if turn.costs[want][0] < DELETE:
            cost, state = cost + turn.costs[want][0], then
        else:
            cost += DELETE
    return cost, state


class Table:
    """Costs of aligning the first i turns with the first j letters, within the band of a bound."""

    def __init__(self, turns: list[Turn], target: tuple[str, str], bound: int, longest: int):
        self.turns, self.target = turns, target
        n = len(turns)
        # A cell j letters ahead of its turns has cost j insertions, one behind as many deletions.
        self.behind, self.ahead = bound // DELETE, min(bound // INSERT, longest)
        self.rows: list[dict[int, int]] = []
        letters = [letter_at(target, j) for j in range(min(longest, n + self.ahead))]
        before: dict[int, int] = {}
        for i in range(n + 1):
            row: dict[int, int] = {}
            turn = turns[i - 1] if i else None
            for j in range(max(0, i - self.behind), min(len(letters), i + self.ahead) + 1):
                cost = 0 if not i and not j else FAR
                if turn is not None:
                    cost = min(cost, before.get(j, FAR) + DELETE)
                    if j:
                        cost = min(cost, before.get(j - 1, FAR) + turn.costs[letters[j - 1]][0])
                if j and letters[j - 1] in ROLES:
                    cost = min(cost, row.get(j - 1, FAR) + INSERT)
                if cost <= bound:
                    row[j] = cost
            self.rows.append(row)
            before = row
        self.letters = letters

    def ends(self) -> dict[int, int]:
        """Cost by target length."""
        return self.rows[-1]

    def audit(self, length: int) -> str:
        """The first in ASCII of the cheapest alignments with the target of this length."""
        n = len(self.turns)
        alive = [set() for _ in range(n + 1)]
        alive[n].add(length)
        for i in range(n, -1, -1):
            for j in range(max(alive[i], default=-1), -1, -1):
                if j not in alive[i]:
                    continue
                cost = self.rows[i][j]
                if j and self.letters[j - 1] in ROLES and self.rows[i].get(j - 1, FAR) + INSERT == cost:
                    alive[i].add(j - 1)
                if i:
                    if self.rows[i - 1].get(j, FAR) + DELETE == cost:
                        alive[i - 1].add(j)
                    if j and self.rows[i - 1].get(j - 1, FAR) + self.turns[i - 1].costs[self.letters[j - 1]][0] == cost:
                        alive[i - 1].add(j - 1)
        i = j = 0
        out = []
        while (i, j) != (n, length):
            cost = self.rows[i][j]
            if i < n and j in alive[i + 1] and self.rows[i + 1][j] == cost + DELETE:
                out.append("D")
                i += 1
            elif (j + 1 in alive[i] and self.letters[j] in ROLES and self.rows[i][j + 1] == cost + INSERT):
                out.append("I")
                j += 1
            else:
                out.append(self.turns[i].costs[self.letters[j]][1])
                i, j = i + 1, j + 1
        return "".join(out)


def align(turns: list[Turn], start: int, whole: bool) -> dict[int, tuple[int, str]]:
    """The cheapest repair, as (cost, audit), to each letter that may come last.

    ``whole``: the turns are a conversation, so only the ends that the grammar allows count.
    """
    best: dict[int, tuple[int, str]] = {}
    wanted = (NONE, ASSISTANT) if whole else (NONE, SYSTEM, USER, ASSISTANT)

    def offer(table: Table, target: tuple[str, str], lengths) -> None:
        found: dict[int, list[int]] = {}
        for length in lengths:
            end = end_of(start, target, length)
            if end in wanted:
                found.setdefault(end, []).append(length)
        for end, ends in found.items():
            least = min(table.ends()[k] for k in ends)
            if end in best and best[end][0] < least:
                continue
            for length in ends:
                if table.ends()[length] == least:
                    entry = least, table.audit(length)
                    best[end] = min(best.get(end, entry), entry)

    # What the plain repair costs, and the insertions that bring it to an end that counts. Two
    # insertions lead from any letter to u or to a.
    cost, last = incumbent(turns, start)
    bound = cost + INSERT * ({USER: 1, SYSTEM: 2}.get(last, 0) if whole else 2)
    for target in targets(start):
        if whole and best:
            bound = min(bound, *(c for c, _ in best.values()))
        table = Table(turns, target, bound, len(turns) + bound // INSERT)
        offer(table, target, table.ends())
    # Ends that insertions cannot reach: nothing at all, or the one kept s.
    for target in targets(start):
        short = len(target[0])
        table = Table(turns, target, DELETE * len(turns) + CUT_OFF, short)
        offer(table, target, table.ends())
    return best


def joined(first: dict[tuple[int, int], tuple[int, str]], then: dict[tuple[int, int], tuple[int, str]]):
    """Repairs of two parts in a row, by the letters before and at the end."""
    out: dict[tuple[int, int], tuple[int, str]] = {}
    for (a, b), (cost, audit) in first.items():
        for (c, d), (more, rest) in then.items():
            if b == c:
                entry = cost + more, audit + rest
                if (a, d) not in out or entry < out[a, d]:
                    out[a, d] = entry
    return out


def _key(column: Column) -> Column:
    """The id as text that tells null from every value."""
    return F.coalesce(F.concat(F.lit("v"), column.cast("string")), F.lit("n"))


def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """The contract's damage, by crc32 of "conv:turn": drop, empty, unpoint, repeat, or set the role."""
    def named(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(named(conv_col), F.lit(":"), named(turn_col))) % 20
    rows = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), named(role_col).alias("role"),
        named(text_col).alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.sequence(F.lit(0), F.lit(1))).otherwise(F.sequence(F.lit(0), F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def placed(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Turns in order over all conversations: key, pos, conv_id, turn, role, text, digest, fault.

    ``pos`` counts the turns of all conversations, so those of one are a run of it.
    """
    def spaced(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    base = rows.select(_key(F.col(conv_col)).alias("key"), F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                       spaced(role_col).alias("role"), spaced(text_col).alias("text"))
    said = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    base = base.withColumn("digest", F.unhex(F.sha2(said, 256)))
    order = ["key", F.col("turn").asc_nulls_first(), "role", "digest"]
    base = base.repartitionByRange(*order).sortWithinPartitions(*order)
    base = dense_ids(base, "pos", first=0)
    first = base.groupBy("key", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    left = F.rtrim(F.col("text"), F.lit(SPACE))
    marked = base.join(staged(first, "first-turns"), "pos", "left")
    fault = (F.when(left == "", 1).when(F.col("first").isNull(), 2)
             .when(~F.right(left, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0))
    return staged(marked.withColumn("fault", fault).drop("first", "digest"), "marked-turns")


PART = ("key string, part long, n long, blank long, duplicate long, truncated long, illegal long, opens string, closes string, "
        "repairs array<struct<a:int,b:int,cost:long,audit:string>>")
ARROW_PART = pa.schema([
    ("key", pa.string()), ("part", pa.int64()), *((c, pa.int64()) for c in ("n", "blank", "duplicate", "truncated", "illegal")),
    ("opens", pa.string()), ("closes", pa.string()),
    ("repairs", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
])
LEGAL = ("su", "ua", "au")


def _aligned(blocks: DataFrame, whole: bool) -> DataFrame:
    """Parts with their repairs: from the start only, or from every letter that may precede."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                seen = sorted(row["turns"], key=lambda t: t["pos"])
                turns = [Turn(t["initial"], t["fault"]) for t in seen]
                starts = (NONE,) if whole else (NONE, SYSTEM, USER, ASSISTANT)
                repairs = [{"a": a, "b": b, "cost": cost, "audit": audit}
                           for a in starts for b, (cost, audit) in align(turns, a, whole).items()]
                letters = [t.initial for t in turns]
                faults = [t.fault for t in turns]
                out.append({
                    "key": row["key"], "part": row["part"], "n": len(turns), "blank": faults.count(1),
                    "duplicate": faults.count(2), "truncated": faults.count(3),
                    "illegal": sum(x + y not in LEGAL for x, y in zip(letters, letters[1:])),
                    "opens": letters[0], "closes": letters[-1], "repairs": repairs})
            yield pa.RecordBatch.from_pylist(out, schema=ARROW_PART)

    return blocks.mapInArrow(work, PART)


def _joined(parts: DataFrame) -> DataFrame:
    """Parts of long conversations, joined some at a time until each conversation is one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                members = sorted(row["members"], key=lambda m: m["part"])
                total = members[0]
                repairs = {(r["a"], r["b"]): (r["cost"], r["audit"]) for r in total["repairs"]}
                for m in members[1:]:
                    repairs = joined(repairs, {(r["a"], r["b"]): (r["cost"], r["audit"]) for r in m["repairs"]})
                    total = {
                        "part": total["part"], "opens": total["opens"], "closes": m["closes"],
                        **{c: total[c] + m[c] for c in ("n", "blank", "duplicate", "truncated")},
                        "illegal": total["illegal"] + m["illegal"] + (total["closes"] + m["opens"] not in LEGAL)}
                out.append({**total, "key": row["key"], "part": row["part"],
                            "repairs": [{"a": a, "b": b, "cost": c, "audit": x} for (a, b), (c, x) in repairs.items()]})
            yield pa.RecordBatch.from_pylist(out, schema=ARROW_PART)

    # Parts are numbered from the first of their conversation; every round makes one of FAN_IN.
    member = F.struct(*[c for c in ARROW_PART.names if c != "key"])
    while True:
        starts = parts.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"))
        if starts.where("low < high").isEmpty():
            return parts
        span = parts.join(starts.select("key", "low"), "key")
        grouped = span.groupBy("key", F.expr(f"(part - low) div {FAN_IN}").alias("part")).agg(F.collect_list(member).alias("members"))
        parts = staged(grouped.mapInArrow(work, PART), "joined-parts")


@dataclass(frozen=True)
class Repair:
    """Turns as placed, and one row per conversation that has turns: key, counts, cost, audit."""

    turns: DataFrame
    report: DataFrame

    def edits(self) -> DataFrame:
        """Repaired turns: key, index (their order), edit, conv_id, turn, role, text; inserted ones have no turn."""
        low = self.turns.groupBy("key").agg(F.min("pos").alias("low"))
        letters = self.report.select("key", "audit").join(low, "key").mapInArrow(
            _letters, "key string, pos long, letter string, index long, edit string")
        letters = staged(letters, "letters").where("edit <> 'D'")
        role = F.when(F.col("letter") == "u", ROLES["u"]).otherwise(ROLES["a"])
        turns = self.turns.select("pos", "conv_id", "turn", F.col("role").alias("given"), "text")
        both = letters.where("edit <> 'I'").join(turns, "pos")
        kept = both.select("key", "index", "edit", "conv_id", "turn",
                           F.when(F.col("edit") == "R", role).otherwise(F.col("given")).alias("role"), "text")
        none = (F.lit(None).cast(self.turns.schema[c].dataType).alias(c) for c in ("conv_id", "turn"))
        new = letters.where("edit = 'I'").select("key", "index", "edit", *none, role.alias("role"), F.lit("").alias("text"))
        return kept.unionByName(new)


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, audit, low) to one row per edit: the turn's position and the letter that it stands for."""
    names = ["key", "pos", "letter", "index", "edit"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    rows: list[tuple] = []
    for batch in batches:
        for key, audit, pos in zip(*(batch.column(i).to_pylist() for i in range(3))):
            target = ("s" if (len(audit) - audit.count("D")) % 2 else "", "ua")
            at = 0
            for index, edit in enumerate(audit):
                rows.append((key, pos, "" if edit == "D" else letter_at(target, at), index, edit))
                at += edit != "D"
                pos += edit != "I"
                if len(rows) == 8192:
                    yield made(rows)
                    rows = []
    if rows:
        yield made(rows)


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> Repair:
    """The cheapest repair of every conversation."""
    turns = placed(rows, conv_col, turn_col, role_col, text_col)
    turn = F.struct("pos", F.substring("role", 1, 1).alias("initial"), "fault")
    blocks = turns.groupBy("key", F.expr(f"pos div {BLOCK}").alias("part")).agg(F.collect_list(turn).alias("turns"))
    blocks = staged(blocks, "blocks")
    several = staged(blocks.groupBy("key").count().where("count > 1").select("key"), "long-conversations")
    whole = _aligned(small_join(blocks, several, "key", "left_anti", 64), True)
    parts = staged(_aligned(small_join(blocks, several, "key", "left_semi", 64), False), "parts")
    parts = _joined(parts)
    ends = F.filter("repairs", lambda r: (r["a"] == NONE) & r["b"].isin(NONE, ASSISTANT))
    best = F.array_min(F.transform(ends, lambda r: F.struct(r["cost"].alias("cost"), r["audit"].alias("audit"))))
    report = staged(whole.unionByName(parts).withColumn("best", best).select(
        "key", "blank", "duplicate", "truncated", "illegal", F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit")),
        "repairs")
    return Repair(turns, report)


def text_hashes(edits: DataFrame) -> DataFrame:
    """(key, repaired_sha256): a running hash over the sorted turns of each conversation."""
    lines = edits.select("key", "index", F.concat("role", F.lit(":"), "text").cast("binary").alias("line"))
    dealt = lines.repartition("key").sortWithinPartitions("key", "index")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running, done = None, None, []
        for batch in batches:
            for k, line in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k != key:
                    if running is not None:
                        done.append((key, running.hexdigest()))
                    key, running = k, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(line)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], names=["key", "repaired_sha256"])
                done = []
        if running is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([key], pa.string()), pa.array([running.hexdigest()], pa.string())], names=["key", "repaired_sha256"])

    return dealt.mapInArrow(work, "key string, repaired_sha256 string")


def structure_digest(conversations: DataFrame) -> DataFrame:
    """One row per conversation of the table before damage: counts, cost, audit and hash of the repaired text."""
    found = repair(damaged(conversations))
    hashes = staged(text_hashes(found.edits()), "text-hashes")
    wide = F.col("turn").cast("decimal(38,0)")
    gaps = (F.max(wide) - F.min(wide) + 1 - F.countDistinct("turn")).cast("decimal(38,0)")
    turns = found.turns.groupBy("key").agg(gaps.alias("gaps"))
    ids = conversations.select("conv_id").distinct().withColumn("key", _key(F.col("conv_id")))
    joined_rows = ids.join(found.report, "key", "left").join(turns, "key", "left").join(hashes, "key", "left")
    counts = ("blank", "duplicate", "truncated", "illegal", "cost")
    in_long = F.when(F.col("gaps").isNull(), F.lit(0).cast("long")).otherwise(F.expr("try_cast(gaps AS bigint)"))
    return joined_rows.select(
        "conv_id", in_long.alias("gaps"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
