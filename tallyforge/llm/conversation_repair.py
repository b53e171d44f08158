"""Conversation structure repair by depth-first branch-and-bound.

A conversation is to read: nothing, or perhaps one system turn and then user and assistant in
turns, the assistant last.  Keeping, re-roling, deleting and inserting turns have costs; of
the cheapest series of edits the one whose initials come first in ASCII is taken.

Rows are sorted over the whole table by conversation and turn, so a long conversation lies in
several partitions.  Each partition is read as a stream and cut into segments of bounded size.
A conversation that fits one segment and has neighbours on both sides in its partition is
solved at once; all other segments are solved for every state in which they can begin and
end, and these results are chained in order, with one running digest per state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.bpe import slices, text_sizes
from tallyforge.llm.shared import Scratch

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
UNFINISHED = 1
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: A whole conversation ends in one of these.
COMPLETE = (START, ASSISTANT)
SPACE = " \t\n\x0b\x0c\r"
NEVER = 1 << 60

#: One turn for the search: (initial of its role, whether it must go, what keeping its text costs).
Turn = tuple[str, bool, int]


def spoken_next(state: int) -> int:
    """The state after the one role, user or assistant, that may come next."""
    return ASSISTANT if state == USER else USER


def after_keeping(state: int, initial: str) -> int | None:
    """The state after a kept turn; None if its role may not come next."""
    if initial == "s":
        return SYSTEM if state == START else None
    return spoken_next(state) if initial == ("a" if state == USER else "u") else None


def suffix_bounds(turns: list[Turn], goals: tuple[int, ...]) -> tuple[list[int], list[int], list[int]]:
    """For each number of turns passed: the least cost of the rest where a user comes next, where an
    assistant comes next, and what a system turn that may still be kept could save.

    The first two let a conversation end after a system turn and never keep one; keeping one
    instead of deleting it saves DELETE at most.
    """
    n = len(turns)
    user, assistant, saves = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    u = 0 if set(goals) - {USER} else NEVER
    a = 0 if USER in goals else NEVER
    for i in range(n, -1, -1):
        if i < n:
            initial, must_go, extra = turns[i]
            saves[i] = max(saves[i + 1], DELETE * (initial == "s" and not must_go))
            if must_go:
                u, a = u + DELETE, a + DELETE
            else:
                by_user = (KEEP if initial == "u" else REROLE) + extra + a
                by_assistant = (KEEP if initial == "a" else REROLE) + extra + u
                u, a = min(u + DELETE, by_user), min(a + DELETE, by_assistant)
        u, a = min(u, a + INSERT), min(a, u + INSERT)
        user[i], assistant[i] = u, a
    return user, assistant, saves


def cheapest(turns: list[Turn], entry: int = START, goals: tuple[int, ...] = COMPLETE, seen: dict | None = None) -> tuple[int, str] | None:
    """(cost, audit) of the best edits that lead from `entry` to one of `goals`; None if there are none.

    A node is a number of turns passed and a state.  Its label (cost, audit so far) is kept in
    `seen`; a later label that is no better is dropped, and so is one that cannot beat the
    incumbent: its cost and the bound of the rest are larger, or equal with a later audit.
    Audits of equal cost to one node are no prefixes of each other, as each holds all turns
    and inserting costs; so the better label stays the better one whatever follows.
    """
    if goals == (START,) and entry != START or goals == (SYSTEM,) and entry not in (START, SYSTEM):
        return None
    able = {(START,): {START}, (SYSTEM,): {START, SYSTEM}}.get(goals, set(STATES))
    user, assistant, saves = suffix_bounds(turns, goals)
    seen = {} if seen is None else seen
    best: tuple[int, str] | None = None
    stack = [(0, entry, 0, "")]
    seen[0, entry] = (0, "")
    while stack:
        i, state, cost, audit = stack.pop()
        if seen[i, state] != (cost, audit):
            continue
        if best is not None:
            least = cost + (assistant[i] if state == USER else max(user[i] - saves[i] * (state == START), 0))
            if least > best[0] or least == best[0] and audit > best[1][: len(audit)]:
                continue
        if i == len(turns) and state in goals:
            if best is None or (cost, audit) < best:
                best = cost, audit
            continue
        onward = spoken_next(state)
        steps = [(i, onward, INSERT, "I")]
        if i < len(turns):
            initial, must_go, extra = turns[i]
            steps.append((i + 1, state, DELETE, "D"))
            if not must_go:
                steps.append((i + 1, onward, REROLE + extra, "R"))
                kept = after_keeping(state, initial)
                if kept is not None:
                    steps.append((i + 1, kept, KEEP + extra, "K"))
        children = []
        for j, to, price, name in steps:
            label = cost + price, audit + name
            if to in able and not ((j, to) in seen and seen[j, to] <= label):
                seen[j, to] = label
                rest = assistant[j] if to == USER else max(user[j] - saves[j] * (to == START), 0)
                children.append((label[0] + rest, name, (j, to, *label)))
        stack += [child for _, _, child in sorted(children, reverse=True)]
    return best


def repaired(audit: str, state: int, roles: list[str], texts: list[str]) -> Iterator[str]:
    """The lines `role:text` that the edits `audit` make of the turns, from `state` on."""
    at = 0
    for name in audit:
        if name == "I":
            state = spoken_next(state)
            yield "assistant:" if state == ASSISTANT else "user:"
            continue
        if name == "K":
            state = after_keeping(state, roles[at][:1])
            yield f"{roles[at]}:{texts[at]}"
        elif name == "R":
            state = spoken_next(state)
            yield f"{'assistant' if state == ASSISTANT else 'user'}:{texts[at]}"
        at += 1


class Digest:
    """SHA-256 of lines joined by newlines, which can be carried on from a copy."""

    def __init__(self, of: Digest | None = None):
        self.sha, self.begun = (of.sha.copy(), of.begun) if of else (hashlib.sha256(), False)

    def add(self, lines: Iterator[str]) -> Digest:
        for line in lines:
            self.sha.update((b"\n" if self.begun else b"") + line.encode())
            self.begun = True
        return self


class Segment:
    """Successive turns of one conversation, with what is counted in them."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.turns: list[Turn] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.chars = self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.first = self.last = None  # non-null turn numbers

    def add(self, turn: int | None, role: str, text: str, blank: bool, unfinished: bool, later: bool) -> None:
        initial = role[:1]
        if self.turns and self.turns[-1][0] + initial not in ("su", "ua", "au"):
            self.illegal += 1
        must_go = blank or later
        self.turns.append((initial, must_go, 0 if must_go else UNFINISHED * unfinished))
        self.roles.append(role)
        self.texts.append("" if must_go else text)
        self.chars += len(text)
        self.blank += blank
        self.duplicate += later and not blank
        self.truncated += unfinished and not must_go
        if turn is not None and turn != self.last:
            self.distinct += 1
            self.first, self.last = turn if self.first is None else self.first, turn

    def facts(self) -> dict:
        return {k: getattr(self, k) for k in ("conv_id", "blank", "duplicate", "truncated", "illegal", "distinct", "first", "last")}


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
SEGMENTS = (
    "closed boolean, part int, number int, conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string, distinct long, first long, last long, opening string, closing string, roles array<string>, texts array<string>, "
    "ways array<struct<entry:int,exit:int,cost:long,audit:string>>"
)


def _gaps(first: int | None, last: int | None, distinct: int) -> int:
    return 0 if first is None else last - first + 1 - distinct


def _solve(schema: pa.Schema, most_turns: int, most_chars: int):
    """Rows of sorted turns to solved conversations and open segments."""

    def closed(s: Segment) -> dict:
        cost, audit = cheapest(s.turns)
        digest = Digest().add(repaired(audit, START, s.roles, s.texts)).sha.hexdigest()
        return s.facts() | {"closed": True, "gaps": _gaps(s.first, s.last, s.distinct), "cost": cost, "audit": audit, "repaired_sha256": digest}

    def part_of(s: Segment, number: int) -> dict:
        ways = []
        for entry in STATES:
            for goal in STATES:
                found = cheapest(s.turns, entry, (goal,))
                if found:
                    ways.append({"entry": entry, "exit": goal, "cost": found[0], "audit": found[1]})
        ends = {"opening": s.turns[0][0], "closing": s.turns[-1][0]}
        return s.facts() | ends | {"closed": False, "part": TaskContext.get().partitionId(), "number": number, "roles": s.roles, "texts": s.texts, "ways": ways}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[dict] = []
        size, number, alone = 0, 0, False  # alone: the conversation has a neighbour before it in this partition
        now: Segment | None = None
        for whole in batches:
            for batch in slices(whole, text_sizes(whole.column("text")), 1 << 20):
                for r in batch.to_pylist():
                    if now is not None and r["conv_id"] != now.conv_id:
                        made.append(closed(now) if alone and not number else part_of(now, number))
                        size += now.chars
                        now, number, alone = None, 0, True
                    for copy in range(r["n"]):
                        if now is not None and (len(now.turns) >= most_turns or now.chars > most_chars):
                            made.append(part_of(now, number))
                            size += now.chars
                            now, number = None, number + 1
                        if now is None:
                            now = Segment(r["conv_id"])
                        now.add(r["turn"], r["role"], r["text"], r["blank"], r["unfinished"], r["later"] or copy > 0)
                        if len(made) >= 1024 or size > most_chars:
                            yield pa.RecordBatch.from_pylist(made, schema)
                            made, size = [], 0
        if now is not None:
            made.append(part_of(now, number))
        if made:
            yield pa.RecordBatch.from_pylist(made, schema)

    return run


def _chain(schema: pa.Schema):
    """The segments of each conversation, in order, to one row."""

    class Chain:
        def __init__(self, conv_id: int | None):
            self.counts = {"conv_id": conv_id, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
            self.first = self.last = self.closing = None
            self.distinct = 0
            self.at: dict[int, tuple[int, str, Digest]] = {START: (0, "", Digest())}

        def add(self, s: dict) -> None:
            for k in ("blank", "duplicate", "truncated", "illegal"):
                self.counts[k] += s[k]
            if self.closing is not None and self.closing + s["opening"] not in ("su", "ua", "au"):
                self.counts["illegal"] += 1
            self.closing = s["closing"]
            if s["first"] is not None:
                self.distinct += s["distinct"] - (s["first"] == self.last)
                self.first, self.last = s["first"] if self.first is None else self.first, s["last"]
            best: dict[int, tuple[int, str, int, str]] = {}
            for w in s["ways"]:
                if w["entry"] in self.at:
                    cost, audit, _ = self.at[w["entry"]]
                    way = (cost + w["cost"], audit + w["audit"], w["entry"], w["audit"])
                    best[w["exit"]] = min(best.get(w["exit"], way), way)
            self.at = {
                to: (cost, audit, Digest(self.at[entry][2]).add(repaired(own, entry, s["roles"], s["texts"])))
                for to, (cost, audit, entry, own) in best.items()
            }

        def result(self) -> dict:
            cost, audit, state = min((*self.at[x][:2], x) for x in COMPLETE if x in self.at)
            sha = self.at[state][2].sha.hexdigest()
            return self.counts | {"gaps": _gaps(self.first, self.last, self.distinct), "cost": cost, "audit": audit, "repaired_sha256": sha}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Chain | None = None
        for whole in batches:
            done = []
            for i in range(whole.num_rows):
                s = whole.slice(i, 1).to_pylist()[0]
                if now is not None and s["conv_id"] != now.counts["conv_id"]:
                    done.append(now.result())
                    now = None
                now = now or Chain(s["conv_id"])
                now.add(s)
            yield pa.RecordBatch.from_pylist(done, schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.result()], schema)

    return run


def repair(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    most_turns: int = 512, most_chars: int = 1 << 20,
) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Null roles and texts count as one space.  Turns are read by number, null ones first, ties
    by the first 64 characters of the role, those of the text, then by SHA-256 of both, so the
    order of rows does not matter; rows alike in all of that are repeats of each other.
    Each turn has at most one fault: blank (white space only), duplicate (role and text came
    earlier), truncated (the last character that is no white space is none of `.!?`).
    illegal counts neighbours whose roles' initials are not su, ua or au.  gaps is the number
    of numbers missing between the smallest and the largest.
    Edits: Keep 0, Rerole to user or assistant 2, Delete 3 (a must for blank and duplicate
    turns), Insert an empty turn of user or assistant 2, and 1 more for each truncated turn
    that stays.  audit holds the initials of the cheapest edits that leave `(s?(ua)+)?`, the
    first in ASCII of equal ones; repaired_sha256 is the digest of the lines `role:text`.
    Roles are told by their initials.  Null ids are one conversation.  An empty table gives no
    rows; further columns are ignored.
    """
    scratch = Scratch(turns.sparkSession, "conversations")
    given = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(role_col, F.lit(" ")).alias("role"), F.coalesce(text_col, F.lit(" ")).alias("text"),
    )
    # Rows that are alike are one row with a count, folded before they are sent anywhere.
    digest = F.unhex(F.sha2(F.concat("role", F.lit("\n"), "text"), 256)).alias("digest")
    rows = scratch.save(given.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n")).select("*", digest), "rows")
    order = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    said = rows.groupBy("conv_id", "digest").agg(F.count("*").alias("turns"), F.min(order).alias("first")).where("turns > 1")
    said = scratch.save(said.select(F.col("conv_id").alias("said_in"), F.col("digest").alias("said"), "first.turn"), "said").withColumnRenamed("turn", "first_turn")
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACE)), F.lit(1))
    marked = rows.join(said, rows["conv_id"].eqNullSafe(said["said_in"]) & (rows["digest"] == said["said"]), "left").select(
        "conv_id", "turn", "role", "text", F.col("n").cast("int").alias("n"), "digest",
        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("unfinished"),
        (F.col("said").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first_turn"))).alias("later"),
    )
    by = ["conv_id", "turn", F.left("role", F.lit(64)), F.left("text", F.lit(64)), "digest"]
    ordered = marked.repartitionByRange(*by).sortWithinPartitions(*by).drop("digest")
    shape = lambda ddl: _arrow_schema(turns, ddl)
    solved = scratch.save(ordered.mapInArrow(_solve(shape(SEGMENTS), most_turns, most_chars), SEGMENTS), "solved")
    scratch.drop("rows", "said")
    names = [c.strip().split(" ")[0] for c in RESULT.split(",")]
    chained = (
        solved.where("not closed").repartition("conv_id").sortWithinPartitions("conv_id", "part", "number").mapInArrow(_chain(shape(RESULT)), RESULT)
    )
    return solved.where("closed").select(*names).unionByName(chained)


def _arrow_schema(df: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.sparkSession.createDataFrame([], ddl).schema)


def damage(turns: DataFrame) -> DataFrame:
    """`conversations` rows (conv_id, turn, role, text) with faults put in by the hash of id and turn; null roles and texts become one space.

    In the hash null ids and turns are one space too.
    """
    spot = F.concat(*[F.coalesce(x, F.lit(" ")) for x in (F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))])
    fault = F.crc32(spot) % 20
    text = F.coalesce("text", F.lit(" "))
    faulty = turns.select(
        "conv_id", "turn", fault.alias("fault"),
        F.when(fault == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
    )
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return faulty.where("fault <> 0").withColumn("copy", copies).select("conv_id", "turn", "role", "text")


def repair_damaged(turns: DataFrame) -> DataFrame:
    """Every conv_id of `turns` with the repair of its damaged rows; without rows: zeros, no edits, the digest of nothing."""
    done = repair(damage(turns)).withColumnRenamed("conv_id", "of")
    ids = turns.select("conv_id").distinct()
    number = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return ids.join(done, ids["conv_id"].eqNullSafe(done["of"]), "left").select(
        "conv_id", *number, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
