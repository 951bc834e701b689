"""Repair of the structure of conversations by the cheapest edits, in one pass over secondary-sorted rows.

A conversation should read `system? (user assistant)+`, or be empty. Rows are shuffled once, by conversation. In each
partition a first sort marks rows whose role and text were there before, a second one puts the rows in the order of
turns; then mapInPandas streams over them and carries, across Arrow batches and for each state of that pattern, the least
cost of the edits so far, the rank of its edits among those of the other states, and the running digest of what they
leave. No conversation is ever held: of each row stay four bytes, a back-pointer for each state, which go to an unnamed
spill file of the task after SPILL of them and are read backwards at the end. So memory is bounded however long a
conversation is, but for the audit itself, a letter for each edit. Counts and the digest follow the order of a
conversation, so one conversation is streamed by one task; a lost one starts again from the shuffle.

Edits: Keep costs 0, Rerole to user or assistant 2, Delete 3, Insert of an empty user or assistant turn 2. Blank and
duplicate rows have to be deleted; a truncated row that is not costs 1 more. Of cheapest edits those with the least
string of initials are taken. Two ways to the same state never are each other's beginning when both end with a row's
own edit, so their ranks decide all later ties too.

Edge cases: a null role or text is one space, a null turn comes first, null conversations are one conversation; rows of
one turn are taken by role, then text; a role that starts with none of s, u, a can't be kept; a conversation none of
whose rows is present has zeros, an empty audit and the digest of nothing; an empty table gives an empty result; other
columns don't matter.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airgrid.llm.common import WS_CHARS

#: What the pattern's states (nothing yet, system, user, assistant) go on to by a kept row's initial, and by the only role that may be put there.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
GIVEN = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
#: Turns to insert in a state before the conversation may end.
MISSING = (0, 2, 1, 0)
INSERT, DELETE, REROLE, TRUNCATED = 2, 3, 2, 1
#: Any state is two inserts from the assistant's at most, which does what any other does but for keeping a system row,
#: deleted for 3. So edits that cost more than both together are never the cheapest, and costs relative to the least are few.
BEHIND = 2 * INSERT + DELETE
EDITS = "DKR"
#: Bytes of back-pointers that are held before they are spilled.
SPILL = 1 << 22
FAULTS = ("", "blank", "duplicate", "truncated")


@cache
def step(costs: tuple, order: tuple, initial: str, fault: str) -> tuple[tuple, tuple, tuple]:
    """From costs by state (None: out of reach) and the states in the order of their edits: costs, order, and for each state (state before, inserts, edit)."""
    best: dict[int, tuple] = {}
    for rank, s in enumerate(order):
        at = s
        for inserts in range(3):
            ways = [(at, "D", DELETE)]
            if fault not in ("blank", "duplicate"):
                late = TRUNCATED if fault == "truncated" else 0
                ways += [(NEXT[at][initial], "K", late)] if initial in NEXT[at] else []
                ways += [(GIVEN[at][1], "R", REROLE + late)]
            for to, edit, cost in ways:
                key = (costs[s] + inserts * INSERT + cost, rank, "I" * inserts + edit)
                if to not in best or key < best[to][0]:
                    best[to] = (key, (s, inserts, edit))
            at = GIVEN[at][1]
    least = min(key[0] for key, _ in best.values())
    best = {t: b for t, b in best.items() if b[0][0] <= least + BEHIND}
    new = tuple(best[t][0][0] if t in best else None for t in range(4))
    return new, tuple(sorted(best, key=lambda t: best[t][0][1:])), tuple(best[t][1] if t in best else None for t in range(4))


@cache
def relative(costs: tuple) -> tuple[int, tuple]:
    least = min(c for c in costs if c is not None)
    return least, tuple(None if c is None else c - least for c in costs)


@cache
def packed(back: tuple) -> bytes:
    return bytes(255 if b is None else 9 * b[0] + 3 * b[1] + EDITS.index(b[2]) for b in back)


class Pointers:
    """Four bytes for each row, spilled beyond a bound and read backwards."""

    def __init__(self, spill: int):
        self.spill, self.held, self.file = spill, bytearray(), None

    def add(self, row: bytes) -> None:
        self.held += row
        if len(self.held) >= self.spill:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.write(self.held)
            self.held = bytearray()

    def backwards(self) -> Iterator[memoryview]:
        yield memoryview(self.held)
        at = self.file.tell() if self.file else 0
        while at:
            at -= self.spill  # what was spilled is a whole number of such blocks
            self.file.seek(at)
            yield memoryview(self.file.read(self.spill))

    def close(self) -> None:
        if self.file:
            self.file.close()


class Conversation:
    """What is carried from row to row of one conversation."""

    def __init__(self, key: str | None, spill: int):
        self.key, self.base, self.costs, self.order = key, 0, (0, None, None, None), (0,)
        self.digests = [hashlib.sha256(), None, None, None]
        self.pointers = Pointers(spill)
        self.counts = dict.fromkeys(FAULTS, 0)
        self.illegal, self.before = 0, None
        self.turns, self.first, self.last = 0, None, None

    def row(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if turn is not None and turn != self.last:
            self.turns, self.first, self.last = self.turns + 1, turn if self.first is None else self.first, turn
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        self.counts[fault] += 1
        costs, self.order, back = step(self.costs, self.order, initial, fault)
        least, self.costs = relative(costs)
        self.base += least
        self.pointers.add(packed(back))
        if any(b is not None and b != (t, 0, "D") for t, b in enumerate(back)):
            self.digests = [b and self.extended(*b, role, text) for b in back]

    def extended(self, s: int, inserts: int, edit: str, role: str, text: str):
        digest = self.digests[s]
        if not inserts and edit == "D":
            return digest.copy()
        out, at = [], s
        for _ in range(inserts):
            out.append(f"{GIVEN[at][0]}:")
            at = GIVEN[at][1]
        if edit != "D":
            out.append(f"{role if edit == 'K' else GIVEN[at][0]}:{text}")
        digest = digest.copy()
        digest.update((("\n" if s else "") + "\n".join(out)).encode("utf-8", "surrogatepass"))
        return digest

    def result(self) -> tuple:
        cost, _, s = min((self.costs[s] + MISSING[s] * INSERT, rank, s) for rank, s in enumerate(self.order))
        if MISSING[s]:
            self.digests[s] = self.extended(s, MISSING[s], "D", "", "")
        digest = self.digests[s].hexdigest()
        edits = ["I" * MISSING[s]]
        for block in self.pointers.backwards():
            for i in range(len(block) - 4, -1, -4):
                s, code = divmod(block[i + s], 9)
                edits.append(EDITS[code % 3] + "I" * (code // 3))
        self.pointers.close()
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        counts = (self.counts[f] for f in FAULTS[1:])
        return (self.key, min(gaps, (1 << 63) - 1), *counts, self.illegal, self.base + cost, "".join(edits)[::-1], digest)


RESULT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def ordered(rows: DataFrame, conv: str, turn: str, role: str, text: str, present: Column) -> DataFrame:
    """(conv, no_turn, turn, role, text, fault, present) with each conversation in one partition, in the order of its turns."""
    r, t = (F.coalesce(F.col(c), F.lit(" ")) for c in (role, text))
    rows = rows.select(F.col(conv).cast("string").alias("conv"), F.col(turn).cast("long").alias("turn"), r.alias("role"), t.alias("text"), F.coalesce(present, F.lit(False)).alias("present"))
    rows = rows.repartition("conv").withColumn("h", F.xxhash64("role", "text"))
    # The window's groups lie in the partitions already made, so this is a sort, not a shuffle.
    again = F.row_number().over(Window.partitionBy("conv", "present", "h", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    trimmed = F.btrim("text", F.lit(WS_CHARS))
    fault = F.when(trimmed == "", 1).when(again, 2).when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    rows = rows.withColumn("fault", fault).drop("h")
    rows = rows.sortWithinPartitions(F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "fault")
    return rows.select("conv", F.col("turn").isNull().alias("no_turn"), F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text", "fault", "present")


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: Column | None = None, spill: int = SPILL) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation.

    Rows that are not `present` only name their conversation.
    """
    spill = max(4, spill - spill % 4)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_ = None
        for b in batches:
            done = []
            for key, no_turn, at, r, t, fault, here in zip(*(b[c].tolist() for c in b.columns), strict=True):
                if open_ is None or open_.key != key:
                    done += [open_.result()] if open_ else []
                    open_ = Conversation(key, spill)
                if here:
                    open_.row(None if no_turn else at, r, t, FAULTS[fault])
            if done:
                yield pd.DataFrame(done, columns=names)
        if open_:
            yield pd.DataFrame([open_.result()], columns=names)

    names = [c.split()[0] for c in RESULT.split(", ")]
    found = ordered(rows, conv, turn, role, text, F.lit(True) if present is None else present).mapInPandas(run, RESULT)
    return found.select(F.col("conv").cast(rows.schema[conv].dataType).alias(conv), *names[1:])


def repaired(rows: DataFrame, repairs: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: Column | None = None) -> DataFrame:
    """(conv, position, edit, role, text) of each row of the repaired conversations, from what `repair` gave.

    An audit joins its conversation as a first row, so this streams like `repair` does.
    """
    own = ordered(rows, conv, turn, role, text, F.lit(True) if present is None else present).where("present").select("conv", F.lit(1).alias("kind"), "no_turn", "turn", "role", "text", "fault")
    audits = repairs.select(F.col(conv).cast("string").alias("conv"), F.lit(0).alias("kind"), F.lit(True).alias("no_turn"), F.lit(0).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).alias("fault"))
    both = own.unionByName(audits).repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "kind", F.col("no_turn").desc(), "turn", "role", "text", "fault").select("conv", "kind", "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, audit, i, state, position, out = None, "", 0, 0, 0, []

        def put(edit: str, name: str, t: str) -> None:
            nonlocal position
            out.append((key, position, edit, name, t))
            position += 1

        def inserted() -> None:
            nonlocal i, state
            while audit[i : i + 1] == "I":
                name, state = GIVEN[state]
                put("I", name, "")
                i += 1

        for b in batches:
            out.clear()
            for k, kind, r, t in zip(*(b[c].tolist() for c in b.columns), strict=True):
                if kind == 0:
                    key, audit, i, state, position = k, t, 0, 0, 0
                else:
                    edit = audit[i]
                    i += 1
                    if edit == "K":
                        state = NEXT[state][r[:1]]
                        put(edit, r, t)
                    elif edit == "R":
                        name, state = GIVEN[state]
                        put(edit, name, t)
                inserted()
            if out:
                yield pd.DataFrame(out, columns=["conv", "position", "edit", "role", "text"])

    found = both.mapInPandas(run, "conv string, position long, edit string, role string, text string")
    return found.select(F.col("conv").cast(rows.schema[conv].dataType).alias(conv), "position", "edit", "role", "text")
