"""Conversations repaired to a grammar of roles at least cost, by Dijkstra's search on an edit lattice.

A node of the lattice is (turns read, state of the grammar); nothing of it is
built beforehand. Keeping, relabelling and deleting a turn lead to the next
turn, inserting one does not. The search pops nodes by (cost, audit), the audit
being the edits' initials so far, and stops at the first accepting node behind
the last turn. Edits decide the states, so no audit at a node is a prefix of
another of the same cost, and the least audit at a node stays least with
whatever is appended.

Conversations are streams of rows, sorted by Spark, of which a task holds BLOCK
turns: the search goes on from block to block with the best way to each state
that can still win, and what all of these have in common is written off. A conversation of any
length passes so in bounded memory, but for its audit, which is one cell of the
result. Its turns pass twice: as flags, for the search, then as texts behind a
row with the audit. What is said twice is found by a window over (conversation,
role, text), so no task remembers what was said.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import python_path

KEEP, RELABEL, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, RELABEL: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
#: Where initials of roles lead, from nothing (0), behind the system's turn (1), the user's (2) and the assistant's (3).
GRAMMAR = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ACCEPTING = {0, 3}
#: What may be inserted, or a turn be relabelled to.
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {a + b for a, b in ("su", "ua", "au")}
#: With two insertions and the deletion of a system's turn any state can do what another one can, so one that costs more than this above the cheapest never wins.
SLACK = 2 * COSTS[INSERT] + COSTS[DELETE]
BLOCK = 256
SPACE = " \t\n\x0b\x0c\r"
#: What stands first of a turn's faults.
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3


def search(turns: list[tuple[str, int]], starts: dict[int, tuple[int, str]], last: bool) -> dict[int, tuple[int, str]]:
    """The least (cost, audit) of each state behind the turns (initial, fault), from those before; of the first accepting one only, if these are the last."""
    heap = [(cost, audit, 0, state) for state, (cost, audit) in starts.items()]
    heapq.heapify(heap)
    done, ends = set(), {}
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(turns):
            ends[state] = cost, audit
            if last and state in ACCEPTING:
                return {state: (cost, audit)}
        ways = GRAMMAR[state]
        for role in ways.keys() & ROLES.keys():
            heapq.heappush(heap, (cost + COSTS[INSERT], audit + INSERT, i, ways[role]))
        if i < len(turns):
            initial, fault = turns[i]
            heapq.heappush(heap, (cost + COSTS[DELETE], audit + DELETE, i + 1, state))
            if fault not in (BLANK, DUPLICATE):
                more = cost + (TRUNCATED_COST if fault == TRUNCATED else 0)
                if initial in ways:
                    heapq.heappush(heap, (more + COSTS[KEEP], audit + KEEP, i + 1, ways[initial]))
                for role in ways.keys() & ROLES.keys():
                    heapq.heappush(heap, (more + COSTS[RELABEL], audit + RELABEL, i + 1, ways[role]))
    return ends


class Path:
    """The search over a conversation that comes turn by turn."""

    def __init__(self, block: int = BLOCK) -> None:
        self.block, self.held, self.common, self.states = block, [], [], {0: (0, "")}

    def add(self, initial: str, fault: int) -> None:
        self.held.append((initial, fault))
        if len(self.held) == self.block:
            ends = search(self.held, self.states, False)
            least = min(cost for cost, _ in ends.values())
            ends = {s: end for s, end in ends.items() if end[0] <= least + SLACK}
            shared = commonprefix([audit for _, audit in ends.values()])
            self.common.append(shared)
            self.held, self.states = [], {s: (cost, audit[len(shared) :]) for s, (cost, audit) in ends.items()}

    def end(self) -> tuple[int, str]:
        ((cost, audit),) = search(self.held, self.states, True).values()
        return cost, "".join([*self.common, audit])


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PATHS = f"conv_id long, {', '.join(f'{c} long' for c in COUNTS)}, audit string"


def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation, of rows (conv_id, turn, initial, fault) in order."""
    names = [x.split()[0] for x in PATHS.split(", ")]
    conversation, path, open_row = None, None, False

    def closed() -> dict:
        cost, audit = path.end()
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns[2] else 0
        return {"conv_id": conversation, "gaps": gaps, "blank": faults[BLANK], "duplicate": faults[DUPLICATE], "truncated": faults[TRUNCATED], "illegal": illegal, "cost": cost, "audit": audit}

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.string() if c == "audit" else pa.int64()) for c in names], names=names)

    for batch in batches:
        out = []
        for conv, turn, initial, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault"))):
            if not open_row or conv != conversation:
                if open_row:
                    out.append(closed())
                conversation, path, open_row = conv, Path(), True
                turns, faults, illegal, before = [0, 0, 0], [0] * 4, 0, None
            if turn is not None and (not turns[2] or turn != turns[1]):  # the turns come in order
                turns = [turns[0] if turns[2] else turn, turn, turns[2] + 1]
            illegal += before is not None and before + initial not in LEGAL
            faults[fault] += 1
            path.add(initial, fault)
            before = initial
        if out:
            yield batch_of(out)
    if open_row:
        yield batch_of([closed()])


REPAIRED = f"{PATHS}, repaired_sha256 string"


class Edits:
    """What an audit makes of a conversation whose turns come one by one."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, 0

    def step(self, turn: tuple[str, str] | None) -> list[tuple[str, str]]:
        """The repaired turns (role, text) up to this one's; with None, those behind the last one."""
        end = self.at
        while end < len(self.audit) and self.audit[end] == INSERT:
            end += 1
        end += turn is not None
        audit, self.at, out = self.audit[self.at : end], end, []
        for edit in audit:
            if edit == DELETE:
                continue
            role = turn[0][:1] if edit == KEEP else next(r for r in GRAMMAR[self.state] if r in ROLES)
            self.state = GRAMMAR[self.state][role]
            out.append((turn[0] if edit == KEEP else ROLES[role], "" if edit == INSERT else turn[1]))
        return out


def conversations_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict | None, list[tuple[str, str]], bool]]:
    """(the row of PATHS, repaired turns that follow, whether the conversation ends) of rows that begin with that row."""
    names = [x.split()[0] for x in PATHS.split(", ")]
    row, edits = None, None
    for batch in batches:
        heads = batch.select(names)
        for i, (head, role, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("head", "role", "text")))):
            if head:
                if row:
                    yield row, edits.step(None), True
                row = heads.slice(i, 1).to_pylist()[0]
                edits = Edits(row["audit"])
            else:
                yield row, edits.step((role, text)), False
    if row:
        yield row, edits.step(None), True


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of PATHS with the hash of the repaired conversation."""
    fields = [x.split()[0] for x in REPAIRED.split(", ")]
    sha, between, out = hashlib.sha256(), "", []
    batch_of = lambda: pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.string() if c in ("audit", "repaired_sha256") else pa.int64()) for c in fields], names=fields)
    for row, turns, ends in conversations_in(batches):
        for role, text in turns:
            sha.update(f"{between}{role}:{text}".encode())
            between = "\n"
        if ends:
            out.append(row | {"repaired_sha256": sha.hexdigest()})
            sha, between = hashlib.sha256(), ""
            if len(out) == 1024:
                yield batch_of()
                out = []
    if out:
        yield batch_of()


TURNS = "conv_id long, place long, role string, text string"


def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired turns, with their places from 0."""
    place, out, size = 0, [], 0
    batch_of = lambda: pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.string()))], names=[x.split()[0] for x in TURNS.split(", ")])
    for row, turns, ends in conversations_in(batches):
        for role, text in turns:
            out.append((row["conv_id"], place, role, text))
            place, size = place + 1, size + len(text)
            if len(out) == 4096 or size > 4 << 20:
                yield batch_of()
                out, size = [], 0
        place = 0 if ends else place
    if out:
        yield batch_of()


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, copy, role, text) with faults put in by crc32 of conv_id:turn, as the contract of op13 has them; a null is one space there."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fate.alias("fate")).where("fate <> 0")
    changed = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.explode(copies).alias("copy"), F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"))


def _in_order() -> list[Column]:
    """Turns in order; what shares a turn by role and text, so that equal tables give equal results."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("copy")]


def with_paths(turns: DataFrame, every: DataFrame) -> DataFrame:
    """Each conversation's row of PATHS (head), then its turns in order: conversations stand together in a partition."""
    python_path(turns.sparkSession)
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    turns = turns.select("conv_id", "turn", "copy", space("role").alias("role"), space("text").alias("text")).withColumn("digest", F.sha2("text", 256))
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    light = turns.select("conv_id", "turn", "copy", "role", "digest", (end == "").alias("blank"), F.substring(end, -1, 1).isin(".", "!", "?").alias("whole"))
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first(), "copy"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("nth") > 1, DUPLICATE).when(~F.col("whole"), TRUNCATED).otherwise(0)
    flags = light.withColumn("nth", seen).select("conv_id", "turn", "copy", "role", "digest", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
    ordered = flags.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *_in_order())
    found = ordered.select("conv_id", "turn", "initial", "fault").mapInArrow(paths, PATHS)
    wanted = every.select(F.col("conv_id").alias("wanted")).distinct()
    heads = wanted.join(found, F.col("wanted").eqNullSafe(F.col("conv_id")), "left")
    heads = heads.select(F.col("wanted").alias("conv_id"), *(F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS), F.coalesce("audit", F.lit("")).alias("audit"), F.lit(True).alias("head"))
    both = heads.unionByName(turns.withColumn("head", F.lit(False)), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("head").desc(), *_in_order())


def repair(turns: DataFrame, every: DataFrame) -> DataFrame:
    """Per conv_id of every: gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256, of turns (conv_id, turn, copy, role, text).

    Turns are taken by turn, nulls first, then by role, text hash and copy; a
    null conv_id is a conversation of its own. Null roles and texts are a
    space. A conversation without turns has zeros, an empty audit and the hash
    of nothing. Further columns are not read; empty tables give no rows.
    """
    return with_paths(turns, every).mapInArrow(digests, REPAIRED)


def repaired_turns(turns: DataFrame, every: DataFrame) -> DataFrame:
    """The repaired conversations themselves: conv_id, place (from 0), role, text."""
    return with_paths(turns, every).mapInArrow(rewritten, TURNS)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair(damaged(conversations), conversations)
