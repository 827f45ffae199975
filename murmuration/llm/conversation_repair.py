"""Cheapest repair of conversations by Knuth's lightest derivations.

A conversation is repaired into an optional system turn and whole pairs of user and assistant turns.
Its items are (rows read, state of the turn order); keeping, reroling, deleting a row and inserting an
empty turn are deductions from one item to another. An agenda pops the lightest item: its value
(cost, rows read, edits so far) is then final, as every deduction gives a greater value than its
premise has (``KEEP`` is free, but reads a row) and a lesser premise never gives a greater
conclusion: two edit strings of one item with equal cost read equally many rows, so none begins the other.

Rows stream through a task in the order of their turns. Conversations are worked off in chunks of
``Limits.rows``: an agenda gives the lightest derivation from each state at a chunk's beginning to each
at its end, a table that depends on the kinds of rows alone and is kept for the next equal chunk; two
such derivations join into one. So a task holds a chunk's texts and the edits of a conversation, one letter a
row, however long it is; the SHA-256 of its repaired text runs along. The digest and the edits of a
conversation are one chain, so one task reads all its rows, in bounded memory.

Defined cases: a null role or text is one space, a null turn comes first, a null conversation is one
of its own; equal rows are counted before they are shuffled, and all but the first are duplicates;
rows of one turn are ordered by role and text; a conversation without rows has an empty repair; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import os
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# White space, sentence ends, legal neighbours, and the costs of edits.
SPACE, ENDS, LEGAL = " \t\n\x0b\x0c\r", ".!?", {"su", "ua", "au"}
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3

# States of the turn order: nothing yet, after a system, a user, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Turn that may be put in front of the next row, with its state: after a user the assistant, else the user.
WANTED = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
ENDED = (START, ASSISTANT)

#: Plans have one letter an edit that says the role too: K, D, U and A (rerole), u and a (insert).
TO_AUDIT = str.maketrans("UAua", "RRII")
ROLES = {"U": "user", "A": "assistant", "u": "user", "a": "assistant"}


class Limits(NamedTuple):
    rows: int = 4096
    chars: int = 1 << 22


@functools.lru_cache(maxsize=1024)
def derivations(kinds: str, entry: int) -> dict[int, tuple[int, str]]:
    """Cheapest (cost, plan) from state ``entry`` in front of rows of these kinds to each state behind.

    A kind is x for a row that must go, else the initial of its role (s, u, a, or o), in upper case where
    the row is cut off.
    """
    final: dict[tuple[int, int], tuple[int, str]] = {}
    exits: dict[int, tuple[int, str]] = {}
    agenda = [(0, 0, "", entry, "")]
    while agenda and len(exits) < 4:
        cost, read, audit, state, plan = heapq.heappop(agenda)
        if (read, state) in final:
            continue
        final[read, state] = cost, plan

        def conclude(extra: int, rows: int, letter: str, to: int) -> None:
            if (read + rows, to) not in final:
                heapq.heappush(agenda, (cost + extra, read + rows, audit + letter.translate(TO_AUDIT), to, plan + letter))

        wanted, then = WANTED[state]
        conclude(INSERT, 0, wanted, then)
        if read == len(kinds):
            exits[state] = cost, plan
            continue
        kind = kinds[read]
        conclude(DELETE, 1, "D", state)
        if kind != "x":
            cut = CUT if kind.isupper() else 0
            conclude(REROLE + cut, 1, wanted.upper(), then)
            if (state, kind.lower()) in NEXT:
                conclude(cut, 1, "K", NEXT[state, kind.lower()])
    return exits


class Path:
    """The lightest derivation of a state behind the rows so far: cost, edits not yet common to all, digest."""

    def __init__(self, cost: int, plan: str, digest, lines: int) -> None:
        self.cost, self.plan, self.digest, self.lines = cost, plan, digest, lines

    def light(self, cost: int, plan: str) -> tuple[int, str]:
        return self.cost + cost, (self.plan + plan).translate(TO_AUDIT)

    def after(self, cost: int, plan: str, rows: list[tuple[str, str]]) -> "Path":
        digest, lines, at = self.digest.copy(), self.lines, 0
        for letter in plan:
            role, text = ("", "") if letter in "ua" else rows[at]
            at += letter not in "ua"
            if letter != "D":
                digest.update(f"{chr(10) if lines else ''}{ROLES.get(letter, role)}:{text}".encode())
                lines += 1
        return Path(self.cost + cost, self.plan + plan, digest, lines)


class Conversation:
    """One conversation as its rows go by."""

    def __init__(self, limits: Limits) -> None:
        self.limits = limits
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.before = None
        self.done: list[str] = []
        self.paths = {START: Path(0, "", hashlib.sha256(), 0)}
        self._clear()

    def _clear(self) -> None:
        self.kinds: list[str] = []
        self.rows: list[tuple[str, str]] = []
        self.chars = 0

    def add(self, turn: int | None, role: str, text: str, copies: int, is_first: bool) -> None:
        if turn is not None and copies:
            self.turns += turn != self.last
            self.first, self.last = turn if self.first is None else self.first, turn
        seen = text.rstrip(SPACE)
        initial = role[:1]
        for i in range(copies):
            kind = initial if initial in ("s", "u", "a") else "o"
            if not seen:
                self.blank += 1
                kind = "x"
            elif i or not is_first:
                self.duplicate += 1
                kind = "x"
            elif seen[-1] not in ENDS:
                self.truncated += 1
                kind = kind.upper()
            self.illegal += self.before is not None and self.before + initial not in LEGAL
            self.before = initial
            if len(self.kinds) >= self.limits.rows or self.chars > self.limits.chars:
                self._advance()
            self.kinds.append(kind)
            self.rows.append((role, "" if kind == "x" else text))
            self.chars += len(role) + (0 if kind == "x" else len(text))

    def _choices(self) -> dict[int, list[tuple]]:
        """For each state behind the chunk: (value, state in front, cost, plan) of each way there."""
        kinds = "".join(self.kinds)
        ways: dict[int, list[tuple]] = {}
        for entry, path in self.paths.items():
            for state, (cost, plan) in derivations(kinds, entry).items():
                ways.setdefault(state, []).append((path.light(cost, plan), entry, cost, plan))
        return ways

    def _advance(self) -> None:
        found = {}
        for state, ways in self._choices().items():
            _, entry, cost, plan = min(ways)
            found[state] = self.paths[entry].after(cost, plan, self.rows)
        # What all paths begin with is settled. States follow from edits, so equal edits are equal plans.
        common = len(os.path.commonprefix([p.plan for p in found.values()]))
        self.done.append(next(iter(found.values())).plan[:common])
        for path in found.values():
            path.plan = path.plan[common:]
        self.paths = found
        self._clear()

    def finish(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, plan."""
        ways = self._choices()
        _, entry, cost, plan = min(min(ways[state]) for state in ENDED if state in ways)
        best = self.paths[entry].after(cost, plan, self.rows)
        whole = "".join(self.done) + best.plan
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, best.cost,
                whole.translate(TO_AUDIT), best.digest.hexdigest(), whole)


def in_order(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies, is_first: distinct rows by conversation and turn.

    ``turns`` has conv_id, turn, role, text, and optionally ``copies`` (0: the row is gone, its
    conversation stays). Equal rows are added up before anything is shuffled.
    """
    space = F.lit(" ")
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), space).alias("role"),
                        F.coalesce(F.col("text").cast("string"), space).alias("text"), copies.cast("long").alias("copies"))
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")) \
        .withColumn("text_sha", F.sha2("text", 256))
    # One task reads a conversation in any case; copies were added up before.
    same = Window.partitionBy("conv_id", "role", "text_sha").orderBy(F.expr("copies = 0"), "turn")
    marked = counted.repartition("conv_id").withColumn("is_first", (F.row_number().over(same) == 1) & (F.col("copies") > 0))
    return marked.select("conv_id", "turn", "role", "text", "copies", "is_first").sortWithinPartitions("conv_id", "turn", "role", "text")


def _streamed(batches: Iterator[pa.RecordBatch], limits: Limits) -> Iterator[tuple]:
    """conv_id and ``Conversation.finish`` of each conversation in a sorted stream of rows."""
    nothing = object()
    now, conversation = nothing, None
    for batch in batches:
        for conv_id, *row in zip(*(column.to_pylist() for column in batch.columns)):
            if conv_id != now or now is nothing:
                if conversation:
                    yield now, *conversation.finish()
                now, conversation = conv_id, Conversation(limits)
            conversation.add(*row)
    if conversation:
        yield now, *conversation.finish()


def repair(turns: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, plan: one row a conversation."""
    rows = in_order(turns)
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = T.StructType([rows.schema["conv_id"], *(T.StructField(c, T.LongType()) for c in longs),
                           *(T.StructField(c, T.StringType()) for c in ("audit", "repaired_sha256", "plan"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, ready, size = to_arrow_schema(schema), [], 0
        for row in _streamed(batches, limits):
            ready.append(row)
            size += 500 + len(row[-1])
            if size > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*ready), kinds)], schema=kinds)
                ready, size = [], 0
        if ready:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*ready), kinds)], schema=kinds)

    return rows.mapInArrow(run, schema)


def repaired_turns(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """conv_id, place (from 0), edit, role, text: the turns after the edits of ``repair``."""
    rows = in_order(turns)
    numbered = T.StructType([rows.schema["conv_id"], T.StructField("row", T.LongType()), T.StructField("role", T.StringType()),
                             T.StructField("text", T.StringType())])
    steps = T.StructType([repairs.schema["conv_id"], T.StructField("place", T.LongType()), T.StructField("edit", T.StringType()),
                          T.StructField("row", T.LongType())])

    def batch_of(found: list[tuple], schema: T.StructType) -> pa.RecordBatch:
        kinds = to_arrow_schema(schema)
        columns = list(zip(*found)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, place = object(), 0
        for batch in batches:
            found = []
            for conv_id, _, role, text, copies, _ in zip(*(column.to_pylist() for column in batch.columns)):
                now, place = conv_id, place if conv_id == now else 0
                # Copies behind the first are deleted by every repair: their places stay empty.
                found += [(conv_id, place, role, text)] if copies else []
                place += copies
            yield batch_of(found, numbered)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv_id, plan in zip(*(column.to_pylist() for column in batch.columns)):
                found, place, row = [], 0, 0
                for letter in plan:
                    if letter != "D":
                        found.append((conv_id, place, letter, None if letter in "ua" else row))
                        place += 1
                    row += letter not in "ua"
                    if len(found) >= 1 << 16:
                        yield batch_of(found, steps)
                        found = []
                yield batch_of(found, steps)

    edits = repairs.select("conv_id", "plan").mapInArrow(walk, steps)
    given = rows.mapInArrow(number, numbered).select(F.col("conv_id").alias("c"), F.col("row").alias("r"), "role", "text")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("row") == F.col("r"))
    new_role = F.when(F.lower("edit") == "u", "user").when(F.lower("edit") == "a", "assistant").otherwise(F.col("role"))
    return edits.join(given, same, "left").select("conv_id", "place", F.translate("edit", "UAua", "RRII").alias("edit"),
                                                  new_role.alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def damage(turns: DataFrame) -> DataFrame:
    """The turns as a fixed rule spoils them, with ``copies``; see the query's contract."""
    space = F.lit(" ")
    rows = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"),
                        F.coalesce(F.col("text").cast("string"), space).alias("text"))
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    dealt = rows.withColumn("harm", F.crc32(name.cast("binary")) % 20)
    harm = F.col("harm")
    return dealt.select(
        "conv_id", "turn", F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        F.when(harm == 0, 0).when(harm == 3, 2).otherwise(1).alias("copies"))
