"""Repair of conversation structure by cheapest edits, with Four-Russians block tables.

A repaired conversation's role initials are nothing, or an optional s and one or more pairs ua. Rows are kept,
given the other role, or deleted, and empty turns are inserted; deleting and inserting never changes the order.
While roles are laid, only four states differ: nothing laid, s laid, u laid last, a laid last. The cost of the
cheapest way from each state to the end is a vector of four numbers, and what a row does to it depends on nine
kinds of row only (four initials, cut off or not, and rows that must go).

Four Russians: any state reaches any other's future within five, so the vectors, less their smallest number, are
few. The vector before a block of rows is looked up by the vector behind it and the block's kinds, for every
block of a fixed length. A conversation is read from its end by blocks; then every block is expanded once from
the vector behind it, and its edits are chosen from the front: the ASCII-least edit that is still cheapest. The
edits taken so far fix the state, so that choice gives the least of all cheapest edit texts. Expanded blocks are
kept in a table too, which the number of vectors bounds.

On Spark: repeated rows are found by their digests (narrow, combined before the shuffle), then rows are dealt by
conversation and sorted. A task streams them: it holds one byte a row, and texts beyond a few megabytes wait in
its own temporary file until the conversation's end is known. One conversation is always one stream, since one
text and one hash over it are asked for.

Defined results: a null role or text is one space; a null id or turn is one space in the key that chooses the
damage; null ids are one conversation; rows of one turn, and of none, go by role and text; roles go by their
first character, so an empty role can only be replaced; repeated rows are duplicates; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creamline.llm.common import arrow_schema, map_batches, table

_BLANK = " \t\n\x0b\x0c\r"
#: What the states lead to: nothing laid 0, s laid 1, u last 2, a last 3.
_NEXT = (2, 2, 3, 2)
_KEEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "": (None,) * 4}
_INITIALS = ("s", "u", "a", "")
#: Kinds of rows: initial and cut off or not; the last must be deleted.
KINDS, _MUST_GO = 9, 8
_DELETE, _INSERT, _REROLE = 3, 2, 2
_NAMES = {2: "user", 3: "assistant"}
_END = (0, 4, 2, 0)


def kind_of(role: str, cut_off: bool) -> int:
    initial = role[:1]
    return 2 * (_INITIALS.index(initial) if initial in ("s", "u", "a") else 3) + cut_off


def before(kind: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    """Cost to the end from each state before a row, given the costs behind it."""
    costs = [_DELETE + cost for cost in behind]
    if kind != _MUST_GO:
        extra = kind & 1
        for state in range(4):
            kept = _KEEP[_INITIALS[kind >> 1]][state]
            if kept is not None:
                costs[state] = min(costs[state], extra + behind[kept])
            costs[state] = min(costs[state], _REROLE + extra + behind[_NEXT[state]])
    for _ in range(3):
        costs = [min(cost, _INSERT + costs[_NEXT[state]]) for state, cost in enumerate(costs)]
    return tuple(costs)


class BlockTables:
    """Vectors, and for every vector and block of kinds the vector in front and the cost that was taken off."""

    def __init__(self, length: int = 3):
        self.length, self.vectors, number = length, [_END], {_END: 0}
        to, off = [], []
        for vector in self.vectors:  # grows while it is read
            row = []
            for kind in range(KINDS):
                costs = before(kind, vector)
                least = min(costs)
                plain = tuple(cost - least for cost in costs)
                if plain not in number:
                    number[plain] = len(self.vectors)
                    self.vectors.append(plain)
                row.append((number[plain], least))
            to.append([a for a, _ in row])
            off.append([b for _, b in row])
        self.step, self.cost = np.array(to), np.array(off)
        self.block_to, self.block_cost = self.step, self.cost
        for _ in range(length - 1):  # one more row in front of every block
            then = self.block_to
            self.block_to = self.step[then].swapaxes(-1, -2).reshape(len(then), -1)
            more = self.block_cost[:, :, None] + self.cost[then]
            self.block_cost = more.swapaxes(-1, -2).reshape(len(then), -1)
        self._expanded = {}

    def edits(self, kinds: bytes) -> tuple[str, int]:
        """The ASCII-least cheapest edits of a conversation's rows, and their cost."""
        at, length, vector, cost = len(kinds), self.length, 0, 0
        bounds = []
        while at:
            size = length if at >= length else 1
            at -= size
            block = kinds[at : at + size]
            bounds.append((block, vector))
            if size == length:
                code = _code(block)
                cost += int(self.block_cost[vector, code])
                vector = int(self.block_to[vector, code])
            else:
                cost += int(self.cost[vector, block[0]])
                vector = int(self.step[vector, block[0]])
        cost += self.vectors[vector][0]
        out, state = [], 0
        for block, behind in reversed(bounds):
            text, state = self.expand(block, behind, state)
            out.append(text)
        return "".join(out) + "I" * (_END[state] // _INSERT), cost

    def expand(self, block: bytes, behind: int, state: int) -> tuple[str, int]:
        """Edits of a block entered in a state, by the costs behind it; and the state in which it is left."""
        found = self._expanded.get((block, behind, state))
        if found is None:
            levels = [self.vectors[behind]]
            for kind in reversed(block):
                levels.append(before(kind, levels[-1]))
            levels.reverse()
            out, now = [], state
            for kind, here, then in zip(block, levels, levels[1:], strict=False):
                extra = kind & 1
                while True:
                    kept = _KEEP[_INITIALS[kind >> 1]][now] if kind != _MUST_GO else None
                    if _DELETE + then[now] == here[now]:
                        out.append("D")
                    elif _INSERT + here[_NEXT[now]] == here[now]:
                        out.append("I")
                        now = _NEXT[now]
                        continue
                    elif kept is not None and extra + then[kept] == here[now]:
                        out.append("K")
                        now = kept
                    else:
                        out.append("R")
                        now = _NEXT[now]
                    break
            found = self._expanded[block, behind, state] = ("".join(out), now)
        return found


def _code(block: bytes) -> int:
    code = 0
    for kind in block:
        code = code * KINDS + kind
    return code


@cache
def tables(length: int = 3) -> BlockTables:
    return BlockTables(length)


class _Turns:
    """The rows of one conversation, in order; those beyond some megabytes wait in a temporary file of the task."""

    MOST_CHARS = 8 << 20

    def __init__(self, conv_id):
        self.conv_id, self.kinds, self.rows, self.chars, self.file = conv_id, bytearray(), [], 0, None
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.initial = self.last = None

    def add(self, turn, role: str, text: str, seen_before: bool) -> None:
        bare, this = text.strip(_BLANK), (turn, role, text)
        cut_off = bool(bare) and bare[-1] not in ".!?"
        if not bare:
            self.blank, kind = self.blank + 1, _MUST_GO
        elif seen_before or this == self.last:
            self.duplicate, kind = self.duplicate + 1, _MUST_GO
        else:
            self.truncated, kind = self.truncated + cut_off, kind_of(role, cut_off)
        if self.last is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        self.initial, self.last = role[:1], this
        self.kinds.append(kind)
        self.rows.append(this)
        self.chars += len(role) + len(text)
        if self.chars > self.MOST_CHARS:
            self.file = self.file or tempfile.TemporaryFile()
            pickle.dump(self.rows, self.file)
            self.rows, self.chars = [], 0

    def all_rows(self) -> Iterator[tuple]:
        if self.file is not None:
            end = self.file.tell()
            self.file.seek(0)
            while self.file.tell() < end:
                yield from pickle.load(self.file)
        yield from self.rows

    @property
    def gaps(self) -> int:
        return self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0

    def repaired(self) -> Iterator[tuple]:
        """(edit, turn, role, text) of every edit in order; deleted rows keep their own role and text."""
        audit, self.cost = tables().edits(bytes(self.kinds))
        self.audit, rows, state = audit, self.all_rows(), 0
        for edit in audit:
            turn, role, text = (None, None, "") if edit == "I" else next(rows)
            if edit in "IR":
                state = _NEXT[state]
                role = _NAMES[state]
            elif edit == "K":
                state = _KEEP[role[:1]][state]
            yield edit, turn, role, text
        if self.file is not None:
            self.file.close()


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[_Turns]:
    now = None
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            for row in batch.slice(start, 512).to_pylist():
                if now is None or now.conv_id != row["conv_id"]:
                    if now is not None:
                        yield now
                    now = _Turns(row["conv_id"])
                for _ in range(row["copies"]):
                    now.add(row["turn"], row["role"], row["text"], row["seen_before"])
    if now is not None:
        yield now


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies (0: dropped) after the damage that each row's key chooses."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind, text = F.col("kind"), F.coalesce("text", F.lit(" "))
    return rows.select("conv_id", "turn", "role", "text", (F.crc32(key.cast("binary")) % 20).alias("kind")).select(
        "conv_id", "turn",
        F.when(kind == 4, "user").when(kind == 0, "").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def ordered(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) by conversation in order, and whether an earlier turn said the same."""
    said = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    keyed = rows.withColumn("said", F.unhex(said))
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    repeated = (
        keyed.filter("copies > 0").groupBy("conv_id", "said").agg(F.min(when).alias("first"), F.max(when).alias("last"))
        .filter(~F.col("first").eqNullSafe(F.col("last")))
        .select(F.col("conv_id").alias("of_conv"), F.col("said").alias("of_said"), "first")
    )
    found = keyed.join(repeated, F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("said") == F.col("of_said")), "left")
    earlier = F.coalesce(~F.col("first").eqNullSafe(when) & F.col("first").isNotNull(), F.lit(False))
    return (
        found.select("conv_id", "turn", "role", "text", "copies", earlier.alias("seen_before"))
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    )


REPAIRED = "conv_id long, place long, edit string, turn long, role string, text string"
AUDITS = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string,"
    " repaired_sha256 string"
)


def repaired(rows: DataFrame) -> DataFrame:
    """Every edit as a row of its conversation, by place: K and R rows and I rows make the repaired conversation."""
    schema = arrow_schema(REPAIRED)

    def run(batches):
        held, chars = [], 0
        for turns in _conversations(batches):
            for place, (edit, turn, role, text) in enumerate(turns.repaired()):
                held.append((turns.conv_id, place, edit, turn, role, text))
                chars += len(text)
                if len(held) == 4096 or chars > 4 << 20:
                    yield _batch(held, schema)
                    held, chars = [], 0
        if held:
            yield _batch(held, schema)

    return map_batches(ordered(rows), run, REPAIRED)


def audits(rows: DataFrame) -> DataFrame:
    """One row a conversation: gaps, faults, the cheapest edits and the hash of what they leave."""
    schema = arrow_schema(AUDITS)

    def run(batches):
        held = []
        for turns in _conversations(batches):
            digest, mark = hashlib.sha256(), ""
            for edit, _, role, text in turns.repaired():
                if edit != "D":
                    digest.update(f"{mark}{role}:{text}".encode())
                    mark = "\n"
            held.append((
                turns.conv_id, turns.gaps, turns.blank, turns.duplicate, turns.truncated, turns.illegal,
                turns.cost, turns.audit, digest.hexdigest(),
            ))
            if len(held) == 4096 or len(turns.audit) > 1 << 20:
                yield _batch(held, schema)
                held = []
        if held:
            yield _batch(held, schema)

    return map_batches(ordered(rows), run, AUDITS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits(damaged(table(spark, sf_dir, "conversations")))
