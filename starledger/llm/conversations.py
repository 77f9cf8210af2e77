"""Conversation structure repair: the cheapest edits that make the roles alternate.

Conversations are partitioned by id and sorted by turn, and streamed through ``mapInPandas``.
A dynamic program over four states (nothing yet, after a system turn, after a user's, after
an assistant's) is carried from row to row and across Arrow batches. What it keeps does not grow
with a conversation: per state the cost, the rank of its edits among those of the other states,
and the running digest of the repaired text. How each state was reached, four bytes a turn,
is what the audit is read from at the end; past ``spill_turns`` turns it goes to a file of the
task, as Spark's own sorts spill, and is read backwards from there.

Which turns repeat an earlier one is found before, by a grouping on digests whose keys
are spread over all tasks, so that no task remembers a conversation's texts.
"""

from __future__ import annotations

import hashlib
import sys
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from starledger.llm.common import as_bytes, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Costs of the edits; keeping is free, and a truncated turn that stays costs one more.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SPILL_TURNS = 1 << 18

_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_ROLES = {_USER: b"user", _ASSISTANT: b"assistant"}
#: The only role that may follow each state, but for a system turn at the start.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
#: Turns to insert at the end of a conversation.
_TO_END = (0, 2, 1, 0)
_EDITS = "DIKR"
#: A state that costs so much more than another cannot be on the cheapest way any more: the
#: other one gets to where it would by a deletion and two insertions at most, which cost 7.
_HOPELESS = DELETE + 2 * INSERT

_RESULT = (
    "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
_COLUMNS = ["conv", "turn", "timed", "role", "text", "copies", "repeats"]


def damage(rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The four columns and ``copies``, how often the row stands: damage by id and turn.

    By the CRC-32 of ``id:turn`` modulo 20, 0 drops a row (no copies), 1 empties its text, 2
    removes the marks that end sentences, 3 doubles it, 4 makes the role user. A null counts as
    one space.
    """
    said = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said(id), F.lit(":"), said(turn))) % 20
    body = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said(text), "[.!?]", "")).otherwise(said(text))
    return rows.select(
        F.col(id),
        F.col(turn),
        F.when(kind == 4, "user").otherwise(said(role)).alias(role),
        body.alias(text),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def repair(
    turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    copies: str | None = None, spill_turns: int = SPILL_TURNS,
) -> DataFrame:
    """One row per id: its faults, the cheapest repair, and the digest of the repaired text.

    Turns go by ``turn``, nulls first, those with the same one by role and text. ``copies`` names
    a column with the number of times that a row stands; with 0 it only names its conversation.
    The first fault of a turn counts: ``blank`` text, ``duplicate`` of an earlier role and text,
    ``truncated`` (no mark that ends a sentence). ``gaps`` are numbers missing between the least
    and the greatest turn, ``illegal`` the neighbours whose roles must not follow one another.

    ``audit`` has an initial for each edit: Keep, Rerole, Delete (a must for blank and duplicate
    turns) or Insert. It is the cheapest that leaves no turns, or pairs of user and assistant
    after a system turn or none; of several the first in ASCII order. ``cost`` is its cost.
    Roles count by their first letter; an empty one may not be kept. A null role or text is
    one space, a null id a conversation of its own. An id without turns has zeros, no audit
    and the digest of nothing; other columns are not read; an empty table gives no rows.
    """
    key = F.col(id).cast("string")
    said = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    rows = turns.select(
        F.when(key.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), key)).alias("conv"),
        F.coalesce(F.col(turn).cast("long"), F.lit(0)).alias("turn"),
        F.col(turn).isNotNull().alias("timed"),
        said(role).alias("role"),
        said(text).alias("text"),
        (F.lit(1) if copies is None else F.col(copies).cast("int")).alias("copies"),
    )
    rows = rows.withColumn("said", _digest("conv", "role", "text"))
    at = F.struct("timed", "turn")
    first = rows.where("copies > 0").groupBy("said").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
    # Stored, so that its size is known: few turns repeat another, and then no text is shuffled here.
    first = stored(first.where("n > 1").select("said", "first"), "repeated-turns")
    marked = rows.join(first, "said", "left").withColumn("repeats", F.coalesce(at > F.col("first"), F.lit(False)))
    ordered = marked.repartition("conv").sortWithinPartitions("conv", "timed", "turn", "role", "text")
    ordered = ordered.withColumn("text", as_bytes("text")).select(_COLUMNS)
    found = ordered.mapInPandas(lambda frames: _stream(frames, spill_turns), _RESULT)
    original = F.when(F.col("conv") != "-", F.expr("substring(conv, 2)")).cast(turns.schema[id].dataType)
    return found.select(original.alias(id), *found.columns[1:])


def _digest(*names: str) -> Column:
    """Different values of the columns, different texts to take the digest of."""
    parts = [part for name in names for part in (F.length(name).cast("string"), F.lit(":"), F.col(name))]
    return F.unhex(F.md5(F.concat(*parts)))


def _stream(frames: Iterator[pd.DataFrame], spill_turns: int) -> Iterator[pd.DataFrame]:
    names = [column.split()[0] for column in _RESULT.split(", ")]
    current = None
    for frame in frames:
        done = []
        for conv, turn, timed, role, text, copies, repeats in zip(*(frame[name].tolist() for name in _COLUMNS)):
            if current is None or current.conv != conv:
                if current is not None:
                    done.append(current.result())
                current = _Conversation(conv, spill_turns)
            for _ in range(copies):
                current.add(turn, timed, role, bytes(text), repeats)
        if done:
            yield pd.DataFrame(done, columns=names)
    if current is not None:
        yield pd.DataFrame([current.result()], columns=names)


def _ways(more: int) -> list[list[list[tuple]]]:
    """By kind of turn and state: the cheapest way to each next state, in the order of edits.

    A turn that stays costs ``more``. A way is the next state, its cost, the number of turns
    inserted before the turn, its edit, and the role it has afterwards if it is another one. Kinds
    are 0 to 2 for turns that may be kept as system, user or assistant, 3 for other roles, 4 for
    those that must be deleted.
    """
    kept = ({_START: _SYSTEM}, {_START: _USER, _SYSTEM: _USER, _ASSISTANT: _USER}, {_USER: _ASSISTANT}, {}, {})
    table = []
    for kind in range(5):
        table.append([])
        for state in range(4):
            best: dict = {}
            before, inserted = state, 0
            while inserted <= 2:  # a third one could be left out with the second
                ways = [("D", before, DELETE, None)]
                if kind < 4:
                    to = _NEXT[before]
                    ways.append(("R", to, REROLE + more, _ROLES[to]))
                    if before in kept[kind]:
                        ways.append(("K", kept[kind][before], more, None))
                for edit, to, cost, role in ways:
                    way = (cost + INSERT * inserted, "I" * inserted + edit, to, inserted, _EDITS.index(edit), role)
                    if to not in best or way[:2] < best[to][:2]:
                        best[to] = way
                before, inserted = _NEXT[before], inserted + 1
            ordered = sorted(best.values(), key=lambda way: way[1])
            table[-1].append([(to, cost, n, edit, role) for cost, _, to, n, edit, role in ordered])
    return table


_WAYS = (_ways(0), _ways(TRUNCATED))
_KINDS = {"s": 0, "u": 1, "a": 2}
_LEGAL = {"su", "ua", "au"}


class _Conversation:
    """What is kept of a conversation while its turns go by."""

    def __init__(self, conv: str, spill_turns: int):
        self.conv, self.spill_turns = conv, spill_turns
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.least = self.greatest = self.numbers = 0
        self.before = None
        #: States that may be on the best way, by the ASCII order of their edits so far:
        #: state, cost, digest, whether anything is in the digest.
        self.live = [(_START, 0, hashlib.sha256(), False)]
        self.back, self.file = bytearray(), None

    def add(self, turn: int, timed: bool, role: str, text: bytes, repeats: bool) -> None:
        told = text.rstrip()  # bytes: the six ASCII white-space characters
        this = (timed, turn, role, text)
        kind, cut = _KINDS.get(role[:1], 3), False
        if not told:
            self.blank, kind = self.blank + 1, 4
        elif repeats or this == self.before:
            self.duplicate, kind = self.duplicate + 1, 4
        elif told[-1] not in b".!?":
            self.truncated, cut = self.truncated + 1, True
        if self.before is not None and self.before[2][:1] + role[:1] not in _LEGAL:
            self.illegal += 1
        if timed:
            if not self.numbers:
                self.least = turn
            if not self.numbers or turn != self.greatest:
                self.numbers, self.greatest = self.numbers + 1, turn
        self.before = this
        self._step(_WAYS[cut][kind], role.encode(), text)

    def _step(self, ways: list, role: bytes, text: bytes) -> None:
        best: dict = {}
        place = 0
        for state, cost, digest, told in self.live:
            for to, added, inserted, edit, other in ways[state]:
                total = cost + added
                # Edits come in their order, so of equal costs the first stays.
                if to not in best or total < best[to][0]:
                    best[to] = (total, place, state, inserted, edit, other, digest, told)
                place += 1
        limit = min(way[0] for way in best.values()) + _HOPELESS
        back, live = bytearray(4), []
        for to, way in sorted(best.items(), key=lambda item: item[1][1]):
            total, _, state, inserted, edit, other, digest, told = way
            if total <= limit:
                back[to] = state | inserted << 2 | edit << 4
                if inserted or edit:
                    digest, told = _insert(digest.copy(), told, state, inserted)
                if edit:
                    digest.update(b"".join((b"\n" if told else b"", other or role, b":", text)))
                    told = True
                live.append((to, total, digest, told))
        self.live = live
        self.back += back
        if len(self.back) >= 4 * self.spill_turns:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.write(self.back)
            self.back = bytearray()

    def result(self) -> tuple:
        _, cost, state, digest, told = min(
            ((cost + INSERT * _TO_END[state], place), cost + INSERT * _TO_END[state], state, digest, told)
            for place, (state, cost, digest, told) in enumerate(self.live)
        )
        digest, _ = _insert(digest, told, state, _TO_END[state])
        audit = self._audit(state)
        gaps = self.greatest - self.least + 1 - self.numbers if self.numbers else 0
        return (
            self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest.hexdigest(),
        )

    def _audit(self, state: int) -> str:
        parts = [bytearray(b"I" * _TO_END[state])]  # pieces from the last one, each reversed
        for back in self._backwards():
            piece = bytearray()
            for at in range(len(back) - 4, -1, -4):
                way = back[at + state]
                state = way & 3
                piece += b"DIKR"[way >> 4 : (way >> 4) + 1] + b"I" * (way >> 2 & 3)
            parts.append(piece)
        return b"".join(parts)[::-1].decode()

    def _backwards(self) -> Iterator[bytearray]:
        """How states were reached, the last turns first; frees the file."""
        yield self.back
        if self.file is not None:
            with self.file:
                step = 4 * self.spill_turns
                for at in range(self.file.seek(0, 2) - step, -1, -step):
                    self.file.seek(at)
                    yield bytearray(self.file.read(step))


def _insert(digest, told: bool, state: int, n: int):
    for _ in range(n):
        state = _NEXT[state]
        digest.update((b"\n" if told else b"") + _ROLES[state] + b":")
        told = True
    return digest, told
