"""Repair of a conversation's structure: the cheapest edits that make its roles a system turn at most, then user and assistant in turn.

The rows of a conversation come to one task sorted by turn and are read as a stream. A forward Viterbi pass goes over four states of
the grammar ``(s?(ua)+)?`` (nothing yet, after system, after user, after assistant) and carries for each state the path of least
(cost, audit string); after each row's layer, inserted turns may lead on to the next state or two. Of two audits of one cost the one that sorts
first in ASCII wins. A path holds its audit as chunks, a rank among the four and a short tail, and the running digest of what it
repairs to, so a conversation of any length takes constant time a row, and no row is held.

Edits: Keep costs 0, Rerole (to user or assistant) 3, Delete 4, Insert (an empty user or assistant turn) 3; a truncated row that is not
deleted adds 3, and blank and duplicate rows must go.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The ASCII white space that no word holds.
SPACES = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: A kept row leads from a state on by its role's initial; a rerole or an insert by the only role that can follow.
KEEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
FOLLOWS = ((USER, "user"), (USER, "user"), (ASSISTANT, "assistant"), (USER, "user"))
#: Rows after which audits' tails go into chunks.
CHUNK = 64
SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of conversations with null roles and texts as one space, damaged by crc32 of ``conv_id:turn`` (null: one space) mod 20.

    0 drops a row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 makes it the user's. A dropped row stays as one that is not
    ``present``, so that its conversation is still known.
    """
    id_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(id_text("conv_id"), F.lit(":"), id_text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), F.when(F.col("kind") > 0, text).otherwise("").alias("text"), (F.col("kind") > 0).alias("present"), times.alias("time")).drop("time")


class Path(NamedTuple):
    cost: int
    rank: int  # of what stands before the tail, among the paths of one layer
    tail: str
    head: tuple | None  # earlier chunks, last first
    digest: object  # of the repaired turns so far
    turns: bool  # are there any

    def followed(self, cost: int, letter: str, role: str | None = None, text: str = "") -> Path:
        """By an edit, which leaves a turn if it has a role."""
        digest = self.digest
        if role is not None:
            digest = digest.copy()
            digest.update(f"\n{role}:{text}".encode()[0 if self.turns else 1 :])
        return Path(self.cost + cost, self.rank, self.tail + letter, self.head, digest, self.turns or role is not None)

    def audit(self) -> str:
        chunks, head = [self.tail], self.head
        while head:
            chunks.append(head[1])
            head = head[0]
        return "".join(reversed(chunks))


def closed(layer: list[Path | None]) -> list[Path | None]:
    """With inserted turns: a user's after any state but its own, then an assistant's after that. More are never cheaper."""
    for state in (START, SYSTEM, ASSISTANT, USER):
        if p := layer[state]:
            to, role = FOLLOWS[state]
            if not layer[to] or (p.cost + INSERT, p.rank, p.tail + "I") < layer[to][:3]:
                layer[to] = p.followed(INSERT, "I", role)
    return layer


class Repair:
    """The fold over one conversation's rows."""

    def __init__(self):
        self.paths = closed([Path(0, 0, "", None, hashlib.sha256(), False), None, None, None])
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.initial = self.least = self.most = self.place = None

    def add(self, turn, role: str, text: str, last: str, earlier: bool, place: tuple) -> None:
        """last: the text's last character that is no white space; earlier: role and text were seen in an earlier turn; place: equal for equal
        rows of a turn, which follow one another."""
        fault = "blank" if not last else "duplicate" if earlier or place == self.place else "truncated" if last not in ".!?" else ""
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        initial, self.place = role[:1], place
        self.illegal += self.rows > 0 and self.initial + initial not in ("su", "ua", "au")
        if turn is not None:
            self.distinct += turn != self.most
            self.least, self.most = turn if self.least is None else self.least, turn
        self.initial, self.rows = initial, self.rows + 1
        best: list[tuple | None] = [None] * 4

        def offer(to: int, cost: int, p: Path, letter: str, new_role: str | None) -> None:
            if not best[to] or (p.cost + cost, p.rank, p.tail + letter) < best[to][0]:
                best[to] = (p.cost + cost, p.rank, p.tail + letter), p, cost, letter, new_role

        more = TRUNCATED if fault == "truncated" else 0
        for state, p in enumerate(self.paths):
            if p:
                offer(state, DELETE, p, "D", None)
                if fault in ("", "truncated"):
                    to, follower = FOLLOWS[state]
                    offer(to, REROLE + more, p, "R", follower)
                    if (to := KEEPS.get((state, initial))) is not None:
                        offer(to, more, p, "K", role)
        layer = [b and b[1].followed(b[2], b[3], b[4], text) for b in best]
        if self.rows % CHUNK == 0:  # no audit begins another here: each ends with a row's edit, as many of them in each
            order = sorted((s for s in range(4) if layer[s]), key=lambda s: layer[s][1:3])
            for rank, s in enumerate(order):
                layer[s] = layer[s]._replace(rank=rank, tail="", head=(layer[s].head, layer[s].tail))
        self.paths = closed(layer)

    def summary(self) -> tuple:
        best = min((self.paths[s] for s in (START, ASSISTANT) if self.paths[s]), key=lambda p: p[:3])
        gaps = self.most - self.least + 1 - self.distinct if self.most is not None else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, best.cost, best.audit(), best.digest.hexdigest()


def _content(role: str | Column, text: str | Column) -> Column:
    """16 bytes that tell rows by role and text."""
    c = F.concat(F.octet_length(role).cast("string"), F.lit(":"), F.col(role), F.col(text))
    return F.unhex(F.substring(F.sha2(c, 256), 1, 32))


def _ordered(rows: DataFrame, notes: DataFrame) -> DataFrame:
    """Rows and notes about them, a conversation's together, in order: by turn (null first), role, then digest of role and text; notes first."""
    both = rows.unionByName(notes, allowMissingColumns=True).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("content"), "note")


def _prepared(rows: DataFrame) -> DataFrame:
    present = F.coalesce("present", F.lit(True)) if "present" in rows.columns else F.lit(True)
    plain = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = rows.select("conv_id", "turn", plain("role"), plain("text"), present.alias("present"))
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    return rows.withColumns({"content": _content("role", "text"), "last": last, "note": F.lit(1).cast("tinyint")})


def audits(conversations: DataFrame) -> DataFrame:
    """One row a conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Takes conv_id, turn, role, text and, if there, present (false: the row counts for nothing but its conversation's name); other
    columns are not read. Null roles and texts are one space, a null conv_id is a conversation, null turns come first, rows of one turn are
    ordered by role, then by a digest of role and text. gaps: last turn - first turn + 1 - different turns, without null ones. No rows in, no
    rows out; a conversation without present rows has zeros, an empty audit and the empty text's hash.

    Two shuffles: 16-byte digests, to find what an earlier turn holds, and the rows by conversation with notes on those that do. The
    notes come right before their rows, so a task holds no set of what it has seen.
    """
    rows = _prepared(conversations)
    seen = Window.partitionBy("conv_id", "content").orderBy(F.asc_nulls_first("turn"))
    again = rows.where("present").select("conv_id", "turn", "role", "content", F.rank().over(seen).alias("rank")).where("rank > 1")
    notes = again.select("conv_id", "turn", "role", "content", F.lit(0).cast("tinyint").alias("note"))
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        now, fold, noted, out, none = None, None, None, [], True
        for batch in batches:
            columns = [batch.column(c) for c in ("conv_id", "turn", "role", "text", "content", "last", "note", "present")]
            for conv, turn, role, text, content, last, note, present in zip(*(c.to_pylist() for c in columns), strict=True):
                if none or conv != now:
                    if not none:
                        out.append((now, *fold.summary()))
                    now, fold, noted, none = conv, Repair(), None, False
                if note == 0:
                    noted = turn, content
                elif present:
                    fold.add(turn, role, text, last, noted == (turn, content), (turn, content))
            if len(out) >= 4096:
                yield _batch(out, batch.schema.field("conv_id").type)
                out = []
        if not none:
            yield _batch([*out, (now, *fold.summary())], batch.schema.field("conv_id").type)

    ordered = _ordered(rows, notes).select("conv_id", "turn", "role", "text", "content", "last", "note", "present")
    return ordered.mapInArrow(run, f"conv_id {kind}, {SUMMARY}")


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    names = ["conv_id", *(c.split()[0] for c in SUMMARY.split(", "))]
    types = [kind, *(pa.int64() if c.endswith(" long") else pa.string() for c in SUMMARY.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array(column, t) for column, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def repaired(conversations: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The edited turns: conv_id, place (0 and on), edit (K, R, D or I), turn (null if inserted), role (the new one) and text.

    found: what audits() gave for the same rows, else it is worked out. Deleted rows are listed with edit D; without them the turns are
    the repaired conversation. The audit comes before its conversation's rows, which are then read as a stream.
    """
    rows = _prepared(conversations)
    found = audits(conversations) if found is None else found
    first = rows.where("present")
    plan = found.select("conv_id", F.col("audit").alias("text"), F.lit(0).cast("tinyint").alias("note"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    turn_kind = rows.schema["turn"].dataType.simpleString()

    def run(batches):
        audit, at, state, conv, kinds = "", 0, START, None, None
        out: list[tuple] = []

        def inserts():
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                state, role = FOLLOWS[state]
                out.append((conv, at, "I", None, role, ""))
                at += 1

        def flushed():
            done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["conv_id", "place", "edit", "turn", "role", "text"])
            out.clear()
            return done

        for batch in batches:
            kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), batch.schema.field("turn").type, pa.string(), pa.string()]
            columns = [batch.column(c) for c in ("conv_id", "turn", "role", "text", "note")]
            for own, turn, role, text, note in zip(*(c.to_pylist() for c in columns), strict=True):
                if note == 0:
                    inserts()
                    conv, audit, at, state = own, text, 0, START
                    continue
                inserts()
                edit = audit[at]
                if edit == "R":
                    state, role = FOLLOWS[state]
                elif edit == "K":
                    state = KEEPS[state, role[:1]]
                out.append((conv, at, edit, turn, role, text))
                at += 1
            if out:
                yield flushed()
        inserts()
        if out:
            yield flushed()

    # An audit sorts before all rows of its conversation: null turn, role and content.
    ordered = _ordered(first, plan).select("conv_id", "turn", "role", "text", "note")
    return ordered.mapInArrow(run, f"conv_id {kind}, place long, edit string, turn {turn_kind}, role string, text string")
