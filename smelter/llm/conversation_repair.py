"""Repair of conversation structure at least cost, by integer minima over a graph of edits.

A conversation's turns, damaged or not, are kept, given another role, deleted, or have empty turns inserted between them, so
that the first letters of the roles read ``(s?(ua)+)?``. Nodes of the graph are places between turns times the four states of
that pattern; an edge is one edit. A path's weight is one integer: high digits hold the cost, below them stand the letters
of its edits (Delete, Insert, Keep, Rerole in ASCII order) in digits of fixed width, the first edit highest, zeros after the
last. So the least integer is the cheapest path, and of equally cheap ones that with the least audit string. The walk goes
from the end to the start, where a path's later letters do not move when an edit is put before it but by one digit.
Beyond ``BLOCK`` turns the letters of the four paths in hand are replaced by their rank, which every later comparison leaves
as it is, so that numbers stay short and a conversation of any length takes linear time.

Spark damages and orders the rows, tells blank, repeated and cut turns apart, and deals conversations out by id; a task reads
one conversation after the other in order. The digest of a repaired conversation is one SHA-256 over its texts in order, so
one task must see them all; it holds one conversation's texts in memory up to 16 MB, beyond that in its own scratch file,
which goes with it, and four bytes a turn of choices.

Nulls: in conv_id (in the damage key), role and text one space; rows with a null conv_id are one conversation; null turns come
first. Equal turns are ordered by role, then text. Repeated rows: duplicates but for the first. Empty table: empty result.
Very long texts: hashed as they are. Other columns are not looked at. gaps beyond 2**63 - 1 are given as that.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLANK = " \t\n\x0b\x0c\r"
FINE, CUT, GONE = 0, 1, 2  # a turn's state for the edits: as it should be, truncated, to be deleted
FAULTS = ("fine", "blank", "duplicate", "truncated")
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
LETTERS = "?DIKR"
DIGIT = 3  # bits of a letter
COST = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
CUT_COST = 3
BLOCK = 512
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLE = {"u": "user", "a": "assistant"}
WANTED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}  # the letter that a rerole or an insertion puts down
SCHEMA = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


# ---- edits of one conversation -------------------------------------------------------------------------------------

def edits(letters: bytes, states: bytes) -> tuple[int, bytearray]:
    """The least cost, and the cheapest edits, of turns given by their role's first letter and FINE, CUT or GONE."""
    n = len(letters)
    choices = bytearray(4 * (n + 1))  # for each place and state: the turn's edit, and above it whether an insertion goes first
    width = DIGIT * (3 * min(n, BLOCK) + 8)
    high = 1 << width
    low = high - 1

    def put(cost: int, letter: int, tail: int) -> int:
        return (tail & ~low) + cost * high + (letter << (width - DIGIT)) + ((tail & low) >> DIGIT)

    never = None
    best: list[int | None] = [0, never, never, 0]  # empty, or ended after an assistant
    best = _with_insertions(best, choices, 4 * n, put)
    for i in range(n - 1, -1, -1):
        if (n - 1 - i) % BLOCK == BLOCK - 1:
            best = _ranked(best, low, width)
        extra, letter = CUT_COST * (states[i] == CUT), chr(letters[i])
        at: list[int | None] = [never] * 4
        for state in range(4):
            found, how = never, 0
            if best[state] is not None:
                found, how = put(COST[DELETE], DELETE, best[state]), DELETE
            if states[i] != GONE:
                to = NEXT.get((state, letter))
                for edit, there in ((KEEP, to), (REROLE, NEXT[state, WANTED[state]])):
                    if there is not None and best[there] is not None:
                        value = put(COST[edit] + extra, edit, best[there])
                        if found is None or value < found:
                            found, how = value, edit
            at[state] = found
            choices[4 * i + state] = how
        best = _with_insertions(at, choices, 4 * i, put)
    return best[START] >> width, _walk(letters, choices)


def _with_insertions(at: list[int | None], choices: bytearray, base: int, put) -> list[int | None]:
    """Values with up to two insertions before the turn; a third would come back to the same state at a cost."""
    for _ in range(2):
        before = list(at)
        for state in range(4):
            there = before[NEXT[state, WANTED[state]]]
            value = None if there is None else put(COST[INSERT], INSERT, there)
            if value is not None and (at[state] is None or value < at[state]):
                at[state] = value
                choices[base + state] = choices[base + state] & 7 | INSERT << 3
    return at


def _ranked(best: list[int | None], low: int, width: int) -> list[int | None]:
    """The same values with their letters replaced by a digit: their rank among the four, 0 for none."""
    order = sorted({v & low for v in best if v is not None} | {0})
    return [None if v is None else (v & ~low) | order.index(v & low) << (width - DIGIT) for v in best]


def _walk(letters: bytes, choices: bytearray) -> bytearray:
    """The edits along the best path, from the start."""
    out, state, n = bytearray(), START, len(letters)
    for i in range(n + 1):
        while choices[4 * i + state] >> 3:
            out.append(INSERT)
            state = NEXT[state, WANTED[state]]
        if i < n:
            how = choices[4 * i + state] & 7
            out.append(how)
            if how == KEEP:
                state = NEXT[state, chr(letters[i])]
            elif how == REROLE:
                state = NEXT[state, WANTED[state]]
    return out


class Conversation:
    """Turns of one conversation in order; what is counted, and the repaired texts once all are there."""

    def __init__(self) -> None:
        self.letters, self.states = bytearray(), bytearray()
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.first: int | None = None
        self.last: int | None = None
        self.before: str | None = None
        self.texts = tempfile.SpooledTemporaryFile(max_size=16 << 20)
        self.sizes = array("Q")

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        letter = role[:1]
        if self.before is not None and self.before + letter not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = letter
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        self.faults[fault] += 1
        self.letters += letter.encode() if letter in ("s", "u", "a") else b"-"
        self.states.append(GONE if fault in (1, 2) else CUT if fault == 3 else FINE)
        role_bytes, text_bytes = (b"", b"") if fault in (1, 2) else (role.encode(), text.encode())
        self.sizes.extend((len(role_bytes), len(text_bytes)))
        self.texts.write(role_bytes)
        self.texts.write(text_bytes)

    def repaired(self, path: bytes) -> Iterator[tuple[bytes, bytes]]:
        """Role and text of the repaired turns."""
        self.texts.seek(0)
        at, state = 0, START
        for edit in path:
            role = text = b""
            if edit != INSERT:
                role, text = self.texts.read(self.sizes[2 * at]), self.texts.read(self.sizes[2 * at + 1])
                at += 1
            if edit == KEEP:
                state = NEXT[state, chr(self.letters[at - 1])]
                yield role, text
            elif edit != DELETE:
                letter = WANTED[state]
                state = NEXT[state, letter]
                yield ROLE[letter].encode(), text

    def close(self, conv_id: int | None) -> list:
        cost, path = edits(bytes(self.letters), bytes(self.states))
        digest, between = hashlib.sha256(), b""
        for role, text in self.repaired(path):
            digest.update(between + role + b":")
            digest.update(text)
            between = b"\n"
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.turns, 2**63 - 1)
        self.texts.close()
        return [conv_id, gaps, *self.faults[1:], self.illegal, cost, path.decode("latin-1").translate({k: LETTERS[k] for k in range(1, 5)}), digest.hexdigest()]


# ---- Spark ---------------------------------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage by the crc32 of ``conv_id:turn`` modulo 20, as ``conv_id, turn, role, text, here``; a dropped row stays
    with here = false, so that a conversation without any turn left is still known."""
    def plain(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    key = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                plain("role").alias("role"), plain("text").alias("text"), key.alias("k"))
    text = F.when(F.col("k").isin(0, 1), "").when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("k") != 0).alias("here"),
                       F.explode(F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows.drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """fault: the first that holds of 1 blank, 2 duplicate (role and text seen earlier), 3 truncated; else 0. The rows are dealt
    out by conversation, which also serves the search for duplicates."""
    bare = F.rtrim(F.col("text"), F.lit(BLANK))
    same = Window.partitionBy("conv_id", "role", "th", "here").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.withColumn("th", F.unhex(F.sha2("text", 256))).repartition("conv_id").withColumn("seen", F.row_number().over(same))
    fault = F.when(bare == "", 1).when(F.col("seen") > 1, 2).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    return rows.withColumn("fault", fault)


def repair(rows: DataFrame) -> DataFrame:
    """A row for each conversation of ``conv_id, turn, role, text``, and ``here`` where rows are marked as dropped."""
    if "here" not in rows.columns:
        rows = rows.withColumn("here", F.lit(True))
    ordered = (with_faults(rows).select("conv_id", "turn", "role", "text", "here", "fault")
               .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text"))

    def work(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, talk, out = None, None, []
        for frame in frames:
            for conv_id, turn, role, text, here, fault in zip(*(c.to_pylist() for c in frame.columns), strict=True):
                if talk is None or conv_id != now:
                    if talk is not None:
                        out.append(talk.close(now))
                    now, talk = conv_id, Conversation()
                if here:
                    talk.add(turn, role, text, fault)
                if len(out) == 5000:
                    yield _batch(out)
                    out = []
        if talk is not None:
            out.append(talk.close(now))
            yield _batch(out)

    return ordered.mapInArrow(work, SCHEMA)


def _batch(rows: list[list]) -> pa.RecordBatch:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [pa.string() if x.endswith("string") else pa.int64() for x in SCHEMA.split(", ")]
    return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """The repair of conversations after damage; every conv_id of the input has its row."""
    return repair(damaged(conversations))
