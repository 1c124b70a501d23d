"""Repair of conversation structure at the least cost, reconstructed by divide and conquer.

Rows of a conversation are kept (0), given another role (3), deleted (4) or preceded by inserted
empty turns (3), so that the role initials read `(s?(ua)+)?`. Blank rows and repeats must go;
rows cut off before a sentence end cost 3 more where they stay. The initials read so far leave one
of four states: nothing yet, after s, after u, after a.

* Hirschberg. A forward pass over the first half of a conversation gives the cost of reaching each
  state, a backward pass over the second half the cost that remains from it; the halves meet in the
  state with the least sum, and each is solved alone. Only vectors of four are held, beside one byte
  a row.
* Ties. The forward vectors also rank the states by the least audit that reaches them. A state's
  audit ends with the letter of the row before the meeting point, so none of the four is a prefix of
  another and the least left audit decides, whatever follows. Given an audit, the roles are settled.
* Steps of vectors (relative costs, ranks) are few and remembered.

One pass over narrow rows (an initial and a fault each) finds the audits, another carries the texts
past them, so a task holds one byte a row of a conversation and never its texts. A conversation is
read by one task all the same: its digest runs over its turns in order and its audit is one value.

Null roles and texts stand as one space; null turns come first; rows with equal turns are ordered by
role and a hash of the text; rows without an id are one conversation. Repeated rows are duplicates of
the first. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signals.llm.common import staged

SPACE = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}
ROLES = {"u": "user", "a": "assistant"}
NEVER = 1 << 40
#: One letter a row: its initial (o: none of s, u, a), a capital if cut off; d: must be deleted.
LETTERS = "suaoSUAOd"
#: Inserted turns that are missing at the end of a conversation, by state.
TAIL = (0, 2, 1, 0)

STATS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
AUDITS = f"conv_id long, {', '.join(s + ' long' for s in STATS)}, audit string"
REPAIRED = f"{AUDITS}, place long, role string, text string"


def due(state: int) -> str:
    """Initial of the role that must come next."""
    return "a" if state == AFTER_U else "u"


@functools.cache
def steps(letter: str, state: int) -> tuple[tuple[int, int, str], ...]:
    """(next state, cost, edits) of a row read in a state, inserts before it included."""
    found = [(state, DELETE, "D")]
    if letter != "d":
        extra = TRUNCATED if letter.isupper() else 0
        initial = letter.lower()
        if initial == "s" and state == START:
            found.append((AFTER_S, KEEP + extra, "K"))
        for role in "ua":
            inserts = 0 if role == due(state) else 1
            edit, cost = ("K", KEEP) if role == initial else ("R", REROLE)
            found.append((NEXT[role], INSERT * inserts + cost + extra, "I" * inserts + edit))
    return tuple(found)


@functools.lru_cache(maxsize=1 << 16)
def _forward(letter: str, costs: tuple, ranks: tuple) -> tuple[int, tuple, tuple]:
    """Costs (less their minimum, given first) and ranks of the four states after one more row."""
    best: dict[int, tuple] = {}
    for state in range(4):
        if costs[state] < NEVER:
            for to, cost, edits in steps(letter, state):
                offer = (costs[state] + cost, ranks[state], edits)
                if to not in best or offer < best[to]:
                    best[to] = offer
    order = sorted(best, key=lambda s: best[s][1:])
    least = min(offer[0] for offer in best.values())
    return (
        least,
        tuple(best[s][0] - least if s in best else NEVER for s in range(4)),
        tuple(order.index(s) if s in best else 4 for s in range(4)),
    )


@functools.lru_cache(maxsize=1 << 16)
def _backward(letter: str, costs: tuple) -> tuple[int, tuple]:
    new = [min(cost + costs[to] for to, cost, _ in steps(letter, state)) for state in range(4)]
    least = min(new)
    return least, tuple(min(c - least, NEVER) for c in new)


def forward(letters: str, start: int) -> tuple[tuple, tuple]:
    """Relative costs and ranks of the states that `letters` lead to from `start`."""
    costs, ranks = tuple(0 if s == start else NEVER for s in range(4)), (0, 0, 0, 0)
    for letter in letters:
        _, costs, ranks = _forward(letter, costs, ranks)
    return costs, ranks


def backward(letters: str, end: tuple) -> tuple[int, tuple]:
    """Least cost from each state through `letters`, given the cost of ending in each state."""
    total = 0
    for letter in reversed(letters):
        least, end = _backward(letter, end)
        total += least
    return total, end


def crossing(left: tuple[tuple, tuple], right: tuple) -> int:
    """The state in which two halves meet: least in cost, then least in audit."""
    costs, ranks = left
    return min(
        (s for s in range(4) if costs[s] < NEVER), key=lambda s: (costs[s] + right[s], ranks[s])
    )


END = tuple(INSERT * t for t in TAIL)


def least_audit(letters: str) -> tuple[int, str]:
    """Cost and ASCII-least audit of the cheapest edits."""
    if len(letters) <= 64:
        return _short_audit(letters)
    return _audit(letters)


@functools.lru_cache(maxsize=1 << 16)
def _short_audit(letters: str) -> tuple[int, str]:
    return _audit(letters)


def _audit(letters: str) -> tuple[int, str]:
    base, rest = backward(letters, END)
    out: list[str] = []
    state = START
    todo = [(0, len(letters), END)] if letters else []
    while todo:
        low, high, end = todo.pop()
        if high - low == 1:
            state, _, edits = min(
                steps(letters[low], state), key=lambda s: (s[1] + end[s[0]], s[2])
            )
            out.append(edits)
            continue
        middle = (low + high) // 2
        meet = crossing(
            forward(letters[low:middle], state), backward(letters[middle:high], end)[1]
        )
        todo.append((middle, high, end))
        todo.append((low, middle, tuple(0 if s == meet else NEVER for s in range(4))))
    return base + rest[START], "".join(out) + "I" * TAIL[state]


def order() -> list[Column]:
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text_key")]


def prepared(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, text_key: nulls of role and text as one space."""
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumn("text_key", F.xxhash64("text"))


def row_letters(rows: DataFrame) -> DataFrame:
    """Per row, narrow: its order, initial, letter and first fault (b, d, t or none)."""
    body = F.rtrim("text", F.lit(SPACE))
    again = F.row_number().over(
        Window.partitionBy("conv_id", "role", "text_key", "check").orderBy(F.asc_nulls_first("turn"))
    )
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return (
        rows.select(
            "conv_id", "turn", "role", "text_key", known.alias("initial"),
            F.xxhash64(F.lit(1), "text").alias("check"),
            F.when(body == "", "b").when(~F.substring(body, -1, 1).isin(".", "!", "?"), "t").alias("fault"),
        )
        .repartition("conv_id")
        .withColumn("again", again > 1)
        .select(
            "conv_id", "turn", "role", "text_key", "initial",
            F.when(F.col("fault") == "b", "b").when(F.col("again"), "d")
            .otherwise(F.coalesce("fault", F.lit(""))).alias("fault"),
        )
    )


LEGAL = {"su", "ua", "au"}


class _Reading:
    """One conversation while its rows pass."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.letters = bytearray()
        self.counts = {"b": 0, "d": 0, "t": 0}
        self.illegal = self.turns = 0
        self.first = self.last = self.before = None

    def row(self, turn, initial, fault):
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        if fault:
            self.counts[fault] += 1
        letter = "d" if fault in ("b", "d") else initial.upper() if fault else initial
        self.letters += letter.encode()

    def result(self) -> tuple:
        gaps = 0 if self.last is None else self.last - self.first + 1 - self.turns
        cost, audit = least_audit(self.letters.decode())
        return (self.conv_id, gaps, *self.counts.values(), self.illegal, cost, audit)


def _audit_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in AUDITS.split(", ")]
    kinds = [pa.int64()] * (len(names) - 1) + [pa.string()]

    def batch_of(rows):
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
        )

    now, done = None, []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault"))
        for conv_id, turn, initial, fault in zip(*columns, strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    done.append(now.result())
                now = _Reading(conv_id)
            if initial is not None:  # the row that only announces the conversation has none
                now.row(turn, initial, fault)
        if len(done) > 2000:
            yield batch_of(done)
            done = []
    if now is not None:
        done.append(now.result())
    yield batch_of(done)


def audits(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Per id of `ids` (with its rows, if any, in `rows`): counts of faults, cost and audit."""
    letters = row_letters(rows).withColumn("kind", F.lit(1))
    named = ids.select(F.col("conv_id").cast("long").alias("conv_id"), F.lit(0).alias("kind"))
    return (
        letters.unionByName(named.distinct(), allowMissingColumns=True)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "kind", *order())
        .select("conv_id", "turn", "initial", "fault")
        .mapInArrow(_audit_part, AUDITS)
    )


def _repair_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit rows pass through (place -1), each followed by the repaired rows of its conversation."""
    names = [c.split()[0] for c in REPAIRED.split(", ")]
    kinds = [pa.int64()] * (len(STATS) + 1) + [pa.string(), pa.int64(), pa.string(), pa.string()]
    out: list[tuple] = []
    nothing = (None,) * (len(STATS) + 1)
    conv_id, edits, at, state, place = None, "", 0, START, 0

    def add(role, text):
        nonlocal place
        out.append((conv_id, *nothing, place, role, text))
        place += 1

    def inserts():
        nonlocal at, state
        while at < len(edits) and edits[at] == "I":
            add(ROLES[due(state)], "")
            state = NEXT[due(state)]
            at += 1

    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in (*names, "kind")), strict=True):
            if row[-1] == 0:
                inserts()
                conv_id, edits, at, state, place = row[0], row[len(STATS) + 1], 0, START, 0
                out.append((*row[: len(STATS) + 2], -1, None, None))
                continue
            inserts()
            role, text = row[-3], row[-2]
            if edits[at] != "D":
                role = role if edits[at] == "K" else ROLES[due(state)]
                state = NEXT[role[0]]
                add(role, text)
            at += 1
        columns = list(zip(*out, strict=True)) if out else [()] * len(names)
        out = []
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
        )
    inserts()
    if out:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names
        )


def repaired(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """In the partition and order of conversations: a row with each one's counts, cost and audit
    (place -1), then its repaired rows (place from 0, role, text)."""
    prep = prepared(rows)
    found = staged(audits(prep, ids), "audits")
    known = found.withColumn("kind", F.lit(0))
    texts = prep.withColumn("kind", F.lit(1))
    return (
        known.unionByName(texts, allowMissingColumns=True)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "kind", *order())
        .withColumn("place", F.lit(None).cast("long"))
        .select(*[c.split()[0] for c in REPAIRED.split(", ")], "kind")
        .mapInArrow(_repair_part, REPAIRED)
    )


def repaired_turns(rows: DataFrame) -> DataFrame:
    """Repaired conversations: conv_id, place, role, text."""
    return repaired(rows, rows.select("conv_id")).where("place >= 0").select(
        "conv_id", "place", "role", "text"
    )


def _digest_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    head = [c.split()[0] for c in AUDITS.split(", ")]
    kinds = [pa.int64()] * (len(head) - 1) + [pa.string()] * 2
    now, hasher = None, hashlib.sha256()

    def batch_of(rows):
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=[*head, "repaired_sha256"],
        )

    for batch in batches:
        done = []
        columns = (batch.column(c).to_pylist() for c in (*head, "place", "role", "text"))
        for *stats, place, role, text in zip(*columns, strict=True):
            if place < 0:
                if now is not None:
                    done.append((*now, hasher.hexdigest()))
                now, hasher = stats, hashlib.sha256()
                continue
            line = f"{role}:{text}".encode("utf-8", "surrogatepass")
            hasher.update(b"\n" + line if place else line)
        yield batch_of(done)
    yield batch_of([(*now, hasher.hexdigest())] if now is not None else [])


def digests(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Per id: counts of faults, cost, audit and a digest of the repaired conversation."""
    return repaired(rows, ids).mapInArrow(_digest_part, f"{AUDITS}, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults planted by a checksum of id and turn; nulls as one space."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    return (
        rows.select(
            "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
            F.coalesce("text", F.lit(" ")).alias("text"), fate.alias("fate"),
        )
        .where("fate != 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("fate") == 1, "")
            .when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
        )
        .drop("col")
    )


def op12(rows: DataFrame) -> DataFrame:
    return digests(damaged(rows), rows.select("conv_id"))
