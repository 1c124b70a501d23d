"""Conversation repair against a table of all costs and, on short ones, all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from signals.llm import dialogue
from signals.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def all_edits(letters):
    """Least (cost, audit) over every sequence of edits, with up to two inserts at each place."""
    best = None
    choices = [
        [("D", 4, "")]
        + ([] if c == "d" else [
            ("K", 3 * c.isupper(), c.lower()), ("R", 3 + 3 * c.isupper(), "u"), ("R", 3 + 3 * c.isupper(), "a"),
        ])
        for c in letters
    ]
    inserts = [x for n in range(3) for x in itertools.product("ua", repeat=n)]
    for picked in itertools.product(*choices):
        for added in itertools.product(inserts, repeat=len(letters) + 1):
            roles = "".join("".join(i) + p[2] for i, p in zip(added, picked)) + "".join(added[-1])
            if GRAMMAR.fullmatch(roles):
                cost = sum(p[1] for p in picked) + 3 * sum(map(len, added))
                audit = "".join("I" * len(i) + p[0] for i, p in zip(added, picked)) + "I" * len(added[-1])
                best = min(best, (cost, audit)) if best else (cost, audit)
    return best


@pytest.mark.parametrize("n", [0, 1, 2])
def test_every_edit_of_short_conversations(n):
    for letters in map("".join, itertools.product(dialogue.LETTERS, repeat=n)):
        assert dialogue.least_audit(letters) == all_edits(letters), letters


def whole_table(letters):
    """The same by a table of least (cost, audit) strings for each row and state."""
    best = {dialogue.START: (0, "")}
    for letter in letters:
        new = {}
        for state, (cost, audit) in best.items():
            for to, c, edits in dialogue.steps(letter, state):
                offer = (cost + c, audit + edits)
                if to not in new or offer < new[to]:
                    new[to] = offer
        best = new
    return min((c + 3 * dialogue.TAIL[s], a + "I" * dialogue.TAIL[s]) for s, (c, a) in best.items())


def test_long_conversations_against_the_whole_table():
    rng = random.Random(1)
    for n in [3, 4, 7, 50, 63, 64, 65, 130, 400]:
        for weights in ([1] * 9, [1, 8, 8, 1, 1, 3, 3, 1, 2], [1, 9, 1, 1, 1, 1, 1, 1, 1]):
            for _ in range(20):
                letters = "".join(rng.choices(dialogue.LETTERS, weights, k=n))
                assert dialogue.least_audit(letters) == whole_table(letters), letters


def brute(rows):
    """The whole contract over plain rows."""
    after = {}
    for conv_id, turn, role, text in rows:
        after.setdefault(conv_id, [])
        role, text = " " if role is None else role, " " if text is None else text
        part = lambda x: " " if x is None else str(x)
        fate = zlib.crc32(f"{part(conv_id)}:{part(turn)}".encode()) % 20
        if fate == 0:
            continue
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        after[conv_id] += [(turn, role, text)] * (2 if fate == 3 else 1)
    out = []
    for conv_id, held in after.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        letters, count, seen = "", {"b": 0, "d": 0, "t": 0}, set()
        for _, role, text in held:
            body = text.rstrip(" \t\n\x0b\f\r")
            fault = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if fault:
                count[fault] += 1
            letters += "d" if fault in ("b", "d") else initial.upper() if fault == "t" else initial
        turns = {t for t, _, _ in held if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(held, held[1:])]
        cost, audit = whole_table(letters)
        lines, state, at = [], 0, 0
        for edit in audit:
            due = "assistant" if state == 2 else "user"
            if edit == "I":
                lines.append(f"{due}:")
                state = {"u": 2, "a": 3}[due[0]]
                continue
            _, role, text = held[at]
            at += 1
            if edit != "D":
                role = due if edit == "R" else role
                lines.append(f"{role}:{text}")
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
        out.append((
            conv_id, gaps, *count.values(), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def found(spark, rows):
    made = dialogue.op12(spark.createDataFrame(rows, SCHEMA))
    assert made.columns == ["conv_id", *dialogue.STATS, "audit", "repaired_sha256"]
    return sorted(map(tuple, made.collect()), key=repr)


def test_random_conversations(spark):
    rng = random.Random(2)
    rows = []
    for conv_id in range(120):
        for turn in range(rng.choice([0, 1, 2, 5, 9, 30])):
            if rng.random() < 0.9:
                role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
                text = rng.choice(["Yes.", "Yes.", "no", "  ", "What?\n", "cut off,", "", None, f"t {turn}!"])
                rows.append((conv_id, turn, role, text))
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (1, None, "user", "a."), (1, 7, "assistant", "b."),
        (2, None, None, None), (3, 5, "user", "x." * 100_000), (3, 6, "assistant", "y"), (3, 6, "assistant", "y"),
        (4, -3, "system", "s."), (4, 9, "system", "é! "),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    clashing = spark.createDataFrame(rows, SCHEMA)
    for name in ("kind", "place", "audit", "fate", "letters", "text_key", "col"):
        clashing = clashing.withColumn(name, F.lit("x"))
    assert sorted(map(tuple, dialogue.op12(clashing).collect()), key=repr) == brute(rows)


def test_all_rows_dropped(spark):
    conv_id = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert found(spark, [(conv_id, 0, "user", "Hi.")]) == [(conv_id, 0, 0, 0, 0, 0, 0, "", empty)]


def test_one_conversation_of_a_third_of_all_rows(spark):
    rng = random.Random(4)
    rows = [(7, i, rng.choice(["user", "assistant"]), f"{i % 900}.") for i in range(4000)]
    rows += [(i, i % 3, "user", f"{i}.") for i in range(100, 8000)]
    assert found(spark, rows) == brute(rows)


def test_repaired_turns_are_legal_and_stay_as_they_are(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "a."), (1, 2, "user", "b."), (2, 0, "system", "S.")]
    made = dialogue.repaired_turns(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "place").collect()
    for conv_id in {r.conv_id for r in made}:
        assert GRAMMAR.fullmatch("".join(r.role[0] for r in made if r.conv_id == conv_id))
    again = spark.createDataFrame([(r.conv_id, r.place, r.role, r.text or ".") for r in made], SCHEMA)
    audits = dialogue.digests(again, again.select("conv_id")).collect()
    assert all(r.illegal == 0 for r in audits)


def test_query_over_the_whole_table(spark):
    base = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, base, "conversations").select("conv_id", "turn", "role", "text").collect()]
    made = dialogue.op12(table(spark, base, "conversations"))
    assert sorted(map(tuple, made.collect()), key=repr) == brute(rows)
