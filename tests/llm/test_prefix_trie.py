"""The trie against one built in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from signals.llm import prefix_trie
from signals.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, rebuild=True):
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(t)] for c, t in own.items()}
    made = own
    if rebuild:
        made = {}
        for c, turns in own.items():
            h = zlib.crc32(str(c).encode()) % 9
            made[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), set()).add(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)

    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        under = children.get(path, [])
        leaves[path] = sum(leaves[p] for p in under) if under else 1
        size = len(path[-1][1].encode()) if path else 0
        saved[path] = (len(members[path]) - 1) * size + sum(saved[p] for p in under)
    out = []
    for path, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(made[c]) == len(path))
        out.append((
            min(held), len(path), min(members[path[:-1]]) if path else None, len(held), len(children.get(path, [])),
            leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def collected(made):
    assert made.columns == prefix_trie.NODE
    return sorted(map(tuple, made.collect()), key=repr)


def found(spark, rows):
    return collected(prefix_trie.op13(spark.createDataFrame(rows, SCHEMA)))


def conversations(n, seed, texts=3):
    rng = random.Random(seed)
    rows = []
    for conv_id in range(n):
        for turn in range(rng.choice([1, 2, 3, 8, 12])):
            role = rng.choice(["user", "assistant", None]) if rng.random() < 0.2 else ["user", "assistant"][turn % 2]
            rows.append((conv_id, turn, role, rng.choice([None, "", "é", *(f"text {i}" for i in range(texts))])))
    return rows


@pytest.mark.parametrize("texts", [1, 40])
def test_random_conversations(spark, texts):
    rows = conversations(60, texts, texts)
    assert found(spark, rows) == brute(rows)
    assert collected(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows, False)


def test_a_full_sketch_only_groups_more(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PAGE", 8)
    rows = conversations(40, 9, 30)
    turns = prefix_trie.turns_of(spark.createDataFrame(rows, SCHEMA))
    made = prefix_trie.prefixes(turns.withColumn("part", F.lit(0)), turns.select("conv_id").distinct())
    none = prefix_trie.np.full(2, 255, prefix_trie.np.uint8)
    assert prefix_trie.screened(made, 8, none).where("alone").count() == 0
    cells, bits = 1 << 16, prefix_trie.np.full(1 << 14, 255, prefix_trie.np.uint8)
    monkeypatch.setattr(prefix_trie, "shared_bits", lambda *_: (cells, bits))
    assert found(spark, rows) == brute(rows)


def test_screen_never_calls_a_shared_prefix_alone(spark):
    rows = conversations(80, 3, 2)
    turns = prefix_trie.turns_of(spark.createDataFrame(rows, SCHEMA)).withColumn("part", F.lit(0))
    made = prefix_trie.prefixes(turns, turns.select("conv_id").distinct()).where("depth > 0")
    cells, bits = prefix_trie.shared_bits(made)
    seen = prefix_trie.screened(made, cells, bits).select("one", "two", "alone").collect()
    count = {}
    for r in seen:
        count[r.one, r.two] = count.get((r.one, r.two), 0) + 1
    assert {r.alone for r in seen} == {True, False}
    assert all(count[r.one, r.two] == 1 for r in seen if r.alone)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "left out"), (3, None, "user", "a"), (3, 0, "user", "b"), (3, 0, "user", "b"),
        (4, 1, None, None), (9, 1, "user", "x" * 100_000), (12, 5, "user", "only one turn"), (7, 2, "", ""),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    clashing = spark.createDataFrame(rows, SCHEMA)
    for name in ("one", "two", "depth", "pos", "part", "h", "last", "alone", "n_convs"):
        clashing = clashing.withColumn(name, F.lit("x"))
    assert collected(prefix_trie.op13(clashing)) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_nodes_whose_counters_collide_below_a_node_that_stands_alone(spark, monkeypatch, seed):
    counted = prefix_trie.shared_bits

    def colliding(*given):
        cells, bits = counted(*given)
        more = prefix_trie.np.random.default_rng(seed).integers(0, 256, len(bits), prefix_trie.np.uint8)
        return cells, bits | more

    monkeypatch.setattr(prefix_trie, "shared_bits", colliding)
    rows = [
        (c, t, "user", f"own {seed} {c} {t}" if t else f"first {c % 7}") for c in range(40) for t in range(12)
    ]
    assert found(spark, rows) == brute(rows)


def test_rows_with_equal_turns_are_ordered_by_role_and_text(spark):
    rng = random.Random(4)
    rows = [
        (c, rng.choice([None, 0, 1, 1]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é", None, "zz"]))
        for c in range(60) for _ in range(5)
    ]
    assert found(spark, rows) == brute(rows)


def test_turnless_conversations_are_members_of_the_root(spark):
    ids = [c for c in range(1000) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1][:5]
    rows = [(c, 0, "user", "gone") for c in ids]
    made = found(spark, rows)
    assert made == brute(rows)
    assert len(made) == 1 and made[0][3:6] == (5, 0, 1)


def test_very_common_first_turn_copies_and_one_long_conversation(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(0, 600) for t in range(2)]
    rows += [(c, 2, "assistant", f"own {c}") for c in range(200, 600)]
    rows += [(5000, t, "user", f"long {t}") for t in range(1500)]
    rows += [(5005, t, "user", f"long {t}") for t in range(1500)]
    assert found(spark, rows) == brute(rows)


def test_query_over_the_whole_table(spark):
    base = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, base, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert collected(prefix_trie.op13(table(spark, base, "conversations"))) == brute(rows)
