"""Repeated passages against a brute-force count of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from signals.llm import substring
from signals.llm.common import table

SCHEMA = "doc_id long, text string"


def brute(rows, length):
    texts = [substring.split_words(t) for _, t in rows]
    seen = Counter(tuple(w[i : i + length]) for w in texts for i in range(len(w) - length + 1))
    out = []
    for (doc_id, _), words in zip(rows, texts, strict=True):
        hit = [False] * len(words)
        for i in range(len(words) - length + 1):
            if seen[tuple(words[i : i + length])] > 1:
                hit[i : i + length] = [True] * length
        kept = b" ".join(w for w, h in zip(words, hit, strict=True) if not h)
        out.append((doc_id, len(words), sum(hit), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, length, seed):
    made = substring.remove_repeats(spark.createDataFrame(rows, SCHEMA), length, seed)
    return sorted(map(tuple, made.drop("kept", "repeats").collect()), key=repr)


def corpus(letters, n, seed):
    """Texts of few different words, with passages copied between them, edits and repeats."""
    rng = random.Random(seed)
    word = lambda: rng.choice(letters)
    passages = [[word() for _ in range(rng.randint(4, 40))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(passages)
        if words and rng.random() < 0.3:
            words[rng.randrange(len(words))] = word()
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", [f"w{i}" for i in range(60)]])
@pytest.mark.parametrize("length,seed", [(9, 4), (8, 8), (5, 1)])
def test_every_window_against_brute_force(spark, letters, length, seed):
    rows = corpus(letters, 40, length)
    assert found(spark, rows, length, seed) == brute(rows, length)


def test_small_chunks_and_hot_anchors_change_nothing(spark, monkeypatch):
    """Rows known to repeat within a task, and anchors of many blocks, take their own way."""
    rows = corpus([f"w{i}" for i in range(40)], 60, 1)
    common = "x1 x2 x3 x4 x5"
    rng = random.Random(5)
    rows += [(100 + i, f"{rng.random()} {rng.random()} {common} {i % 7} {i % 3} b c") for i in range(60)]
    rows += [(200 + i, rows[3][1]) for i in range(30)]
    expect = brute(rows, 8)
    for chunk, many in ((40, 2), (1 << 18, 3)):
        monkeypatch.setattr(substring, "CHUNK", chunk)
        monkeypatch.setattr(substring, "MANY", many)
        parts = list(substring._seed_part(8, 4)(_batches(rows)))
        states = np.concatenate([p.column("state").to_numpy() for p in parts])
        assert {substring.REPEATS, substring.MARKER, substring.EXTENDS} <= set(states.tolist())
        assert _in_plain_python(spark, rows, 8, 4) == expect


def _batches(rows):
    import pyarrow as pa

    yield pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([hash(r[1]) for r in rows], pa.int64()),
            pa.array([r[1] for r in rows]),
        ],
        names=["doc_key", "text_key", "text"],
    )


def _in_plain_python(spark, rows, length, seed):
    """The same operator with its settings carried into the tasks."""
    chunk, many = substring.CHUNK, substring.MANY
    seeds, windows = substring._seed_part, substring._extend_part

    def with_settings(make):
        def maker(*args):
            def run(batches):
                substring.CHUNK, substring.MANY = chunk, many
                try:
                    yield from make(*args)(batches)
                finally:
                    substring.CHUNK, substring.MANY = 1 << 18, 1000

            return run

        return maker

    substring._seed_part, substring._extend_part = with_settings(seeds), with_settings(windows)
    try:
        return found(spark, rows, length, seed)
    finally:
        substring._seed_part, substring._extend_part = seeds, windows


def test_odd_rows(spark):
    long = " ".join(str(i) for i in range(3000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "a b"), (None, "p q r s t"), (6, "p q r s t"), (6, "p q r s t"),
        (6, "other words of this one"), (7, long), (8, long + " end"), (9, "z " * 500), (10, "É b É b"),
    ]
    assert found(spark, rows, 5, 3) == brute(rows, 5)
    assert found(spark, [], 5, 3) == []


def test_other_columns_are_left_alone(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("at", "size", "state", "doc_key", "text_key", "salt", "kept"):
        docs = docs.withColumn(name, F.lit("x"))
    made = substring.remove_repeats(docs, 5, 2).orderBy("doc_id").collect()
    assert [(r.n_removed, r.kept, [tuple(s) for s in r.repeats]) for r in made] == [(6, "", [(0, 6)])] * 2


def test_a_third_of_all_rows_share_one_text_or_passage(spark):
    rng = random.Random(3)
    same = " ".join(f"s{i}" for i in range(60))
    rows = [(i, same) for i in range(400)]
    rows += [(1000 + i, f"{rng.random()} " * 20 + same[:200] + f" {rng.random()}" * 20) for i in range(400)]
    rows += [(2000 + i, f"{rng.random()} " * 40) for i in range(400)]
    assert found(spark, rows, 35, 12) == brute(rows, 35)


def test_query_over_the_whole_table(spark):
    base = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, base, "documents").select("doc_id", "text").collect()]
    made = sorted(map(tuple, substring.op11(table(spark, base, "documents")).collect()), key=repr)
    assert made == brute(rows, 35)
    assert any(r[2] for r in made)
