"""Removal of word passages that occur more than once: seeds from winnowing, extended both ways.

* Seeds. Every window of `length` words holds `length - seed + 1` runs of `seed` words; the run with
  the smallest hash (the first of equals) is the window's anchor. Windows with the same words have
  the same anchor at the same place, so nothing that repeats escapes. Neighbouring windows mostly
  share their anchor: they form a block, told by its anchor and a hash of all its words.
* Join. Occurrences meet at their anchor. Blocks whose words are equal too extend over each other
  whole: all their windows repeat. An anchor with a single block repeats nothing.
* Extension. Where an anchor has blocks of different words, the extension ends inside them. One
  occurrence of each such block goes back to its text, and its windows are compared one by one
  (128-bit hashes).
* Maximal repeats. Per document, repeating windows that overlap or touch are merged; the spans
  are at least `length` words long and are maximal.

Hot groups. A task passes on two occurrences of a block or window out of every `CHUNK` rows it makes;
further ones are known to repeat and skip the comparison. An anchor with over `MANY` different blocks
in one such run of rows is known to need extension, so its blocks are dealt over `SALTS` groups. A
third of all rows with one text, passage or anchor thus sends a bounded number of rows for each
task to one group. No pairs are formed, nothing is capped.

Words are `[^\\x20\\x09-\\x0D]+`, compared unchanged. Null and empty texts have no words and keep
none. Texts shorter than `length` words lose nothing. Rows that repeat an id with another text are
documents of their own; rows that repeat id and text repeat each other and lose all their windows.
Null ids stay. An empty table gives no rows. Only the id and text columns are read. A text is held
whole by one task, with some 40 bytes a word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signals.llm.common import staged
from signals.llm.shingles import mix
from signals.llm.tokens import Remembered

U = np.uint64
#: Odd multipliers of the two independent rolling hashes.
FIRST, SECOND = 0xD6E8FEB86659FD93, 0xB5297A4D3F84D5B5
KEPT_POWERS = 1 << 20
CHUNK = 1 << 18
MANY, SALTS = 1000, 64
SLICE = 1 << 15
NO_ID = -(1 << 63)
#: What a task knows of an occurrence: nothing, that it repeats, that its anchor has many blocks
#: (its group must extend), that its own group must extend.
OPEN, REPEATS, MARKER, EXTENDS = 0, 1, 2, 3

SEEDS = (
    "anchor long, salt int, block long, doc_key long, text_key long, at int, size int, state int"
)
WINDOWS = "one long, two long, salt int, doc_key long, text_key long, at int, weight int, state int"


def split_words(text: str | None) -> list[bytes]:
    """Words as bytes; `bytes.split` parts at exactly the white space that ends words here."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_memory() -> Remembered:
    return Remembered(xxhash.xxh64_intdigest, 400_000, 64)


def hashed(words: list[bytes], memory: Remembered) -> np.ndarray:
    return np.fromiter(map(memory.__getitem__, words), U, len(words))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and its inverse modulo 2^64 for i < n; kept for texts up to `KEPT_POWERS` words."""
    held = _powers.get(base)
    if held is None or len(held[0]) < n:
        size = max(n, 1 << 14)
        size = 1 << (size - 1).bit_length() if size <= KEPT_POWERS else size
        held = tuple(
            np.cumprod(np.concatenate([[U(1)], np.full(size - 1, b, U)]), dtype=U)
            for b in (base, pow(base, -1, 1 << 64))
        )
        if size <= KEPT_POWERS:
            _powers[base] = held
    return held


class Rolling:
    """Hash of any run of words in two look-ups."""

    def __init__(self, hashes: np.ndarray, base: int):
        up, self.down = powers(base, len(hashes) + 1)
        self.sums = np.concatenate(([U(0)], np.cumsum(hashes * up[: len(hashes)], dtype=U)))

    def runs(self, start: np.ndarray, length) -> np.ndarray:
        return mix((self.sums[start + length] - self.sums[start]) * self.down[start])


def blocks_of(hashes: np.ndarray, length: int, seed: int):
    """Anchor, block hash, first window and number of windows of each block of a text."""
    count = len(hashes) - length + 1
    wide = length - seed + 1
    first = Rolling(hashes, FIRST)
    grams = first.runs(np.arange(count + wide - 1), seed)
    anchors = np.concatenate(
        [
            np.argmin(sliding_window_view(grams[i : i + SLICE + wide - 1], wide), axis=1)
            for i in range(0, count, SLICE)
        ]
    ) + np.arange(count)
    at = np.flatnonzero(np.diff(anchors, prepend=-1))
    size = np.diff(np.append(at, count))
    place = anchors[at]
    whole = Rolling(hashes, SECOND).runs(at, size + length - 1)
    block = mix(whole + (place - at).astype(U) * U(FIRST) + size.astype(U) * U(SECOND))
    return grams[place], block, at, size


def _ranks(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (a, b); whether a row starts a new pair; and its rank among equal pairs."""
    order = np.lexsort((b, a))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    starts = np.flatnonzero(new)
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order, new, rank


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _seed_rows(found: list[tuple]) -> pa.RecordBatch:
    anchor, block, at, size = (np.concatenate([f[i] for f in found]) for i in range(4))
    lengths = [len(f[0]) for f in found]
    doc_key = np.repeat(np.array([f[4] for f in found], np.int64), lengths)
    text_key = np.repeat(np.array([f[5] for f in found], np.int64), lengths)
    order, new, rank = _ranks(anchor, block)
    state, salt = np.zeros(len(anchor), np.int32), np.zeros(len(anchor), np.int32)
    values, group = np.unique(anchor[order], return_inverse=True)
    hot = np.bincount(group, weights=new, minlength=len(values)) > MANY
    many = np.zeros(len(anchor), dtype=bool)
    many[order] = hot[group]
    state[many] = EXTENDS
    salt[many] = 1 + (block[many] % U(SALTS)).astype(np.int32)
    again = order[rank >= 2]
    state[again] = REPEATS
    salt[again] = 1 + SALTS + (text_key[again] + at[again]) % SALTS
    marks = values[hot]
    pad = np.zeros(len(marks), np.int64)
    return pa.RecordBatch.from_arrays(
        [
            _signed(np.concatenate([anchor, marks])),
            pa.array(np.concatenate([salt, pad]).astype(np.int32)),
            pa.array(np.concatenate([block.view(np.int64), pad])),
            pa.array(np.concatenate([doc_key, pad])),
            pa.array(np.concatenate([text_key, pad])),
            pa.array(np.concatenate([at, pad]).astype(np.int32)),
            pa.array(np.concatenate([size, pad]).astype(np.int32)),
            pa.array(np.concatenate([state, np.full(len(marks), MARKER)]).astype(np.int32)),
        ],
        names=[c.split()[0] for c in SEEDS.split(", ")],
    )


def _seed_part(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, found, rows = word_memory(), [], 0
        for batch in batches:
            for doc_key, text_key, text in zip(*batch.columns, strict=True):
                words = split_words(text.as_py())
                if len(words) < length:
                    continue
                made = blocks_of(hashed(words, memory), length, seed)
                found.append((*made, doc_key.as_py(), text_key.as_py()))
                rows += len(made[0])
                if rows >= CHUNK:
                    yield _seed_rows(found)
                    found, rows = [], 0
        if found:
            yield _seed_rows(found)

    return run


def _window_rows(found: list[tuple]) -> pa.RecordBatch:
    one, two, at, weight = (np.concatenate([f[i] for f in found]) for i in range(4))
    lengths = [len(f[0]) for f in found]
    doc_key = np.repeat(np.array([f[4] for f in found], np.int64), lengths)
    text_key = np.repeat(np.array([f[5] for f in found], np.int64), lengths)
    order, _, rank = _ranks(one, two)
    again = order[rank >= 2]
    state = np.zeros(len(one), np.int32)
    state[again] = REPEATS
    salt = np.zeros(len(one), np.int32)
    salt[again] = 1 + (text_key[again] + at[again]) % SALTS
    return pa.RecordBatch.from_arrays(
        [
            _signed(one),
            _signed(two),
            pa.array(salt),
            pa.array(doc_key),
            pa.array(text_key),
            pa.array(at.astype(np.int32)),
            pa.array(weight.astype(np.int32)),
            pa.array(state),
        ],
        names=[c.split()[0] for c in WINDOWS.split(", ")],
    )


def _extend_part(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, found, rows = word_memory(), [], 0
        for batch in batches:
            for doc_key, text_key, text, listed in zip(*batch.columns, strict=True):
                hashes = hashed(split_words(text.as_py()), memory)
                blocks = listed.values
                size = blocks.field("size").to_numpy().astype(np.int64)
                at = np.repeat(blocks.field("at").to_numpy().astype(np.int64), size)
                at += np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
                weight = np.repeat(blocks.field("weight").to_numpy(), size)
                one, two = (Rolling(hashes, base).runs(at, length) for base in (FIRST, SECOND))
                found.append((one, two, at, weight, doc_key.as_py(), text_key.as_py()))
                rows += len(at)
                if rows >= CHUNK:
                    yield _window_rows(found)
                    found, rows = [], 0
        if found:
            yield _window_rows(found)

    return run


def merged(at: np.ndarray, size: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal spans of words under windows that start at `at` .. `at + size - 1`."""
    if not len(at):
        return []
    order = np.argsort(at, kind="stable")
    start = at[order]
    end = np.maximum.accumulate(start + size[order] + length - 1)
    first = np.concatenate(([True], start[1:] > end[:-1]))
    last = np.append(np.flatnonzero(first)[1:], len(start)) - 1
    return list(zip(start[first].tolist(), end[last].tolist(), strict=True))


def _remove_part(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, listed in zip(batch.column(1), batch.column(2), strict=True):
                words = split_words(text.as_py())
                spans = []
                if listed.is_valid:
                    at = listed.values.field("at").to_numpy().astype(np.int64)
                    size = listed.values.field("size").to_numpy().astype(np.int64)
                    spans = merged(at, size, length)
                kept, done = [], 0
                for start, end in spans:
                    kept += words[done:start]
                    done = end
                kept += words[done:]
                out.append((len(words), len(words) - len(kept), b" ".join(kept), spans))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([o[0] for o in out], pa.int64()),
                    pa.array([o[1] for o in out], pa.int64()),
                    pa.array([hashlib.sha256(o[2]).hexdigest() for o in out], pa.string()),
                    pa.array([o[2].decode("utf-8", "surrogatepass") for o in out], pa.string()),
                    pa.array(
                        [[{"first": a, "end": b} for a, b in o[3]] for o in out],
                        pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])),
                    ),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "repeats"],
            )

    return run


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_key"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def repeating_blocks(texts: DataFrame, length: int, seed: int) -> DataFrame:
    """Blocks that repeat whole (`full`), and one of each block to be extended (`rep`)."""
    rows = texts.mapInArrow(_seed_part(length, seed), SEEDS).repartition("anchor", "salt")
    group = Window.partitionBy("anchor", "salt")
    same = Window.partitionBy("anchor", "salt", "block")
    state = F.col("state")
    seen = rows.select(
        "doc_key", "text_key", "at", "size", "state",
        F.sum(F.when(state != MARKER, 1).otherwise(0)).over(same).alias("weight"),
        F.row_number().over(same.orderBy("doc_key", "text_key", "at")).alias("nth"),
        (
            (F.min("block").over(group) != F.max("block").over(group))
            | (F.max(state == MARKER).over(group))
        ).alias("differs"),
    )
    full = (state == REPEATS) | ((state != MARKER) & (F.col("weight") >= 2))
    rep = ((state == EXTENDS) | ((state == OPEN) & F.col("differs"))) & (F.col("nth") == 1)
    return seen.select(
        "doc_key", "text_key", "at", "size",
        F.least("weight", F.lit(2)).cast("int").alias("weight"), full.alias("full"), rep.alias("rep"),
    ).where("full or rep")


def repeating_windows(texts: DataFrame, blocks: DataFrame, length: int) -> DataFrame:
    """Single windows that repeat, of blocks that do not repeat whole: doc_key, text_key, at."""
    key = ["doc_key", "text_key"]
    listed = blocks.where("rep").groupBy(key).agg(
        F.collect_set(F.struct("at", "size", "weight")).alias("blocks")
    )
    rows = (
        texts.join(listed, key)
        .select("doc_key", "text_key", "text", "blocks")
        .mapInArrow(_extend_part(length), WINDOWS)
        .where(f"state = {OPEN} or weight = 1")
        .repartition("one", "two", "salt")
    )
    total = F.sum("weight").over(Window.partitionBy("one", "two", "salt"))
    return (
        rows.withColumn("total", total)
        .where(f"weight = 1 and (state = {REPEATS} or total >= 2)")
        .select("doc_key", "text_key", "at")
    )


def remove_repeats(docs: DataFrame, length: int = 35, seed: int = 12) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, kept (words that stay, joined by one
    space) and repeats (maximal repeated spans of words, end exclusive)."""
    if not 1 <= seed <= length:
        raise ValueError("a seed is no longer than a window")
    texts = keyed(docs)
    blocks = staged(repeating_blocks(texts, length, seed), "repeating-blocks")
    windows = staged(repeating_windows(texts, blocks, length), "repeating-windows")
    key = ["doc_key", "text_key"]
    spans = (
        blocks.where("full").select(*key, "at", "size")
        .unionByName(windows.select(*key, "at", F.lit(1).alias("size")))
        .groupBy(key)
        .agg(F.collect_set(F.struct("at", "size")).alias("spans"))
    )
    rows = texts.join(spans, key, "left").select(
        F.when(F.col("doc_key") != NO_ID, F.col("doc_key")).alias("doc_id"), "text", "spans"
    )
    return rows.mapInArrow(
        _remove_part(length),
        "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, "
        "repeats array<struct<first:long,end:long>>",
    )


def op11(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
