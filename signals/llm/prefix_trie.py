"""Trie of conversation prefixes, with a count-min screen in front of the exact grouping.

A conversation of n turns is on n + 1 nodes: the root and its prefixes, told by a chain of 128-bit
digests.

* Screen. A count-min sketch over all prefix digests (counters stop at two) is merged from one part a
  task. It never counts too little, so an estimate of one proves that no other conversation has the
  prefix: that node is emitted where it is. Prefixes that may be shared are shuffled and grouped
  exactly; some of them turn out to be below a node that stands alone, whose one member is then
  theirs too and is their parent's id without a lookup. The sketch grows with the data up to
  `MOST_CELLS` counters a row (4 MiB of bits for each executor); beyond that more unshared prefixes
  are merely grouped like the others.
* Sums over subtrees need no walk from level to level: every node has a smallest member, and the
  nodes below a node are met once each on the paths of their smallest members, which pass through
  it. So each conversation sums, from its end upwards, over the nodes it is the smallest member of,
  and a node adds up what its members have at its depth.
* Parents. A node's parent is looked up by digest. Parents with over a thousandth of all nodes as
  children (at most a thousand of them) are broadcast, the rest joined.

Groups are only counted, with map-side combining; ids that end at a node pass a hash one by one in
order, in constant memory. A conversation's turns pass one task in order, one at a time.

Null turns come first, equal turns are ordered by role and text, null roles and texts are empty. Rows without an id belong to no conversation and are left out. An empty table gives no
nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signals.llm.common import staged

ROWS, CELLS_PER_PREFIX, MOST_CELLS = 2, 8, 1 << 24
PAGE = 1 << 16  # counters in one piece of a sketch
ROOT = (0, 0)
KEY = ["one", "two"]
PREFIXES = (
    "conv_id long, depth long, one long, two long, up_one long, up_two long, bytes long, last boolean"
)
NODE = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]
NOTHING = hashlib.sha256(b"").hexdigest()


def turns_of(rows: DataFrame) -> DataFrame:
    """Narrow turns with their place in the conversation: conv_id, pos, a, b (digest), bytes."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    place = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return (
        rows.where("conv_id is not null")
        .select(
            F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
            role.alias("role"), text.alias("text"),
        )
        .select("*", (F.row_number().over(place) - 1).cast("long").alias("pos"))
        .select(
            "conv_id", "pos", F.xxhash64("role", "text").alias("a"),
            F.xxhash64(F.lit(1), "role", "text").alias("b"),
            F.octet_length("text").cast("long").alias("bytes"),
        )
    )


def _chain_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes of conversations whose turns come in order, each after a row without a digest."""
    names = [c.split()[0] for c in PREFIXES.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.bool_()]
    out: list[list] = []

    def batch_of(rows):
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
        )

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "a", "b", "bytes"))
        for conv_id, a, b, size in zip(*columns, strict=True):
            if a is None:
                out.append([conv_id, 0, *ROOT, None, None, 0, True])
                continue
            before = out[-1]
            before[-1] = False
            up = before[2:4]
            digest = xxhash.xxh3_128_digest(struct.pack("<4q", *up, a, b))
            out.append([conv_id, before[1] + 1, *struct.unpack("<2q", digest), *up, size, True])
        if len(out) > 5000:
            yield batch_of(out[:-1])  # the last one may not be its conversation's end
            del out[:-1]
    yield batch_of(out)


def prefixes(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """All prefixes of all `ids`, the empty one included, from turns ordered by part and pos."""
    columns = ["conv_id", "part", "pos", "a", "b", "bytes"]
    named = ids.select("conv_id", F.lit(-1).alias("part"))
    return (
        turns.select(columns)
        .unionByName(named, allowMissingColumns=True)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "pos")
        .select("conv_id", "a", "b", "bytes")
        .mapInArrow(_chain_part, PREFIXES)
    )


def _cells(one: np.ndarray, two: np.ndarray, cells: int) -> tuple[np.ndarray, ...]:
    """A digest's counter in each row of the sketch."""
    return one & (cells - 1), two & (cells - 1)


def _count_part(cells: int):
    """Pieces of a task's sketch: places of the counters at one, and of those at two or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((ROWS, cells), np.uint8)
        for batch in batches:
            places = _cells(batch.column(0).to_numpy(), batch.column(1).to_numpy(), cells)
            for row, place in zip(counts, places, strict=True):
                found, n = np.unique(place, return_counts=True)
                row[found] = np.minimum(2, row[found] + np.minimum(n, 2))
        flat = counts.reshape(-1)
        for i in range(0, len(flat), PAGE):
            piece = flat[i : i + PAGE]
            ones, twos = (np.flatnonzero(piece == c).astype("<u2").tobytes() for c in (1, 2))
            if ones or twos:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i // PAGE], pa.int32()), pa.array([ones]), pa.array([twos])],
                    names=["page", "ones", "twos"],
                )

    return run


def _merge_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits of the counters that reach two, page by page."""

    def batch_of(page, counts):
        bits = np.packbits(counts >= 2).tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([page], pa.int32()), pa.array([bits])], names=["page", "bits"]
        )

    now, counts = None, None
    for batch in batches:
        for page, ones, twos in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if page != now:
                if now is not None:
                    yield batch_of(now, counts)
                now, counts = page, np.zeros(PAGE, np.uint8)
            for added, places in ((1, ones), (2, twos)):
                at = np.frombuffer(places, "<u2")
                counts[at] = np.minimum(2, counts[at] + added)
    if now is not None:
        yield batch_of(now, counts)


def shared_bits(found: DataFrame, most_cells: int = MOST_CELLS) -> tuple[int, np.ndarray]:
    """Counters a row, and one byte for eight counters: whether each reached two. Bounded."""
    total = found.count()
    cells = PAGE
    while cells < min(most_cells, total * CELLS_PER_PREFIX):
        cells *= 2
    pages = (
        found.select(KEY)
        .mapInArrow(_count_part(cells), "page int, ones binary, twos binary")
        .repartition("page")
        .sortWithinPartitions("page")
        .mapInArrow(_merge_part, "page int, bits binary")
    )
    bits = np.zeros(ROWS * cells // 8, np.uint8)
    for page, piece in pages.collect():
        bits[page * PAGE // 8 : (page + 1) * PAGE // 8] = np.frombuffer(piece, np.uint8)
    return cells, bits


def screened(found: DataFrame, cells: int, bits: np.ndarray) -> DataFrame:
    """`found` with `alone` (no other conversation has this prefix) and `alone_above` (its parent)."""
    held = found.sparkSession.sparkContext.broadcast(bits)

    def alone(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        out = np.zeros(len(one), dtype=bool)
        for row, place in enumerate(_cells(one, two, cells)):
            at = row * cells + place
            out |= (held.value[at >> 3] >> (7 - (at & 7))) & 1 == 0
        return out & ((one != 0) | (two != 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(c).fill_null(0).to_numpy() for c in ("one", "two", "up_one", "up_two")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(alone(*keys[:2])), pa.array(alone(*keys[2:]))],
                names=[*batch.schema.names, "alone", "alone_above"],
            )

    return found.mapInArrow(run, f"{PREFIXES}, alone boolean, alone_above boolean")


def _ends_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, hasher, out = None, None, []

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.string()),
            ],
            names=["one", "two", "ends"],
        )

    for batch in batches:
        for one, two, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (one, two) == now:
                hasher.update(b",%d" % conv_id)
                continue
            if now is not None:
                out.append((*now, hasher.hexdigest()))
            now, hasher = (one, two), hashlib.sha256(b"%d" % conv_id)
        if len(out) > 5000:
            yield batch_of(out)
            out = []
    if now is not None:
        out.append((*now, hasher.hexdigest()))
    yield batch_of(out)


def shared_nodes(found: DataFrame) -> DataFrame:
    """Nodes that may have several members, grouped exactly; key and parent's key with them."""
    shared = found.where("not alone")
    groups = staged(
        shared.groupBy(KEY).agg(
            F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"),
            *(F.max(c).alias(c) for c in ("depth", "bytes", "up_one", "up_two", "alone_above")),
        ),
        "trie-groups",
    )
    up = [F.col("up_one").alias("one"), F.col("up_two").alias("two")]
    children = (
        groups.select(up).unionByName(found.where("alone and not alone_above").select(up))
        .where("one is not null").groupBy(KEY).agg(F.count("*").alias("n_children"))
    )
    counted = staged(
        groups.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))),
        "trie-children",
    )
    own = counted.select(
        "conv_id", "depth", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        (F.col("n_children") == 0).cast("long").alias("leaf"),
    ).unionByName(
        found.where("alone and last").select(
            "conv_id", "depth", F.lit(0).cast("long").alias("saved"), F.lit(1).cast("long").alias("leaf")
        )
    )
    upwards = (
        Window.partitionBy("conv_id").orderBy(F.desc("depth"))
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    sums = (
        shared.select("conv_id", "depth", *KEY)
        .unionByName(own, allowMissingColumns=True)
        .select(
            *KEY, F.sum("saved").over(upwards).alias("saved"), F.sum("leaf").over(upwards).alias("leaf")
        )
        .where("one is not null")
        .groupBy(KEY)
        .agg(F.sum("saved").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    )
    ends = (
        shared.where("last").select(*KEY, "conv_id").repartition(*KEY)
        .sortWithinPartitions(*KEY, "conv_id").mapInArrow(_ends_part, "one long, two long, ends string")
    )
    return counted.join(sums, KEY).join(ends, KEY, "left").select(
        *KEY, "up_one", "up_two", "alone_above", "conv_id", "depth", "n_convs", "n_children",
        F.coalesce("n_leaves", F.lit(0).cast("long")).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0).cast("long")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"),
    )


def with_parents(nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """`nodes` with the parent's conv_id, by (up_one, up_two); parents of many children broadcast."""
    known = parents.where("n_children > 0").select(
        F.col("one").alias("up_one"), F.col("two").alias("up_two"),
        F.col("conv_id").alias("parent_conv_id"), "n_children",
    )
    total = known.agg(F.sum("n_children")).first()[0] or 0
    many = known.where(F.col("n_children") * 1000 > total).drop("n_children")
    few = known.where(F.col("n_children") * 1000 <= total).drop("n_children")
    looked = nodes.join(F.broadcast(many), ["up_one", "up_two"], "left")
    done = looked.where("parent_conv_id is not null or up_one is null")
    rest = looked.where("parent_conv_id is null and up_one is not null").drop("parent_conv_id")
    return done.unionByName(rest.join(few, ["up_one", "up_two"])).select(NODE)


def trie(turns: DataFrame, ids: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """Nodes of the trie of all `ids` (conv_id), whose turns are ordered by (part, pos)."""
    made = staged(prefixes(turns, ids), "trie-prefixes")
    cells, bits = shared_bits(made.where("depth > 0"), most_cells)
    found = staged(screened(made, cells, bits), "trie-screened")
    shared = staged(shared_nodes(found), "trie-shared")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    tails = found.where("alone").select(
        "up_one", "up_two", "alone_above", "conv_id", "depth", one.alias("n_convs"),
        F.when(F.col("last"), zero).otherwise(one).alias("n_children"), one.alias("n_leaves"),
        zero.alias("saved_tokens"),
        F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256))
        .otherwise(F.lit(NOTHING)).alias("ends_sha256"),
    )
    nodes = shared.drop(*KEY).unionByName(tails)
    inner = nodes.where("alone_above").withColumn("parent_conv_id", F.col("conv_id")).select(NODE)
    return inner.unionByName(with_parents(nodes.where("not alone_above").drop("alone_above"), shared))


def conversation_trie(rows: DataFrame) -> DataFrame:
    """The trie of the conversations of a table (conv_id, turn, role, text) as they are."""
    turns = staged(turns_of(rows).withColumn("part", F.lit(0)), "trie-turns")
    return trie(turns, turns.select("conv_id").distinct())


def rebuilt(turns: DataFrame, ids: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Conversation c: the first h turns of c - c % group, then its own after the first h;
    h = crc32(decimal c) % most."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    wanted = ids.select(
        "conv_id", (F.col("conv_id") - F.pmod("conv_id", F.lit(group))).alias("from_id"), h.alias("h")
    ).where("h > 0")
    first = turns.where(F.col("pos") < most - 1).withColumnRenamed("conv_id", "from_id")
    heads = wanted.join(first, "from_id").where("pos < h").withColumn("part", F.lit(0))
    tails = turns.where(F.col("pos") >= h).withColumn("part", F.lit(1))
    return heads.select(tails.columns).unionByName(tails)


def op13(rows: DataFrame) -> DataFrame:
    turns = staged(turns_of(rows), "trie-turns")
    ids = turns.select("conv_id").distinct()
    return trie(rebuilt(turns, ids), ids)
