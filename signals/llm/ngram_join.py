"""Exact Jaccard join on word n-grams by parity sketches, and its connected components.

Two texts link when den * |A & B| >= num * |A | B| over their sets of distinct `k`-word shingles.

* Sets. Texts with one and the same set are one node (a 64-bit hash of the set; among N sets about
  N^2 / 2^65 unequal pairs share one). All further work is on nodes, so copies cost one row each.
* Sketches. A set's hash range is cut into m parts and the hashes in each part are XORed. One
  token changes one part, so the number of parts that differ is at most the symmetric difference;
  with m over the largest difference that a link allows, linked sets agree in at least one part
  (pigeonhole). Sizes are banded: a band's m follows its largest size, and a set stands in its own
  band and, when it is small enough to link down, in the one below. A few parts more than needed
  make up for parts that are empty in both sets, so only sets with more empty parts than that
  report empty ones.
* Candidates. Nodes with an equal part form a group. Each group is first verified as a star around
  its most connected member, which links families of near copies with one check a member; texts are
  fetched only for members whose sketches (below) may link. What then is in a group but not in one component is compared pair by pair inside tasks, tile by tile,
  by the Hamming distance of longer parity bit sketches, a lower bound of the difference; only
  pairs that pass are emitted and verified exactly on whole texts.
* Components are found by alternating large and small stars over the links.

No pair of a group is emitted unverified beyond its star, and nothing is capped. Each text is
shuffled once, to fetch one text per node. No key with a large share of rows lands in one task:
group figures are aggregates that combine before they shuffle, and keys with at least 1 in `HEAVY`
of the rows of a join, at most `HEAVY` keys, have their figures broadcast (`skew_join`). Sketch parts
that are common in a sample of texts are spread over `SALTS` tasks; the sample decides where rows
go, never which rows stay. In a group with several components, members of its largest one are
compared with the others only, never with each other.

Null texts, empty texts and texts without words have an empty set and link with nothing. Texts of
fewer than k words are one shingle. Rows that repeat an id or a text are each returned; the
component is the smallest id reachable (null only when no row of it has an id). An empty table
gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import functools
import gc
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signals.llm.common import staged
from signals.llm.shingles import U, mix, shingle_set

TILE = 1000
STAR = 64
ROWS = "key long, node long, doc_id long, n int"
SPARE = 0.1
BATCH_KEYS = 200_000
HEAVY = 10_000
SALTS = 256
SAMPLE = 4000


@dataclass(frozen=True)
class Rule:
    """Shingles of k words; linked at Jaccard num / den or more."""

    k: int = 4
    num: int = 85
    den: int = 100

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        if self.den * min(len(a), len(b)) < self.num * max(len(a), len(b)) or not len(a):
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return self.den * both >= self.num * (len(a) + len(b) - both)

    def most_apart(self, a, b):
        """Largest symmetric difference of linked sets of these sizes."""
        return (self.den - self.num) * (a + b) // (self.den + self.num)

    @functools.cached_property
    def bands(self) -> list[int]:
        """Smallest size of each band: a factor (den / num)^2 apart, up to 2^40."""
        return _bands(self.num, self.den)

    def parts(self, band: int) -> tuple[int, int]:
        """Parts of a band's sketch, and how many of them are spare."""
        top = self.bands[band + 1] - 1
        apart = self.most_apart(top, self.den * top // self.num)
        spare = math.ceil(SPARE * apart)
        return apart + 1 + spare, spare


def _bands(num: int, den: int) -> list[int]:
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, out[-1] * den * den // (num * num)))
    return out


def node_of(tokens: np.ndarray) -> int:
    """Hash of a whole set, as a signed 64-bit number."""
    total = int(mix(tokens).sum(dtype=np.uint64))
    turned = int(np.bitwise_xor.reduce(mix(tokens ^ U(0x5851F42D4C957F2D))))
    one = mix(np.array([(total * 3 + turned * 7 + len(tokens)) % (1 << 64)], np.uint64))
    return int(one.view(np.int64)[0])


def part_keys(tokens: np.ndarray, rule: Rule) -> np.ndarray:
    """Keys of a sorted set's sketch parts in every band where it may find a partner."""
    size = len(tokens)
    bands = rule.bands
    own = int(np.searchsorted(bands, size, side="right")) - 1
    folded = mix(tokens)
    out = []
    for band in (own, own - 1):
        # In the band below it is the larger set: its partner has at most bands[own] - 1.
        if band < 0 or (band < own and rule.num * size > rule.den * (bands[own] - 1)):
            continue
        parts, spare = rule.parts(band)
        at = (((tokens >> U(32)) * U(parts)) >> U(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        filled = at[first]
        values = np.bitwise_xor.reduceat(folded, first)
        if parts - len(filled) > spare:
            whole = np.zeros(parts, np.uint64)
            whole[filled] = values
            filled, values = np.arange(parts), whole
        out.append(mix(values ^ mix(filled.astype(np.uint64) + U(band << 40))))
    return np.concatenate(out)


def bit_sketch(tokens: np.ndarray) -> np.ndarray:
    """Parity of tokens over 2^j bits, at least twice as many as tokens, as 64-bit words."""
    bits = max(64, 1 << (2 * len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _emit(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a task reports the parts of a set once, whatever its copies
        for batch in batches:
            keys, nodes, docs, sizes = [], [], [], []

            def flush() -> pa.RecordBatch:
                counts = np.array([len(k) for k in keys], np.int64)
                firsts = np.cumsum(counts) - counts
                docs_of = np.full(int(counts.sum()), None, object)
                docs_of[firsts] = docs
                sizes_of = np.full(int(counts.sum()), None, object)
                sizes_of[firsts] = sizes
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)),
                        pa.array(np.repeat(np.array(nodes, np.int64), counts)),
                        pa.array(docs_of, pa.int64()),
                        pa.array(sizes_of, pa.int32()),
                    ],
                    names=["key", "node", "doc_id", "n"],
                )

            held = 0
            for doc_id, row_key, text in zip(*batch.columns, strict=True):
                tokens = shingle_set(text.as_py(), rule.k)
                # A row's first key is its own and carries its id and size; parts follow.
                mine = np.array([row_key.as_py()], np.int64).view(np.uint64)
                node = node_of(tokens) if len(tokens) else 0
                new = len(tokens) and node not in seen
                own = np.concatenate((mine, part_keys(tokens, rule))) if new else mine
                seen.add(node)
                keys.append(own)
                nodes.append(node)
                docs.append(doc_id.as_py())
                sizes.append(len(tokens))
                held += len(own)
                if held > BATCH_KEYS:
                    yield flush()
                    keys, nodes, docs, sizes, held = [], [], [], [], 0
            yield flush()

    return run


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, row_key (of id and text), text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit(""))).alias("row_key"),
        "text",
    )


def skew_join(rows: DataFrame, figures: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join of a written table of `total` rows with one line of figures per `key`.

    `figures` has a column `in_rows`, the key's number of rows. Keys with 1 in `HEAVY` of all rows
    or more are at most `HEAVY` lines of numbers: they are broadcast and their rows stay where
    they are. All other rows are joined by a shuffle."""
    heavy = F.col("in_rows") * HEAVY >= max(total, HEAVY)
    hot = F.broadcast(figures.where(heavy))
    rest = rows.join(F.broadcast(figures.where(heavy).select(key)), key, "left_anti").join(figures.where(~heavy), key)
    return rows.join(hot, key).unionByName(rest).drop("in_rows")


def _keys(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                tokens = shingle_set(text.as_py(), rule.k)
                if len(tokens):
                    yield pa.RecordBatch.from_arrays([pa.array(part_keys(tokens, rule).view(np.int64))], names=["key"])

    return run


def common_parts(source: DataFrame, rule: Rule) -> DataFrame:
    """The `HEAVY` most common keys of about `SAMPLE` texts that at least four of them hold."""
    share = min(1.0, SAMPLE / max(1, source.count()))
    return (
        source.select("text")
        .sample(share, seed=7)
        .mapInArrow(_keys(rule), "key long")
        .groupBy("key")
        .agg(F.count("*").alias("held"))
        .where("held >= 4")
        .orderBy(F.desc("held"), "key")
        .limit(HEAVY)
        .select("key", F.lit(True).alias("common"))
    )


def groups(source: DataFrame, rule: Rule) -> DataFrame:
    """A written table of every row's own line (n set) and of the nodes in groups of two or more.

    The nodes of a common key are spread by node, so that such a key stays even if it has one."""
    rows = source.mapInArrow(_emit(rule), ROWS).join(F.broadcast(common_parts(source, rule)), "key", "left")
    dealt = rows.withColumn("salt", F.when(F.col("common"), F.pmod(F.xxhash64("node"), F.lit(SALTS))))
    alike = Window.partitionBy("key", "salt")
    before = F.lag("node").over(alike.orderBy("node"))
    return staged(
        dealt.withColumn("again", before.eqNullSafe(F.col("node")))
        .withColumn("low", F.min("node").over(alike))
        .withColumn("high", F.max("node").over(alike))
        .where("n IS NOT NULL OR ((low <> high OR common) AND NOT again)")
        .select("key", "node", "doc_id", "n"),
        "sketch-groups",
    )


def _texts(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # repeated rows meet in one task
        for batch in batches:
            keep, sizes, sketches = [], [], []
            for i, (node, text) in enumerate(zip(batch.column(0), batch.column(1), strict=True)):
                if node.as_py() in seen:
                    continue
                tokens = shingle_set(text.as_py(), rule.k)
                if len(tokens) and node_of(tokens) == node.as_py():
                    seen.add(node.as_py())
                    keep.append(i)
                    sizes.append(len(tokens))
                    sketches.append(bit_sketch(tokens).tobytes())
            picked = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary())],
                names=["node", "text", "n", "sketch"],
            )

    return run


def node_texts(source: DataFrame, table: DataFrame, rule: Rule) -> DataFrame:
    """node, text, n, sketch: one text of every node in a group."""
    nodes = table.where("n IS NULL").select("node").distinct()
    picked = (
        table.where("n > 0").groupBy("node").agg(F.min("key").alias("row_key")).join(nodes, "node", "left_semi")
    )
    found = source.join(picked.hint("shuffle_hash"), "row_key").select("node", "text")
    made = found.mapInArrow(_texts(rule), "node long, text string, n int, sketch binary")
    return staged(made, "node-texts")


def star_edges(members: DataFrame, total: int) -> DataFrame:
    """(a, b): every member of a group with the member that stands in the most groups."""
    weight = members.groupBy("node").agg(F.count("*").alias("weight"))
    centres = (
        members.join(weight, "node")
        .groupBy("key")
        .agg(F.max(F.struct("weight", "node"))["node"].alias("a"), F.count("*").alias("in_rows"))
    )
    return (
        skew_join(members, centres, "key", total)
        .where("a <> node")
        .select("a", F.col("node").alias("b"))
        .distinct()
    )


def _check_star(rule: Rule):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        centre = rows["a"].iloc[0]
        sets = {n: shingle_set(t, rule.k) for n, t in zip(rows["node"], rows["text"], strict=True)}
        linked = [n for n, s in sets.items() if n != centre and rule.linked(sets[centre], s)]
        return pd.DataFrame({"a": [centre] * len(linked), "b": linked}, columns=["a", "b"]).astype("int64")

    return run


def _may_link(rule: Rule):
    """Edges that the Hamming distance of the sketches, a lower bound of the difference, lets pass."""

    def near(n_a: int, n_b: int, sketch_a: bytes, sketch_b: bytes) -> bool:
        if rule.den * min(n_a, n_b) < rule.num * max(n_a, n_b):
            return False
        width = min(len(sketch_a), len(sketch_b)) // 8
        folded = [
            np.bitwise_xor.reduce(np.frombuffer(s, np.uint64).reshape(-1, width), axis=0) for s in (sketch_a, sketch_b)
        ]
        return int(np.bitwise_count(folded[0] ^ folded[1]).sum()) <= rule.most_apart(n_a, n_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("n_a", "n_b", "sketch_a", "sketch_b")]
            passed = pa.array([near(*row) for row in zip(*columns, strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(passed)

    return run


def shared_out(edges: DataFrame) -> DataFrame:
    """a, b, share of a written table: about `STAR` partners of an `a` in every share."""
    degrees = edges.groupBy("a").agg(F.count("*").alias("n")).withColumn("in_rows", F.col("n"))
    return skew_join(edges, degrees, "a", edges.count()).select(
        "a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / STAR)).alias("share")
    )


def near_edges(edges: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The (a, b) of a written table that may link by size and sketch, so that no text is moved for
    the others. A centre's sketch is fetched once a share, never to all partners in one task."""
    split = shared_out(edges)
    of = lambda side: texts.select(
        F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")
    )
    centres = split.select("a", "share").distinct().join(of("a"), "a")
    pairs = split.join(of("b"), "b").join(centres, ["a", "share"])
    return pairs.mapInArrow(_may_link(rule), "a long, b long")


def verify(edges: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The (a, b) of a written table that link. Each task sees one `a` with about `STAR` partners."""
    split = shared_out(edges)
    members = split.select("a", "share", F.col("b").alias("node")).union(
        split.select("a", "share", F.col("a").alias("node")).distinct()
    )
    with_texts = members.join(texts.select("node", "text"), "node")
    checked = with_texts.groupBy("a", "share").applyInPandas(_check_star(rule), "a long, b long")
    return staged(checked, "links")


def _near_pairs(rule: Rule):
    """Pairs of one tile group in different components that may link by their bit sketches."""

    def pairs(rows: pa.Table) -> set[tuple[int, int]]:
        keys = rows["key"].to_numpy()
        tiles = rows["tile"].to_numpy()
        home = rows["home"].to_numpy()
        nodes, roots = rows["node"].to_numpy(), rows["root"].to_numpy()
        sizes = rows["n"].to_numpy().astype(np.int64)
        raw = rows["sketch"].to_pylist()
        words = np.array([len(s) // 8 for s in raw])
        folded: dict[int, np.ndarray] = {}
        out: set[tuple[int, int]] = set()

        def at_width(width: int) -> np.ndarray:
            """Every long enough sketch folded to `width` words: parity stays a lower bound."""
            if width not in folded:
                folded[width] = np.zeros((len(raw), width), np.uint64)
                for r in np.flatnonzero(words >= width):
                    parts = np.frombuffer(raw[r], np.uint64).reshape(-1, width)
                    folded[width][r] = np.bitwise_xor.reduce(parts, axis=0)
            return folded[width]

        last = np.flatnonzero(np.concatenate(((keys[1:] != keys[:-1]) | (tiles[1:] != tiles[:-1]), [True])))
        longest = int(np.diff(np.concatenate(([-1], last))).max())
        for step in range(1, longest):
            i = np.arange(len(keys) - step)
            j = i + step
            same = (keys[i] == keys[j]) & (tiles[i] == tiles[j]) & (roots[i] != roots[j])
            # Two different tiles meet: pairs within either are found where it meets itself.
            same &= (home[i] != home[j]) | (home[i] * (home[i] + 1) // 2 + home[i] == tiles[i])
            low, high = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
            near = np.flatnonzero(same & (rule.den * low >= rule.num * high))
            widths = np.minimum(words[near], words[near + step])
            for width in np.unique(widths).tolist():
                some = near[widths == width]
                table, most = at_width(width), max(1, (1 << 20) // width)
                for at in range(0, len(some), most):
                    x = some[at : at + most]
                    y = x + step
                    apart = np.bitwise_count(table[x] ^ table[y]).sum(axis=1, dtype=np.int64)
                    ok = apart <= rule.most_apart(sizes[x], sizes[y])
                    for u, v in zip(nodes[x[ok]].tolist(), nodes[y[ok]].tolist(), strict=True):
                        out.add((min(u, v), max(u, v)))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(found: set[tuple[int, int]]) -> pa.RecordBatch:
            a, b = zip(*sorted(found), strict=True) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
            if not rows.num_rows:
                continue
            # The last group may go on in the next batch.
            keys, tiles = rows["key"].to_numpy(), rows["tile"].to_numpy()
            open_rows = (keys == keys[-1]) & (tiles == tiles[-1])
            cut = int(np.flatnonzero(open_rows)[0])
            held = rows.slice(cut)
            if cut:
                yield result(pairs(rows.slice(0, cut)))
        if held is not None and held.num_rows:
            yield result(pairs(held))

    return run


def remaining_pairs(members: DataFrame, roots: DataFrame, texts: DataFrame, rule: Rule, total: int) -> DataFrame:
    """(a, b) of one group and two components that the sketches' distance does not rule out."""
    rooted = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    by_root = rooted.groupBy("key", "root").agg(F.count("*").alias("in_root"))
    mixed = (
        by_root.groupBy("key")
        .agg(F.max(F.struct("in_root", "root")).alias("main"), F.sum("in_root").alias("in_rows"))
        .where("in_rows > main.in_root")
        .select(
            "key", "in_rows", F.col("main.root").alias("main"),
            F.ceil(F.col("main.in_root") / TILE).alias("own"),
            F.ceil((F.col("in_rows") - F.col("main.in_root")) / TILE).alias("others"),
        )
    )
    mixed = staged(mixed, "mixed-groups")
    # Tiles are numbered with those of the main component first; no two of these meet.
    is_main = F.col("root") == F.col("main")
    last = F.col("own") + F.col("others") - 1
    met = F.when(is_main, F.sequence("own", last)).otherwise(F.sequence(F.lit(0).cast("long"), last))
    at = F.when(is_main, F.pmod(F.xxhash64("node"), F.col("own"))).otherwise(
        F.col("own") + F.pmod(F.xxhash64("node"), F.col("others"))
    )
    full = (
        skew_join(rooted, mixed, "key", total)
        .join(texts.select("node", "n", "sketch"), "node")
        .select("key", at.alias("home"), "node", "root", "n", "sketch", F.explode(met).alias("other"))
        .withColumn("far", F.greatest("home", "other"))
        # Tile pairs are numbered by their triangle: far * (far + 1) / 2 + near.
        .withColumn("tile", F.expr("far * (far + 1) div 2 + least(home, other)"))
        .select("key", "tile", "home", "node", "root", "n", "sketch")
    )
    dealt = full.repartition("key", "tile").sortWithinPartitions("key", "tile")
    return dealt.mapInArrow(_near_pairs(rule), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link, root the least node of its component."""
    edges = staged(links.select("a", "b").where("a <> b").distinct(), "component-edges")
    before, n = None, edges.count()
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("in_rows"))
        met = skew_join(both, near, "a", 2 * n)
        large = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = staged(large.where("a <> b"), "component-large")
        least = down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("in_rows"))
        small = skew_join(down, least, "a", down.count())
        edges = staged(
            least.select("a", F.col("m").alias("b"))
            .union(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
            .distinct(),
            "component-edges",
        )
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, n = now, now[0]


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of jobs whose results are written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def links(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """(every row's own line: key, node, doc_id, n; links between nodes: a, b)."""
    spark = docs.sparkSession
    source = keyed(docs)
    table = groups(source, rule)
    release(spark)
    members = table.where("n IS NULL").select("key", "node")
    texts = node_texts(source, table, rule)
    total = members.count()
    stars = staged(star_edges(members, total), "star-edges")
    release(spark)
    near = staged(near_edges(stars, texts, rule), "near-star-edges")
    release(spark)
    found = verify(near, texts, rule)
    release(spark)
    tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = remaining_pairs(members, components(found), texts, rule, total).join(tried, ["a", "b"], "left_anti")
    more = verify(staged(rest, "remaining-pairs"), texts, rule)
    return table.where("n IS NOT NULL"), found.union(more)


def classes(docs: DataFrame, rule: Rule) -> DataFrame:
    """Per row: doc_id, row_key, n_shingles, component_id."""
    lines, found = links(docs, rule)
    roots = components(found)
    filled = lines.where("n > 0")
    least = filled.groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    placed = staged(
        least.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "component-nodes"
    )
    of_root = placed.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("in_rows"))
    of_node = skew_join(placed, of_root, "root", placed.count()).select(
        "node", "component_id", F.col("copies").alias("in_rows")
    )
    joined = skew_join(filled, of_node, "node", filled.count()).select("doc_id", "key", "n", "component_id")
    empty = lines.where("n = 0").select("doc_id", "key", "n", F.col("doc_id").alias("component_id"))
    return joined.union(empty).select(
        "doc_id", F.col("key").alias("row_key"), F.col("n").cast("long").alias("n_shingles"), "component_id"
    )


def op10(docs: DataFrame) -> DataFrame:
    return classes(docs, Rule()).drop("row_key")


def keep_one(docs: DataFrame, rule: Rule) -> DataFrame:
    """`docs` with one row of each component, that with the smallest id; all without words.

    Of rows with that id, repeated or of other texts, the one with the least key stays; of rows
    that repeat id and text, any one, though columns beside them may differ."""
    lines = classes(docs, rule).where("n_shingles > 0")
    chosen = (
        lines.where("doc_id <=> component_id")
        .groupBy("component_id")
        .agg(F.min("row_key").alias("row_key"))
    )
    counted = lines.groupBy("row_key").agg(F.count("*").alias("copies"))
    marked = counted.join(chosen.select("row_key", F.lit(True).alias("stays")), "row_key", "left")
    # Only rows that go, and the few that stay but are repeated, need a mark.
    marks = staged(
        marked.where("stays IS NULL OR copies > 1").select(
            F.col("row_key").alias("mark"), F.coalesce("stays", F.lit(False)).alias("stays")
        ),
        "near-duplicate-marks",
    )
    mine = F.xxhash64(F.coalesce(docs.doc_id.cast("string"), F.lit("null")), F.coalesce(docs.text, F.lit("")))
    # Whole rows in one column: their own names meet no others.
    rows = docs.select(mine.alias("own_mark"), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    kept = rows.join(marks, rows["own_mark"] == marks["mark"], "left_anti").select("row.*")
    twice = rows.join(marks.where("stays"), rows["own_mark"] == marks["mark"])
    once = twice.groupBy("mark").agg(F.first("row").alias("row"))
    return kept.unionByName(once.select("row.*"))
