"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraphs, in DataFrame
operations only.

A text is cut into words at white space; where there is none (Chinese, Japanese, Thai) every code
point is a word, and runs of more than 16 code points (minified lines) are cut after certain
characters. A paragraph ends after a word where a hash of it and the word before it is a multiple of
2^class, so an edit changes only the paragraphs it touches, and every word counts in one. The class
is the largest that leaves some `LEAST` to twice as many distinct ends, or 0, where every word is a
paragraph, told with the word before it. A paragraph's digest is a sum over its words modulo 2^27, so
the paragraphs of a coarser class are sums of neighbouring ones, and two texts of any lengths are
compared at the class of the coarser. A stored unit is a digest and the coarsest class that ends there.

* Sketch. Three rows of cells; a digest is counted and XORed into one cell of each row.
* Difference. The cells of one text are subtracted from those of the other, so that paragraphs in
  both vanish. Peeling takes digests out of cells that hold a single one, row by row, each time
  removing them from their other cells, and so recovers the paragraphs that differ. Cells are
  rows, keyed by pair; a step of peeling is one aggregation, and none of them shuffles.
* Retry. A sketch is as wide as the two sets are large. Pairs that do not peel clear are sketched
  again, three times as wide, with other places; after `TRIES` their sets are compared directly.

Likeness is one less the share of recovered paragraphs among those of both texts. A fingerprint
holds the text's class and its sketches at that class and the next.

The order of documents is numbered by ranges and offsets, never in one task. Each text is
shuffled once, and the head of the next document, at most a third of a text, once.

Null text counts as empty; two empty texts are alike (1.0). Null ids stand as the smallest id.
Rows that repeat an id with another text are documents of their own (ordered by a hash of the
text); rows that repeat id and text are one document in the order, and each is returned. A single
document is its own next one. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signals.llm.common import staged

ROWS = 3
FINE, COARSE = 48, 24  # cells in a row of each sketch of a fingerprint
LEAST, RUN = 64, 16
DIGEST = 1 << 27
TRIES, STEPS, FINER = 3, 4, 4
#: Blocks of scripts written without spaces (Thai to Myanmar, Khmer, Han, kana and their
#: extensions). The first condition keeps other characters from being held against each block.
UNSPACED = (
    r"[\x{0E00}-\x{10FFFF}&&[\x{0E00}-\x{109F}\x{1780}-\x{17FF}\x{19E0}-\x{19FF}\x{2E80}-\x{2FDF}"
    r"\x{3005}-\x{30FF}\x{31F0}-\x{31FF}\x{3400}-\x{9FFF}\x{A9E0}-\x{A9FF}\x{AA60}-\x{AA7F}\x{F900}-\x{FAFF}"
    r"\x{FF66}-\x{FF9F}\x{1AFF0}-\x{1B16F}\x{20000}-\x{3FFFF}]]"
)
#: Ends of words within long runs: before these, no more than `RUN` code points from a white space.
CUTS = "AEIOUaeiou0-4;,(){}=."
SMALLEST = -(1 << 63)


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest).bitwiseAND(F.lit(0xFFFF).cast("long"))


def packed(digest: Column) -> Column:
    """A digest, and 16 bits that tell it from the XOR of several."""
    return F.shiftleft(digest.cast("long"), 16).bitwiseOR(_check(digest.cast("long")))


def words(text: Column) -> Column:
    """Words at white space; where there is none, code points or short runs."""
    body = F.trim(text, F.lit(" \t\n\x0b\f\r"))
    ends = rf"(?<={UNSPACED})|(?={UNSPACED})|(?<=\S{{{RUN}}})(?<=[{CUTS}])(?=\S)"

    def pieces(run: Column) -> Column:
        size = F.octet_length(run)  # characters of unspaced scripts have three bytes or more
        odd = (size > RUN) | ((size > F.length(run) + 1) & run.rlike(UNSPACED))
        return F.when(odd, F.filter(F.split(run, ends), lambda w: w != "")).otherwise(F.array(run))

    cut = F.flatten(F.transform(F.split(body, r"\s+"), pieces))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(cut)


def _sums(values: Column, ends: Column, part) -> Column:
    """Per end (a position from 1): the sum of `part` of the values after the end before it."""

    def one(end: Column, i: Column) -> Column:
        before = F.coalesce(F.get(ends, i - 1), F.lit(0))
        total = F.aggregate(
            F.sequence(before, end - 1), F.lit(0).cast("long"), lambda t, at: t + part(F.get(values, at))
        )
        return total.bitwiseAND(F.lit(DIGEST - 1).cast("long"))

    return F.transform(ends, one)


def _positions(values: Column, ends_at) -> Column:
    """Positions from 1 of the values that end a paragraph; the last one always does."""

    def found(n: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(1), n), lambda e: ends_at(F.get(values, e - 1)) | (e == n))
        return F.when(n > 0, ends).otherwise(F.array().cast("array<int>"))

    return let(F.size(values), found)


def _digest(unit: Column) -> Column:
    return F.shiftright(unit, 5) + (1 << 26)  # a unit is stored less 2^31


def _coarsest(unit: Column) -> Column:
    """The coarsest class in which a unit still ends a paragraph."""
    return unit.bitwiseAND(F.lit(31))


def sketch_units(text: Column) -> Column:
    """Struct of a text's class (grain) and its paragraphs in order (units)."""
    return word_units(words(text))


def word_units(found: Column) -> Column:
    """`sketch_units` of the text that has these words."""

    def hashes(found: Column) -> Column:
        return F.transform(found, lambda w, i: F.xxhash64(F.get(found, i - 1), w))

    def cut(pairs: Column) -> Column:
        distinct = F.greatest(F.size(F.array_distinct(pairs)), F.lit(1))
        grain = F.least(F.lit(30), F.greatest(F.lit(0), F.floor(F.log2(distinct / float(LEAST))))).cast("int")
        return let(grain, lambda g: F.struct(g.alias("grain"), units(pairs, g).alias("units")))

    def units(pairs: Column, grain: Column) -> Column:
        # The hash from its second bit on, of which the class wants this many zeros.
        mask = ((F.pow(F.lit(2.0), grain) - 1) * 2).cast("long")
        low = lambda h: F.shiftrightunsigned(h, 1)
        n = F.size(pairs)

        def coarsest(end: Column) -> Column:
            h = low(F.get(pairs, end - 1))
            zeros = F.bit_count(h.bitwiseAND(-h) - 1)  # at the end of the hash; 64 of nought
            return F.when(end == n, 31).otherwise(F.least(zeros, F.lit(30)))

        def packed_units(ends: Column) -> Column:
            return F.zip_with(
                _sums(pairs, ends, lambda h: F.shiftrightunsigned(h, 37)),
                ends,
                lambda total, end: (F.shiftleft(total, 5) + coarsest(end) - (1 << 31)).cast("int"),
            )

        return let(
            let(mask, lambda m: _positions(pairs, lambda h: h.bitwiseAND(m) == 0)), packed_units
        )

    return let(let(found, hashes), cut)


def level(text: Column, grain: Column) -> Column:
    """Distinct digests of a text's paragraphs at its own class or a coarser one."""

    def coarser(units: Column, grain: Column) -> Column:
        sums = let(
            _positions(units, lambda u: _coarsest(u) >= grain), lambda ends: _sums(units, ends, _digest)
        )
        return F.transform(sums, lambda d: d.cast("int"))

    own = F.transform(text["units"], _digest)
    above = let(text["units"], lambda units: let(grain, lambda g: coarser(units, g)))
    return F.array_distinct(F.when(text["grain"] >= grain, own).otherwise(above))


def _places(digest: Column, width: Column, salt: int) -> list[Column]:
    """A packed digest's cell in each row."""
    return [(F.pmod(F.xxhash64(digest, F.lit(salt + r)), width) + r * width).cast("int") for r in range(ROWS)]


def subtracted(pairs: DataFrame, keys: list[str], wider: int, salt: int) -> DataFrame:
    """Cells (cell, n, x) of the sketch of `a` less that of `b`, empty ones left out, per pair.

    `pairs` is clustered by `keys`, or by some of them, so this and what follows only aggregates.
    """
    both = F.size("a") + F.size("b")
    width = F.ceil(both * 1.6 / 48.0) * (16 * wider)
    placed = pairs.select(
        *keys, width.cast("long").alias("width"), F.size("a").alias("of_a"),
        F.posexplode(F.concat("a", "b")).alias("at", "digest"),
    ).select(
        *keys, "width", F.when(F.col("at") < F.col("of_a"), 1).otherwise(-1).alias("n"),
        packed(F.col("digest")).alias("x"),
    )
    cells = [
        F.struct(place.alias("cell"), "n", "x") for place in _places(F.col("x"), F.col("width"), salt)
    ]
    return _summed(placed.select(*keys, "width", F.inline(F.array(*cells))), keys)


def _summed(cells: DataFrame, keys: list[str]) -> DataFrame:
    return (
        cells.groupBy(*keys, "width", "cell")
        .agg(F.sum("n").cast("int").alias("n"), F.bit_xor("x").alias("x"))
        .where("n != 0 or x != 0")
    )


def peeled(
    cells: DataFrame, keys: list[str], salt: int, steps: int = STEPS, digests: bool = True
) -> DataFrame:
    """Recovered digests (negative `cell`) and whatever cells are left (others), per pair.

    A digest is in one cell of a row, so taking the single ones of one row takes none twice.
    Without `digests`, one line per pair counts the recovered ones instead (cell -1, n).
    """
    for step in range(steps * ROWS):
        row = step % ROWS
        x, n, cell, width = F.col("x"), F.col("n"), F.col("cell"), F.col("width")
        digest = F.shiftright(x, 16)
        single = (
            (cell >= row * width) & (cell < (row + 1) * width) & (F.abs(n) == 1)
            & (_check(digest) == x.bitwiseAND(F.lit(0xFFFF).cast("long")))
        )
        places = _places(x, width, salt)
        taken = [
            F.struct(places[r].alias("cell"), (-n).alias("n"), "x") for r in range(ROWS) if r != row
        ]
        if digests:
            found = F.struct((-(1 + step * ROWS * width + cell)).cast("int").alias("cell"), "n", "x")
        else:
            found = F.struct(F.lit(-1).alias("cell"), F.lit(1).alias("n"), F.lit(0).cast("long").alias("x"))
        itself = F.array(F.struct("cell", "n", "x"))
        cells = _summed(
            cells.select(
                *keys, "width", F.inline(F.when(single, F.array(*taken, found)).otherwise(itself))
            ),
            keys,
        )
    return cells


def differences(
    pairs: DataFrame, keys: list[str], remade: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """How many digests differ between `a` and `b` of each pair that is not equal: keys,
    differing, tried (sketches taken; `TRIES` + 1 where the sets were compared instead).
    `remade` gives the pairs of some keys again, at less cost than a join with all of them."""
    done: list[DataFrame] = []
    todo = pairs
    for tried in range(1, TRIES + 1):
        salt = 100 * tried
        cells = peeled(subtracted(todo, keys, 3 ** (tried - 1), salt), keys, salt, digests=False)
        result = staged(
            cells.groupBy(keys).agg(
                F.coalesce(F.sum(F.when(F.col("cell") < 0, F.col("n"))), F.lit(0)).cast("int").alias("differing"),
                F.count_if(F.col("cell") >= 0).alias("left"),
            ),
            f"peeled-{tried}",
        )
        done.append(result.where("left = 0").select(*keys, "differing", F.lit(tried).alias("tried")))
        failed = staged(result.where("left > 0").select(keys), f"not-peeled-{tried}")
        if failed.isEmpty():
            break
        todo = remade(failed) if remade else pairs.join(failed, keys)
    else:
        exact = F.size(F.array_except("a", "b")) + F.size(F.array_except("b", "a"))
        done.append(todo.select(*keys, exact.alias("differing"), F.lit(TRIES + 1).alias("tried")))
    return functools.reduce(DataFrame.unionByName, done)


def fingerprints(once: DataFrame) -> DataFrame:
    """Per document (number) with words in its text or edited text: fingerprint and
    edited_fingerprint without their classes, the sketches as text: of every cell that is not empty
    its place, count and XOR; empty where there are no words."""

    def sketched(kind: int, text: Column, coarser: int) -> Column:
        return F.struct(F.lit(kind).alias("kind"), level(text, text["grain"] + coarser).alias("digests"))

    text, edited = F.col("text_units"), F.col("edited_units")
    sets = F.array(sketched(0, text, 0), sketched(1, text, 1), sketched(2, edited, 0), sketched(3, edited, 1))
    width = F.when(F.col("kind") % 2 == 0, FINE).otherwise(COARSE).cast("long")
    placed = (
        once.select("number", F.inline(sets))
        .select("number", "kind", width.alias("width"), F.explode("digests").alias("digest"))
        .select("number", "kind", "width", packed(F.col("digest")).alias("x"))
    )
    # The cells of a document's four sketches are numbered through: two short keys are summed by.
    each = ROWS * FINE
    cells = [
        F.struct((F.col("kind") * each + place).alias("slot"), "x")
        for place in _places(F.col("x"), F.col("width"), 0)
    ]
    summed = (
        placed.select("number", F.inline(F.array(*cells)))
        .groupBy("number", "slot")
        .agg(F.count("*").cast("int").alias("n"), F.bit_xor("x").alias("x"))
    )

    def sketch(kind: int) -> Column:
        at = F.col("slot") - kind * each
        held = F.collect_list(F.when((at >= 0) & (at < each), F.struct(at.alias("cell"), "n", "x")))
        return F.when(F.size(held) > 0, F.sort_array(held).cast("string"))

    return summed.groupBy("number").agg(
        F.concat_ws(":", sketch(0), sketch(1)).alias("fingerprint"),
        F.concat_ws(":", sketch(2), sketch(3)).alias("edited_fingerprint"),
    )


def neighbours(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document (id, version): its number in descending order, how often it stands in the
    table, the number of the document before it (last_number), its key and its length."""
    keys = docs.select("id", "version", F.length("text").alias("n")).groupBy("id", "version").agg(
        F.count("*").alias("copies"), F.first("n").alias("n")
    )
    order = [F.col("id").desc(), F.col("version").desc()]
    ranged = staged(
        keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "document-order"
    )
    parts = ranged.groupBy("part").agg(F.count("*").alias("size"))
    total = parts.agg(F.sum("size")).first()[0] or 1
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    numbered = staged(
        ranged.withColumn("place", place).join(bases, "part").select(
            "id", "version", "copies", "n", (F.col("base") + F.col("place") - 1).alias("number")
        ),
        "document-numbers",
    )

    last = numbered.select(
        F.pmod(F.col("number") + 1, F.lit(total)).alias("number"), F.col("number").alias("last_number"),
        F.col("id").alias("last_id"), F.col("version").alias("last_version"), F.col("n").alias("last_n"),
    )
    return numbered.drop("n").join(last, "number")


def compare_with_next(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row: id, its document's number, copies, the number of the document before it
    (last_number), n_chars, edited_sha256 and the kept paragraphs of text and edited text."""
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(SMALLEST)).alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("version"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    links = staged(neighbours(spark, keyed), "document-links")
    # The links are the narrow side: hashed, so that texts need no sort.
    texts = keyed.join(links.hint("shuffle_hash"), ["id", "version"])
    head = F.expr("substring(text, 1, CAST(floor(last_n / 3) AS INT))")
    heads = texts.select(
        F.col("last_id").alias("id"), F.col("last_version").alias("version"), head.alias("head"), "copies"
    )
    heads = heads.where("copies = 1").drop("copies").unionByName(
        heads.where("copies > 1").groupBy("id", "version").agg(F.min("head").alias("head"))
    )
    n = F.length("text")
    kept = F.expr("substring(text, 1, length(text) - CAST(floor(length(text) / 3) AS INT))")
    cut = (
        texts.join(heads, ["id", "version"])
        .select("id", "number", "copies", "last_number", n.alias("n_chars"), "text", kept.alias("kept"), "head")
        # Both texts begin with the kept part: its words before its last space are cut once for both.
        .withColumn("shared", F.length("kept") - F.length(F.substring_index("kept", " ", -1)))
        .select(
            "id", "number", "copies", "last_number", F.col("n_chars").cast("long").alias("n_chars"),
            F.sha2(F.concat("kept", "head"), 256).alias("edited_sha256"),
            words(F.expr("substring(text, 1, shared)")).alias("words"),
            words(F.expr("substring(text, shared + 1, n_chars)")).alias("text_words"),
            words(F.concat(F.expr("substring(kept, shared + 1, n_chars)"), "head")).alias("edited_words"),
        )
    )
    rows = cut.select(
        "id", "number", "copies", "last_number", "n_chars", "edited_sha256",
        word_units(F.concat("words", "text_words")).alias("text_units"),
        word_units(F.concat("words", "edited_words")).alias("edited_units"),
    )
    return staged(rows, "paragraph-digests")


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt by document, into more parts than other shuffles: the aggregations that follow
    hold a dozen cells for every digest dealt here."""
    parts = FINER * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, "number")


def once_each(made: DataFrame) -> DataFrame:
    """One row of every document, whose copies are all alike."""
    return made.where("copies = 1").unionByName(
        made.where("copies > 1").dropDuplicates(["number"])
    )


def likenesses(made: DataFrame) -> DataFrame:
    """Per document (number): near_edited, near_next and how many sketches it took (tries)."""
    once = once_each(made)
    following = once.select(F.col("last_number").alias("number"), F.col("text_units").alias("next_units"))
    once = once.select("number", "text_units", "edited_units")
    text, edited, after = F.col("text_units"), F.col("edited_units"), F.col("next_units")

    def pair(kind: int, other: Column) -> Column:
        grain = F.greatest(text["grain"], other["grain"])
        return F.struct(
            F.lit(kind).alias("kind"), level(text, grain).alias("a"), level(other, grain).alias("b")
        )

    def paired(once: DataFrame, following: DataFrame) -> DataFrame:
        both = dealt(once).join(dealt(following), "number")
        pairs = both.select("number", F.inline(F.array(pair(0, edited), pair(1, after))))
        # One key tells the pair of a document and how many digests it has in all.
        total = (F.size("a") + F.size("b")).cast("long")
        return pairs.select("number", (total * 2 + F.col("kind")).alias("pair"), "a", "b")

    def remade(failed: DataFrame) -> DataFrame:
        named = failed.select("number").distinct()
        return paired(
            once.join(named, "number", "left_semi"), following.join(named, "number", "left_semi")
        ).join(failed, keys, "left_semi")

    keys = ["number", "pair"]
    found = differences(paired(once, following), keys, remade)
    near = 1.0 - F.col("differing") / F.shiftright("pair", 1)
    kind = F.col("pair") % 2
    return found.groupBy("number").agg(
        F.max(F.when(kind == 0, near)).alias("near_edited"),
        F.max(F.when(kind == 1, near)).alias("near_next"),
        F.max("tried").alias("tries"),
    )


def op4(spark: SparkSession, docs: DataFrame) -> DataFrame:
    made = compare_with_next(spark, docs)
    once = dealt(once_each(made).select("number", "text_units", "edited_units"))
    # Texts without words have no cells; pairs of equal sets leave none: they are alike.
    named = made.join(fingerprints(once), "number", "left").join(likenesses(made), "number", "left")

    def classed(units: str, cells: str) -> Column:
        return F.concat_ws(":", F.col(units)["grain"].cast("string"), F.nullif(F.col(cells), F.lit("")))

    return named.select(
        F.when(F.col("id") != SMALLEST, F.col("id")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        classed("text_units", "fingerprint").alias("fingerprint"),
        classed("edited_units", "edited_fingerprint").alias("edited_fingerprint"),
        F.coalesce("near_edited", F.lit(1.0)).alias("near_edited"),
        F.coalesce("near_next", F.lit(1.0)).alias("near_next"),
    )
