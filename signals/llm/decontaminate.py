"""Benchmark decontamination by a prefix-filtered containment join, all in DataFrame operations.

Items are cut into windows of `window` consecutive words (an item of fewer words is one window)
and windows into shingles of up to `SHINGLE` words. A document contains a window exactly when it
contains its words in a row, so a window's necessary prefix is one shingle: the rarest in the
corpus. One pass over the documents keeps the positions at which any shingle of any item stands,
with the words around them; document frequencies, the prefix join, the bounds and the exact
comparison all work on that small table. A matching prefix fixes where its window would have to
start (positional bound); a start before the document or an end behind it is out (length bound);
what is left is compared word by word.

Item shingles are broadcast while there are at most `broadcast_shingles` of them and their texts
hold at most `broadcast_bytes` (both checked). Beyond that they are joined by shuffle: rows of that
join carry a position and its shingle only, and the words around are cut afterwards from the texts
of the documents that hold any, shuffled once. Both ways give the same positions. Positions grow
with what documents share with items; one document's positions are bounded by its text.

Null texts and texts without words have no words, no hits and no items. Items without words have
no windows; repeated items count once by id, null ids are not counted. Rows that repeat a
document are each returned. An empty table of either kind gives no hits. Other columns are unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signals.llm.common import staged, text_key

SHINGLE = 3
#: Starts the shingle of a document's own line (no word holds it), over `ENDS` keys.
END, ENDS = "\x00", 1024
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Capitals beyond A-Z, which only the slower way of lower-casing leaves alone.
OTHER_CAPITALS = r"[[\p{Lu}\p{Lt}\p{Nl}\p{So}]&&[^A-Z]]"


def ascii_lower(text):
    """A-Z in lower case, everything else as it is."""
    return F.when(text.rlike(OTHER_CAPITALS), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words_of(text):
    """Lower-cased words of a text, none for null."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORDS})"), F.lit(0))


def windows_of(items: DataFrame, window: int) -> DataFrame:
    """item_id, words of each window, its text and length."""
    words = items.select("item_id", words_of(F.col("text")).alias("all")).where(F.size("all") > 0)
    length = F.least(F.size("all"), F.lit(window))
    return (
        words.select(
            "item_id", "all", length.alias("length"),
            F.explode(F.sequence(F.lit(1), F.size("all") - length + 1)).alias("at"),
        )
        .select("item_id", "length", F.slice("all", F.col("at"), F.col("length")).alias("words"))
        .withColumn("window", F.array_join("words", " "))
        .distinct()
    )


def shingles_of(windows: DataFrame) -> DataFrame:
    """window, words, length, offset and shingle of each place in a window."""
    size = F.least(F.col("length"), F.lit(SHINGLE))
    return (
        windows.select("window", "words", "length")
        .distinct()
        .select("window", "words", "length", F.explode(F.sequence(F.lit(0), F.col("length") - size)).alias("offset"))
        .withColumn("shingle", F.array_join(F.slice("words", F.col("offset") + 1, size), " "))
    )


def marked_positions(
    docs: DataFrame, shingles: DataFrame, window: int, broadcast_shingles: int, broadcast_bytes: int
) -> DataFrame:
    """Where documents hold item shingles, with the words around, and one row more per document
    whose shingle is empty and whose position is its number of words."""
    keys = shingles.select("shingle", F.least("length", F.lit(SHINGLE)).alias("k")).distinct()
    keys = staged(keys, "item-shingles")
    found = keys.agg(
        F.count("*").alias("n"), F.sum(F.octet_length("shingle")).alias("bytes"), F.collect_set("k").alias("sizes")
    ).first()
    sizes = sorted(found["sizes"]) or [1]  # among 1, 2, 3
    own = docs.select("doc_id", text_key().alias("version"), "text")
    words, n = F.col("words"), F.size("words") - 1  # an empty word ends the list
    # A document's own line: its key is spread, so that no task gets the lines of all documents.
    end = F.concat(F.lit(END), F.pmod(F.xxhash64("doc_id", "version"), F.lit(ENDS)).cast("string"))
    ends = docs.sparkSession.range(ENDS).select(F.concat(F.lit(END), F.col("id").cast("string")).alias("shingle"))
    keys = keys.select("shingle").union(ends)

    def shingle(k: int):
        whole = F.concat_ws(" ", F.col("word"), *(F.get(words, F.col("pos") + i) for i in range(1, k)))
        return F.when(F.col("pos") == n, end if k == sizes[0] else None).when(F.col("pos") + k <= n, whole)

    made = [shingle(k) for k in sizes]
    placed = own.select(
        "doc_id", "version", F.concat(words_of(F.col("text")), F.array(F.lit(""))).alias("words")
    ).select("doc_id", "version", "words", F.posexplode_outer("words").alias("pos", "word"))
    placed = placed.withColumn("shingle", made[0] if len(made) == 1 else F.explode(F.array(*made)))
    first = F.greatest(F.col("pos") - window, F.lit(0))
    around = F.slice(words, first + 1, 2 * window)
    is_end = F.col("shingle").startswith(END)
    named = F.when(is_end, F.lit("")).otherwise(F.col("shingle")).alias("shingle")
    if found["n"] <= broadcast_shingles and (found["bytes"] or 0) <= broadcast_bytes:
        return staged(
            placed.join(F.broadcast(keys), "shingle").select(
                "doc_id", "version", "pos", named, n.alias("n_words"), first.alias("first"),
                F.when(~is_end, around).alias("around"),
            ),
            "item-shingle-positions",
        )
    places = staged(
        placed.select("doc_id", "version", "pos", "shingle", n.alias("n_words")).join(keys, "shingle"),
        "item-shingle-places",
    )
    spots = (
        places.where(~is_end)
        .groupBy(F.col("doc_id").alias("spot_id"), F.col("version").alias("spot_version"), "n_words")
        .agg(F.collect_set(F.struct("pos", "shingle")).alias("spots"))
    )
    cut = (
        own.join(spots, own.doc_id.eqNullSafe(spots.spot_id) & (own.version == spots.spot_version))
        .select("doc_id", "version", "n_words", words_of(F.col("text")).alias("words"), "spots")
        .select("doc_id", "version", "n_words", "words", F.inline("spots"))
        .select("doc_id", "version", "pos", "shingle", "n_words", first.alias("first"), around.alias("around"))
    )
    lines = places.where(is_end).select(
        "doc_id", "version", "pos", named, "n_words", F.lit(0).alias("first"),
        F.lit(None).cast("array<string>").alias("around"),
    )
    return staged(cut.union(lines), "item-shingle-positions")


def rarest(shingles: DataFrame, marks: DataFrame) -> DataFrame:
    """Each window's prefix: window, words, length, offset, shingle."""
    seen = marks.where("shingle <> ''").groupBy("shingle").agg(F.count("*").alias("n"))
    order = F.struct(F.coalesce("n", F.lit(0)), "shingle", "offset")
    return (
        shingles.join(seen, "shingle", "left")
        .groupBy("window", "words", "length")
        .agg(F.min(order).alias("least"))
        .select("window", "words", "length", F.col("least.offset").alias("offset"), F.col("least.shingle").alias("shingle"))
    )


def occurrences(
    docs: DataFrame, items: DataFrame, window: int = 10,
    broadcast_shingles: int = 2_000_000, broadcast_bytes: int = 1 << 27,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with their number of words, exact occurrences of windows, windows by item)."""
    windows = windows_of(items, window)
    shingles = shingles_of(windows)
    marks = marked_positions(docs, shingles, window, broadcast_shingles, broadcast_bytes)
    start = F.col("pos") - F.col("offset")
    found = (
        marks.where("shingle <> ''")
        .join(rarest(shingles, marks), "shingle")
        .where((start >= 0) & (start + F.col("length") <= F.col("n_words")))
        .where(F.slice("around", start - F.col("first") + 1, F.col("length")) == F.col("words"))
        .select("doc_id", "version", start.alias("start"), "length", "window")
    )
    every = marks.where("shingle = ''").select("doc_id", "version", "n_words")
    return every, found, windows.select("window", "item_id").distinct()


def covered(intervals):
    """Words covered by sorted distinct (start, length) pairs."""
    state = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def step(a, x):
        end = x["start"] + x["length"]
        return F.struct(
            (a["n"] + F.greatest(F.lit(0), end - F.greatest(x["start"], a["end"]))).alias("n"),
            F.greatest(a["end"], end).alias("end"),
        )

    return F.aggregate(F.array_sort(intervals), state, step, lambda a: a["n"])


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, **settings) -> DataFrame:
    """Per document row: doc_id, version, n_words, n_hit, items (sorted ids as strings)."""
    every, found, owners = occurrences(docs, items, window, **settings)
    hits = (
        found.join(owners, "window", "left")
        .groupBy("doc_id", "version")
        .agg(
            F.collect_set(F.struct("start", "length")).alias("intervals"),
            F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
        )
        .select(
            F.col("doc_id").alias("hit_id"), F.col("version").alias("hit_version"), "items",
            covered(F.col("intervals")).alias("n_hit"),
        )
    )
    same = every.doc_id.eqNullSafe(hits.hit_id) & (every.version == hits.hit_version)
    return every.join(hits, same, "left").select(
        "doc_id", "version", F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def op1(docs: DataFrame, items: DataFrame) -> DataFrame:
    return decontaminate(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, max_share: float = 0.0, **settings) -> DataFrame:
    """`docs` without rows of which more than `max_share` of the words are hit."""
    found = decontaminate(docs, items, **settings).where(
        (F.col("n_hit") > 0) & (F.col("n_hit") > max_share * F.col("n_words"))
    )
    bad = found.select(F.col("doc_id").alias("bad_id"), F.col("version").alias("bad_version")).distinct()
    same = docs.doc_id.eqNullSafe(bad.bad_id) & (text_key() == bad.bad_version)
    return docs.join(bad, same, "left_anti")


ORACLE_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), sized AS (SELECT *, least(10, len(w)) AS n FROM iw WHERE len(w) > 0
), starts AS (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized
), win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM starts
), lens AS (SELECT DISTINCT n FROM win
), places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n
), occ AS (
  SELECT p.doc_id, p.i, p.n, win.item_id
  FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM places) p
  JOIN win ON p.n = win.n AND p.t = win.t
), cov AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM occ) GROUP BY doc_id
), its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY doc_id
)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, coalesce(cov.n_hit, 0) AS n_hit,
  coalesce(its.n_items, 0) AS n_items, sha256(coalesce(its.ids, '')) AS items_sha256,
  coalesce(cov.n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""
