"""Quality classifier: a factorisation machine over hashed words and structure statistics.

A text becomes a sparse vector of hashed words (log-scaled counts, unit length) and a few measures
of its structure: shares of letters, capitals, digits, marks and white space, word and line
lengths, repeated words and lines. The score is sigmoid(w0 + w.x + pairs), and the pairwise part
sum over f of ((v_f.x)^2 - v_f^2.x^2) / 2 costs one pass over the vector, not one over pairs.

Training takes at most `max_rows` labelled rows, picked by a hash of the id (a bounded sample, as
documented), builds their vectors in Spark and fits on the driver; scoring is one pass over all
texts with the model shipped in the task closure (`BUCKETS` x (`RANK` + 1) numbers).

Null and empty texts get a score too (an empty vector of words and the measures of no text).
Rows that repeat an id are each scored. Without a single labelled row of each class every score
is 0.5. An empty table gives no rows. Labels, lang, source and doc_id never enter a score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
RANK = 8
THRESHOLD = 0.3
WORD = re.compile(r"\S+")
MEASURES = 18


def measures(text: str, words: list[str], counts: Counter) -> np.ndarray:
    """Structure of a text; every measure lies in about 0 to 1."""
    n = len(text)
    if not n:
        return np.zeros(MEASURES)
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ascii_only = raw[raw < 128]
    hist = np.bincount(ascii_only, minlength=128)
    upper, lower = hist[65:91].sum(), hist[97:123].sum()
    digits, spaces = hist[48:58].sum(), hist[[9, 10, 11, 12, 13, 32]].sum()
    stops = hist[[46, 63]].sum()
    marks = hist[33:].sum() - upper - lower - digits - hist[127]
    lines = text.split("\n")
    line_counts = Counter(lines)
    n_words = max(1, len(words))
    marked = sum(c for w, c in counts.items() if not w[-1].isalnum() and w[-1] not in ".,;:?")
    doubled = sum(c for w, c in counts.items() if len(w) > 1 and w[-1] == w[-2] and not w[-1].isalnum())
    bare = sum(c for w, c in counts.items() if not any(ch.isalnum() for ch in w))
    shouted = sum(c for w, c in counts.items() if len(w) > 1 and w.upper() == w and w.lower() != w)
    return np.array(
        [
            upper / n, lower / n, digits / n, spaces / n, marks / n, 1 - len(ascii_only) / n,
            min(1.0, 4 * stops / n_words), marked / n_words, doubled / n_words, bare / n_words,
            shouted / n_words, len(counts) / n_words, max(counts.values(), default=0) / n_words,
            min(1.0, sum(map(len, words)) / n_words / 20), min(1.0, len(lines) / n_words),
            1 - len(line_counts) / len(lines), min(1.0, np.log1p(n) / 12),
            min(1.0, hist[124] / n_words),
        ]
    )


def vector(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of a whole text."""
    text = text or ""
    words = text.split()
    counts = Counter(words)
    hashed: dict[int, float] = {}
    for word, n in counts.items():
        at = MEASURES + zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % BUCKETS
        hashed[at] = hashed.get(at, 0.0) + n
    values = np.log1p(np.fromiter(hashed.values(), float, len(hashed)))
    length = np.sqrt((values**2).sum())
    if length:
        values /= length
    at = np.fromiter(hashed.keys(), np.int64, len(hashed))
    return np.concatenate([np.arange(MEASURES), at]), np.concatenate(
        [measures(text, words, counts), values]
    )


class Machine:
    """Second-order factorisation machine with logistic loss, fitted by AdaGrad."""

    def __init__(self, seed: int = 7):
        size = MEASURES + BUCKETS
        self.w0 = 0.0
        self.w = np.zeros(size, dtype=np.float64)
        self.v = np.random.default_rng(seed).normal(0, 0.01, (size, RANK))
        self.trained = False

    def raw(self, at: np.ndarray, x: np.ndarray) -> float:
        vx = self.v[at] * x[:, None]
        sums = vx.sum(axis=0)
        return float(self.w0 + self.w[at] @ x + 0.5 * ((sums**2) - (vx**2).sum(axis=0)).sum())

    def score(self, text: str | None) -> float:
        z = self.raw(*vector(text)) if self.trained else 0.0
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 12, rate: float = 0.1, decay: float = 1e-5) -> Machine:
        """Both classes weigh the same in total."""
        labels = np.array([y for _, _, y in rows])
        if len(set(labels.tolist())) < 2:
            return self
        weight = {c: len(labels) / (2 * (labels == c).sum()) for c in (0, 1)}
        g0, gw, gv = 1e-6, np.full_like(self.w, 1e-6), np.full_like(self.v, 1e-6)
        order = np.random.default_rng(11)
        for _ in range(epochs):
            for i in order.permutation(len(rows)):
                at, x, y = rows[i]
                v = self.v[at]
                sums = (v * x[:, None]).sum(axis=0)
                z = self.w0 + self.w[at] @ x + 0.5 * ((sums**2) - ((v * x[:, None]) ** 2).sum(axis=0)).sum()
                slope = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight[y]
                dw = slope * x + decay * self.w[at]
                dv = slope * (x[:, None] * sums[None, :] - v * (x**2)[:, None]) + decay * v
                g0 += slope**2
                gw[at] += dw**2
                gv[at] += dv**2
                self.w0 -= rate * slope / np.sqrt(g0)
                self.w[at] -= rate * dw / np.sqrt(gw[at])
                self.v[at] -= 0.5 * rate * dv / np.sqrt(gv[at])
        self.trained = True
        return self


def remainder(doc_id="doc_id"):
    """crc32 of the id as text, modulo 5."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [vector(t.as_py()) for t in batch.column(0)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([a.tolist() for a, _ in made], pa.list_(pa.int64())),
                pa.array([x.tolist() for _, x in made], pa.list_(pa.float64())),
                batch.column(1),
            ],
            names=["at", "x", "quality"],
        )


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 4000) -> Machine:
    """Fitted on at most `max_rows` labelled rows whose id's remainder is not 0."""
    known = labels.where(F.col("quality").isin(0, 1) & (remainder() != 0)).select(
        "doc_id", F.col("quality").cast("int").alias("quality")
    )
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "quality")
    rows = texts.mapInArrow(_vectors, "at array<long>, x array<double>, quality int").collect()
    made = [(np.array(r.at), np.array(r.x), r.quality) for r in rows]
    made.sort(key=lambda r: (r[2], r[0].tolist(), r[1].tolist()))
    return Machine().fit(made)


def score(docs: DataFrame, machine: Machine, text: str = "text", name: str = "score") -> DataFrame:
    """`docs` in one struct column `row`, and the score of each row's text."""
    source = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.value.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], names=["row", name]
            )

    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(run, f"row {kind}, {name} double")


def op2(docs: DataFrame, labels: DataFrame) -> DataFrame:
    machine = train(docs, labels)
    return score(docs.select("doc_id", "text"), machine).select(
        F.col("row.doc_id").alias("doc_id"),
        F.coalesce(remainder("row.doc_id") == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **settings) -> DataFrame:
    """`docs` without those scored below `threshold`; without a fitted machine all stay."""
    machine = train(docs, labels, **settings)
    return score(docs, machine).where(F.col("score") >= threshold).select("row.*")
