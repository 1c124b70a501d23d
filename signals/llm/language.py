"""Language identification by Bayesian fusion of four kinds of evidence.

* Text: naive Bayes over hashed byte trigrams of the whole text, learned from documents with a
  known language (rows whose crc32(doc_id) mod 5 is 0 stay out, for measuring).
* Declared markup language and address suffix: likelihood of what is declared given a language,
  from sums of text posteriors, with a prior that favours the declared language itself.
* Host: prior of a host's languages, smoothed towards its domain's, and that towards the corpus's.
  A row's own posterior is taken out of its host's and domain's sums first.

All counts are grouped aggregates over all rows, the learned ones written once. A host has one
suffix, so suffixes are joined to hosts; the figures of hosts come back to the rows by a join in
which hosts with a large share of all rows are broadcast (`skew_join`). The text model is `BUCKETS` numbers a
language, and at most `max_languages` languages are told apart (codes are a closed set; more is an
error, not a cut).

Null and empty texts have no text evidence; without any evidence the corpus prior decides. Rows
that repeat an id are each returned. An empty table gives no rows. Only named columns are read.
"""

from __future__ import annotations

import html
import re
import urllib.parse
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signals.llm.common import staged
from signals.llm.ngram_join import skew_join

BUCKETS = 1 << 12
#: Byte trigrams overlap, so a text counts as a third of them; no text outweighs all else.
TEMPER, MOST = 1 / 3, 300.0
TAG = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.DOTALL | re.IGNORECASE)
DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})(?![A-Za-z])", re.IGNORECASE)
CUT = 1 << 20


def trigram_counts(text: str) -> np.ndarray:
    """Hashed byte trigrams of a whole text in lower case, white space as one space."""
    total = np.zeros(BUCKETS)
    data = (" " + " ".join(text.lower().split()) + " ").encode("utf-8", "surrogatepass")
    if len(data) < 3:
        return total
    for at in range(0, len(data) - 2, CUT):  # bounded memory for long texts
        b = np.frombuffer(data[at : at + CUT + 2], np.uint8).astype(np.uint32)
        grams = b[:-2] | (b[1:-1] << 8) | (b[2:] << 16)
        total += np.bincount((grams * np.uint32(2654435761)) >> np.uint32(20), minlength=BUCKETS)
    return total


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1), strict=True):
            counts, name = trigram_counts(text.as_py() or ""), lang.as_py()
            sums[name] = sums.get(name, 0) + counts
            rows[name] = rows.get(name, 0) + 1
    out = [(n, -1, float(rows[n])) for n in rows]
    out += [(n, int(b), float(c[b])) for n, c in sums.items() for b in np.flatnonzero(c)]
    columns = list(zip(*out, strict=True)) if out else [(), (), ()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.float64())],
        names=["lang", "bucket", "n"],
    )


def learn(docs: DataFrame, max_languages: int = 400) -> tuple[list[str], np.ndarray]:
    """Languages, and log P(trigram | language) by bucket."""
    known = docs.where(
        F.col("lang").isNotNull()
        & (F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) != 0)
    )
    counted = staged(
        known.select("text", "lang")
        .mapInArrow(_counts, "lang string, bucket int, n double")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n")),
        "language-counts",
    )
    if counted.where("bucket = -1").count() > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    rows = counted.where("bucket >= 0").toPandas()
    names = sorted(set(rows["lang"])) or ["und"]
    table = np.full((BUCKETS, len(names)), 0.5)
    for i, name in enumerate(names):
        own = rows[rows["lang"] == name]
        table[own["bucket"].to_numpy(), i] += own["n"].to_numpy()
    return names, np.log(table / table.sum(axis=0))


def address_parts(url: str | None) -> tuple[str | None, str | None, str | None]:
    """Host, domain (its last two names) and suffix (the last one) of an address."""
    try:
        host = urllib.parse.urlsplit(url or "").hostname
    except ValueError:
        host = None
    if not host:
        return None, None, None
    names = host.split(".")
    return host, ".".join(names[-2:]), names[-1] if len(names) > 1 else None


def _text_evidence(logs: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, markup, url in zip(*(batch.column(i) for i in (2, 3, 4)), strict=True):
                source, page = text.as_py() or "", markup.as_py()
                said = DECLARED.search(page or "")
                if page is not None:
                    source = html.unescape(TAG.sub(" ", page))
                counts = trigram_counts(source)
                logs_of = (counts @ logs) * min(TEMPER, MOST / max(1.0, counts.sum()))
                out.append((logs_of.tolist(), said[1].lower() if said else None, *address_parts(url.as_py())))
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = [pa.list_(pa.float64()), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(5), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "page_id", "site", "logs", "declared", "host", "domain", "suffix"],
            )

    return run


def _softmax(logs):
    top = F.array_max(logs)
    grown = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(grown, F.lit(0.0), lambda a, x: a + x)
    return F.transform(grown, lambda x: x / total)


def _sums(df: DataFrame, keys: list[str], width: int, name: str) -> DataFrame:
    """Sums of text posteriors by `keys`, as one array."""
    return df.groupBy(*keys).agg(F.array(*(F.sum(F.col("p")[i]) for i in range(width))).alias(name))


def _likelihood(df: DataFrame, key: str, names: list[str], weight: float, own: bool) -> DataFrame:
    """log P(key's value | language) by value; `own`: a value names a language itself."""
    sums = _sums(df.where(F.col(key).isNotNull()), [key], len(names), "sums")
    found = sums.agg(
        F.count("*").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"t{i}") for i in range(len(names)))
    ).first()
    values = max(1, found["n"])

    def chance(i: int):
        flat = F.lit(1.0 / values)
        prior = F.when(F.col(key) == names[i], 0.8).otherwise(0.2 / values) if own else flat
        return F.log((F.col("sums")[i] + weight * prior) / ((found[f"t{i}"] or 0.0) + weight))

    return sums.select(key, F.array(*map(chance, range(len(names)))).alias(f"{key}_logs"))


def identify(
    docs: DataFrame, pages: DataFrame, host_weight: float = 10.0, value_weight: float = 20.0
) -> DataFrame:
    """doc_id or page_id, lang and probability of every document and page."""
    names, logs = learn(docs)
    width = range(len(names))
    text = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), "text",
        F.lit(None).cast("string").alias("html"), F.lit(None).cast("string").alias("url"),
        F.col("source").cast("string").alias("site"),
    )
    web = pages.select(
        F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"),
        F.lit(None).cast("string").alias("text"), F.coalesce("html", F.lit("")).alias("html"), "url",
        F.lit(None).cast("string").alias("site"),
    )
    found = (
        text.unionByName(web)
        .mapInArrow(
            _text_evidence(logs),
            "doc_id long, page_id long, site string, logs array<double>, declared string, "
            "host string, domain string, suffix string",
        )
        # A document's source plays its host.
        .withColumn("host", F.coalesce("host", F.concat(F.lit("source:"), "site"), F.lit("")))
        .withColumn("domain", F.coalesce("domain", "host"))
    )
    rows = staged(found.withColumn("p", _softmax(F.col("logs"))), "language-evidence")
    hosts = staged(
        rows.groupBy("domain", "host", "suffix").agg(
            F.array(*(F.sum(F.col("p")[i]) for i in width)).alias("host_sums"), F.count("*").alias("in_rows")
        ),
        "language-hosts",
    )
    domains = hosts.groupBy("domain").agg(
        F.array(*(F.sum(F.col("host_sums")[i]) for i in width)).alias("domain_sums")
    )
    suffixes = _likelihood(hosts.withColumn("p", F.col("host_sums")), "suffix", names, value_weight, False)
    priors = hosts.join(domains, "domain").join(suffixes, "suffix", "left").drop("domain", "suffix")
    every = hosts.agg(
        F.sum("in_rows").alias("n"), *(F.sum(F.col("host_sums")[i]).alias(f"s{i}") for i in width)
    ).first()
    counts = [(every[f"s{i}"] or 0.0) + 1 for i in width]
    # At most 26^2 + 26^3 declared codes.
    fused = skew_join(rows.drop("domain", "suffix"), priors, "host", every["n"] or 0).join(
        F.broadcast(_likelihood(rows, "declared", names, value_weight, True)), "declared", "left"
    )
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    base = [F.lit(c / sum(counts)) for c in counts]

    def prior(i: int):
        domain = (F.col("domain_sums")[i] - F.col("p")[i] + host_weight * base[i]) / (
            total(F.col("domain_sums")) - 1 + host_weight
        )
        host = (F.col("host_sums")[i] - F.col("p")[i] + host_weight * domain) / (
            total(F.col("host_sums")) - 1 + host_weight
        )
        return F.log(F.greatest(host, F.lit(1e-9)))

    zero = F.lit(0.0)
    posterior = _softmax(
        F.array(
            *(
                F.col("logs")[i] + prior(i) + F.coalesce(F.col("declared_logs")[i], zero)
                + F.coalesce(F.col("suffix_logs")[i], zero)
                for i in width
            )
        )
    )
    known = F.array(*map(F.lit, names))
    return fused.select("doc_id", "page_id", posterior.alias("posterior")).select(
        "doc_id",
        "page_id",
        F.element_at(known, F.array_position("posterior", F.array_max("posterior")).cast("int")).alias("lang"),
        F.array_max("posterior").alias("probability"),
    )


def op9(docs: DataFrame, pages: DataFrame) -> DataFrame:
    return identify(docs, pages)
