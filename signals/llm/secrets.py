"""Secret scan with corpus-wide ownership frequency.

One pass finds candidates: the three base kinds, and further kinds of credential. Every candidate
value is hashed, and its hash counted by distinct repositories and owners over the whole corpus.
A value that many owners show is an example copied around; one that stays with few owners looks
live. Base spans are always reported; opaque strings, which are only suspicious by their looks,
are reported when they look live. Counting works on distinct (hash, owner, repository) rows after
map-side aggregation, and the counts go back to the spans by a salted join, so a value in a third
of all documents is one row per task and is spread over `SALTS` tasks.

Null text counts as empty. Rows that repeat an id are each scanned and returned. A null owner is
one owner. An empty table gives no rows. Input columns travel in one struct, so no name can clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signals.llm.common import staged

#: Kinds in the order in which spans that start together are listed; the first three are base.
KINDS = ("assign", "access", "hex", "key_block", "bearer", "login_url", "opaque")
BASE = 3
SALTS = 64
SPAN = "array<struct<kind:int,start:int,end:int,digest:string>>"

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
# Runs of one class: the shortest length in the pattern finds the same spans as a later check.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KEY_BLOCK = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*")
BEARER = re.compile(r"\b[Bb]earer\x20+([A-Za-z0-9+/_.=~-]{16,})")
LOGIN_URL = re.compile(r"\b[a-z][a-z0-9+.-]{1,20}://[^\s/:@]*:([^\s/:@]+)@")
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}(?![A-Za-z0-9+/_=-])")


def _mixed(value: str) -> bool:
    """Digits, capitals and small letters, and many different characters."""
    return (
        any(c.isdigit() for c in value)
        and any(c.isupper() for c in value)
        and any(c.islower() for c in value)
        and len(set(value)) >= 12
    )


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, secret value) in code points, by start, then kind."""
    out = []
    if "=" in text or ":" in text:
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                out.append((0, m.start(), m.end(), m[2]))
    if "AKIA" in text:
        out += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    out += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    if "-----BEGIN" in text:
        out += [(3, m.start(), m.end(), m[0]) for m in KEY_BLOCK.finditer(text)]
    if "earer " in text:
        out += [(4, m.start(), m.end(), m[1]) for m in BEARER.finditer(text)]
    if "://" in text:
        out += [(5, m.start(), m.end(), m[1]) for m in LOGIN_URL.finditer(text)]
    taken = [(a, b) for _, a, b, _ in out]
    for m in OPAQUE.finditer(text):
        if _mixed(m[0]) and not any(a < m.end() and m.start() < b for a, b in taken):
            out.append((6, m.start(), m.end(), m[0]))
    return sorted(out, key=lambda s: (s[1], s[0], s[2]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base_row = TaskContext.get().partitionId() << 33
    for batch in batches:
        spans, digests = [], []
        for text in batch.column(1):
            found = candidates(text.as_py() or "")
            spans.append(
                [
                    (k, a, b, hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest()[:32])
                    for k, a, b, v in found
                ]
            )
            base = ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b, _ in found if k < BASE)
            digests.append(hashlib.sha256(base.encode()).hexdigest())
        span = pa.struct(
            [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("digest", pa.string())]
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([base_row + i for i in range(batch.num_rows)], pa.int64()),
                *(batch.column(i) for i in (0, 2, 3)),
                pa.array(
                    [[dict(zip(span.names, s, strict=True)) for s in row] for row in spans],
                    pa.list_(span),
                ),
                pa.array(digests, pa.string()),
            ],
            names=["row_id", "row", "owner", "repository", "spans", "base_sha256"],
        )
        base_row += batch.num_rows


def find(docs: DataFrame, owner: str, repository: list[str], keep: list[str]) -> DataFrame:
    """A written table: row_id, row (the kept columns), owner, repository, spans, base_sha256."""
    source = docs.select(
        F.struct(*keep).alias("row"),
        F.col("text").alias("text"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.to_json(F.struct(*repository)).alias("repository"),
    )
    kind = source.schema["row"].dataType.simpleString()
    schema = f"row_id long, row {kind}, owner string, repository string, spans {SPAN}, base_sha256 string"
    return staged(source.mapInArrow(_find, schema), "secret-candidates")


def ownership(found: DataFrame) -> DataFrame:
    """Per candidate hash: in how many documents, repositories and owners it stands."""
    each = found.select("owner", "repository", F.explode("spans.digest").alias("digest"))
    pairs = each.groupBy("digest", "owner", "repository").agg(F.count("*").alias("n"))
    owners = pairs.groupBy("digest", "owner").agg(
        F.count("*").alias("repositories"), F.sum("n").alias("n")
    )
    return owners.groupBy("digest").agg(
        F.count("*").alias("n_owners"),
        F.sum("repositories").alias("n_repositories"),
        F.sum("n").alias("n_found"),
    )


def judge(found: DataFrame, max_owners: int = 3, max_repositories: int = 8) -> DataFrame:
    """Per row with candidates: row_id, judged (spans with live, sorted)."""
    copied = (
        ownership(found)
        .where((F.col("n_owners") > max_owners) | (F.col("n_repositories") > max_repositories))
        .select("digest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("copied"))
    )
    spans = found.select(
        "row_id", F.pmod(F.xxhash64("row_id"), F.lit(SALTS)).cast("int").alias("salt"), F.inline("spans")
    )
    return (
        spans.join(copied, ["digest", "salt"], "left")
        .groupBy("row_id")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("start", "kind", "end", F.col("copied").isNull().alias("live")))
            ).alias("judged")
        )
    )


def scan(
    docs: DataFrame,
    owner: str = "source",
    repository: tuple[str, ...] = ("source", "lang"),
    keep: list[str] | None = None,
    max_owners: int = 3,
    max_repositories: int = 8,
) -> DataFrame:
    """row (the kept columns, all by default), judged spans (start, kind, end, live), base_sha256."""
    found = find(docs, owner, list(repository), keep or docs.columns)
    judged = judge(found.where(F.size("spans") > 0), max_owners, max_repositories)
    hit = found.where(F.size("spans") > 0).select("row_id", "row", "base_sha256").join(judged, "row_id")
    clean = found.where(F.size("spans") == 0).withColumn(
        "judged", F.array().cast("array<struct<start:int,kind:int,end:int,live:boolean>>")
    )
    columns = ["row", "judged", "base_sha256"]
    return hit.select(columns).unionByName(clean.select(columns))


def reported(judged):
    """Spans to report: all but opaque strings that are copied around."""
    return F.filter(judged, lambda s: (s["kind"] < KINDS.index("opaque")) | s["live"])


def op3(docs: DataFrame) -> DataFrame:
    rows = scan(docs, keep=["doc_id"]).withColumn("judged", reported(F.col("judged")))
    names = F.array(*map(F.lit, KINDS))

    def count(kind: int):
        return F.size(F.filter("judged", lambda s: s["kind"] == kind)).cast("long")

    return rows.select(
        F.col("row.doc_id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        "base_sha256",
        F.concat_ws(
            ",",
            F.transform(
                "judged",
                lambda s: F.concat_ws(
                    ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
                ),
            ),
        ).alias("spans"),
        F.size(F.filter("judged", lambda s: s["live"])).cast("long").alias("n_live"),
    )


def _blank(mask: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                text, out, at = text.as_py(), [], 0
                for span in spans.as_py():
                    if span["end"] > at:
                        out += [text[at : max(at, span["start"])], mask]
                        at = span["end"]
                texts.append("".join(out) + text[at:])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["row", "masked"]
            )

    return run


def mask_live(docs: DataFrame, mask: str = "[secret]", **settings) -> DataFrame:
    """`docs` with every live-looking secret replaced; documents and columns all stay."""
    rows = scan(docs, **settings).withColumn("live", F.filter("judged", lambda s: s["live"]))
    kind = rows.schema["row"].dataType.simpleString()
    hit = rows.where(F.size("live") > 0).select("row", F.col("row.text").alias("text"), "live")
    masked = hit.mapInArrow(_blank(mask), f"row {kind}, masked string")
    rest = rows.where(F.size("live") == 0).select("row", F.col("row.text").alias("masked"))

    def column(name: str):
        if name == "text":
            return F.col("masked").alias("text")
        if name == "n_chars":
            return F.length("masked").cast("long").alias("n_chars")
        return F.col("row").getField(name).alias(name)

    return masked.unionByName(rest).select(*(column(c) for c in docs.columns))
