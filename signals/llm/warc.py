"""WARC archives: written as plain Spark output, read by a Python data source.

Writing makes one record per page. Of the pages with one payload (by SHA-1), the one with the
largest id becomes a `response`; the others become `revisit` records that refer to it and carry no
payload. The winner is found by partial aggregation per digest and goes back to the pages by a
salted join, so a payload that a third of all pages share is spread over `SALTS` tasks. Payloads
go through that join compressed.

A record is its header block and content, and records are separated by an empty line, so Spark's
text writer with that separator writes the archive to whatever store the path names.

The data source plans one partition per archive file (files are bounded by the writer's
partitions). Record types, page ids and headers asked for are pushed down: every record's headers
are parsed first, and the content of a record that is not wanted is skipped by its length without
being read into a string or decoded. With `payload` not asked for, no content is decoded at all.

Null html counts as an empty payload. A null id is allowed and never wins over another id. Rows
that repeat the winning id with its payload are all responses. An empty table gives an archive
without records. Only page_id, url and html are read.
"""

from __future__ import annotations

import base64
import hashlib
import os
import urllib.parse
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from signals.llm.common import fresh_path

SALTS = 64
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n"
DATE = "2026-01-01T00:00:00Z"
SCHEMA = (
    "page_id long, record_type string, target_uri string, payload_digest string, "
    "payload_bytes long, refers_to long, payload binary"
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payloads = [(h.as_py() or "").encode() for h in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([digest(p) for p in payloads], pa.string()),
                pa.array([len(p) for p in payloads], pa.int64()),
            ],
            names=["page_id", "url", "digest", "n_bytes"],
        )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests, and payloads compressed for the way through the shuffle."""
    codec = pa.Codec("brotli", compression_level=5)
    for batch in batches:
        payloads = [(h.as_py() or "").encode() for h in batch.column(2)]
        (coded,) = _digests([batch])
        packed = pa.array([codec.compress(p, asbytes=True) for p in payloads], pa.binary())
        yield pa.RecordBatch.from_arrays([*coded.columns, packed], names=[*coded.schema.names, "packed"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec("brotli")
    for batch in batches:
        at = batch.schema.get_field_index("packed")
        html = [
            None if p is None else codec.decompress(p, decompressed_size=n, asbytes=True).decode()
            for p, n in zip(batch.column(at).to_pylist(), batch.column("n_bytes").to_pylist(), strict=True)
        ]
        yield batch.set_column(at, "html", pa.array(html, pa.string()))


def with_winners(pages: DataFrame, min_revisit_bytes: int) -> DataFrame:
    """page_id, url, digest, n_bytes, winner (the page others of its payload refer to), revisit,
    html (null for revisits)."""
    raw = pages.select("page_id", "url", "html")
    schema = "page_id long, url string, digest string, n_bytes long"
    hashed = raw.mapInArrow(_packed, f"{schema}, packed binary").withColumn(
        "salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
    )
    winners = (
        raw.select("page_id", F.lit("").alias("url"), "html")
        .mapInArrow(_digests, schema)
        .where(F.col("n_bytes") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("winner"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("digest", "winner", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    revisit = F.col("winner").isNotNull() & ~F.col("winner").eqNullSafe(F.col("page_id"))
    return (
        hashed.join(winners, ["digest", "salt"], "left")
        .withColumn("revisit", revisit)
        .select(
            "page_id", "url", "digest", "n_bytes", "winner", "revisit",
            F.when(~F.col("revisit"), F.col("packed")).alias("packed"),
        )
        .mapInArrow(_unpacked, f"{schema}, winner long, revisit boolean, html string")
    )


def records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """One column `value`: each page's whole WARC record without the separator after it."""
    rows = with_winners(pages, min_revisit_bytes)
    revisit = F.col("revisit")
    uri = F.coalesce(F.regexp_replace("url", r"[\r\n]", ""), F.lit(""))
    body = F.when(revisit, F.lit("")).otherwise(
        F.concat(
            F.lit(HTTP.split("{n}")[0]), F.col("n_bytes").cast("string"), F.lit(HTTP.split("{n}")[1]),
            F.coalesce("html", F.lit("")),
        )
    )
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), _uuid("page_id", "digest"), F.lit(">")),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(
            revisit,
            F.concat(F.lit("WARC-Refers-To: <urn:uuid:"), _uuid("winner", "digest"), F.lit(">")),
        ),
        F.when(
            revisit,
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ),
        # Extension fields: the page's own number, the referred page's, the full payload's length.
        F.concat(F.lit("X-Page-ID: "), F.col("page_id").cast("string")),
        F.when(revisit, F.concat(F.lit("X-Refers-To-Page-ID: "), F.col("winner").cast("string"))),
        F.concat(F.lit("X-Payload-Length: "), F.col("n_bytes").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    )
    return rows.select(F.concat(head, F.lit(END), body).alias("value"))


def _uuid(page_id: str, digest_column: str):
    """A name of a page and payload in the form of a UUID."""
    h = F.md5(F.concat_ws("/", F.col(page_id).cast("string"), F.col(digest_column)))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *(F.substring(h, a, n) for a, n in cuts))


def write_warc(pages: DataFrame, path: str, min_revisit_bytes: int = 0) -> str:
    """Archives of `pages`: one file per output partition of Spark's text writer."""
    records(pages, min_revisit_bytes).write.option("lineSep", END).text(path)
    return path


def _open(path: str):
    """A binary stream of a file in any store; plain open() for local and shared folders."""
    parsed = urllib.parse.urlparse(path)
    if parsed.scheme in ("", "file"):
        return open(urllib.parse.unquote(parsed.path), "rb")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_stream(inner, buffer_size=1 << 20)


def _files(path: str) -> list[str]:
    parsed = urllib.parse.urlparse(path)
    if parsed.scheme in ("", "file"):
        folder = urllib.parse.unquote(parsed.path)
        if os.path.isfile(folder):
            return [folder]
        names = sorted(n for n in os.listdir(folder) if n[0] not in "._")
        return [os.path.join(folder, n) for n in names]
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    if system.get_file_info(inner).type == fs.FileType.File:
        return [path]
    found = system.get_file_info(fs.FileSelector(inner))
    names = sorted(f.base_name for f in found if f.type == fs.FileType.File)
    return [f"{path.rstrip('/')}/{n}" for n in names if n[0] not in "._"]


def parse(stream, wanted) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, content) of each record; the content of one that `wanted` refuses is skipped.

    `wanted(headers)` gives None to pass over a record, False for its headers alone, True for all.
    """
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.partition(b":")
            headers[name.decode("ascii").strip().lower()] = value.decode().strip()
        length = int(headers["content-length"])
        use = wanted(headers)
        if use:
            content = stream.read(length)
            if len(content) != length:
                raise ValueError("a record ends before its length")
            yield headers, content
        else:
            stream.seek(length, os.SEEK_CUR) if stream.seekable() else stream.read(length)
            if use is not None:
                yield headers, None


class ArchivePart(InputPartition):
    def __init__(self, path: str):
        self.path = path


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        types = options.get("record_types", "")
        self.types = {t for t in types.split(",") if t} or None
        self.ids: set[int] | None = None
        self.payload = options.get("payload", "true").lower() == "true"

    def partitions(self) -> list[ArchivePart]:
        return [ArchivePart(p) for p in _files(self.path)]

    def _wanted(self, headers: dict[str, str]) -> bool | None:
        if self.types is not None and headers.get("warc-type") not in self.types:
            return None
        if self.ids is not None and _number(headers.get("x-page-id")) not in self.ids:
            return None
        return self.payload and headers.get("warc-type") == "response"

    def read(self, partition: ArchivePart) -> Iterator[tuple]:
        with _open(partition.path) as stream:
            for headers, content in parse(stream, self._wanted):
                body = None if content is None else content.partition(b"\r\n\r\n")[2]
                name = headers.get("warc-payload-digest", "").removeprefix("sha1:")
                if body is not None and digest(body) != name:
                    raise ValueError(f"a payload does not match its digest {name}")
                yield (
                    _number(headers.get("x-page-id")), headers.get("warc-type"),
                    headers.get("warc-target-uri"), name, _number(headers.get("x-payload-length")),
                    _number(headers.get("x-refers-to-page-id")), body,
                )


class PushingReader(ArchiveReader):
    """With filter push-down; Spark refuses such a reader where the session does not allow it."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality and membership on record_type and page_id; the rest goes back to Spark."""
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            column = f.attribute if values is not None else None
            if column == ("record_type",):
                self.types = values if self.types is None else self.types & values
            elif column == ("page_id",):
                self.ids = values if self.ids is None else self.ids & values
            else:
                yield f


def _number(text: str | None) -> int | None:
    return int(text) if text else None


class WarcSource(DataSource):
    """format("warc"): options path, record_types (comma-joined), payload and pushdown (true or
    false)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        pushing = self.options.get("pushdown", "false").lower() == "true"
        return (PushingReader if pushing else ArchiveReader)(dict(self.options))


def read_warc(
    spark: SparkSession, path: str, record_types: list[str] | None = None, payload: bool = True
) -> DataFrame:
    """The archives' records. Filters on record_type and page_id are pushed into the source where
    the session sets spark.sql.python.filterPushdown.enabled; `record_types` is pushed always."""
    spark.dataSource.register(WarcSource)
    allowed = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    reader = spark.read.format("warc").options(payload=str(payload).lower(), pushdown=allowed)
    if record_types is not None:
        reader = reader.option("record_types", ",".join(record_types))
    return reader.load(path)


def op8(spark: SparkSession, pages: DataFrame) -> DataFrame:
    path = write_warc(pages, fresh_path(spark, "warc"))
    return read_warc(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
