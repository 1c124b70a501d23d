"""Token ids as Parquet list columns: dictionary or delta encoded, with bounded row groups and
pages, sorted by document so that page indexes let a reader skip to the documents it wants.

Each file holds one range of documents in ascending order and says where in the file's token
stream each document starts. A document's place in the whole stream is that plus the lengths of
the files before it, which one small table over files gives: no window over all documents.

Null text counts as empty. Repeated and null ids are kept, nulls first, ties by text. An empty
table gives an empty file set. Only the id and text columns are read; others may clash freely.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signals.llm.common import fresh_path
from signals.llm.tokens import vocabulary_path, worker_encoder

FILE_SCHEMA = "doc_id long, part int, start_in_part long, n_tokens long, tokens array<int>"
#: Text encoded at once; a longer one is encoded alone.
SLICE_BYTES = 8 << 20


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with up to `SLICE_BYTES` of text (the second column), or one row."""
    size = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy())
    first = 0
    while first < batch.num_rows:
        before = size[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(size, before + SLICE_BYTES, side="right")))
        yield batch.slice(first, last - first)
        first = last


def _encode_part(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, end_id)
        part = TaskContext.get().partitionId()
        start = 0
        for batch in batches:
            for piece in slices(batch):
                counts, ids = encoder.encode_column(piece.column(1))
                ends = np.cumsum(counts)
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        pa.array(np.full(len(counts), part, dtype=np.int32)),
                        pa.array(start + ends - counts),
                        pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.view("<i4"))),
                    ],
                    names=["doc_id", "part", "start_in_part", "n_tokens", "tokens"],
                )
                start += int(ends[-1])

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int = 1,
    encoding: str = "dictionary",
    row_group_bytes: int = 32 << 20,
    page_rows: int = 2000,
    codec: str = "zstd",
) -> str:
    """Writes the ids of every document to `path`, in ascending id order over all files.

    `encoding`: 'dictionary' (bit-packed indexes) or 'delta' (binary packed differences).
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"no such encoding: {encoding}")
    ranged = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    )
    coded = ranged.mapInArrow(_encode_part(vocabulary, end_id), FILE_SCHEMA)
    writer = (
        coded.write.option("compression", codec)
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .option("parquet.dictionary.page.size", 1 << 20)
    )
    if encoding == "delta":
        writer = writer.option("parquet.writer.version", "PARQUET_2_0").option(
            "parquet.enable.dictionary#tokens.list.element", "false"
        )
    writer.parquet(path)
    return path


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The files' rows; with `columns`, only those are read. Filters on doc_id skip pages."""
    stored = spark.read.schema(FILE_SCHEMA).parquet(path)
    return stored.select(*columns) if columns else stored


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each file: (part, base). Reads two metadata columns, returns a row per file."""
    sizes = (
        read_tokens(spark, path, ["part", "n_tokens"])
        .groupBy("part")
        .agg(F.sum("n_tokens").alias("size"))
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = batch.column(3)
        offsets = tokens.offsets.to_numpy()
        values = tokens.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        crc = [
            zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())],
            names=["doc_id", "part", "start_in_part", "n_tokens", "ids_crc32"],
        )


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    rows = read_tokens(spark, path, ["doc_id", "part", "start_in_part", "tokens"]).mapInArrow(
        _checksums, "doc_id long, part int, start_in_part long, n_tokens long, ids_crc32 long"
    )
    return rows.join(part_starts(spark, path), "part").select(
        "doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32"
    )


def op5(spark: SparkSession, docs: DataFrame) -> DataFrame:
    path = write_tokens(docs, fresh_path(spark, "token-ids"), vocabulary_path())
    return token_digest(spark, path)
