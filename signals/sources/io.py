"""Reading sources, checking contracts, writing tables.

Nothing here touches business values. Contracts are checked before anything is written,
so a bad month never leaves a half-loaded set of tables behind.
"""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.sources.manifest import Manifest, absent
from signals.sources.schemas import PREDICTION_LABELS, PREDICTION_SCHEMA, SCHEMAS, SOURCES


class ContractError(ValueError):
    """A source or a prediction table does not honour its contract."""


def read_source(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """One source untouched. The declared schema is applied, never inferred.

    For self-describing parquet the file's own columns are kept, so that a missing
    column is reported by ``check_contract`` and not read as NULL.
    """
    reader = spark.read
    if fmt == "parquet":
        return reader.parquet(path)
    if fmt == "csv":
        # The schema is enforced by header name, not by position.
        header = reader.option("header", True).csv(path)
        wanted = {f.name: f.dataType for f in SCHEMAS[name].fields}
        return header.select(
            *[
                F.col(c).cast(wanted[c]).alias(c) if c in wanted else F.col(c)
                for c in header.columns
            ]
        )
    return reader.schema(SCHEMAS[name]).format(fmt).load(path)


def check_contract(name: str, df: DataFrame | None) -> DataFrame:
    """The frame itself if present, complete and non-empty; otherwise ContractError."""
    if df is None:
        raise ContractError(f"source '{name}' is missing")
    missing = [c for c in SCHEMAS[name].names if c not in df.columns]
    if missing:
        raise ContractError(f"source '{name}' lacks columns: {', '.join(missing)}")
    if df.isEmpty():
        raise ContractError(f"source '{name}' is empty")
    return df


def load_all(sources: Mapping[str, DataFrame], out_dir: str, run_id: int = 1) -> str:
    """Check all sources, write all into a folder of this run, then publish the folder.

    A failed check writes nothing. A source that fails while it is written leaves the load
    published before it readable as it was: never some sources of one month and some of another.
    The writes run side by side. Returns the folder.
    """
    checked = {name: check_contract(name, sources.get(name)) for name in SOURCES}
    manifest = Manifest(next(iter(checked.values())).sparkSession, out_dir)
    folder = manifest.fresh(f"load-{run_id}")
    with ThreadPoolExecutor(len(checked)) as pool:
        writes = [
            pool.submit(df.write.parquet, f"{folder}/raw_{name}") for name, df in checked.items()
        ]
    for write in writes:
        write.result()
    manifest.add("load", run_id, "", folder)
    return folder


def loaded(spark: SparkSession, out_dir: str) -> str | None:
    """The folder of the newest complete load, None before the first."""
    newest = Manifest(spark, out_dir).last("load")
    return newest.folder if newest else None


def load_summary(sources: Mapping[str, DataFrame]) -> DataFrame:
    """table, rows, columns of each loaded source."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).alias("column_count"),
        )
        for name, df in sources.items()
    ]
    return union_all(parts)


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    parts = list(parts)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def check_predictions(predictions: DataFrame) -> DataFrame:
    """Required columns, one row per comment, no NULL among the five labels."""
    missing = [c for c in PREDICTION_SCHEMA.names if c not in predictions.columns]
    if missing:
        raise ContractError(f"predictions lack columns: {', '.join(missing)}")
    # Collapsed per id on the map side first, so one heavily repeated id stays cheap.
    per_id = predictions.groupBy("comment_id").agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in PREDICTION_LABELS],
    )
    found = per_id.agg(
        F.count_if(F.col("n") > 1).alias("duplicates"),
        *[F.sum(c).alias(c) for c in PREDICTION_LABELS],
    ).first()
    if found["duplicates"]:
        raise ContractError(f"{found['duplicates']} comment_id values are repeated")
    holes = [c for c in PREDICTION_LABELS if found[c]]
    if holes:
        raise ContractError(f"predictions have NULL in: {', '.join(holes)}")
    return predictions


EXPORT_COLUMNS = [
    "comment_id", "platform", "published_at", "author_handle",
    "comment_text", "like_count", "reply_to_id",
]


def export_comments(comments: DataFrame, path: str) -> None:
    """Comment texts for an external classifier, ordered by id; repeated ids are refused."""
    rows = stage(comments.select(*EXPORT_COLUMNS))
    repeated = rows.groupBy("comment_id").count().filter("count > 1")
    if not repeated.isEmpty():
        raise ContractError("comment_id is not unique, nothing exported")
    rows.orderBy("comment_id").write.mode("overwrite").parquet(path)


def write_mart(df: DataFrame, path: str) -> None:
    """Overwrite a table whole."""
    df.write.mode("overwrite").parquet(path)


def available(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when it has not been built yet. One that is there but cannot
    be read is an error."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if absent(error):
            return None
        raise


@functools.cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="signals-")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, as the cluster names it in spark.checkpoint.dir."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder(spark.sparkContext.applicationId)


def stage(df: DataFrame) -> DataFrame:
    """Write a frame that several consumers read, and return it read back.

    Cuts lineage with a plain parquet table in the shared folder: a lost executor costs
    a re-read, and the work upstream is not repeated once per consumer.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/signals-stage/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_union(parts: Iterable[DataFrame], at_once: int = 4) -> DataFrame:
    """All rows of frames of one schema, each written by a run of its own, a few side by side: never
    the plans and shuffle files of all of them at once."""
    parts = list(parts)
    spark, schema = parts[0].sparkSession, parts[0].schema
    path = f"{shared_dir(spark)}/signals-stage/{uuid.uuid4().hex}"
    folders = [f"{path}/{n}" for n in range(len(parts))]
    with shuffles_dropped(spark), ThreadPoolExecutor(at_once) as pool:
        list(pool.map(lambda part, folder: part.select(*schema.names).write.parquet(folder), parts, folders))
    return spark.read.schema(schema).parquet(*folders)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Drop the shuffle files of everything run meanwhile when its run ends.

    Otherwise they stay on the disks until the driver happens to collect its garbage. For frames
    that run once, like those that are written.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
