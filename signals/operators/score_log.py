"""A log of scored comments: scored in slices, resumed where it stopped, compacted by key.

A run works through the comments its version has not scored, slice by slice (by a hash of the id).
A finished slice is recorded in the manifest; the same run id started again skips it, so what was
scored once is not scored again, and a slice that was cut off is written anew. Compaction merges
everything recorded so far into key buckets, one row per version and comment, and is recorded in
the same way: readers take the newest compacted set and the slices after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.operators import scoring
from signals.params import Params
from signals.sources.io import ContractError
from signals.sources.manifest import Manifest

TODO_SCHEMA = "comment_id string, comment_text string, slice int"
LOG_SCHEMA = (
    "comment_id string, comment_text string, language_model string, sentiment_model string, "
    "theme_model string, product_model string, is_spam_model boolean, model_used boolean, "
    "rules_complete boolean, coerced array<string>, classifier_version string, run_id long"
)
FAILED_SCHEMA = "comment_id string, comment_text string, error string, run_id long"


class ScoreLog:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.manifest = Manifest(spark, path)

    # --- reading ---------------------------------------------------------------------------
    def live_folders(self) -> list[str]:
        """The newest compacted set and the slices recorded after it."""
        folders: list[str] = []
        for entry in self.manifest.entries("slice", "compact"):
            folders = [entry.folder] if entry.kind == "compact" else [*folders, entry.folder]
        return folders

    def rows(self) -> DataFrame | None:
        """Every recorded prediction that compaction has not replaced; None before the first."""
        folders = self.live_folders()
        return self.spark.read.schema(LOG_SCHEMA).parquet(*folders) if folders else None

    def current(self, version: str) -> DataFrame | None:
        """The newest prediction per comment of one version, never mixed with another."""
        rows = self.rows()
        if rows is None:
            return None
        return scoring.keep_last(rows.where(F.col("classifier_version") == version))

    def failures(self, run_id: int) -> DataFrame:
        """comment_id, comment_text, error of the comments a run could not score."""
        folders = [f"{e.folder}-failed" for e in self.manifest.entries("slice") if e.run_id == run_id]
        if not folders:
            return self.spark.createDataFrame([], FAILED_SCHEMA).drop("run_id")
        return self.spark.read.schema(FAILED_SCHEMA).parquet(*folders).drop("run_id")

    # --- scoring ---------------------------------------------------------------------------
    def _todo(self, comments: DataFrame, version: str, run_id: int, slices: int) -> tuple[DataFrame, int]:
        """The run's comments as they were when it first started, and its number of slices."""
        planned = [e for e in self.manifest.entries("todo") if e.run_id == run_id]
        if planned:
            known, count = planned[0].part.rsplit("/", 1)
            if known != version:
                raise ContractError(f"run {run_id} belongs to version {known}")
            return self.manifest.read(planned[0].folder, TODO_SCHEMA), int(count)
        texts = comments.where("comment_text <> ''").select("comment_id", "comment_text").distinct()
        log = self.rows()
        if log is not None:
            texts = scoring.new_only(texts, log, version)
        share = F.pmod(F.xxhash64("comment_id"), F.lit(slices)).cast("int")
        folder = self.manifest.fresh(f"todo-{run_id}")
        texts.withColumn("slice", share).write.partitionBy("slice").parquet(folder)
        self.manifest.add("todo", run_id, f"{version}/{slices}", folder)
        return self.manifest.read(folder, TODO_SCHEMA), slices

    def score(
        self,
        comments: DataFrame,
        version: str,
        run_id: int,
        scorer: scoring.Scorer | None = None,
        slices: int = 8,
    ) -> None:
        """Score what the version lacks. Started again with its run id, it does what is left."""
        if any(e.run_id == run_id for e in self.manifest.entries("run")):
            return
        todo, slices = self._todo(comments, version, run_id, slices)
        done = {e.part for e in self.manifest.entries("slice") if e.run_id == run_id}
        for number in range(slices):
            if str(number) in done:
                continue
            part = todo.where(F.col("slice") == number).drop("slice")
            scored, failed = scoring.predict_reporting(part, scorer)
            folder = self.manifest.fresh(f"rows-{run_id}-{number}")
            stamp = F.lit(run_id).cast("long")
            scored.withColumn("classifier_version", F.lit(version)).withColumn("run_id", stamp).write.parquet(
                folder
            )
            failed.withColumn("run_id", stamp).write.parquet(f"{folder}-failed")
            self.manifest.add("slice", run_id, str(number), folder)
        self.manifest.add("run", run_id, version, "")

    # --- compaction ------------------------------------------------------------------------
    def compact(self, buckets: int = 16) -> None:
        """Merge the live rows into `buckets` files by key, the newest row per version and comment.

        The new set replaces the old ones when its manifest row is there; a failure before that
        changes nothing. Replaced folders stay as the archive.
        """
        rows = self.rows()
        if rows is None:
            return
        newest = self.manifest.last("slice", "compact")
        folder = self.manifest.fresh("compact")
        (
            scoring.keep_last(rows, "classifier_version")
            .repartition(buckets, "comment_id")
            .sortWithinPartitions("classifier_version", "comment_id")
            .select(*[c.split()[0] for c in LOG_SCHEMA.split(", ")])
            .write.parquet(folder)
        )
        self.manifest.add("compact", newest.run_id, str(buckets), folder)


def incremental_score(
    comments: DataFrame,
    path: str,
    run_id: int,
    params: Params = Params(),
    scorer: scoring.Scorer | None = None,
    slices: int = 8,
) -> DataFrame:
    """Score what the current version has not scored, record it, return the full result.

    A comment whose scoring failed is not recorded as scored, so the next run tries it again.
    """
    log = ScoreLog(comments.sparkSession, path)
    log.score(comments, params.classifier_version, run_id, scorer, slices)
    return log.current(params.classifier_version)
