"""An append-only record of finished folders, which makes several writes visible at once.

Data goes into a folder of its own first; a row here, added last, publishes it. Spark commits a row as
one renamed file, so a reader sees it whole or not at all, and whatever a failed run left behind is
never read. Rows are a few per run; reading them to the driver is bounded by the number of runs and
slices since the table began.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

SCHEMA = "seq long, kind string, run_id long, part string, folder string"


def absent(error: AnalysisException) -> bool:
    """Is this the error of a path that does not exist (and not of one that cannot be read)?"""
    return error.getCondition() == "PATH_NOT_FOUND"


class Manifest:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.path = f"{self.root}/manifest"

    def entries(self, *kinds: str) -> list[Row]:
        """Rows of the given kinds, oldest first; none before the first one is added."""
        try:
            found = self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if absent(error):
                return []
            raise
        rows = sorted(found.collect(), key=lambda r: (r.seq, r.run_id, r.part))
        return [r for r in rows if not kinds or r.kind in kinds]

    def last(self, *kinds: str) -> Row | None:
        return next(reversed(self.entries(*kinds)), None)

    def add(self, kind: str, run_id: int, part: str, folder: str) -> None:
        newest = self.last()
        row = (1 + (newest.seq if newest else 0), kind, run_id, part, folder)
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def fresh(self, name: str) -> str:
        """A folder below the root that nobody has used yet."""
        return f"{self.root}/{name}-{uuid.uuid4().hex}"

    def read(self, folder: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(folder)
