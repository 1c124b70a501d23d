"""The monthly run: check and load the sources, score new comments, build and check tables.

One Spark application. Layers are parquet tables under one folder, so every step starts from
written data and a failed run can be started again with its run id: the load is published whole,
scoring goes on where it stopped, and facts are rewritten month by month where they changed.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.operators import increments, quality, scoring
from signals.operators.score_log import incremental_score
from signals.params import Params
from signals.plans.workspace import Workspace
from signals.session import configure
from signals.sources import io
from signals.sources.schemas import SOURCES

# In build order; each table only reads tables before it.
CLEAN = [
    "clean_campaigns", "clean_media_plan", "clean_pos_sales", "clean_comments",
    "clean_chat_orders",
]
CONFORMED = [
    "campaign_attributes", "campaign_rollup", "sales_daily", "product_dimension", "pos_dimension",
    "sales_calendar", "order_items", "order_quality", "media_reconciliation",
    "comments_enriched",
]
MARTS = [
    "marketing_channel_monthly", "sales_monthly", "monthly_performance",
    "channel_performance_monthly", "product_mix_monthly", "chat_orders_monthly",
    "chat_customers", "social_monthly", "budget_allocation", "channel_evidence",
    "decision_budget", "channel_decision", "budget_recommendation",
]
NEEDS_PREDICTIONS = {"comments_enriched", "social_monthly"}


@dataclass(frozen=True)
class Fact:
    """A table kept by month, and the tables by month that are made of the same months of it."""

    month: Column
    derived: Mapping[str, Column]


def facts() -> dict[str, Fact]:
    month = F.col("month")
    return {
        "clean_pos_sales": Fact(
            F.col("sale_date"),
            {"sales_daily": F.col("sale_date"), "sales_monthly": month, "product_mix_monthly": month},
        ),
        "clean_chat_orders": Fact(
            month, {"order_items": F.col("received_at"), "order_quality": month, "chat_orders_monthly": month}
        ),
        "clean_comments": Fact(month, {}),
        "comments_enriched": Fact(F.col("published_at"), {"social_monthly": month}),
    }


class TableFolder:
    """Tables of one run by name: written once, then read back."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        if name.startswith("raw_"):
            return f"{io.loaded(self.spark, self.folder)}/{name}"
        return f"{self.folder}/{name}"

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name)).drop(increments.PART)


def build_fact(
    tables: TableFolder, ws: Workspace, name: str, fact: Fact, skipped: set[str]
) -> list[str]:
    """Write the changed months of a fact and of what derives from it; returns the tables written.

    The digests of the months are written last: a run cut off before that finds the same months
    changed and writes them again.
    """
    spark, digest_path = tables.spark, f"{tables.path('month_digests')}/{name}"
    df = ws(name)
    now = io.stage(increments.month_digests(df, fact.month))
    todo = increments.changes(now, io.available(spark, digest_path))
    names = [name, *(n for n in fact.derived if n not in skipped)]
    if todo:
        increments.write_changed(df, tables.path(name), fact.month, todo)
        ws.replace(name, tables(name))
        part = Workspace(ws.sources, ws.params, ws.predictions, staged=())
        # Partitions of other months are not even listed for reading.
        months = spark.read.parquet(tables.path(name))
        if not todo.removed:
            months = months.where(F.col(increments.PART).isin(todo.changed))
        part.replace(name, months.drop(increments.PART))
        for derived in names[1:]:
            increments.write_changed(part(derived), tables.path(derived), fact.derived[derived], todo)
            part.replace(derived, increments_of(tables, derived, todo))
        now.write.mode("overwrite").parquet(digest_path)
    for written in names:
        ws.replace(written, tables(written))
    return names


def increments_of(tables: TableFolder, name: str, todo: increments.Changes) -> DataFrame:
    written = tables.spark.read.parquet(tables.path(name))
    if not todo.removed:
        written = written.where(F.col(increments.PART).isin(todo.changed))
    return written.drop(increments.PART)


def build_tables(
    spark: SparkSession,
    folder: str,
    params: Params = Params(),
    predictions: DataFrame | None = None,
) -> list[str]:
    """Write every table whose inputs exist; without predictions their readers are skipped.

    Facts and the tables at month grain made of them are written for changed months only; all
    other tables are small and written whole.
    """
    tables = TableFolder(spark, folder)
    sources = {name: tables(f"raw_{name}") for name in SOURCES}
    ws = Workspace(sources, params, predictions, staged=())
    skipped = NEEDS_PREDICTIONS if predictions is None else set()
    by_month = facts()
    built: list[str] = []
    for name in [*CLEAN, *CONFORMED, *MARTS]:
        if name in skipped or name in built:
            continue
        if name in by_month:
            built += build_fact(tables, ws, name, by_month[name], skipped)
            continue
        io.write_mart(ws(name), tables.path(name))
        # Later tables read what was written instead of repeating the work.
        ws.replace(name, tables(name))
        built.append(name)
    return built


def run_month(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    folder: str,
    params: Params = Params(),
    scorer: scoring.Scorer | None = None,
    run_id: int = 1,
) -> DataFrame:
    """Load, score incrementally, build everything; returns the quality report."""
    configure(spark)
    io.load_all(sources, folder, run_id)
    tables = TableFolder(spark, folder)
    raw = {name: tables(f"raw_{name}") for name in SOURCES}
    comments = Workspace(raw, params, staged=())("clean_comments")
    predictions = incremental_score(comments, f"{folder}/predictions", run_id, params, scorer)
    io.check_predictions(predictions)
    build_tables(spark, folder, params, predictions)
    return quality.quality_report(tables, params)
