"""All tables of one set of sources, built on first use.

A table is a lazy DataFrame. The few that several others read can be staged: written once
to the shared folder and read back, so their upstream work runs once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from threading import Lock
from types import MappingProxyType

from pyspark.sql import DataFrame

from signals.operators import cleaning, conform, items, scoring
from signals.params import Params
from signals.plans import marts
from signals.sources.io import shuffles_dropped, stage


# Small tables with several readers.
STAGED = (
    "sales_daily", "campaign_rollup", "marketing_channel_monthly", "monthly_performance", "channel_decision",
    "social_monthly",
)


class Workspace:
    """``workspace("sales_monthly")`` is the sales mart over the given sources."""

    def __init__(
        self,
        sources: Mapping[str, DataFrame],
        params: Params = Params(),
        predictions: DataFrame | None = None,
        staged: tuple[str, ...] = STAGED,
        unread: Mapping[str, tuple[str, ...]] = MappingProxyType({}),
    ) -> None:
        self.sources = sources
        self.params = params
        self.predictions = predictions
        self.staged = staged
        # Columns of staged tables that nothing reads here: they are not written.
        self.unread = unread
        self._built: dict[str, DataFrame] = {}
        self._locks: dict[str, Lock] = defaultdict(Lock)

    def __call__(self, name: str) -> DataFrame:
        # One lock a table: tables only wait for tables they read, which never read them.
        with self._locks[name]:
            if name not in self._built:
                table = getattr(self, f"_{name}")()
                if name in self.staged:
                    table = stage(table.drop(*self.unread.get(name, ())))
                self._built[name] = table
            return self._built[name]

    def stage_all(self, at_once: int = 6, alone: tuple[str, ...] = ()) -> None:
        """Write the staged tables, side by side where they do not need each other: the jobs of
        small tables leave most of a cluster idle.

        Those named in ``alone`` come first, in their order and one at a time, and the shuffle files
        of a table go when it is written: the disks hold the files of one large table at once.
        """
        with shuffles_dropped(next(iter(self.sources.values())).sparkSession):
            for name in alone:
                self(name)
            with ThreadPoolExecutor(at_once) as pool:
                list(pool.map(self, self.staged))

    def replace(self, name: str, table: DataFrame) -> None:
        """Use a written copy of a table from here on."""
        self._built[name] = table

    @classmethod
    def names(cls) -> list[str]:
        skip = {"_built", "_locks"}
        return [n[1:] for n in vars(cls) if n.startswith("_") and n[1] != "_" and n not in skip]

    def _clean_campaigns(self):
        return cleaning.clean_campaigns(self.sources["campaign_spend_export"], self.params)

    def _clean_media_plan(self):
        return cleaning.clean_media_plan(self.sources["media_plan"])

    def _clean_pos_sales(self):
        return cleaning.clean_pos_sales(self.sources["pos_sales_daily"])

    def _clean_comments(self):
        return cleaning.clean_comments(self.sources["social_comments"])

    def _clean_chat_orders(self):
        return cleaning.clean_chat_orders(self.sources["whatsapp_orders"])

    def _campaign_attributes(self):
        return cleaning.campaign_attributes(self("clean_campaigns"))

    def _sales_daily(self):
        return conform.sales_daily(self("clean_pos_sales"))

    def sold(self) -> DataFrame:
        """What the calendar, the products and the monthly sales sum up: the lines themselves where
        they are written. Their daily table has nearly as many rows, so it is not worth writing too."""
        return self("clean_pos_sales" if "clean_pos_sales" in self.staged else "sales_daily")

    def _product_dimension(self):
        return conform.product_dimension(self.sold())

    def _pos_dimension(self):
        return conform.pos_dimension(self("clean_pos_sales"))

    def _sales_calendar(self):
        return conform.sales_calendar(self.sold())

    def _order_items(self):
        return items.order_items(self("clean_chat_orders"))

    def _order_quality(self):
        return items.order_quality(self("clean_chat_orders"), self.params)

    def _campaign_rollup(self):
        return conform.campaign_rollup(self("campaign_attributes"))

    def _media_reconciliation(self):
        return conform.media_reconciliation(
            conform.campaign_totals(self("campaign_rollup")),
            conform.plan_totals(self("clean_media_plan")),
        )

    def _social_predictions(self):
        if self.predictions is not None:
            return self.predictions
        return scoring.predict(self("clean_comments"))

    def _comments_enriched(self):
        if self.predictions is None:
            return scoring.labelled_comments(self("clean_comments").select(*conform.COMMENT_COLUMNS))
        return conform.comments_enriched(self("clean_comments"), self("social_predictions"))

    def _marketing_channel_monthly(self):
        return marts.marketing_channel_monthly(
            self("campaign_rollup"), self("clean_media_plan")
        )

    def _sales_monthly(self):
        return marts.sales_monthly(self.sold(), self("sales_calendar"))

    def _monthly_performance(self):
        return marts.monthly_performance(
            self("marketing_channel_monthly"), self("sales_monthly")
        )

    def _channel_performance_monthly(self):
        return marts.channel_performance_monthly(
            self("marketing_channel_monthly"), self("sales_monthly")
        )

    def _product_mix_monthly(self):
        return marts.product_mix_monthly(
            self.sold(), self("product_dimension"), self("sales_monthly")
        )

    def _chat_orders_monthly(self):
        return marts.chat_orders_monthly(self("order_quality"))

    def _chat_customers(self):
        return marts.chat_customers(self("clean_chat_orders"))

    def _social_monthly(self):
        return marts.social_monthly(self("comments_enriched"))

    def _budget_allocation(self):
        return marts.budget_allocation(self("marketing_channel_monthly"))

    def _channel_evidence(self):
        return marts.channel_evidence(self("marketing_channel_monthly"))

    def _decision_budget(self):
        return marts.decision_budget(
            self("monthly_performance"), self("marketing_channel_monthly")
        )

    def _channel_decision(self):
        return marts.channel_decision(
            self("channel_evidence"), self("budget_allocation"), self("monthly_performance")
        )

    def _budget_recommendation(self):
        return marts.budget_recommendation(self("channel_decision"), self.params)
