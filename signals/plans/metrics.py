"""The metric registry and the one query form over it.

A metric is a table, an aggregate expression and the dimensions it may be cut by. A query
names a metric, dimensions and filters; the result is a DataFrame, so Catalyst plans it
together with whatever built the table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.functions import labels
from signals.operators import filters
from signals.plans.marts import SENTIMENT_COLUMNS, THEME_COLUMNS

Tables = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Metric:
    name: str
    table: str
    expression: str
    dimensions: tuple[str, ...]
    unit: str = "count"
    bounds: tuple[float, float] | None = None
    components: Mapping[str, str] = field(default_factory=dict)
    per_row: bool = False


@dataclass(frozen=True)
class Intent:
    metric: str
    dimensions: tuple[str, ...] = ()
    month: str | None = None
    since: str | None = None
    relative_months: int | None = None
    channel: str | tuple[str, ...] | None = None
    product: str | tuple[str, ...] | None = None
    platform: str | tuple[str, ...] | None = None


def _share(part: str, whole: str) -> str:
    return f"try_divide(sum({part}), sum({whole}))"


_MONTH, _CHANNEL, _SOCIAL = ("month",), ("channel",), ("month", "platform")
_UNIT = (0.0, 1.0)
_NON_SPAM = "non_spam_comments_count"

METRICS = {
    m.name: m
    for m in [
        Metric("spend", "marketing_channel_monthly", "sum(campaign_spend_fcfa)",
               ("month", "channel"), "FCFA"),
        Metric("budget_share", "budget_allocation", "sum(spend_share)", _CHANNEL, "ratio",
               (0.999, 1.001)),
        Metric("net_revenue", "sales_monthly", "sum(net_revenue_fcfa)", _MONTH, "FCFA"),
        Metric("revenue_growth", "sales_monthly", "net_revenue_fcfa", _MONTH, "ratio",
               per_row=True),
        Metric("units_sold", "clean_pos_sales", "sum(units_sold)",
               ("sale_date", "pos_key", "commune", "channel", "product_sku"), "units"),
        Metric("product_mix", "product_mix_monthly", "sum(net_revenue_fcfa)",
               ("month", "product", "format", "product_sku"), "FCFA"),
        Metric("negative_share", "social_monthly", _share("negative_comments_count", _NON_SPAM),
               _SOCIAL, "ratio", _UNIT),
        Metric("repeat_rate", "chat_customers",
               "try_divide(count_if(is_repeat_customer), count_if(has_delivered_order))", (),
               "ratio", _UNIT),
        Metric("gross_revenue", "sales_monthly", "sum(gross_revenue_fcfa)", _MONTH, "FCFA"),
        Metric("return_rate", "sales_monthly",
               "try_divide(abs(sum(return_revenue_fcfa)), sum(gross_revenue_fcfa))", _MONTH,
               "ratio", (0.0, 0.1)),
        Metric("missing_days", "sales_monthly", "sum(missing_sales_days)", _MONTH),
        Metric("sales_coverage", "sales_monthly", _share("observed_sales_days", "calendar_days"),
               _MONTH, "ratio", _UNIT),
        Metric("revenue_per_observed_day", "monthly_performance",
               _share("net_revenue_fcfa", "observed_sales_days"), _MONTH, "FCFA"),
        Metric("spend_vs_plan", "budget_allocation",
               _share("campaign_spend_fcfa", "planned_budget_fcfa"), _CHANNEL, "ratio"),
        Metric("spend_minus_invoiced", "budget_allocation", "sum(campaign_vs_invoiced_fcfa)",
               _CHANNEL, "FCFA"),
        Metric("delivered_orders", "chat_orders_monthly", "sum(delivered_orders)", _MONTH),
        Metric("ordered_units", "chat_orders_monthly", "sum(total_units)", _MONTH, "units"),
        Metric("usable_amount_share", "chat_orders_monthly",
               "1.0D - try_divide(sum(delivered_amount_missing_orders)"
               " + sum(delivered_outlier_amount_orders), sum(delivered_orders))",
               _MONTH, "ratio", _UNIT),
        Metric("sentiment_split", "social_monthly", f"sum({_NON_SPAM})", _SOCIAL,
               components={s: f"sum({c})" for s, c in SENTIMENT_COLUMNS.items()}),
        Metric("positive_comments", "social_monthly", "sum(positive_comments_count)", _SOCIAL),
        Metric("negative_comments", "social_monthly", "sum(negative_comments_count)", _SOCIAL),
        Metric("neutral_comments", "social_monthly", "sum(neutral_comments_count)", _SOCIAL),
        Metric("positive_share", "social_monthly", _share("positive_comments_count", _NON_SPAM),
               _SOCIAL, "ratio", _UNIT),
        Metric("comments_total", "social_monthly", "sum(comments_count)", _SOCIAL),
        Metric("comments_usable", "social_monthly", f"sum({_NON_SPAM})", _SOCIAL),
        Metric("comments_spam", "social_monthly", "sum(spam_comments_count)", _SOCIAL),
        Metric("spam_share", "social_monthly", _share("spam_comments_count", "comments_count"),
               _SOCIAL, "ratio", _UNIT),
        Metric("theme_split", "social_monthly", f"sum({_NON_SPAM})", _SOCIAL,
               components={t: f"sum({c})" for t, c in THEME_COLUMNS.items()}),
        Metric("proposed_budget", "budget_recommendation", "sum(proposed_budget_fcfa)", _CHANNEL,
               "FCFA"),
    ]
}

_MEMBERS = {
    "channel": labels.CHANNEL_ALIASES,
    "product": labels.PRODUCT_ALIASES,
    "platform": labels.PLATFORM_ALIASES,
}


def get_metric(name: str) -> Metric:
    if name not in METRICS:
        raise ValueError(f"unknown metric {name!r}")
    return METRICS[name]


def _conditions(metric: Metric, intent: Intent, table: DataFrame) -> list[Column]:
    out = []
    if intent.month is not None:
        out.append(filters.month_window(intent.month))
    if intent.since is not None:
        out.append(F.col("month") >= F.lit(filters.as_month(intent.since)))
    if intent.relative_months is not None:
        if intent.relative_months <= 0:
            raise ValueError("relative_months must be positive")
        latest = table.agg(F.max("month")).scalar()
        out.append(F.col("month") >= F.add_months(latest, 1 - intent.relative_months))
    for column, aliases in _MEMBERS.items():
        wanted = getattr(intent, column)
        if wanted is None:
            continue
        if column not in metric.dimensions and column not in ("channel",):
            raise ValueError(f"{column} is not a dimension of {metric.name}")
        out.append(filters.member_condition(column, wanted, aliases))
    return out


def _check_dimensions(metric: Metric, dimensions: tuple[str, ...]) -> None:
    for dimension in dimensions:
        if dimension not in metric.dimensions:
            raise ValueError(f"{dimension} is not a dimension of {metric.name}")


def metric_query(tables: Tables, intent: Intent) -> DataFrame:
    """The metric's value, with its components, by the asked dimensions and in their order."""
    metric = get_metric(intent.metric)
    _check_dimensions(metric, intent.dimensions)
    table = tables(metric.table)
    rows = table
    for condition in _conditions(metric, intent, table):
        rows = rows.where(condition)
    if metric.per_row:
        return revenue_growth(rows, metric.name)
    values = {metric.name: metric.expression, **metric.components}
    columns = [F.expr(expression).alias(name) for name, expression in values.items()]
    result = rows.groupBy(*intent.dimensions).agg(*columns) if intent.dimensions else rows.agg(*columns)
    return ordered(result, intent)


def ordered(result: DataFrame, intent: Intent) -> DataFrame:
    """Result in the order of its dimensions: months and members, never rows of a fact."""
    return result.orderBy(*intent.dimensions) if intent.dimensions else result


def revenue_growth(monthly: DataFrame, name: str = "revenue_growth") -> DataFrame:
    """Net revenue over that of the month row before it, minus 1; NULL if that was 0.

    The short month series is laid out as one sorted array, so no global window is needed.
    """
    point = F.struct("month", "net_revenue_fcfa")
    series = monthly.agg(F.array_sort(F.collect_list(point)).alias("s"))
    rows = series.select(F.posexplode("s").alias("i", "r"), "s")
    before = F.when(F.col("i") > 0, F.get("s", F.col("i") - 1)["net_revenue_fcfa"])
    return rows.select(
        "r.month", (F.try_divide(F.col("r.net_revenue_fcfa"), before) - 1).alias(name)
    )


def latest_month(table: DataFrame, month_of_year: int | None = None) -> DataFrame:
    """Most recent month, or the most recent one that is the given month of the year."""
    rows = table
    if month_of_year is not None:
        rows = rows.where(F.month("month") == month_of_year)
    return rows.agg(F.max("month").alias("latest_month"))


def _shifted(month: str) -> str:
    first = filters.as_month(month)
    year, number = (first.year, first.month - 1) if first.month > 1 else (first.year - 1, 12)
    return f"{year:04d}-{number:02d}"


def with_previous_month(tables: Tables, intent: Intent) -> DataFrame:
    """The value of a one-month intent beside the same intent one month earlier."""
    if intent.month is None:
        raise ValueError("a month filter is needed")
    now = metric_query(tables, intent)
    before = metric_query(tables, replace(intent, month=_shifted(intent.month)))
    metric = get_metric(intent.metric)
    names = [metric.name, *metric.components]
    renamed = before.select(
        *intent.dimensions, *[F.col(n).alias(f"previous_{n}") for n in names]
    )
    if intent.dimensions:
        return now.join(renamed, list(intent.dimensions), "left")
    return now.select(
        *names,
        *[renamed.select(f"previous_{n}").scalar().alias(f"previous_{n}") for n in names],
    )


def previous_by_month(tables: Tables, metric_name: str) -> DataFrame:
    """Every month of a metric beside the calendar month before it."""
    metric = get_metric(metric_name)
    now = metric_query(tables, Intent(metric_name, ("month",)))
    names = [metric.name, *metric.components]
    before = now.select(
        F.add_months("month", 1).alias("month"), *[F.col(n).alias(f"previous_{n}") for n in names]
    )
    return now.join(before, "month", "left")


def several_metrics(tables: Tables, intent: Intent, others: list[str]) -> dict[str, DataFrame]:
    """One result per metric for the same dimensions and filters.

    A metric that cannot be cut by an asked dimension, or filtered so, is left out.
    """
    out = {}
    for name in [intent.metric, *others]:
        metric = get_metric(name)
        asked = [c for c in _MEMBERS if getattr(intent, c) is not None]
        if set(intent.dimensions) | set(asked) <= set(metric.dimensions):
            out[name] = metric_query(tables, replace(intent, metric=name))
    return out


def metric_bounds_check(tables: Tables) -> DataFrame:
    """(metric, value, low, high, passed): overall value of each bounded metric, and the
    sum of the components of each metric that has some against its total."""
    parts = []
    for metric in METRICS.values():
        if metric.bounds is None and not metric.components:
            continue
        result = metric_query(tables, Intent(metric.name))
        value = F.col(metric.name).cast("double")
        if metric.components:
            total = sum((F.col(c) for c in metric.components), F.lit(0))
            low = high = total.cast("double")
        else:
            low, high = (F.lit(b) for b in metric.bounds)
        parts.append(
            result.select(
                F.lit(metric.name).alias("metric"),
                value.alias("value"),
                low.alias("low"),
                high.alias("high"),
                F.coalesce((value >= low) & (value <= high), F.lit(False)).alias("passed"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
