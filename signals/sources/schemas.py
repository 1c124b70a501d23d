"""Explicit schemas of the five sources and of the prediction table."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


def _schema(spec: str) -> T.StructType:
    # Plain "name type" pairs; StructType.fromDDL would need a running session.
    pairs = (column.split() for column in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS = {
    "campaign_spend_export": _schema(
        "platform string, campaign_name string, date_start string, date_end string, "
        "spend string, impressions int, clicks int, objective string"
    ),
    "media_plan": _schema(
        "plan_id string, month string, channel string, planned_budget_fcfa double, "
        "invoiced_fcfa double, objective string, owner string, notes string"
    ),
    "pos_sales_daily": _schema(
        "sale_date date, pos_id string, pos_name string, commune string, channel string, "
        "product_sku string, units_sold int, revenue_fcfa double"
    ),
    "whatsapp_orders": _schema(
        "order_ref string, received_at string, customer_phone string, items_text string, "
        "amount_fcfa double, delivery_zone string, status string"
    ),
    "social_comments": _schema(
        "comment_id string, platform string, post_id string, published_at timestamp, "
        "author_handle string, comment_text string, like_count int, reply_to_id string"
    ),
}
SOURCES = list(SCHEMAS)

PREDICTION_SCHEMA = _schema(
    "comment_id string, language_model string, sentiment_model string, theme_model string, "
    "product_model string, is_spam_model boolean, model_used boolean, rules_complete boolean"
)
# The fields a usable prediction must fill.
PREDICTION_LABELS = [f.name for f in PREDICTION_SCHEMA.fields[1:6]]
