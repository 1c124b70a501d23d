"""Closed vocabularies. They decide what counts as the same label."""

from __future__ import annotations

from pyspark.sql import Column

from signals.functions.text import canon_label, trimmed_lower

# Canonical label -> accepted spellings.
AD_PLATFORMS = {
    "Meta": ["meta"],
    "TikTok": ["tiktok"],
    "Google": ["google", "google ads"],
    "Influenceurs": ["influenceur", "influenceurs"],
    "Radio": ["radio"],
}
PLAN_CHANNELS = {
    **AD_PLATFORMS,
    "Meta": ["fb/ig", "meta", "facebook", "instagram"],
    "Activation terrain": ["activation terrain"],
}
OBJECTIVES = {
    "traffic": ["traffic", "trafic"],
    "engagement": ["engagement"],
    "awareness": ["notoriété", "notoriete", "awareness"],
    "conversions": ["conversions", "conv"],
}
COMMUNES = {
    "Cocody": ["cocody"],
    "Yopougon": ["yopougon"],
    "Marcory": ["marcory"],
    "Treichville": ["treichville"],
    "Port-Bouet": ["port-bouet"],
}
SALES_CHANNELS = {name: [name] for name in ("retail", "delivery", "ecommerce")}
ORDER_STATUSES = {
    "delivered": ["livré", "livree", "livrée", "livre"],
    "cancelled": ["annulé", "annule", "annulée", "annulee"],
    "pending": ["en cours"],
}
SOCIAL_PLATFORMS = {
    "Instagram": ["instagram"],
    "Facebook": ["facebook"],
    "TikTok": ["tiktok"],
}

# What a filter may name, alias -> member.
CHANNEL_ALIASES = {
    "meta": "Meta",
    "facebook": "Meta",
    "instagram": "Meta",
    "tiktok": "TikTok",
    "google": "Google",
    "google ads": "Google",
    "radio": "Radio",
    "influenceurs": "Influenceurs",
    "influenceur": "Influenceurs",
    "activation terrain": "Activation terrain",
}
PRODUCT_ALIASES = {
    "bissap": "bissap",
    "bouye": "bouye",
    "gingembre": "gingembre",
    "ginger": "gingembre",
}
PLATFORM_ALIASES = {
    "facebook": "Facebook",
    "fb": "Facebook",
    "instagram": "Instagram",
    "insta": "Instagram",
    "tiktok": "TikTok",
    "tik tok": "TikTok",
}

PRODUCTS = ["bissap", "gingembre", "bouye"]

# SKU parts.
SKU_PRODUCTS = {"BIS": "bissap", "GIN": "gingembre", "BOU": "bouye"}
SKU_FORMATS = {"1L": ("1L", 1.0), "33": ("33cl", 0.33), "33CL": ("33cl", 0.33)}


def canon_platform(c: Column) -> Column:
    return canon_label(c, AD_PLATFORMS)


def canon_objective(c: Column) -> Column:
    return canon_label(c, OBJECTIVES, trimmed_lower(c))


def canon_channel(c: Column) -> Column:
    return canon_label(c, PLAN_CHANNELS)


def canon_commune(c: Column) -> Column:
    return canon_label(c, COMMUNES)


def canon_sales_channel(c: Column) -> Column:
    return canon_label(c, SALES_CHANNELS, trimmed_lower(c))


def canon_status(c: Column) -> Column:
    return canon_label(c, ORDER_STATUSES, trimmed_lower(c))


def canon_social_platform(c: Column) -> Column:
    return canon_label(c, SOCIAL_PLATFORMS)
