"""The five dirty sources, derived from a TPC-H-like star schema plus documents.

Stands in for the real feeds in tests, benchmarks and the registered queries: every row of
the base tables is kept, so the work grows with them, and the dirt (layouts, spellings,
copies, gaps) is spread by key. Money stays in whole units.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.functions.dates import MONTHS, MONTHS_PLAIN
from signals.functions.text import literal_array

SKUS = ["BIS-1L", "BIS-33", "BOU-1L", "GIN-1L", "GIN-33", "MAN-50"]
SITES = ["Cocody", "yopougon", "Marcory", "Treichville", "port-bouet", "Abobo"]
SHOPS = ["Épicerie", "Supermarché", "Kiosque"]
SALES_CHANNELS = ["retail", "Retail ", "DELIVERY", "ecommerce"]
PLATFORMS = {
    1: ["Meta", " meta", "META"],
    2: ["TikTok", "tiktok ", "TIKTOK"],
    3: ["google", "Google Ads", "GOOGLE ADS "],
    4: ["Influenceur", "influenceurs", "INFLUENCEURS"],
    5: ["radio", "Radio ", " RADIO"],
}
PLAN_CHANNELS = {
    1: ["FB/IG", "Instagram"],
    2: ["TikTok", "tiktok "],
    3: ["Google Ads", "google"],
    4: ["Influenceurs", "influenceur"],
    5: [" radio", "Radio"],
}
SHORT_MONTHS = [
    "jan", "fevr", "mar", "avr", "mai", "jun", "juil", "aou", "sept", "oct", "nov", "dec",
]
CAMPAIGNS = ["Bissap", "promo GINGEMBRE", "Bouye", "Gamme", "maison bissap"]
OBJECTIVES = [
    "traffic", "Trafic", " TRAFIC", "engagement", "Engagement ", "notoriété", "Notoriete",
    "AWARENESS", "conversions", "conv", "Ventes",
]
STATUSES = {
    "F": ["Livré", "livree", " LIVRÉE", "livre"],
    "O": ["Annulé", "annule", "ANNULÉE", "annulee"],
    "P": ["en cours", "En cours ", "perdu", "EN COURS"],
}
SOCIAL = ["instagram", "Facebook ", " TIKTOK", "twitter"]
THEMES = [
    "taste", "price", "availability", "delivery", "packaging",
    "health", "service", "promotion", "product_question", "other",
]

# Comment phrases with the theme and product a person would give them.
PHRASES = [
    ("j'adore le bissap, trop bon", "taste", "bissap"),
    ("le gingembre est trop cher", "price", "gingembre"),
    ("vous livrez à Bassam ?", "delivery", "none"),
    ("rupture de stock partout", "availability", "unknown"),
    ("la bouteille fuit", "packaging", "unknown"),
    ("sucre ajouté ?", "health", "unknown"),
    ("❤️❤️❤️", "other", "none"),
    ("bonjour", "other", "none"),
    ("boostez vos followers, cliquez ici", "other", "none"),
    ("franchement enjaillant, pas drap", "other", "none"),
    ("le bissap est pas bon", "taste", "bissap"),
    ("je ne dirais pas que c'est mauvais", "taste", "unknown"),
    ("where can i buy the hibiscus drink?", "availability", "bissap"),
    ("how much is it", "price", "unknown"),
    ("so tasty and sweet", "taste", "unknown"),
    ("version sans sucre du bouye ?", "product_question", "bouye"),
    ("vu la pub sur tiktok", "promotion", "none"),
    ("bissap et gingembre, les meilleurs", "taste", "multiple"),
    ("le service client ne répond pas", "service", "none"),
    ("pas mauvais du tout", "taste", "unknown"),
    ("😡😤", "other", "none"),
    ("+1", "other", "none"),
    ("bon vous avez du bouye en rayon ?", "availability", "bouye"),
    ("bravo, bien organisé, qui est comme moi ?", "other", "none"),
    ("gingembre dèh, c'est doux", "taste", "gingembre"),
    ("le livreur ne répond pas", "delivery", "none"),
    ("cher pour une telle qualité", "price", "unknown"),
    ("her", "other", "none"),
    ("her bottle", "packaging", "unknown"),
    ("please restock", "availability", "unknown"),
    ("le 33cl à 700 francs ça va", "price", "unknown"),
    ("stand de dégustation, excellent", "promotion", "none"),
    ("je vends des téléphones 07 08 09 10 11", "other", "none"),
    ("je n'aime pas l'emballage", "packaging", "unknown"),
    ("plus de bissap au supermarché", "availability", "bissap"),
    ("this product is le top", "other", "none"),
    ("prêt d'argent rapide sans garantie", "other", "none"),
    ("👍 super", "other", "none"),
    ("c'est quoi la composition ?", "product_question", "unknown"),
    ("", "other", "none"),
    ("commande annulée, toujours rien", "delivery", "none"),
    ("on peut payer par wave ?", "service", "none"),
    ("l'étiquette se décolle", "packaging", "unknown"),
    ("les ingrédients sont naturels, j'apprécie", "health", "unknown"),
]


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(literal_array(values), (index + 1).cast("int"))


def _table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def pos_sales(spark: SparkSession, base: str) -> DataFrame:
    """POS lines: returns, a two-week hole, stores that change id and spelling."""
    line, supp = F.col("l_linenumber"), F.col("l_suppkey")
    shipped = F.col("l_shipdate").cast("date")
    hole = shipped.between(F.lit("1997-04-13").cast("date"), F.lit("1997-04-26").cast("date"))
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    site = _pick(SITES, F.col("s_nationkey") % 6)
    moved = (supp % 10 == 0) & (F.col("sale_date") >= F.lit("1998-06-01").cast("date"))
    name = F.concat_ws(" ", _pick(SHOPS, supp % 3), F.col("s_name"))
    renamed = F.concat(
        _pick(["EPICERIE", "SUPERMARCHE", "KIOSQUE"], supp % 3), F.lit("  "), F.upper("s_name")
    )
    unknown = (line == 7) & (F.col("l_quantity") == 50)
    # Dates and whole numbers before the joins: they shuffle smaller than what they are made of.
    lines = _table(spark, base, "lineitem").select(
        "l_partkey",
        supp,
        line,
        F.when(hole, F.date_add(shipped, 14)).otherwise(shipped).alias("sale_date"),
        (F.col("l_quantity").cast("int") * sign).alias("units_sold"),
        F.when(~unknown, F.floor("l_extendedprice").cast("double") * sign).alias("revenue_fcfa"),
    )
    return (
        lines.join(_table(spark, base, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(_table(spark, base, "supplier"), supp == F.col("s_suppkey"))
        .select(
            "sale_date",
            F.concat(
                F.lit("POS"), (supp + F.when(moved, 500000).otherwise(0)).cast("string")
            ).alias("pos_id"),
            F.when(moved, renamed).otherwise(name).alias("pos_name"),
            F.when(line % 3 == 0, F.upper(site))
            .when(line % 3 == 1, F.concat(F.lit(" "), site, F.lit(" ")))
            .otherwise(site)
            .alias("commune"),
            _pick(SALES_CHANNELS, line % 4).alias("channel"),
            _pick(SKUS, F.col("p_size") % 6).alias("product_sku"),
            "units_sold",
            "revenue_fcfa",
        )
    )


def chat_orders(spark: SparkSession, base: str) -> DataFrame:
    """Free-text orders: reused references, four time layouts, messy phones and prose."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    clock = F.concat(
        F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":"), F.lpad((k % 60).cast("string"), 2, "0")
    )
    iso, dmy = F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "dd/MM/yyyy")
    number = F.concat(F.lit("07"), F.lpad((F.col("o_custkey") % 100000000).cast("string"), 8, "0"))

    def pairs(sep: str) -> Column:
        return F.concat_ws(sep, *[F.substring(number, i, 2) for i in (1, 3, 5, 7, 9)])

    q = (k % 9 + 1).cast("string")
    texts = [
        F.concat(q, F.lit(" bissap 1L + 1 gingembre 33cl")),
        F.concat(q, F.lit("x BIS-1L")),
        F.concat(q, F.lit(" x bis-1l et 2 bouye 1 L")),
        F.concat(F.lit("commande habituelle x"), q),
        F.concat(q, F.lit(" bissap (bien frais) 33 cl")),
        F.lit(None).cast("string"),
        F.concat(q, F.lit(" gingembre")),
        F.lit("bouye 33cl + quelque chose"),
        F.lit("   "),
        F.concat(q, F.lit("  Bissap   1L et 1 Gingembre 1L et 2 bouye")),
        F.concat(F.lit("1"), q, F.lit(" gingembre 33CL+livraison")),
        F.concat(F.lit("bissap 1L x"), q),
    ]
    items = F.lit(None).cast("string")
    for i, text in enumerate(texts):
        items = F.when(k % 12 == i, text).otherwise(items)
    status = F.lit(None).cast("string")
    for code, labels in STATUSES.items():
        status = F.when(F.col("o_orderstatus") == code, _pick(labels, k % 4)).otherwise(status)
    zone = F.col("c_mktsegment")
    return (
        _table(spark, base, "orders")
        .join(_table(spark, base, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.concat(
                F.lit("WA-"), F.when(k % 7 < 2, k - k % 7).otherwise(k).cast("string")
            ).alias("order_ref"),
            F.when(k % 97 == 0, "hier soir")
            .when(k % 4 == 0, F.concat_ws(" ", iso, clock))
            .when(k % 4 == 1, F.concat_ws(" ", dmy, clock))
            .when(k % 4 == 2, iso)
            .otherwise(dmy)
            .alias("received_at"),
            F.when(k % 101 == 0, "inconnu")
            .when(k % 41 == 0, F.substring(number, 1, 6))
            .when(k % 5 == 0, pairs(" "))
            .when(k % 5 == 1, F.concat(F.lit("+225"), number))
            .when(k % 5 == 2, F.concat(F.lit("225"), number))
            .when(k % 5 == 3, pairs("."))
            .otherwise(number)
            .alias("customer_phone"),
            items.alias("items_text"),
            F.when(k % 8 == 0, F.lit(None))
            .when(k % 43 == 0, F.floor("o_totalprice").cast("double") * 1000)
            .otherwise(F.floor(F.col("o_totalprice") / 10).cast("double"))
            .alias("amount_fcfa"),
            F.when(k % 2 == 0, F.concat(F.lit(" "), F.lower(zone))).otherwise(zone).alias(
                "delivery_zone"
            ),
            status.alias("status"),
        )
    )


def _written_date(d: Column, k: Column) -> Column:
    worded = F.concat_ws(
        " ", F.dayofmonth(d).cast("string"), _pick(MONTHS, F.month(d) - 1), F.year(d).cast("string")
    )
    return (
        F.when(k % 3 == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(k % 3 == 1, F.date_format(d, "dd/MM/yyyy"))
        .otherwise(worded)
    )


def campaign_export(spark: SparkSession, base: str) -> DataFrame:
    """One campaign line per order, a twentieth of them copied exactly."""
    k, p = F.col("o_orderkey"), F.substring("o_orderpriority", 1, 1).cast("int")
    d = F.col("o_orderdate").cast("date")
    end = F.date_add(d, F.when(k % 89 == 0, -3).otherwise((k % 10).cast("int")))
    base_amount = F.floor("o_totalprice")
    thousands = F.concat_ws(
        " ",
        F.floor(base_amount / 1000).cast("string"),
        F.lpad((base_amount % 1000).cast("string"), 3, "0"),
        F.lit("FCFA"),
    )
    spend = (
        F.when(k % 127 == 0, "à confirmer")
        .when(k % 4 == 0, thousands)
        .when(k % 4 == 1, base_amount.cast("string"))
        .when(k % 8 == 3, F.concat(F.floor(base_amount / 655).cast("string"), F.lit(",40 EUR")))
        .otherwise(F.concat(base_amount.cast("string"), F.lit(" fcfa")))
    )
    platform = F.lit(None).cast("string")
    for code, labels in PLATFORMS.items():
        platform = F.when(p == code, _pick(labels, k % 3)).otherwise(platform)
    m = F.month(d) - 1
    month_word = (
        F.when(k % 4 == 0, _pick(MONTHS, m))
        .when(k % 4 == 1, _pick(SHORT_MONTHS, m))
        .when(k % 4 == 2, F.concat(_pick(SHORT_MONTHS, m), F.date_format(d, "yy")))
        .otherwise("")
    )
    measured = p < 4
    rows = _table(spark, base, "orders").select(
        k,
        platform.alias("platform"),
        F.concat(_pick(CAMPAIGNS, k % 5), F.lit(" - "), month_word).alias("campaign_name"),
        F.when(k % 113 == 0, "fin de mois").otherwise(_written_date(d, k)).alias("date_start"),
        _written_date(end, k + 1).alias("date_end"),
        spend.alias("spend"),
        F.when(measured & (k % 11 != 0), (k % 50000 + 1000).cast("int")).alias("impressions"),
        F.when(measured, (k % 300).cast("int")).alias("clicks"),
        _pick(OBJECTIVES, k % 11).alias("objective"),
    )
    return rows.union(rows.where(k % 20 == 0)).drop("o_orderkey")


def media_plan(spark: SparkSession, base: str) -> DataFrame:
    """One plan line per month and channel, plus a channel the export never reports."""
    orders = _table(spark, base, "orders").select(
        F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("m"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("p"),
        F.floor("o_totalprice").cast("double").alias("v"),
        "o_orderstatus",
    )
    field = orders.where("o_orderstatus = 'P'").withColumn("p", F.lit(6))
    lines = orders.union(field.select(orders.columns)).groupBy("m", "p").agg(F.sum("v").alias("v"))
    m, p, n, year = F.col("m"), F.col("p"), F.month("m"), F.year("m").cast("string")
    style = (n + p) % 3
    month_text = (
        F.when((F.year(m) == 1999) & (n == 7) & (p == 3), "T3 1999")
        .when(style == 0, F.concat_ws(" ", _pick(MONTHS, n - 1), year))
        .when(style == 1, F.concat_ws(" ", F.initcap(_pick(MONTHS_PLAIN, n - 1)), year))
        .otherwise(F.concat(F.upper(_pick(MONTHS, n - 1)), F.lit("  "), year, F.lit(" ")))
    )
    channel = F.lit("Activation terrain")
    for code, labels in PLAN_CHANNELS.items():
        channel = F.when(p == code, _pick(labels, n % 2)).otherwise(channel)
    return lines.select(
        F.concat(F.lit("PLAN-"), F.date_format(m, "yyyyMM"), F.lit("-"), p.cast("string")).alias(
            "plan_id"
        ),
        month_text.alias("month"),
        channel.alias("channel"),
        F.col("v").alias("planned_budget_fcfa"),
        F.when((n + p) % 5 != 0, F.col("v") - 1000 * p).alias("invoiced_fcfa"),
        F.when(p == 2, "").otherwise("notoriété").alias("objective"),
        F.lit(" Nadia ").alias("owner"),
        F.when(p == 4, "   ").alias("notes"),
    )


def _said(n: Column, line: Column) -> Column:
    """What is said on a line: always the whole line, for some lines after a phrase, for others
    with the phrase in a row of its own (mark 'p')."""
    phrase = _pick([text for text, _, _ in PHRASES], n % len(PHRASES))

    def row(mark: str, text: Column) -> Column:
        return F.struct(F.lit(mark).alias("mark"), text.alias("text"))

    return (
        F.when(n % 5 <= 2, F.array(row("", line), row("p", phrase)))
        .when(n % 5 == 3, F.array(row("", F.concat_ws(" ", phrase, line))))
        .otherwise(F.array(row("", line)))
    )


def comments(spark: SparkSession, base: str) -> DataFrame:
    """Every line of every document and every turn, whole, as a comment; phrases beside them."""
    doc, pos = F.col("doc_id"), F.col("pos")
    lines = _table(spark, base, "documents").select(
        "doc_id", "lang", "source", F.posexplode(F.split("text", "\n")).alias("pos", "line")
    )
    lines = lines.withColumn("said", F.explode(_said(doc + pos * 7, F.col("line"))))
    days, hours = ((doc * 3 + pos) % 181).cast("int"), (pos % 24).cast("int")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    rows = lines.select(
        doc,
        pos,
        F.concat(
            F.lit("C"), doc.cast("string"), F.lit("-"), pos.cast("string"), "said.mark"
        ).alias("comment_id"),
        _pick(SOCIAL, doc % 4).alias("platform"),
        F.concat(F.lit("P"), "source", F.lit("-"), (doc % 20).cast("string")).alias("post_id"),
        (start + F.make_dt_interval(days, hours)).alias("published_at"),
        F.concat(F.lit("@"), "lang", (doc % 1000).cast("string")).alias("author_handle"),
        F.col("said.text").alias("comment_text"),
        ((doc * 7 + pos) % 60).cast("int").alias("like_count"),
        F.when(
            (pos > 0) & (pos % 5 == 0),
            F.concat(F.lit("C"), doc.cast("string"), F.lit("-"), (pos - 1).cast("string")),
        ).alias("reply_to_id"),
    )
    liked_again = rows.where((doc + pos) % 40 == 1).withColumn(
        "like_count", F.col("like_count") + 1
    )
    repeated = rows.where((doc + pos) % 25 == 0)
    conv, turn = F.col("conv_id"), F.col("turn")
    turns = (
        _table(spark, base, "conversations")
        .select(
            F.concat(F.lit("V"), conv.cast("string"), F.lit("-"), turn.cast("string")).alias(
                "comment_id"
            ),
            F.lit("Facebook").alias("platform"),
            F.concat(F.lit("V"), (conv % 20).cast("string")).alias("post_id"),
            (start + F.make_dt_interval((conv % 181).cast("int"))).alias("published_at"),
            F.when(F.col("role") == "user", "@visitor")
            .otherwise(F.concat(F.lit("@"), "role"))
            .alias("author_handle"),
            F.col("text").alias("comment_text"),
            F.lit(0).alias("like_count"),
            F.lit(None).cast("string").alias("reply_to_id"),
        )
    )
    return rows.union(liked_again).union(repeated).drop("doc_id", "pos").union(turns)


def human_labels(spark: SparkSession, base: str, batch: int | None = None) -> DataFrame:
    """Annotated comments on the lines of labelled documents, as people would write the labels.

    All lines, or for merging drafts: batch 0 those at even positions, batch 1 the others."""
    doc, pos = F.col("doc_id"), F.col("pos")
    n = doc + 7 * pos
    plain = (F.col("said.mark") == "") & (n % 5 != 3)
    theme = _pick([t for _, t, _ in PHRASES], n % len(PHRASES))
    product = _pick([p for _, _, p in PHRASES], n % len(PHRASES))
    return (
        _table(spark, base, "labels")
        .join(_table(spark, base, "documents"), "doc_id")
        .select(
            "doc_id", "quality", "toxic", "lang",
            F.posexplode(F.split("text", "\n")).alias("pos", "line"),
        )
        .where(F.lit(True) if batch is None else pos % 2 == batch)
        .withColumn("said", F.explode(_said(n, F.col("line"))))
        .select(
            F.concat(
                F.lit("C"), doc.cast("string"), F.lit("-"), pos.cast("string"), "said.mark"
            ).alias("comment_id"),
            F.trim("said.text").alias("comment_text"),
            F.when(F.col("lang").isin("fr", "en"), F.upper("lang"))
            .otherwise("other")
            .alias("language_human"),
            F.when(doc % 3 == 0, " Neutral")
            .when(F.col("quality") == 1, "positive")
            .otherwise("negative")
            .alias("sentiment_human"),
            F.when(plain, "other").otherwise(theme).alias("theme_human"),
            F.when(plain, "none").otherwise(product).alias("product_human"),
            F.when(F.col("toxic") == 1, _pick(["true", "1", "Yes"], doc % 3))
            .otherwise(_pick(["false", "0", "no", "?"], doc % 4))
            .alias("is_spam_human"),
        )
    )


BUILDERS = {
    "campaign_spend_export": campaign_export,
    "media_plan": media_plan,
    "pos_sales_daily": pos_sales,
    "whatsapp_orders": chat_orders,
    "social_comments": comments,
}


class DerivedSources(Mapping):
    """The five sources by name, each derived when first asked for."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = BUILDERS[name](self.spark, self.base)
        return self._built[name]

    def __iter__(self):
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)
