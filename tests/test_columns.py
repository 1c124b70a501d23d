import unicodedata
from datetime import date, datetime

import duckdb
from pyspark.sql import functions as F

from signals.functions import dates, labels, money, text


def test_parse_mixed_date(column_values):
    texts = ["2026-02-01", "1/2/2026", " 1 février 2026 ", "1 fevrier 2026", "31/02/2026",
             "31 avril 2026", "5 août 2025", "hier", "", None]
    first = date(2026, 2, 1)
    assert column_values(texts, dates.parse_mixed_date) == [
        first, first, first, None, None, None, date(2025, 8, 5), None, None, None,
    ]


def test_parse_french_month(column_values):
    texts = ["février 2026", "Fevrier  2026 ", "AOÛT 2025", "aout 2025", "T1 2026", "mai 26", None]
    assert column_values(texts, dates.parse_french_month) == [
        date(2026, 2, 1), date(2026, 2, 1), date(2025, 8, 1), date(2025, 8, 1), None, None, None,
    ]


def test_parse_mixed_timestamp(column_values):
    texts = ["2026-01-05 09:30", "5/1/2026 9:30", "2026-01-05", "05/01/2026", "hier soir", None]
    noon, day = datetime(2026, 1, 5, 9, 30), datetime(2026, 1, 5)
    assert column_values(texts, dates.parse_mixed_timestamp) == [noon, noon, day, day, None, None]


def test_money(column_values):
    texts = ["1 100 000 FCFA", "617700", "524,42 EUR", "-", "1.2.3", "", None, "68 900 fcfa"]
    assert column_values(texts, money.parse_money) == [
        1100000.0, 617700.0, 524.42, None, None, None, None, 68900.0,
    ]
    assert column_values(["5 eur", "5", None], money.detect_currency) == ["EUR", "FCFA", "FCFA"]

    def converted(x):
        return money.convert_fx(money.parse_money(x), money.detect_currency(x), 655.0)

    assert column_values(["2 EUR", "2", "x"], converted) == [1310.0, 2.0, None]


def test_entity_key_of_any_accent(column_values):
    """As DuckDB's strip_accents, which the check SQL uses."""
    letters = [chr(c) for a, b in ((0xC0, 0x250), (0x370, 0x530), (0x1E00, 0x2000)) for c in range(a, b)]
    accented = [c for c in letters if unicodedata.decomposition(c)[:1] not in ("", "<") and c.isalpha()]
    texts = ["Cafe\u0301", "Ph\u1ea1m", *accented, *(unicodedata.normalize("NFD", c) for c in accented)]
    sql = "SELECT lower(strip_accents(x)) FROM (SELECT unnest(?) AS x, generate_subscripts(?, 1) AS i) ORDER BY i"
    wanted = [v for (v,) in duckdb.execute(sql, [texts, texts]).fetchall()]
    assert column_values(texts, text.entity_key) == wanted
    assert wanted[:2] == ["cafe", "pham"]


def test_entity_key(column_values):
    texts = ["Épicerie  du Marché ", "EPICERIE DU MARCHE", "épicerie du marché 2", None]
    assert column_values(texts, text.entity_key) == [
        "epicerie du marche", "epicerie du marche", "epicerie du marche 2", None,
    ]


def test_normalize_phone(column_values):
    texts = ["05 48 68 72 57", "+225 0548687257", "2250548687257", "1230548687257", "abc", "", None]
    good = "+2250548687257"
    assert column_values(texts, text.normalize_phone) == [good] * 3 + [None] * 4


def test_labels_fall_through(column_values):
    assert column_values([" META", "google ads", "Affiche "], labels.canon_platform) == [
        "Meta", "Google", "Affiche",
    ]
    assert column_values(["fb/ig", " Radio"], labels.canon_channel) == ["Meta", "Radio"]
    assert column_values(["Notoriété", "CONV", "Autre"], labels.canon_objective) == [
        "awareness", "conversions", "autre",
    ]
    assert column_values(["LIVRÉE", "Annule", "en cours", "Perdu"], labels.canon_status) == [
        "delivered", "cancelled", "pending", "perdu",
    ]


def test_rounding_and_ratios(spark):
    row = spark.range(1).select(
        money.round_half_up(F.lit(0.25), 1).alias("a"),
        money.ratio(F.lit(1), F.lit(0)).alias("b"),
        money.variation(F.lit(5.0), F.lit(-10.0)).alias("c"),
        money.percent(F.lit(1), F.lit(3)).alias("d"),
    ).first()
    assert (row.a, row.b, row.c, row.d) == (0.3, None, 1.5, 33.3)


def test_literal_array_quotes(spark):
    values = ["l'eau", "a\\b", "é"]
    assert spark.range(1).select(text.literal_array(values)).first()[0] == values
