import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from signals.functions import lexicon as lx
from signals.functions.patterns import Markers, known_words
from signals.operators import conform, evaluation, scoring, voice_rules
from signals.sources.io import ContractError

# text -> (language, sentiment, theme, product, is_spam)
CASES = {
    "le bissap est pas bon": ("fr", "negative", "taste", "bissap", False),
    "pas mauvais du tout": ("fr", "positive", "other", None, False),
    "je ne dirais pas que c'est bon": ("fr", None, "taste", None, False),
    "vous livrez ici ?": ("fr", "neutral", "delivery", None, False),
    "bon vous livrez ici ?": ("fr", "neutral", "delivery", None, False),
    "❤️❤️": ("other", "positive", "other", "none", False),
    "😡": ("other", "negative", "other", "none", False),
    "❤️😡": ("other", "neutral", "other", "none", False),
    "+1": ("fr", "neutral", "other", "none", False),
    "cliquez ici pour le bissap": ("fr", "neutral", "other", "none", True),
    "so tasty": ("en", None, "taste", None, False),
    "her": ("en", None, None, None, None),
    "le gingembre est enjaillant": ("nouchi", "positive", "taste", "gingembre", False),
    "sucre ?": (None, "neutral", "health", None, False),
    "trop cher la bouteille": ("fr", "negative", "price", None, False),
    "bissap et bouye": ("fr", None, None, "multiple", False),
    "stock et prix": ("fr", None, None, None, None),
    "xyz": (None, None, None, None, None),
    "dégustation bonne": ("fr", "positive", "promotion", None, False),
}


@pytest.fixture(scope="module")
def ruled(spark):
    rows = [(str(i), t) for i, t in enumerate(CASES)]
    df = spark.createDataFrame(rows, "comment_id string, comment_text string")
    return voice_rules.classify_rules(df)


def test_rules(ruled):
    got = {r.comment_text: (r.rule_language, r.rule_sentiment, r.rule_theme, r.rule_product,
                            r.rule_is_spam) for r in ruled.collect()}
    assert got == CASES


def test_rules_stay_in_the_jvm_and_narrow(spark):
    df = spark.range(1).selectExpr("'1' as comment_id", "cast(id as string) as comment_text")
    plan = voice_rules.classify_rules(df).where("rule_theme = 'taste'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Exchange" not in text


def test_markers_split():
    got = Markers.of([r"livr\w*", "boutique?s?", r"plus\s+rien", r"\d+\s?(?:cl|l)"])
    assert got.stems == ("livr",)
    assert set(got.words) == {"boutiqu", "boutiqus", "boutique", "boutiques"}
    assert (got.phrases, got.anchors, got.free) == (
        (r"plus\s+rien",), ("plus",), (r"\d+\s?(?:cl|l)",)
    )


def test_no_stem_hides_another():
    assert not [(a, b) for a in voice_rules.STEMS for b in voice_rules.STEMS
                if a != b and a.startswith(b)]


def test_default_labels_equal_constant_scorer(ruled):
    scores = scoring.score_distinct_texts(ruled)
    merged = scoring.merge_rules_and_scores(ruled, scores)
    default = scoring.default_labels(ruled)
    assert sorted(map(str, merged.collect())) == sorted(map(str, default.collect()))


def test_conform_labels(spark):
    raw = spark.createDataFrame(
        [(" FR ", "great", None, "yes"), ("fr", "positive", "taste", None)],
        "language string, sentiment string, theme string, is_spam string",
    )
    a, b = scoring.conform_labels(raw).collect()
    assert (a.language, a.sentiment, a.theme, a.is_spam, a.coerced) == (
        "fr", "neutral", "other", True, ["sentiment", "theme"],
    )
    assert (b.is_spam, b.coerced) == (False, [])


def test_known_other_names_are_repaired_first(spark):
    raw = spark.createDataFrame(
        [("fr", "neutral", " Stock FINI", None), ("fr", "neutral", "stock", None)],
        "language string, sentiment string, theme string, is_spam string",
    )
    a, b = scoring.conform_labels(raw).collect()
    assert (a.theme, a.coerced, b.theme, b.coerced) == ("availability", [], "other", ["theme"])
    assert set(lx.THEME_ALIASES.values()) <= set(lx.CLASSES["theme"])


def test_labels_without_a_join_equal_the_joined_ones(spark):
    rows = [(f"c{i}", "p", None, "a", t, i, None) for i, t in enumerate([*CASES, "", "bissap", "bissap"])]
    comments = spark.createDataFrame(
        rows, "comment_id string, platform string, published_at timestamp, author_handle string, "
        "comment_text string, like_count int, reply_to_id string"
    )
    joined = conform.comments_enriched(comments, scoring.predict(comments))
    labelled = scoring.labelled_comments(comments)
    assert joined.columns == labelled.columns
    assert sorted(map(str, joined.collect())) == sorted(map(str, labelled.collect()))
    assert "Join" not in labelled._jdf.queryExecution().executedPlan().toString()


def test_merge_validated_is_all_or_nothing(spark):
    schema = ("comment_id string, comment_text string, language_human string, sentiment_human "
              "string, theme_human string, product_human string, is_spam_human string")  # fmt: skip
    human = spark.createDataFrame([("a", "t", "fr", "neutral", "other", "none", "false")], schema)
    rows = [("b", "t", "fr", "positive", "taste", "none", "false", "Oui"),
            ("c", "t", "fr", "bof", "taste", "none", "false", "non")]
    draft = spark.createDataFrame(rows, schema + ", validated string")
    merged, rest = evaluation.merge_validated(human, draft)
    assert (merged.count(), rest.count()) == (2, 1)
    bad = draft.withColumn("validated", F.lit("oui"))
    with pytest.raises(ContractError, match="c: sentiment_human"):
        evaluation.merge_validated(human, bad)


def test_vocabularies_cover_defaults():
    assert all(lx.DEFAULTS[f] in lx.CLASSES[f] for f in ("language", "sentiment", "theme"))


def test_a_text_is_looked_up_by_its_known_words_only(spark):
    """Work per word: a long text of unknown words leaves nothing for the rules to look through."""
    rows = [
        ("1", "zzz " * 5000 + "le bissap est pas bon"), ("2", "zzz " * 300), ("3", "bon bon bon, diabétique"), ("4", ""),
        ("5", " mais le bissap qui est comme moi ??\u0085"), ("6", "c'est comme moi"), ("7", None),
    ]
    df = spark.createDataFrame(rows, "comment_id string, comment_text string")
    normal = voice_rules.normalize_comment(F.col("comment_text"))
    words = known_words(normal, voice_rules.KNOWN_WORDS, voice_rules.STEMS)
    found = {r.comment_id: r for r in df.select("*", normal.alias("n"), voice_rules.strip_fillers(normal).alias("b"), words.alias("w")).collect()}
    assert found["1"].w == ["le", "bissap", "est", "pas", "bon"]
    assert found["2"].w == [] and found["4"].w == [] and found["7"].w is None
    assert found["3"].w == ["bon", "diabétique"]
    assert (found["5"].n, found["5"].b) == ("mais le bissap qui est comme moi ??", "le bissap")
    assert found["6"].b == "c'est comme moi" and found["7"].b is None
    labels = {r.comment_id: r for r in voice_rules.classify_rules(df).collect()}
    assert (labels["1"].rule_sentiment, labels["1"].rule_theme, labels["1"].rule_product) == ("negative", "taste", "bissap")
    assert labels["3"].rule_theme == "health"


def test_sizes_are_only_searched_where_a_word_begins_with_a_digit(spark):
    texts = ["zzz 33cl", "zzz 5 l", "zzz ٣٣ cl", "zzz x33cl", "zzz cl ßé Ωλ 中文", "bon 1 l"]
    rows = [(str(i), t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "comment_id string, comment_text string")
    words = known_words(F.col("comment_text"), voice_rules.KNOWN_WORDS, voice_rules.STEMS)
    found = [r.w for r in df.select("comment_id", words.alias("w")).orderBy("comment_id").collect()]
    assert found == [["33cl"], ["5"], ["٣٣"], [], [], ["bon", "1"]]
    ruled = voice_rules.classify_rules(df).orderBy("comment_id").collect()
    assert [r.rule_theme for r in ruled] == ["packaging", "packaging", "packaging", None, None, "packaging"]


def test_the_newest_row_does_not_hang_on_the_order_of_rows(spark):
    rows = [("1", "same", "taste", 2), ("1", "same", "price", 2), ("1", "later", "other", 1), ("2", None, "price", 1)]
    schema = "comment_id string, comment_text string, theme_model string, run_id int"
    for given in (rows, rows[::-1]):
        kept = scoring.keep_last(spark.createDataFrame(given, schema).coalesce(1))
        assert kept.columns == ["comment_id", "comment_text", "theme_model", "run_id"]
        assert sorted(map(tuple, kept.collect())) == [("1", "same", "taste", 2), ("2", None, "price", 1)]


@pytest.mark.parametrize("name", ["keep_last", "version_drift", "top_themes", "points_label", "previous_by_month"])
def test_comments_are_labelled_once(spark, name):
    """A labelling with several readers is written first or shared, not planned once a reader."""
    plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 1
