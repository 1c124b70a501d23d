"""Scoring that survives: one bad text, a run cut off, a second run, compaction."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from signals.operators import scoring
from signals.operators.score_log import ScoreLog, incremental_score
from signals.params import Params
from signals.sources.io import ContractError
from signals.sources.manifest import Manifest

VERSION = Params().classifier_version
TEXTS = ["zzz", "ZZZ ", "le bissap est bon", "xyz", "", "stock et prix", *(f"qqq {i}" for i in range(30))]


def fake_model(bad=(), calls=None):
    """Labels texts; one with a word of `bad` raises. Nested, so that it travels to the workers."""

    def label_batch(texts: pd.Series) -> pd.DataFrame:
        if calls:
            with open(calls, "a") as file:
                file.write(f"{len(texts)}\n")
        for text in texts:
            if any(word in text for word in bad):
                raise RuntimeError(f"cannot read {text}")
        labels = {"language": "fr", "sentiment": "negative", "theme": "price", "is_spam": "false"}
        return pd.DataFrame(labels, index=texts.index).mask(texts.str.contains("xyz"))

    return scoring.pandas_scorer(label_batch)


def comments(spark, texts=TEXTS):
    rows = [(f"c{i}", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "comment_id string, comment_text string")


def ids(df):
    return sorted(r.comment_id for r in df.collect())


def rows(df):
    return sorted(map(str, df.drop("run_id").collect()))


def test_a_bad_text_fails_alone_and_is_tried_again(spark, tmp_path):
    calls = tmp_path / "calls"
    everything, log = comments(spark), ScoreLog(spark, str(tmp_path / "log"))
    log.score(everything, VERSION, 1, fake_model(["qqq 9", "qqq 21"], str(calls)), slices=1)
    sizes = [int(n) for n in calls.read_text().split()]
    assert max(sizes) > 8 and sizes.count(1) >= 2
    failed = {r.comment_id: r.error for r in log.failures(1).collect()}
    assert failed == {
        "c3": "no label", "c15": "RuntimeError: cannot read qqq 9", "c27": "RuntimeError: cannot read qqq 21",
    }
    scored = set(ids(log.current(VERSION)))
    assert scored == {f"c{i}" for i in range(len(TEXTS))} - {"c3", "c4", "c15", "c27"}
    log.score(everything, VERSION, 2, fake_model(), slices=1)
    assert set(ids(log.current(VERSION))) == scored | {"c15", "c27"}
    assert ids(log.failures(2)) == ["c3"]


def test_wrong_number_of_answers_is_a_failure(spark):
    scorer = scoring.pandas_scorer(lambda texts: pd.DataFrame({"language": ["fr"] * (len(texts) + 1)}))
    done, failed = scoring.predict_reporting(comments(spark, ["zzz", "qqq"]), scorer)
    assert done.isEmpty() and ids(failed) == ["c0", "c1"]


class CutOff(RuntimeError):
    pass


def stopping(scorer, after):
    """A scorer whose driver side dies at the given call."""
    calls = []

    def run(texts):
        calls.append(1)
        if len(calls) > after:
            raise CutOff
        return scorer(texts)

    return run


def test_a_run_cut_off_continues_where_it_stopped(spark, tmp_path):
    everything = comments(spark)
    whole = incremental_score(everything, str(tmp_path / "whole"), 1, scorer=fake_model(), slices=6)
    log = ScoreLog(spark, str(tmp_path / "cut"))
    with pytest.raises(CutOff):
        log.score(everything, VERSION, 1, stopping(fake_model(), 3), slices=6)
    first = ids(log.current(VERSION))
    assert 0 < len(first) < len(TEXTS) - 2
    calls = tmp_path / "calls"
    # More comments and another number of slices asked for: the run's own plan stands.
    log.score(comments(spark, [*TEXTS, "later"]), VERSION, 1, fake_model(calls=str(calls)), slices=2)
    again = sum(int(n) for n in calls.read_text().split())
    # "zzz" and "ZZZ " are one text, and may stand in two slices.
    assert again <= len(TEXTS) - 1 - len(first)
    assert rows(log.current(VERSION)) == rows(whole)
    slices = [e.part for e in log.manifest.entries("slice")]
    assert sorted(slices) == sorted(set(slices)) and len(slices) == 6


def test_a_finished_run_does_nothing_and_a_new_one_only_what_is_missing(spark, tmp_path):
    log = ScoreLog(spark, str(tmp_path / "log"))
    assert log.current(VERSION) is None
    log.score(comments(spark), VERSION, 1, fake_model(), slices=2)
    before = log.live_folders()
    log.score(comments(spark), VERSION, 1, fake_model(["qqq"]), slices=2)
    assert log.live_folders() == before
    calls = tmp_path / "calls"
    log.score(comments(spark, [*TEXTS, "one more"]), VERSION, 2, fake_model(calls=str(calls)), slices=2)
    # The failed text, and the new one.
    assert sum(int(n) for n in calls.read_text().split()) == 2
    assert f"c{len(TEXTS)}" in ids(log.current(VERSION))


def test_versions_stay_apart(spark, tmp_path):
    log = ScoreLog(spark, str(tmp_path / "log"))
    log.score(comments(spark), VERSION, 1, fake_model(), slices=1)
    with pytest.raises(ContractError, match="belongs to version"):
        log.manifest.add("todo", 7, "other/1", log.manifest.fresh("x"))
        log.score(comments(spark), VERSION, 7, fake_model())
    log.score(comments(spark), "rules-2", 2, fake_model(), slices=1)
    assert ids(log.current("rules-2")) == ids(log.current(VERSION))
    assert log.rows().count() == 2 * log.current(VERSION).count()


def test_compaction_keeps_the_newest_row_in_one_set_of_files(spark, tmp_path):
    log = ScoreLog(spark, str(tmp_path / "log"))
    log.compact()
    assert log.rows() is None
    log.score(comments(spark), VERSION, 1, fake_model(), slices=3)
    # The same comments recorded once more by a later run, under the same version.
    folder = log.manifest.fresh("rows-2-0")
    later = log.rows().withColumn("theme_model", F.lit("taste")).withColumn("run_id", F.lit(2).cast("long"))
    later.where("comment_id < 'c2'").write.parquet(folder)
    log.manifest.add("slice", 2, "0", folder)
    expected = rows(log.current(VERSION))
    log.compact(buckets=3)
    assert len(log.live_folders()) == 1
    assert rows(log.current(VERSION)) == rows(log.rows()) == expected
    log.score(comments(spark, [*TEXTS, "one more"]), VERSION, 3, fake_model(), slices=2)
    assert len(log.live_folders()) == 3
    assert log.current(VERSION).count() == len(expected) + 1
    log.compact(buckets=2)
    assert log.rows().count() == len(expected) + 1


def test_compaction_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    log = ScoreLog(spark, str(tmp_path / "log"))
    log.score(comments(spark), VERSION, 1, fake_model(), slices=2)
    before = log.live_folders()

    def broken(*_):
        raise CutOff

    monkeypatch.setattr(Manifest, "add", broken)
    with pytest.raises(CutOff):
        log.compact()
    assert log.live_folders() == before
