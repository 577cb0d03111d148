"""Language models and the quality classifier."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from samples import EDGE
from haulage.llm import langid, quality
from haulage.llm.langid import fold, identify
from haulage.llm.quality import Machine, features, score_quality
from haulage.llm.shared import Scratch

SYLLABLES = {"aa": "ka to mi ra ne so".split(), "bb": "sch gru pft orn ber zwi".split()}


def speak(lang, seed, n=40):
    pick = random.Random(f"{lang}{seed}")
    return " ".join("".join(pick.choice(SYLLABLES[lang]) for _ in range(pick.randint(1, 4))) for _ in range(n))


def test_languages(frame):
    rows = [(i, speak(lang, i), lang, "s", 0) for i in range(120) for lang in ("aa",)]
    rows += [(200 + i, speak("bb", i, 1 + i % 40), "bb", "s", 0) for i in range(120)]
    rows += [(400 + i, t, None, "s", 0) for i, t in enumerate(EDGE)] + [(0, speak("aa", 0), "aa", "s", 0)]
    learn = fold(F.col("doc_id"), 4) != 2
    out = identify(frame(rows), learn).select("doc.doc_id", "doc.lang", "lang_pred", "score").collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert all(r.lang_pred == r.lang for r in out if r.lang and len(rows[0][1]) > 3)
    und = {r.doc_id for r in out if r.lang_pred == "und"}
    assert und == {400 + i for i, t in enumerate(EDGE) if not any(c.isalpha() for c in t or "")}


def test_no_language_to_learn(frame, clashing, rows):
    out = identify(clashing(rows), F.lit(False))
    assert {r.lang_pred for r in out.collect()} == {"und"} and out.count() == len(rows)
    assert identify(frame([]), F.lit(True)).count() == 0


def test_probabilities_add_up(spark):
    texts = [(speak("aa", i), "aa", False) for i in range(20)]
    with Scratch(spark) as tables:
        rows = spark.createDataFrame(texts, "text string, lang string, aside boolean")
        model = langid.train(langid.counts(rows, ["aa"], tables), ["aa"], tables)
    letters = model.runs[0][0]
    for context in np.unique(model.runs[3][0] >> langid.BITS)[::7]:
        p = np.exp(model.log_probability((context << langid.BITS) | letters, 4).astype(float)).sum()
        # What is missing is the share that unseen characters get from the uniform order.
        assert 0.97 < p < 1.001


def test_a_letter_run_is_read_the_same_in_any_spacing():
    a, b = (langid.runs([t])[0].tolist() for t in ("Ab,  c!", " ab c "))
    assert a == b and langid.runs([None, "", "1 2"])[2].tolist() == [0, 0, 0]


def test_sum_of_squares_identity():
    machine = Machine(3, seed=2)
    pick = np.random.default_rng(0)
    machine.w, machine.bias = pick.normal(size=machine.w.shape), 0.3
    d, x = pick.integers(0, quality.DIMENSIONS, 12), pick.normal(size=12)
    pairs = sum(machine.v[d[i]] @ machine.v[d[j]] * x[i] * x[j] for i in range(12) for j in range(i))
    odds, _ = machine.raw(np.zeros(12, np.int64), d, x, 1)
    assert odds[0] == pytest.approx(0.3 + machine.w[d] @ x + pairs)


def junk(seed):
    return (speak("aa", seed, 8).upper() + "!! ") * 5


def test_quality_is_learnt_on_held_out_rows(spark, frame):
    rows = [(i, junk(i) if i % 4 == 0 else speak("aa", i, 20 + i % 50), "aa", "s", 0) for i in range(400)]
    rows += [(400 + i, t, None, None, None) for i, t in enumerate(EDGE)] + [rows[1], rows[1]]
    labels = [(i, int(i % 4 != 0)) for i in range(400)] + [(1, 1), (2, None), (None, 0), (9999, 1)]
    known = spark.createDataFrame(labels, "doc_id bigint, quality int")
    out = score_quality(frame(rows), known, fold(F.col("id"), 5) != 0) \
        .select("doc.doc_id", (fold(F.col("doc.doc_id"), 5) == 0).alias("held"), "score").collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    held = [(r.score >= 0.3) == (r.doc_id % 4 != 0) for r in out if r.held and r.doc_id < 400]
    assert len(held) > 50 and np.mean(held) > 0.95


def test_no_labels_and_empty_table(spark, frame, clashing, rows):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in score_quality(clashing(rows), none, F.lit(True)).collect()} == {quality.NO_MODEL}
    assert score_quality(frame([]), none, F.lit(True)).count() == 0


def test_features_of_nothing():
    row, dimension, value, stats = features([None, b""], np.full((2, 1), np.nan))
    assert not len(row) and not stats.any()


def test_clashing_columns_beside_a_model(spark, clashing, frame, rows):
    taught = [(100 + i, speak(lang, i, 8), lang, "s", 0) for i in range(12) for lang in ("aa", "bb")] + rows[:9] + [rows[3]]
    plain, wide = (sorted((r.doc.doc_id, r.lang_pred, round(r.score, 6)) for r in identify(make(taught), F.col("lang") != "en").collect())
                   for make in (frame, clashing))
    assert plain == wide and len(plain) == len(taught) and {lang for _, lang, _ in plain} >= {"aa", "bb"}
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(12)], "doc_id bigint, quality int")
    plain, wide = (sorted((r.doc.doc_id, round(r.score, 6)) for r in score_quality(make(taught), labels, F.lit(True)).collect())
                   for make in (frame, clashing))
    assert [i for i, _ in plain] == [i for i, _ in wide] and all(0 <= p <= 1 for _, p in wide)
