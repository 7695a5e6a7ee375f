import numpy as np

from leadmill.llm import language_id
from leadmill.llm.language_id import (
    LONGEST_RUN, LanguageModel, Scorer, fit_languages, identify_languages, training_rows,
)
from leadmill.llm.queries import op8_language
from tests.llm.frames import by_id, documents

ENGLISH = "the cat and the dog were with this house that thing"
GERMAN = "der hund und die katze waren mit diesem haus nicht dort"


def model(spark):
    docs = documents(spark, *[ENGLISH, GERMAN] * 6, langs={i: ["en", "de"][i % 2] for i in range(12)})
    return fit_languages(training_rows(docs, "doc_id >= 0"))


def test_known_and_unseen_words(spark):
    texts = ["The DOG", "der hund", "thather thising", "undie katzenhaus", None, "", "123 ²", "the", "the", "x" * 100_000]
    found = by_id(identify_languages(documents(spark, *texts), model(spark)), "lang_pred", "score")
    assert [found[i][0] for i in range(9)] == ["en", "de", "en", "de", "und", "und", "und", "en", "en"]
    assert found[4][1] == 0.0 and all(0 <= s <= 1 for _, s in found.values()) and found[7] == found[8]


def test_words_that_were_not_learned_count_by_their_longest_known_runs():
    runs = {"th": 0, "h": 1, "t": 2}
    scores = np.array([[-1.0, -5.0], [-2.0, -3.0], [-4.0, -2.0], [-9.0, -9.0]], np.float32)
    scorer = Scorer(LanguageModel(["a", "b"], {}, np.empty((0, 2), np.float32), runs, scores))
    # " th ": of the runs of two characters one is known, two are not; nothing longer is known.
    assert np.allclose(scorer.unseen(["th"]), [[(-1 - 9 - 9) / 3, (-5 - 9 - 9) / 3]])
    assert np.allclose(scorer.unseen(["h"]), [[-2, -3]])
    assert np.allclose(scorer.unseen(["zz"]), [[-9, -9]]) and LONGEST_RUN > 2


def test_nothing_to_learn_from_and_empty_tables(spark):
    nothing = fit_languages(training_rows(documents(spark, ENGLISH), "true"))
    assert by_id(identify_languages(documents(spark, "the"), nothing), "lang_pred", "score") == {0: ("und", 0.0)}
    assert identify_languages(documents(spark, "a").limit(0), model(spark)).count() == 0


def test_learning_is_bounded_for_each_language(spark):
    docs = documents(spark, *[ENGLISH] * 3000, GERMAN, langs={i: "en" for i in range(3000)} | {3000: "de"})
    sizes = {r.lang: r["count"] for r in training_rows(docs, "true", 200).groupBy("lang").count().collect()}
    assert sizes["de"] == 1 and 120 < sizes["en"] < 280


def test_held_out_accuracy(spark):
    tables = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "lang")
    found = op8_language(spark, tables).join(docs, "doc_id").filter("held_out AND lang IS NOT NULL")
    rows = found.collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_a_rare_language_keeps_its_words_when_the_model_is_full(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MODEL_WORDS", 12)
    monkeypatch.setattr(language_id, "MODEL_RUNS", 12)
    rows = [("en", " ".join(f"word{chr(97 + i)}" for i in range(26)))] * 50 + [("xx", "zuq zuq vyk")] * 2
    model = fit_languages(spark.createDataFrame(rows, "lang string, text string"))
    assert model.languages == ["en", "xx"] and {"zuq", "vyk"} <= set(model.words) and len(model.words) == 12
