"""Stages of the pipeline where they differ from their operators' queries."""

import corpus_pipeline
from leadmill.llm.ngram_join import near_duplicates
from tests.llm.frames import documents


def test_near_copies_share_five_word_shingles_from_four_fifths(spark):
    words = [f"w{i}" for i in range(100)]
    def changed(*places):
        return " ".join("x" if i in places else w for i, w in enumerate(words))
    # Similarity with the first: 0.811 by five words and 0.848 by four, 0.730 by five words.
    docs = documents(spark, changed(), changed(30, 70), changed(20, 50, 80))
    assert sorted(r.doc_id for r in corpus_pipeline.deduplicate(spark, docs, "").collect()) == [0, 2]
    assert {r.doc_id: r.component_id for r in near_duplicates(docs).collect()} == {0: 0, 1: 1, 2: 2}
