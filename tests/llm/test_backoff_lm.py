import math
from collections import Counter

import numpy as np
import duckdb
import pytest

import __spark_entry__ as registry
from leadmill.llm import backoff_lm
from leadmill.llm.backoff_lm import BACKOFF, backoff_scores
from tests.llm.frames import by_id, documents

TEXTS = ["the cat sat on the mat", "The cat sat on\tthe hat", "a dog", "the cat", None, "", "the cat sat on the mat",
         "x", " ".join(f"w{i % 700}" for i in range(30_000))]


def brute_force(texts, order, corpus=None):
    docs, learned = ([(t or "").lower().split() for t in x] for x in (texts, texts if corpus is None else corpus))
    counts = [Counter(tuple(d[i:i + k]) for d in learned for i in range(len(d) - k + 1)) for k in range(1, order + 1)]
    total = sum(counts[0].values())
    scores = {}
    for n, d in enumerate(docs):
        score = 0.0
        for i, word in enumerate(d):
            most = min(order, i + 1)
            for k in range(most, 0, -1):
                gram = tuple(d[i - k + 1:i + 1])
                if k == 1:
                    p = max(counts[0][gram], 1) / total
                elif counts[k - 1][gram]:
                    p = counts[k - 1][gram] / counts[k - 2][gram[:-1]]
                else:
                    continue
                score += math.log(p) + (most - k) * math.log(BACKOFF)
                break
        scores[n] = (len(d), round(score, 6))
    return scores


@pytest.mark.parametrize("hot", [2, 500_000])  # nearly all n-grams by the join, or nearly none
@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_agree_with_brute_force(spark, monkeypatch, order, hot):
    monkeypatch.setattr(backoff_lm, "PARTITION_GRAMS", 5_000)  # several partitions
    monkeypatch.setattr(backoff_lm, "HOT", hot)
    found = by_id(backoff_scores(documents(spark, *TEXTS), order), "n_words", "log_score")
    assert {k: (n, round(s, 6)) for k, (n, s) in found.items()} == brute_force(TEXTS, order)


@pytest.mark.parametrize("hot", [2, 500_000])
@pytest.mark.parametrize("order", [1, 2, 3])
def test_another_corpus_backs_off(spark, monkeypatch, order, hot):
    monkeypatch.setattr(backoff_lm, "HOT", hot)
    corpus = ["the cat sat", "a dog sat on the mat", "on the hat", None, "the cat"]
    found = by_id(backoff_scores(documents(spark, *TEXTS), order, corpus=documents(spark, *corpus)), "n_words", "log_score")
    assert {k: (n, round(s, 6)) for k, (n, s) in found.items()} == brute_force(TEXTS, order, corpus)


def test_many_batches_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(backoff_lm, "HASHED_BYTES", 20)
    monkeypatch.setattr(backoff_lm, "BATCH_WORDS", 3)
    found = by_id(backoff_scores(documents(spark, *TEXTS[:-1])), "n_words", "log_score")
    assert {k: (n, round(s, 6)) for k, (n, s) in found.items()} == brute_force(TEXTS[:-1], 2)


def test_repeated_rows_and_rows_without_an_id_are_scored(spark):
    docs = spark.createDataFrame([(0, "a b"), (1, "a c"), (0, "a b"), (None, "a b"), (None, "a b")], "doc_id long, text string")
    rows = backoff_scores(docs).collect()
    assert sorted([r.doc_id is None, r.doc_id or 0, r.n_words] for r in rows) == [
        [False, 0, 2], [False, 0, 2], [False, 1, 2], [True, 0, 2], [True, 0, 2]]
    assert len({round(r.log_score, 6) for r in rows if r.doc_id != 1}) == 1


def test_counts_are_in_the_plan_as_a_join(spark):
    plan = backoff_scores(documents(spark, "a b"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and "FlatMapGroups" not in plan


def test_pairs_that_the_corpus_has_once_count(spark):
    found = by_id(backoff_scores(documents(spark, "a b", "a c")), "n_words", "log_score")
    expected = math.log(2 / 4) + math.log(1 / 2)  # the share of a, then one of the two pairs that begin with a
    assert {k: (n, round(s, 6)) for k, (n, s) in found.items()} == {0: (2, round(expected, 6)), 1: (2, round(expected, 6))}


def test_empty_table(spark):
    assert backoff_scores(documents(spark, "a").limit(0)).count() == 0
    assert by_id(backoff_scores(documents(spark, None, "")), "n_words", "log_score") == {0: (0, 0.0), 1: (0, 0.0)}


def test_as_many_frequent_ngrams_are_sent_along_as_may_be(spark, monkeypatch):
    counts = spark.createDataFrame(
        [(i, n, 1) for i, n in enumerate([40, 9, 9, 5, 3, 3, 3])] + [(i, 2, 2) for i in range(10, 16)] + [(0, 71, 0)],
        "gram long, n long, length byte")
    for hot, expected in ((4, [0, 1, 2, 3]), (6, [0, 1, 2, 3, 10, 11, 12, 13, 14, 15]), (1, [0])):
        monkeypatch.setattr(backoff_lm, "HOT", hot)
        sent = counts.filter(backoff_lm._often(counts, 71)).filter("length > 0")
        assert sorted(r.gram for r in sent.collect()) == expected
        assert all(r["count"] <= hot for r in sent.groupBy("length").count().collect())


def test_ngrams_that_occur_once_are_not_sent_to_the_sums(spark):
    plan = backoff_scores(documents(spark, "a b"))._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(n#" in plan.split("Join LeftOuter")[0] and "isnotnull(base#" in plan.split("Join LeftOuter")[0]


@pytest.mark.parametrize("n", [0, 1, 7, 5_000])
def test_hashes_are_found_at_their_places(n):
    random = np.random.default_rng(n)
    held = np.unique(random.integers(0, 2**64 - 1, n, dtype=np.uint64))
    for extra in ([], [2**64 - 1], [0, 1, 2, 3, 4, 5]):  # also the greatest, and many with the same first bits
        hashes = np.unique(np.concatenate([held, np.array(extra, np.uint64)]))
        asked = np.concatenate([hashes, hashes + np.uint64(1), random.integers(0, 2**64 - 1, 500, dtype=np.uint64)])
        known, at = backoff_lm.SortedHashes(hashes).find(asked)
        assert known.tolist() == np.isin(asked, hashes).tolist() and hashes[at].tolist() == asked[known].tolist()


def test_a_query_backs_off_at_every_order(spark):
    """Three-word, two-word and single n-grams and words that the corpus lacks, against the statement."""
    tables = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{tables}/documents.parquet'")
    expected = connection.sql(registry.oracle_sql()["op1_other_corpus"]).fetchall()
    found = registry.queries()["op1_other_corpus"](spark, tables)
    assert found.columns == ["doc_id", "n_words", "log_score"] and expected
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))
    itself = {r.doc_id: r.log_score for r in registry.queries()["op1_backoff_scores"](spark, tables).collect()}
    assert any(itself[i] != s for i, _, s in expected)
