import random
import re
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leadmill.llm import ngram_join
from leadmill.llm.components import components
from leadmill.llm.ngram_join import near_duplicates
from leadmill.llm.shared import BATCH_BYTES, pick
from tests.llm.frames import by_id, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(SMALL))
    if len(words) < 4:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 4]) for i in range(len(words) - 3)}


def brute_force(texts, percent=85):
    sets = [shingles(t) for t in texts]
    group = list(range(len(texts)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                group[y] = x
    return {i: (len(s), root(i)) for i, s in enumerate(sets)}


def corpus(seed=3):
    """Copies, near copies of many degrees, chains of them, a passage and a line that many texts have."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(words, k=60))
    texts = [None, "", "one", "One", "two words", "a b c d", "A b  c\td", "a b c d e"]
    for _ in range(25):
        base = rng.choices(words, k=rng.choice([5, 8, 12, 20, 40, 90, 200]))
        if rng.random() < 0.4:
            base = base + passage.split()
        last = base
        for _ in range(rng.choice([0, 1, 3, 8])):
            changed = list(last if rng.random() < 0.5 else base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                changed[rng.randrange(len(changed))] = rng.choice(words)
            last = changed
            texts.append(" ".join(changed))
        texts.append(" ".join(base))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("boundaries", [[0], [24], [96]])
def test_components_agree_with_brute_force(spark, monkeypatch, boundaries):
    monkeypatch.setattr(ngram_join, "BOUNDARIES", boundaries)
    texts = corpus()
    found = by_id(near_duplicates(documents(spark, *texts)), "n_shingles", "component_id")
    assert found == brute_force(texts)


def test_one_round_of_centres_loses_no_link_either(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "ROUNDS", 1)
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)
    texts = corpus(8)
    assert by_id(near_duplicates(documents(spark, *texts)), "n_shingles", "component_id") == brute_force(texts)


def test_a_group_of_near_copies_is_one_component(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    texts = []
    for _ in range(120):
        text = list(base)
        for _ in range(2):
            text[rng.randrange(150)] = f"r{rng.random()}"
        texts.append(" ".join(text))
    texts += [" ".join(base)] * 200
    found = by_id(near_duplicates(documents(spark, *texts)), "component_id")
    assert {c for c, in found.values()} == {0}


def test_other_similarities(spark):
    texts = corpus(6)
    assert by_id(near_duplicates(documents(spark, *texts), percent=80), "n_shingles", "component_id") == brute_force(texts, 80)


def test_null_ids_repeated_rows_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = documents(spark, text, text, text).withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id") * 0 + 7))
    rows = sorted(map(tuple, near_duplicates(docs).collect()), key=str)
    assert rows == [(7, 27, 7), (7, 27, 7), (None, 27, None)]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_components_of_long_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 400)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    expected = defaultdict(int) | {i: 100 for i in range(100, 161)} | {i: 5 for i in [5, *range(200, 400)]}
    assert found == expected


def test_frequent_shingles_are_known_by_number_not_by_share(spark, monkeypatch):
    """Lists that are small beside the table, but long: only the most frequent shingles are sent, however large the table."""
    common = "a shingle of five words"
    docs = spark.range(12_000).select(F.when(F.col("id") % 2_000 < 5, F.lit(common)).otherwise(
        F.concat(F.lit("w"), F.col("id").cast("string"))).alias("text")).coalesce(1)
    keys, n = ngram_join.frequent_shingles(docs.filter("text LIKE 'w%'").limit(11_000).union(
        docs.filter(F.col("text") == common).limit(5)).coalesce(1), "text", 5)
    assert n.tolist() == [5]
    counts = spark.range(1, 101).select(F.col("id").alias("shingle"), F.col("id").alias("n"))
    sent = [r.n for r in ngram_join._most_frequent(counts, 10).collect()]
    assert 0 < len(sent) <= 10 and min(sent) == 101 - len(sent)
    assert ngram_join._most_frequent(counts.limit(0), 10).count() == 0


def test_batches_are_small(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    long = spark.range(0, 2_000, 1, 1).select(F.repeat(F.lit("word "), 2_000).alias("text"))
    sent = [r.n for r in pick(long, "text").mapInArrow(sizes, "n long").collect()]
    assert sum(sent) > 20_000_000 and max(sent) < 2 * BATCH_BYTES
