import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from leadmill.llm.quality_rules import (
    COUNTS, apply_rules, document_statistics, fit_rules, learn_rules, text_counts,
)
from tests.llm.frames import by_id, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    found = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if found[w] > 1 for j in range(i, i + 3)}
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            duplicates += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(repeated)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab\n #| é\x0b\x1c\r", max_size=60))
def test_counts_agree_with_their_definitions(text):
    assert text_counts(text)[:5] == plain_counts(text)


GOOD = " ".join(f"word{i}" for i in range(60))
NOISY = " ".join(f"w{i}###" for i in range(60))


def test_nulls_short_repeated_and_long_texts(spark):
    texts = [None, "", "too short", GOOD, GOOD, "a b c " * 40, " ".join(f"x{i}" for i in range(200_000))]
    judged = by_id(apply_rules(document_statistics(documents(spark, *texts)), []), "n_words", "base_failed", "kept")
    assert judged == {0: (0, True, False), 1: (0, True, False), 2: (2, True, False), 3: (60, False, True),
                      4: (60, False, True), 5: (120, True, False), 6: (200_000, False, True)}
    carried = document_statistics(documents(spark, GOOD), carried=("doc_id", "text", "source"))
    assert carried.columns == ["doc_id", "text", "source", *COUNTS] and carried.first().text == GOOD


def test_rules_are_learned_and_applied(spark):
    docs = documents(spark, *[NOISY + f" {i}" if i % 4 == 0 else GOOD + f" {i}" for i in range(120)])
    labels = spark.createDataFrame([(i, int(i % 4 != 0), "z") for i in range(90)] + [(None, 0, "z"), (3, None, "z"), (4, 0, "z")],
                                   "doc_id long, quality int, QUALITY string")
    rules = fit_rules(docs, labels)
    assert len(rules) == 1
    kept = by_id(apply_rules(document_statistics(docs), rules), "kept", "failed_rule")
    assert all(kept[i][0] == (i % 4 != 0) for i in range(120))
    assert kept[0][1] == str(rules[0][0])
    assert fit_rules(docs, labels, limit=20) and fit_rules(docs, labels.limit(0)) == [] == fit_rules(docs.limit(0), labels)


def test_a_rule_has_several_conditions_and_noise_gives_none():
    rng = np.random.default_rng(1)
    values = {"symbols_per_word": rng.random(3000), "upper_words": rng.random(3000)}
    poor = (values["symbols_per_word"] > 0.8) & (values["upper_words"] > 0.7)
    rules = learn_rules(values, poor)
    covered = np.zeros(3000, bool)
    for rule in rules:
        hit = np.ones(3000, bool)
        for condition in rule:
            hit &= condition.holds(values)
        covered |= hit
    assert (covered == poor).mean() > 0.99 and max(map(len, rules)) >= 2
    assert learn_rules(values, rng.random(3000) < 0.1) == []
    assert learn_rules(values, np.zeros(3000, bool)) == []


def test_empty_table(spark):
    assert apply_rules(document_statistics(documents(spark, "a").limit(0)), []).count() == 0
