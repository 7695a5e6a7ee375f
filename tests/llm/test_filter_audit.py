"""The audit against filters applied one after the other."""

from itertools import permutations

import pandas as pd
import pytest

from leadmill.llm.filter_audit import FILTERS, audit_filters, subset_states
from tests.llm.frames import SCHEMA, documents

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
LABELS = "doc_id long, quality int, toxic int, QUALITY string"


def brute_force(rows, labels):
    """Every order applied filter by filter; rows are (id, text, part)."""
    rows = [(i, t or "", p or "") for i, t, p in rows]

    def fails(i, t):
        words = t.split()
        return {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), "D": any(c in "#$%&*|" for c in t),
                "E": i is not None and any(j is not None and j < i and t == u for j, u, _ in rows)}

    judged = [(fails(i, t), p, any(l[0] == i and l[1] == 1 for l in labels if i is not None),
               any(l[0] == i and l[2] == 1 for l in labels if i is not None)) for i, t, p in rows]
    found, shapley = [], {}
    for part in {p for _, p, _, _ in judged}:
        for order in map("".join, permutations(FILTERS)):
            left = [r for r in judged if r[1] == part]
            everyone = list(left)
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[0][f]]
                left = [r for r in left if not r[0][f]]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                found.append([part, order, step, len(left), len(gone), sum(r[0][f] for r in everyone) - len(gone),
                              sum(r[0][f] and sum(r[0].values()) == 1 for r in everyone),
                              sum(r[2] for r in gone), sum(r[3] for r in gone), f])
    return sorted((*r[:9], shapley[r[0], r[9]]) for r in found)


def rows_of(frame):
    assert frame.columns == COLUMNS
    return sorted(map(tuple, frame.collect()))


def test_every_order_equals_filters_applied_one_by_one(spark):
    good = " ".join(f"w{i}" for i in range(120))
    shouted = " ".join(f"W{i}" for i in range(120))
    texts = [good, good, shouted, shouted + " #1", "short", "short", "", None, "a " * 150, "a " * 150 + "|", good + " $",
             good, "\t\x0b ", "É" * 50, "A" * 11 + "é" * 99, "A" * 10 + "é" * 90, good + " x" * 3_000, good + " y"]
    langs = {0: "en", 1: "de", 2: "en", 3: "", 4: "en", 6: "en", 10: "de", 11: "en"}
    docs = documents(spark, *texts, langs=langs)
    labels = [(0, 1, 0, "q"), (1, 1, 1, "q"), (1, 0, 1, "q"), (3, 0, 1, "q"), (5, 1, None, "q"), (99, 1, 1, "q"), (None, 1, 1, "q")]
    expected = brute_force([(r.doc_id, r.text, r.lang) for r in docs.collect()], labels)
    assert rows_of(audit_filters(docs, spark.createDataFrame(labels, LABELS))) == expected
    assert len(expected) == 3 * 120 * 5


def test_repeated_rows_null_ids_and_a_text_of_many_ids(spark):
    rows = [(1, "x", "a"), (1, "x", "a"), (1, "x", "b"), (0, "y", "a"), (2, "x", "a"), (None, "x", "a"), (None, "x", "a"), (None, None, None)]
    rows += [(i, "same", "ab"[i % 2]) for i in range(10, 400)]
    docs = spark.createDataFrame([(i, t, "x", p, "s", None, "y") for i, t, p in rows], SCHEMA)
    labels = [(1, 1, 1, "q"), (12, 1, 0, "q"), (10, 0, 1, "q")]
    assert rows_of(audit_filters(docs, spark.createDataFrame(labels, LABELS))) == brute_force(rows, labels)


@pytest.mark.parametrize("empty", ["documents", "labels"])
def test_empty_tables(spark, empty):
    docs = documents(spark, "one", "two #")
    labels = spark.createDataFrame([(0, 1, 1, "q")], LABELS)
    found = rows_of(audit_filters(docs.limit(0) if empty == "documents" else docs, labels.limit(0) if empty == "labels" else labels))
    assert found == ([] if empty == "documents" else brute_force([(0, "one", None), (1, "two #", None)], []))


def test_states_are_the_survivors_of_every_subset(spark):
    cells = pd.DataFrame([("p", mask, 1 << mask, mask, mask % 3) for mask in range(8)], columns=["part", "mask", "n", "good", "toxic"])
    state = subset_states(spark.createDataFrame(cells, "part string, mask int, n long, good long, toxic long"), "XYZ").first()
    for subset in range(8):
        alive = [m for m in range(8) if not m & subset]
        assert (state.n[subset], state.good[subset], state.toxic[subset]) == (
            sum(1 << m for m in alive), sum(alive), sum(m % 3 for m in alive))
    assert state.unique == [1 << 1, 1 << 2, 1 << 4]
