"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from leadmill.llm.queries import op13_spelling, table
from leadmill.llm.spelling import Acceptor, NearPairs, drop_some, near_pairs, spelling_variants, word_counts
from tests.llm.frames import SCHEMA, documents

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]
TABLES = "/root/testdata/sf0.001"


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def counted(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda c: c[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}


def brute_force(counts):
    near = {w: [] for w in counts}
    by_length = {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    for size, words in by_length.items():
        for a, b in [*combinations(words, 2), *((a, b) for a in words for b in by_length.get(size + 1, []))]:
            if is_near(a, b):
                near[a].append(b)
                near[b].append(a)
    best = {w: min(near[w], key=lambda v: (-counts[v], v)) for w in counts if near[w]}
    form = {w: v for w, v in best.items() if counts[v] >= 10 * counts[w]}
    found = []
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        found.append((w, form.get(w), root, counts[w], len(near[w]), counts.get(form.get(w))))
    return sorted(found, key=repr)


def rows_of(frame):
    assert frame.columns == COLUMNS
    return sorted(map(tuple, frame.collect()), key=repr)


def test_query_equals_brute_force(spark):
    docs = table(spark, TABLES, "documents").select("doc_id", "text").collect()
    expected = brute_force(counted([(r.doc_id, r.text) for r in docs]))
    assert rows_of(op13_spelling(spark, TABLES)) == expected and any(r[4] for r in expected)


@pytest.mark.parametrize("group", [20_000, 3])
def test_dense_vocabularies_and_cut_states(spark, group):
    rng = random.Random(5)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(7, 9))) for _ in range(300)}
    words |= {"ü" * 7, "ü" * 8, "ü" * 10, "a" * 40 + "b" + "c" * 40, "a" * 40 + "c" * 40, "a" * 40 + "d" + "c" * 40}
    words |= {"x" * 20_000, "x" * 20_001, "x" * 20_003, "xy" * 5_000, "xy" * 5_000 + "z", "xy" * 2_500 + "z" + "xy" * 2_500}
    counts = {w: 10 ** rng.randint(0, 6) + 1 for w in sorted(words)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling_variants(frame, group=group)) == brute_force(counts)
    pairs = near_pairs(frame, group)
    assert pairs.count() == pairs.distinct().count()


def test_chains_of_forms_and_ties(spark):
    counts = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2_000, "abcdefghijk": 20_000,
              "zzzzzzz": 1, "azzzzzz": 10, "zzzzzzy": 10, "yyyyyyy": 1, "yyyyyyx": 9}
    found = {r[0]: r[1:] for r in rows_of(spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))}
    assert found["abcdefg"] == ("abcdefgh", "abcdefghijk", 2, 1, 20) and found["abcdefghij"][1] == "abcdefghijk"
    assert found["zzzzzzz"] == ("azzzzzz", "azzzzzz", 1, 2, 10) and found["yyyyyyy"] == (None, "yyyyyyy", 1, 1, None)


def test_nulls_long_texts_repeated_rows_and_empty_tables(spark):
    long = " ".join(f"Wörter{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3_000)) + " " + "x" * 100_000
    texts = [None, "", long, long, "Éclairs éclairs ÉCLAIRS ECLAIRS a×b÷c×d", "don't-stop_over12345678"]
    docs = documents(spark, *texts).union(spark.createDataFrame([(None, "ECLAIRS nothing Nothing", "x", None, "s", 1, "y")] * 2, SCHEMA))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows_of(spelling_variants(word_counts(docs, drop_some))) == brute_force(counted(rows))
    assert rows_of(spelling_variants(word_counts(docs.limit(0)))) == []


def test_acceptor_is_minimal_and_pairs_are_accepted_once():
    strings = sorted({"", "a", "ab", "abc", "b", "bb", "bbc", "cab", "cb", "aabb", "aab", "abb"})
    acceptor = Acceptor(strings)

    def accepted(state):
        return frozenset([""] if acceptor.final[state] else []) | {c + t for c, q in acceptor.arcs[state].items() for t in accepted(q)}

    reached, agenda = {0}, [0]
    while agenda:
        new = set(acceptor.arcs[agenda.pop()].values()) - reached
        reached |= new
        agenda += new
    assert accepted(0) == set(strings) and len({accepted(q) for q in reached}) == len(reached)
    pairs = [frozenset(p) for p in NearPairs(strings)]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {frozenset(p) for p in combinations(strings, 2) if is_near(*p)}
