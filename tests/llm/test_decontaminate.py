import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from leadmill.llm import decontaminate
from leadmill.llm.decontaminate import (
    BLOCKS, RADIUS, SIMILARITY, WIDTH, BenchmarkIndex, distance, find_passages, weighted_similarity, without_passages,
)
from leadmill.llm.words import shingle_hashes, word_hashes
from tests.llm.frames import documents

ITEM = "the quick brown fox jumps over the lazy dog while seven wizards make toxic brew for the evil queen and jack"
OTHER = "Pack my box with five dozen liquor jugs before the judge and the jury vow to quiz them both again today"


def benchmark(spark, *texts):
    return spark.createDataFrame([(n, t, "x") for n, t in enumerate(texts)], "item_id long, text string, TEXT string")


def words(n, seed=0):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def test_passages_are_found_where_they_are(spark):
    changed = ITEM.replace("wizards", "lizards")
    docs = documents(spark, f"{words(40)} {ITEM.upper()}\n{words(30, 1)}", words(500, 2), None, "", ITEM,
                     f"{words(3)} {changed} {words(2)}", f"{OTHER} {words(9)} {ITEM}", " ".join(ITEM.split()[:9]), ITEM)
    found = {(r.doc_id, r.item_id): (r.first_word, round(r.similarity, 3)) for r in
             find_passages(docs, benchmark(spark, ITEM, OTHER, None, "", words(20, 9))).collect()}
    n = len(ITEM.split()) - 4
    near = round((n - 5) / (n + 5), 3)
    expected = {(0, 0): (40, 1.0), (4, 0): (0, 1.0), (6, 0): (len(OTHER.split()) + 9, 1.0), (6, 1): (0, 1.0), (8, 0): (0, 1.0)}
    assert near < 0.8 and found == expected


def test_near_passages_count_from_the_similarity_on(spark):
    item = words(60, 4)
    one = item.split()
    one[30] = "changed"
    four = item.split()
    for i in (5, 20, 35, 50):
        four[i] = "changed"
    docs = documents(spark, f"{words(20)} {' '.join(one)} {words(20, 1)}", f"{words(20)} {' '.join(four)} {words(20, 1)}")
    found = [(r.doc_id, round(r.similarity, 4)) for r in find_passages(docs, benchmark(spark, item)).collect()]
    assert found == [(0, round(51 / 61, 4))]


def test_rows_without_passages_are_kept_whole(spark):
    docs = documents(spark, ITEM, words(80), None, f"x {OTHER}")
    kept = without_passages(docs, benchmark(spark, ITEM, OTHER))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert without_passages(docs, benchmark(spark, ITEM).limit(0)).count() == 4
    assert find_passages(docs, benchmark(spark, ITEM).limit(0)).count() == 0
    assert find_passages(docs.limit(0), benchmark(spark, ITEM)).count() == 0


def test_a_benchmark_in_several_blocks_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BENCHMARK_BYTES", 100)
    docs = documents(spark, ITEM, words(80), f"x {OTHER}")
    found = sorted((r.doc_id, r.item_id) for r in find_passages(docs, benchmark(spark, ITEM, OTHER, words(30, 7))).collect())
    assert found == [(0, 0), (2, 1)]
    assert [r.doc_id for r in without_passages(docs, benchmark(spark, ITEM, OTHER)).collect()] == [1]


def test_the_index_finds_all_hashes_within_the_radius():
    rng = np.random.default_rng(1)
    index = BenchmarkIndex(list(range(40)), [words(30, i) for i in range(40)])
    items = index.by_size[26]
    windows = []
    for i in range(2000):
        h = int(items.hashes[i % 40])
        for bit in rng.choice(64, rng.integers(0, RADIUS + 6), replace=False):
            h ^= 1 << int(bit)
        windows.append(h)
    windows = np.array(windows, np.uint64)
    w, i = items.candidates(windows)
    expected = {(a, b) for a in range(2000) for b in range(40) if bin(int(windows[a]) ^ int(items.hashes[b])).count("1") <= RADIUS}
    assert set(zip(w.tolist(), i.tolist(), strict=True)) == expected and BLOCKS * 8 == 64
    assert distance(np.array([0, 1], np.uint64), np.array([7, 1], np.uint64)).tolist() == [3, 0]


@pytest.mark.parametrize(("a", "b", "expected"), [([1, 2, 3], [1, 2, 3], 1.0), ([1, 1, 2], [1, 2, 2], 0.5), ([1], [2], 0.0)])
def test_weights_are_numbers_of_occurrences(a, b, expected):
    assert weighted_similarity(np.array(a, np.uint64), np.array(b, np.uint64)) == expected


def edited(rng, passage):
    """The passage with some words replaced, dropped, doubled or put in."""
    made = []
    for word in passage:
        kind = rng.random() * 100
        if kind < 1.2:
            made.append(f"n{rng.randrange(10**6)}")
        elif kind < 2:
            pass
        elif kind < 2.6:
            made += [word, word]
        elif kind < 3.2:
            made += [word, f"n{rng.randrange(10**6)}"]
        else:
            made.append(word)
    return made


def test_edited_passages_equal_brute_force_over_all_windows():
    rng = random.Random(11)
    texts = [words(rng.randint(12, 160), 100 + k) for k in range(150)]
    index = BenchmarkIndex(list(range(150)), texts)
    whole = {i: s for items in index.by_size.values() for i, s in zip(items.ids, items.shingles, strict=True)}
    found, expected = 0, 0
    for k in range(300):
        passage = edited(rng, texts[k % 150].split())
        text = f"{words(rng.randint(0, 50), 10_000 + k)} {' '.join(passage)} {words(rng.randint(0, 50), 20_000 + k)}"
        shingles, _ = shingle_hashes(*word_hashes(pa.array([text])), WIDTH)
        item = whole[k % 150]
        length = min(len(item), len(shingles))
        best = max(weighted_similarity(shingles[a:a + length], item) for a in range(len(shingles) - length + 1))
        matches = index.matches(shingles)
        assert set(matches) <= {k % 150}
        if best >= SIMILARITY:
            expected += 1
            found += k % 150 in matches and matches[k % 150][0] == best
        else:
            assert not matches
    # The radius could lose a window; of these it loses none.
    assert found == expected > 100


def test_long_texts_full_of_passages_need_bounded_memory():
    texts = [words(60, 1_000 + k) for k in range(2_000)]
    index = BenchmarkIndex(list(range(2_000)), texts)
    shingles, _ = shingle_hashes(*word_hashes(pa.array([" ".join(texts[:400])])), WIDTH)
    far, _ = shingle_hashes(*word_hashes(pa.array([f"{words(300_000, 3)} {texts[7]} {words(300_000, 4)}"])), WIDTH)
    tracemalloc.start()
    matches = index.matches(shingles)
    assert set(matches) == set(range(400)) and all(m[0] == 1.0 for m in matches.values())
    assert index.matches(far) == {7: (1.0, 300_000, 56)}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 250 << 20, peak


def test_shingles_of_items_are_sorted_once(monkeypatch):
    index = BenchmarkIndex([1, 2], ["a b c d e f g h", "x y z"])
    probe = np.concatenate([index.known, index.known + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
    assert index.knows(probe).tolist() == np.isin(probe, index.known).tolist()
    # Membership by sorting both sides costs as much for a text of one word as the whole benchmark.
    monkeypatch.setattr(np, "isin", None)
    assert index.matches(index.by_size[4].shingles[0]) == {1: (1.0, 0, 4)}
