"""Packings against the library's ids and the bounds that any packing has."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from leadmill.llm import packing
from leadmill.llm.packing import Population, pack_documents, pack_pieces, token_pieces
from leadmill.llm.queries import op12_packing, table
from tests.llm.frames import SCHEMA, documents

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def expected_pieces(rows, capacity=2048):
    library = Tokenizer.from_file(VOCABULARY)
    found = []
    for i, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        found += [(i, k, start, len(part), zlib.crc32(part.tobytes()))
                  for k, start in enumerate(range(0, len(ids), capacity)) for part in [ids[start:start + capacity]]]
    return sorted(found, key=repr)


def check(frame, rows, capacity=2048):
    """The pieces are right and lie in sequences without gaps; returns how many sequences there are."""
    assert frame.columns == COLUMNS
    found = frame.collect()
    assert sorted((tuple(r)[:5] for r in found), key=repr) == expected_pieces(rows, capacity)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert None not in sequences
    return len(sequences)


def test_query_packs_every_document(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    least = -(-sum(p[3] for p in expected_pieces(docs)) // 2048)
    assert least <= check(op12_packing(spark, "/root/testdata/sf0.001"), docs) <= least + 1


def test_odd_texts_are_encoded_as_the_library_does(spark):
    texts = [None, "", " ", "it's I'LL we'RE 'd", "a<|endoftext|>b <|startoftext|>", "é ́x", "İstanbul ΣΑΣ",
             " x\x0by\x1cz\x85w", "漢字かな 12345 ½ \U0001f600‍", "x" * 5_000, "word " * 5_000, "\t\r\n", "#$%^ ...",
             "A’s x's't ÀÉ×÷ß ªµº 12²½ \xadb\xa0c\x1f\x1ed \x7f \x01 Ÿ Ǆ ﬁ"]
    docs = documents(spark, *texts).union(spark.createDataFrame([(None, "none", "x", None, "s", 1, "y")] * 2, SCHEMA))
    docs = docs.union(documents(spark, "again"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(pack_documents(docs, VOCABULARY), rows)
    check(pack_documents(docs, VOCABULARY, 16), rows, 16)


def test_empty_table(spark):
    assert check(pack_documents(documents(spark), VOCABULARY), []) == 0


@pytest.mark.parametrize("kind", ["mixed", "halves", "equal"])
def test_many_shards_cost_about_one_sequence(spark, monkeypatch, kind):
    monkeypatch.setattr(packing, "SHARD", 200)
    rng = np.random.default_rng(3)
    n, capacity = 3_000, 1_000
    lengths = {"mixed": rng.integers(1, 700, n), "equal": np.full(n, 501),
               "halves": np.concatenate([x := rng.integers(1, capacity, n // 2), capacity - x])}[kind]
    cut = spark.createDataFrame([(int(i), int(x)) for i, x in enumerate(lengths)], "doc_id long, length long")
    found = pack_pieces(cut, capacity).toPandas()
    assert sorted(zip(found["doc_id"], found["length"])) == list(enumerate(lengths.tolist()))
    assert found.groupby("sequence_id")["length"].sum().max() <= capacity
    n_sequences = found["sequence_id"].nunique()
    assert n_sequences <= {"mixed": -(-lengths.sum() // capacity) + 3, "equal": n, "halves": 1.03 * n / 2}[kind]
    again = pack_pieces(cut, capacity).toPandas()
    assert sorted(map(tuple, again.to_numpy().tolist())) == sorted(map(tuple, found.to_numpy().tolist()))


def test_crossover_keeps_whole_bins_and_evolution_improves():
    # Best fit, longest first, needs one bin more than the best packing, which is full triples.
    lengths = np.array(sorted([6, 5, 5, 4, 4, 4, 3, 3, 3, 3] * 12, reverse=True))
    home = Population(lengths, 10, [1])
    giver, taker = home.first(), home.mutate(home.first())
    child = home.cross(giver, taker)
    assert home.fill(child).max() <= 10 and set(np.bincount(child)) > {0} - {0}
    bins = {frozenset(np.flatnonzero(giver == b)) for b in range(giver.max() + 1)}
    assert bins & {frozenset(np.flatnonzero(child == b)) for b in range(child.max() + 1)}
    best = home.evolve([], 30)[0]
    assert home.cost(best) <= home.cost(home.first()) and home.cost(best)[0] >= home.least


def test_only_strings_that_are_not_remembered_are_learned(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 3)
    learned = []
    remembered = packing.Remembered(lambda some: [learned.append(s) or s.encode() for s in some])
    for strings in (["a", "b"], ["b", "c", ""], ["d", "a", "e", "b"], ["a", "f"], []):
        assert remembered.of(strings) == [s.encode() for s in strings]
    assert learned == ["a", "b", "c", "", "d", "e", "f"]  # those of the generation before are still known


def test_small_batches_are_looked_up_together(spark):
    batches = [pa.RecordBatch.from_pydict({"id": [i], "text": ["word " * n]}) for i, n in enumerate([10, 20, 30, 40, 5])]
    found = list(packing._together(iter(batches), 200))
    assert all(b.nbytes >= 200 for b in found[:-1]) and len(found) < 5
    assert [i for b in found for i in b.column("id").to_pylist()] == [0, 1, 2, 3, 4]
    assert not list(packing._together(iter([]), 200))
    assert not token_pieces(documents(spark).limit(0), VOCABULARY).count()


def test_units_are_remembered_without_an_object_for_each(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 2)
    learned = []

    def learn(strings):
        learned.append(strings.to_pylist())
        return np.frombuffer(b"".join(learned[-1]), np.uint8).astype("<u4"), np.array(list(map(len, learned[-1])))

    remembered = packing.RememberedUnits(learn)
    for strings in ([b"ab", b"c", b"ab"], [], [b"c", b"", b"d", b"ab"], [b"d"], [b"e", b"c"], [b"x" * 50, b"d", b"ab"]):
        ids, sizes = remembered.of(pa.array(strings, pa.binary()))
        assert bytes(ids.tolist()) == b"".join(strings) and sizes.tolist() == list(map(len, strings))
    # At the fifth, two of five are kept: the ones just used. What is too long is not kept.
    assert learned == [[b"ab", b"c"], [b"", b"d"], [b"e"], [b"x" * 50, b"d", b"ab"]]
    assert sorted(remembered.strings.to_pylist()) == [b"ab", b"d"]


def test_words_of_all_ordinary_characters_are_cut_as_the_library_does():
    random = np.random.default_rng(5)
    kinds = ["stremvld'", "''", "ab1²¼", "!\xad×÷~<|", "ÀÖØÞßöøÿªµº", "XS'T'RE'LL'D'VE'M", "\xa1\xbf", "é ́", "\x80\xa0\xc2\x7f"]
    words = ["".join(random.choice(list("".join(random.choice(kinds[:7 if i % 9 else 9], 3))), random.integers(1, 9))) for i in range(4_000)]
    library, ids = Tokenizer.from_file(VOCABULARY), packing.WordIds(VOCABULARY)
    for some in (words[:2_000], words, ["<|endoftext|>a's", "", "a<|startoftext|>’s"], [""], [None]):
        texts = [" ".join((w or "") for w in some)] + some
        found, upto = ids.encode(pa.array(texts, pa.string()))
        expected = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [r.tolist() for r in packing.by_row(found, upto)] == expected
