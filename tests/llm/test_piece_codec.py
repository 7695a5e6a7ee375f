import hashlib

import public_tokenizers
import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from leadmill.llm import piece_codec
from leadmill.llm.piece_codec import MergeVocabulary, encode_pieces
from leadmill.llm.queries import piece_digests, vocabulary
from tests.llm.frames import by_id, documents

PIECES_MODEL = vocabulary("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES_MODEL)
TEXTS = ["", " ", "  a  b ", "hello\tworld\n\nfoo \n", "▁x ▁", "a<s>b</s><unk><0x41>", "漢字😀 é", "\x00a", None,
         "same text", "same text", "word " * 30_000 + "x" * 50_000]


def test_ids_and_texts_are_those_of_the_library(spark):
    found = by_id(encode_pieces(documents(spark, *TEXTS), PIECES_MODEL), "token_ids", "decoded")
    assert len(found) == len(TEXTS)
    for n, text in enumerate(TEXTS):
        ids = LIBRARY.encode(text or "")
        assert found[n] == (ids, LIBRARY.decode(ids))


def test_digests(spark):
    n, ids, text = by_id(piece_digests(documents(spark, "two words")), "n_tokens", "ids_sha256", "decoded_sha256")[0]
    expected = LIBRARY.encode("two words")
    assert n == len(expected)
    assert ids == hashlib.sha256(",".join(map(str, expected)).encode()).hexdigest()
    assert text == hashlib.sha256(b"two words").hexdigest()


def test_empty_table(spark):
    empty = encode_pieces(documents(spark, "a").limit(0), PIECES_MODEL)
    assert empty.count() == 0 and empty.columns == ["doc_id", "token_ids", "decoded"]


@pytest.fixture(scope="module")
def vocabulary():
    return MergeVocabulary(public_tokenizers.path("piece_bpe_32k.model"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" ▁\n\tabtheionrs<>0x"), st.characters(exclude_categories=["Cs"])),
                        max_size=40), max_size=4))
def test_any_text_goes_round(vocabulary, texts):
    vocabulary.young.clear()
    ids, decoded = vocabulary.encode(texts)
    for text, i, d in zip(texts, ids, decoded, strict=True):
        expected = LIBRARY.encode(text)
        assert (list(memoryview(i).cast("i")), d) == (expected, LIBRARY.decode(expected))


def test_what_is_remembered_is_bounded(vocabulary, monkeypatch):
    from leadmill.llm import piece_codec
    monkeypatch.setattr(piece_codec, "REMEMBERED_WORDS", 10)
    texts = [f"w{i} common" for i in range(100)]
    for text in texts:
        assert list(memoryview(vocabulary.encode([text])[0][0]).cast("i")) == LIBRARY.encode(text)
    assert len(vocabulary.young) + len(vocabulary.old) < 40


def test_rows_of_any_width_and_the_heap_merge_alike(vocabulary):
    words = ["\u2581the", "\u2581", "a", "\u2581unbelievable", "Stra\u00dfe", "\u2581xyzzyxyzzyxyzzyxyzzyxy"]
    assert all(vocabulary.merge_rows(words, width) == [vocabulary.merge_heap(w) for w in words] for width in (24, 30))
    assert vocabulary.merged(words) == [vocabulary.merge_heap(w) for w in words]


def test_pairs_with_no_symbol_stay_apart(vocabulary):
    left, right = vocabulary.ids["t"], vocabulary.ids["h"]
    ranks, ids = vocabulary._pairs(np.array([[left, -1], [left, -1]], np.int32), np.array([[right, right], [-1, -1]], np.int32))
    assert ranks.tolist() == [[vocabulary.ranks["th"], piece_codec.NEVER], [piece_codec.NEVER] * 2]
    assert ids[0, 0] == vocabulary.ids["th"]
