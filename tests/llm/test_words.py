import re
import weakref

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from leadmill.llm.shared import pieces
from leadmill.llm.words import shingle_hashes, shingle_sets, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbÉé \n\t \x0b", max_size=25)), max_size=6), st.integers(0, 2))
def test_equal_words_and_shingles_have_equal_hashes_wherever_they_are(texts, cut):
    column = pa.array([*["x y"] * cut, *texts], pa.string()).slice(cut)
    words, ends = word_hashes(column)
    plain = [WORD.findall((t or "").translate(SMALL)) for t in texts]
    flat = [w for p in plain for w in p]
    assert ends.tolist() == [sum(map(len, plain[:i + 1])) for i in range(len(plain))] and len(words) == len(flat)
    assert len(set(words.tolist())) == len(set(flat)) == len(set(zip(words.tolist(), flat, strict=True)))
    for width in (1, 4):
        grams = [[tuple(p[i:i + width]) for i in range(max(1, len(p) - width + 1))] if p else [] for p in plain]
        made, upto = shingle_hashes(words, ends, width)
        every = [g for row in grams for g in row]
        assert len(made) == len(every) and len(set(zip(made.tolist(), every, strict=True))) == len(set(every)) == len(set(made.tolist()))
        assert [len(s) for s in shingle_sets(column, width)] == [len(set(g)) for g in grams]


def test_a_batch_is_not_held_while_the_next_one_is_read():
    def batches():
        for n in range(3):
            batch = pa.RecordBatch.from_pydict({"text": ["some text", None, "x" * n]})
            seen = weakref.ref(batch)
            yield batch
            del batch
            held.append(seen() is not None)

    held = []
    assert [p.num_rows for p in pieces(batches(), "text", 5)] == [1, 2] * 3
    assert held == [False] * 3
