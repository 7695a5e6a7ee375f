"""Encoding and decoding with SentencePiece vocabularies of the merge type.

``encode_pieces`` gives the ids of every text and the text decoded from them. A word's symbols are
merged from an agenda of its adjacent pairs, the best score first and the leftmost of equals. Since
no piece of such a vocabulary holds a word mark after another character, words are encoded on their
own, and a bounded memory keeps those met lately. New words of an Arrow batch are merged together,
one row of the agenda each (long or unusual ones from a heap), and checked against the
sentencepiece library; a difference stops the job.

A null text counts as empty: no ids, empty text. Repeated rows are all returned; an empty table
gives an empty table; columns other than the two named are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from leadmill.llm.shared import PIECE_BYTES, pick, pieces
from leadmill.llm.words import SortedHashes, mix

MARK = "▁"  # stands for a space
SPACED = re.compile(" +[^ ]*")

# A task remembers up to twice so many words, none of them longer than so many characters.
REMEMBERED_WORDS, REMEMBERED_LENGTH = 150_000, 40
# New words that are merged together, which bounds the matrices of their agendas.
LEARNED_TOGETHER = 8_000
# Words whose agenda is a row of a matrix: their longest, its mark included, in each matrix.
ROW_LENGTHS = 6, 9, 13, 24
NEVER = np.int32(2**31 - 1)


class MergeVocabulary:
    """Pieces and scores of a model file, and the words encoded with it."""

    def __init__(self, model: str):
        self.library = library = sentencepiece.SentencePieceProcessor(model_file=model)
        every = range(library.get_piece_size())
        piece = library.id_to_piece
        plain = [i for i in every
                 if not (library.is_control(i) or library.is_byte(i) or library.is_unknown(i))]
        self.ids = {piece(i): i for i in plain}
        scores = sorted({-library.get_score(i) for i in plain})
        rank = dict(zip(scores, range(len(scores)), strict=True))
        self.ranks = {piece(i): rank[-library.get_score(i)] for i in plain}
        self.texts = {i: piece(i).replace(MARK, " ") for i in plain}
        self.bytes = {int(piece(i)[1:-1], 16): i for i in every if library.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        probe = " a  éﬁ "
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces go across words; such a model cannot be encoded word by word")
        if len(self.bytes) != 256 or library.decode(library.encode(probe)) != probe:
            raise ValueError("only models with byte pieces and without normalisation are supported")
        self.line_break = array("i", [self.bytes[10]]).tobytes()
        self.split_lines = not any("\n" in p for p in self.ids if len(p) > 1)
        self._pair_table()
        # Text of each id, and how long it is; of bytes only the line break's, which is whole by itself.
        self.text_of = [self.texts.get(i, "") for i in every]
        self.text_of[self.bytes[10]] = "\n"
        self.text_length = np.array(list(map(len, self.text_of)))
        self.partial = np.array([i not in self.texts and i != self.bytes[10] for i in every])
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.other_texts: dict[str, str] = {}  # of words that decoding does not give back as they are

    def _pair_table(self) -> None:
        """The pairs that merge, by their keys' hashes, with the rank and the id of what they become."""
        ids, pairs = self.ids, {}
        for p, i in ids.items():
            for cut in range(1, len(p)):
                left, right = ids.get(p[:cut]), ids.get(p[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = (self.ranks[p], i)
        hashes = mix(np.array(list(pairs), np.uint64))
        order = np.argsort(hashes)
        self.pairs = SortedHashes(hashes[order])
        self.pair_rank, self.pair_id = np.array(list(pairs.values()), np.int32).reshape(-1, 2)[order].T.copy()
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for p, i in ids.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = i

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of what two symbols become; NEVER where they stay apart."""
        # Where there is no symbol, -1 makes a key that no pair has.
        keys = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        known, at = self.pairs.find(mix(keys.ravel().view(np.uint64)))
        rank, made = np.full(keys.size, NEVER, np.int32), np.zeros(keys.size, np.int32)
        rank[known], made[known] = self.pair_rank[at], self.pair_id[at]
        return rank.reshape(keys.shape), made.reshape(keys.shape)

    def merge_rows(self, words: list[str], width: int) -> list[bytes]:
        """Ids of words of up to ``width`` known symbols, each with its agenda in one row."""
        n, sizes = len(words), np.array([len(w) for w in words])
        symbols = np.full((n, width + 1), -1, np.int32)
        inside = np.arange(width + 1) < sizes[:, None]
        symbols[inside] = self.symbol_of[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        ranks = np.full((n, width + 1), NEVER, np.int32)
        made = np.zeros((n, width + 1), np.int32)
        ranks[:, :-1], made[:, :-1] = self._pairs(symbols[:, :-1], symbols[:, 1:])
        following = np.tile(np.arange(1, width + 2, dtype=np.int32), (n, 1))
        previous = np.tile(np.arange(-1, width, dtype=np.int32), (n, 1))
        rows = np.arange(n)
        while True:
            best = ranks[rows].argmin(1)  # the leftmost of equals
            going = ranks[rows, best] != NEVER
            rows, best = rows[going], best[going]
            if not len(rows):
                break
            gone = following[rows, best]
            symbols[rows, best] = made[rows, best]
            symbols[rows, gone] = -1
            ranks[rows, gone] = NEVER
            after = following[rows, best] = following[rows, gone]
            here = after <= width
            previous[rows[here], after[here]] = best[here]
            right = np.where(here, symbols[rows, np.minimum(after, width)], -1)
            ranks[rows, best], made[rows, best] = self._pairs(symbols[rows, best], right)
            before = previous[rows, best]
            r, b, m = rows[before >= 0], before[before >= 0], best[before >= 0]
            ranks[r, b], made[r, b] = self._pairs(symbols[r, b], symbols[r, m])
        kept = symbols >= 0
        flat, ends = symbols[kept].tobytes(), (4 * np.cumsum(kept.sum(1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def merge_heap(self, word: str) -> bytes:
        """Ids of any word; the agenda is a heap."""
        ranks, symbols, end = self.ranks, list(word), len(word)
        following, previous = list(range(1, end + 1)), list(range(-1, end - 1))
        agenda = [(ranks[p], i, p) for i, p in
                  ((i, symbols[i] + symbols[i + 1]) for i in range(end - 1)) if p in ranks]
        heapq.heapify(agenda)
        while agenda:
            _, i, pair = heapq.heappop(agenda)
            j = following[i]
            # The pair is stale if one of its symbols has been merged since.
            if symbols[i] is None or j >= end or symbols[i] + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, None
            k = following[i] = following[j]
            if k < end:
                previous[k] = i
                if (longer := pair + symbols[k]) in ranks:
                    heapq.heappush(agenda, (ranks[longer], i, longer))
            h = previous[i]
            if h >= 0 and (longer := symbols[h] + pair) in ranks:
                heapq.heappush(agenda, (ranks[longer], h, longer))
        ids = array("i")
        for s in symbols:
            if s in self.ids:
                ids.append(self.ids[s])
            elif s is not None:
                ids.extend(self.bytes[b] for b in s.encode())
        return ids.tobytes()

    def merged(self, words: list[str]) -> list[bytes]:
        """Ids of words, none of them empty, each with its mark in front if it has one."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.symbol_of[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        known = np.minimum.reduceat(symbols, np.cumsum(sizes) - sizes) >= 0 if words else np.empty(0, bool)
        ids_of: dict[str, bytes] = {}
        least = 0
        for width in ROW_LENGTHS:
            some = [words[i] for i in np.flatnonzero(known & (sizes > least) & (sizes <= width)).tolist()]
            ids_of.update(zip(some, self.merge_rows(some, width), strict=True))
            least = width
        return [ids_of[w] if w in ids_of else self.merge_heap(w) for w in words]

    def decoded(self, ids: Iterable[int]) -> str:
        """Text of ids; neighbouring byte pieces make up characters."""
        try:
            return "".join([self.texts[i] for i in ids])
        except KeyError:
            pass
        parts = []
        for i in ids:
            parts.append(bytes([self.byte_of[i]]) if i in self.byte_of else self.texts[i].encode())
        return b"".join(parts).decode(errors="replace")

    def learn(self, words: list[str]) -> None:
        """Encode words that follow a space, and compare them with the library."""
        marked = [(" " + w).replace(" ", MARK) for w in words]
        # A line break is merged with nothing, so that words at the ends of lines are short too.
        lines = [m.split("\n") if self.split_lines and "\n" in m else [m] for m in marked]
        parts = list(set(chain.from_iterable(lines)).difference([""]))
        ids_of = dict(zip(parts, self.merged(parts), strict=True)) | {"": b""}
        ours = [self.line_break.join([ids_of[part] for part in line]) if len(line) > 1 else ids_of[line[0]]
                for line in lines]
        sizes = np.fromiter(map(len, ours), np.int64, len(ours)) // 4
        theirs = self.library.encode(words, num_threads=1)
        # The library gives nothing for an empty text, while a mark can stand alone in a longer one.
        theirs = [ids if word else array("i", mine).tolist() for word, ids, mine in zip(words, theirs, ours, strict=True)]
        flat = np.frombuffer(b"".join(ours), np.int32)
        if not (np.array_equal(sizes, np.fromiter(map(len, theirs), np.int64, len(theirs)))
                and np.array_equal(flat, np.fromiter(chain.from_iterable(theirs), np.int32))):
            for word, mine, library in zip(words, ours, theirs, strict=True):
                if array("i", mine).tolist() != library:
                    raise ValueError(f"{word!r} is encoded as {array('i', mine).tolist()}, by the library as {library}")
        whole, ends = "".join(map(self.text_of.__getitem__, flat.tolist())), np.cumsum(sizes)
        upto = np.concatenate([[0], np.cumsum(self.text_length[flat])])[ends].tolist()
        texts = [whole[a + 1:b] for a, b in zip([0, *upto], upto, strict=False)]  # without the mark in front
        # Words with parts of characters, piece by piece.
        partial = {int(i) for i in np.searchsorted(ends, np.flatnonzero(self.partial[flat]), "right")}
        for i in partial:
            texts[i] = "\n".join([self.decoded(array("i", ids_of[part])) for part in lines[i]])[1:]
        self.young.update(zip(words, ours, strict=True))
        if partial or texts != words:
            other = [i for i, (text, word) in enumerate(zip(texts, words, strict=True)) if text != word]
            self.other_texts.update((words[i], texts[i]) for i in other)
            unusual = sorted(partial.union(i for i in other if words[i]))
            for i, text in zip(unusual, self.library.decode([theirs[i] for i in unusual]), strict=True):
                if texts[i] != text:
                    raise ValueError(f"{theirs[i]} are decoded as {texts[i]!r}, by the library as {text!r}")

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[str]]:
        """Ids as int32 and decoded text of each text."""
        cut, young, old = [], self.young, self.old
        for text in texts:
            words = (text or "").replace(MARK, " ").split(" ")
            if "" in words:  # spaces in a row or at an end, which belong to the next word
                words = [w[1:] for w in SPACED.findall(" " + " ".join(words))] if text else []
            cut.append(words)
        words = set().union(*cut)
        unknown = words.difference(young)
        new = list(unknown.difference(old))
        young.update((w, old[w]) for w in unknown.intersection(old))
        for first in range(0, len(new), LEARNED_TOGETHER):
            self.learn(new[first:first + LEARNED_TOGETHER])
        ids = [b"".join(map(young.__getitem__, c)) for c in cut]
        if words.isdisjoint(self.other_texts):
            decoded = list(map(" ".join, cut))
        else:
            decoded = [" ".join([self.other_texts.get(w, w) for w in c]) for c in cut]
        for word in new:
            if len(word) > REMEMBERED_LENGTH:
                del young[word]
                self.other_texts.pop(word, None)
        if len(young) > REMEMBERED_WORDS:
            self.old, self.young = young, {}
            self.other_texts = {w: t for w, t in self.other_texts.items() if w in young}
        return ids, decoded


def encode_pieces(df: DataFrame, model: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: the id, ``token_ids``, and ``decoded``, the text that the ids give back.

    ``model`` is the path of a model file on every executor.
    """
    rows = pick(df, id_column, text)
    schema = T.StructType([rows.schema[id_column], T.StructField("token_ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.StringType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = MergeVocabulary(model)  # goes with the task, as a worker's memory is short
        for piece in pieces(batches, text, PIECE_BYTES // 4):
            ids, decoded = vocabulary.encode(piece.column(text).to_pylist())
            ends = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype=np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))
            yield pa.RecordBatch.from_arrays(
                [piece.column(id_column), tokens, pa.array(decoded, pa.string())],
                names=[id_column, "token_ids", "decoded"],
            )

    return rows.mapInArrow(encode, schema)
