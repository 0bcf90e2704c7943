"""SentencePiece ids of whole texts by a prefix table, and the texts that ids decode to.

The vocabulary merges pieces in pairs: of all neighbours whose joint text is a piece, those
with the best score are joined first, the leftmost of equal ones. Instead of merging, the last
piece of every prefix of a text is found:

- A piece can only be the last of a prefix if it ends there; an automaton over all pieces
  finds those that do.
- It is the last one if the piece before it, which is the last of the shorter prefix, is
  compatible: merging their joint text gives the same two pieces. This is true of exactly one
  piece for each prefix, as a sequence is what merging gives if all its neighbours are
  compatible. So a piece of one character is the last one where no longer one is, and
  the automaton need not find it.

Ids are then recovered backwards, from the last piece of the whole text to the first. This takes
time in proportion to the text however long its words are.

Whether two pieces are compatible follows from how they were made. Undoing their merges, the
latest first, shows which pieces met at the border between them and until when; they are
compatible if no two that met make a piece which is merged before that.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlab.llm.common import map_batches, worker_memory

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
_LETTER = r"[\p{L}\p{M}]"
# Words remembered per Python worker, some 250 bytes each, and pairs of pieces, some 100 bytes
# each. Once full, the memory stays as it is.
REMEMBERED_WORDS = 600_000
REMEMBERED_PAIRS = 500_000
_LONGEST_REMEMBERED = 48
# Ids put out at once.
_AT_ONCE = 1 << 21
# The automaton's values: a piece's id above its length.
_LENGTH_BITS = 8
_LENGTH = (1 << _LENGTH_BITS) - 1


class PieceTable:
    """The pieces of a model that pair merges with byte fallback can give.

    The model must leave texts as they are but for a space put before them, and must
    have each character of a piece as a piece too.
    """

    def __init__(self, model: str | None = None):
        path = model or public_tokenizers.path(MODEL)
        self._library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, scores = {}, {}
        for i in range(self._library.get_piece_size()):
            if self._library.is_unused(i):
                raise ValueError("a model with unused pieces is not supported")
            special = (self._library.is_unknown, self._library.is_control, self._library.is_byte)
            if not any(of(i) for of in special):
                pieces[self._library.id_to_piece(i)] = i
                scores[self._library.id_to_piece(i)] = self._library.get_score(i)
        self._ids = pieces
        # Equal scores have equal ranks; the lowest rank is merged first.
        place = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self._order = {p: place[s] for p, s in scores.items()}
        self.alphabet = {p for p in pieces if len(p) == 1}
        if any(not self.alphabet.issuperset(p) for p in pieces):
            raise ValueError("a piece has a character that is no piece")
        probe = f" a  {SPACE}b "
        if self._library.decode(self._library.encode(probe)) != probe.replace(SPACE, " "):
            raise ValueError("a model that changes white space is not supported")
        self._bytes = [self._library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(not self._library.is_byte(i) for i in self._bytes):
            raise ValueError("a model without byte fallback is not supported")
        # The two parts that the last merge of a piece joins, for pieces that merging gives.
        self._parts: dict[int, tuple[int, int]] = {}
        self._rank: dict[int, int] = {}
        self._automaton = ahocorasick.Automaton()
        for piece, i in pieces.items():
            if len(piece) == 1:
                self._rank[i] = -1
            else:
                parts = self._last_merge(piece)
                if parts is None:
                    continue
                self._rank[i] = self._order[piece]
                self._parts[i] = (pieces[parts[0]], pieces[parts[1]])
                # Id and length in one number, which no piece has as 0.
                self._automaton.add_word(piece, i << _LENGTH_BITS | len(piece))
        self._automaton.make_automaton()
        for i, (left, right) in self._parts.items():
            if self._rank[i] < max(self._rank[left], self._rank[right]):
                raise ValueError("a piece is merged before its parts")
        self._single = {p: pieces[p] << _LENGTH_BITS | 1 for p in self.alphabet}
        self._texts = {i: p for p, i in pieces.items()}
        if max(map(len, pieces)) > _LENGTH:
            raise ValueError("a piece is too long")
        self._pairs: dict[int, bool] = {}

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        """Merge the characters of ``piece``; the last two parts if it comes out whole."""
        parts = list(piece)
        while len(parts) > 1:
            joint = [
                (self._order[a + b], at)
                for at, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
                if a + b in self._order
            ]
            if not joint:
                return None
            _, at = min(joint)
            if len(parts) == 2:
                return parts[0], parts[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return None

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the joint text of two pieces gives these two."""
        return self._remember(left << _LENGTH_BITS, right << _LENGTH_BITS)

    def _remember(self, left: int, right: int) -> bool:
        """As :meth:`compatible`, for ids with lengths, as the automaton has them."""
        known = self._stay_apart(left >> _LENGTH_BITS, right >> _LENGTH_BITS)
        if len(self._pairs) < REMEMBERED_PAIRS:
            self._pairs[left << 32 | right] = known
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        # Merges of this rank or later come too late to join the two at the border.
        order, rank, texts, parts = self._order, self._rank, self._texts, self._parts
        too_late = len(order) + 1
        while True:
            # A joint piece need not be one that merging gives from its own characters.
            if order.get(texts[left] + texts[right], too_late) < too_late:
                return False
            if rank[left] > rank[right]:
                # Of equal ranks the left one is merged first, before any at the border.
                too_late, left = rank[left], parts[left][1]
            elif rank[right] >= 0:
                # Of equal ranks one at the border is merged before the right one.
                too_late, right = rank[right] + 1, parts[right][0]
            else:
                return True

    def word_ids(self, text: str) -> list[int]:
        """Ids of a text in which spaces are marked already."""
        # The last piece of the prefix of each length, 0 where there is none: at the start
        # and behind a character that is no piece, with which nothing is merged.
        single, known, remember = self._single.get, self._pairs.get, self._remember
        last = [0, *[single(c, 0) for c in text]]
        for end, found in self._automaton.iter(text):
            before = last[end + 1 - (found & _LENGTH)]
            if before:
                apart = known(before << 32 | found)
                if apart is None:
                    apart = remember(before, found)
                if not apart:
                    continue
            last[end + 1] = found
        backwards: list[int] = []
        at = len(text)
        while at:
            found = last[at]
            if found:
                backwards.append(found >> _LENGTH_BITS)
                at -= found & _LENGTH
            else:
                at -= 1
                backwards.extend(self._bytes[b] for b in reversed(text[at].encode()))
        return backwards[::-1]

    @cached_property
    def _patterns(self) -> tuple[regex.Pattern, regex.Pattern | None]:
        """Words, and parts of words, that no piece reaches across.

        Line ends and tabs are cut out where they are no pieces. If no piece has a space
        behind another character, texts are also cut before each run of spaces; and if no piece
        has a letter beside anything but letters and spaces, words are cut where letters begin
        and end.
        """
        single = "".join(re.escape(c) for c in "\n\t\r" if c not in self.alphabet)
        alone = f"|[{single}]" if single else ""
        neighbours = {pair for p in self._ids for pair in zip(p, p[1:], strict=False)}
        if any(a != SPACE and b == SPACE for a, b in neighbours):
            return re.compile(f"[^{single}]+{alone}" if single else "(?s:.+)"), None
        words = re.compile(f"{SPACE}*[^{SPACE}{single}]+|{SPACE}+{alone}")
        letter = regex.compile(_LETTER)
        if any(
            bool(letter.match(a)) != bool(letter.match(b)) for a, b in neighbours if SPACE not in (a, b)
        ):
            return words, None
        return words, regex.compile(f"{SPACE}*(?:{_LETTER}+|[^{SPACE}{_LETTER[1:]}+)|{SPACE}+")

    def marked_words(self, text: str) -> list[str]:
        return self._patterns[0].findall(SPACE + text.replace(" ", SPACE)) if text else []

    def word_parts(self, word: str) -> list[str]:
        return self._patterns[1].findall(word) if self._patterns[1] else [word]

    def decode(self, ids: list[int]) -> str:
        return self._library.decode(ids)


class _Remembered(dict):
    """Ids of words as little-endian 32-bit numbers."""

    def __init__(self, table: PieceTable):
        self._table = table

    def __missing__(self, word: str) -> bytes:
        parts = self._table.word_parts(word)
        if len(parts) > 1:
            ids = b"".join([self[part] for part in parts])
        else:
            ids = np.array(self._table.word_ids(word), "<i4").tobytes()
        if len(word) <= _LONGEST_REMEMBERED and len(self) < REMEMBERED_WORDS:
            self[word] = ids
        return ids


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded) for every row of ``docs`` (doc_id, text).

    ``ids`` are those that the sentencepiece library gives for the text, without begin and end
    ids and without sampling; ``decoded`` is the text it decodes them to. ``model`` is the path of
    a model file of pair merges with byte fallback. A null text is an empty one, which has
    no ids and decodes to the empty text. A null doc_id is kept. Repeated rows each come back.
    Other columns of ``docs`` are not looked at. No rows give no rows.
    """

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, key = worker_memory(), ("pieces", model, REMEMBERED_WORDS, REMEMBERED_PAIRS)
        if key not in memory:
            table = PieceTable(model)
            memory[key] = table, _Remembered(table)
        table, remembered = memory[key]

        def made(doc_ids: list, ids: list[np.ndarray], decoded: list[str]) -> pa.RecordBatch:
            ends = np.cumsum([0, *map(len, ids)])
            listed = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, "<i4"), *ids]), pa.int32())
            )
            columns = [pa.array(doc_ids, pa.int64()), listed, pa.array(decoded, pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

        for batch in batches:
            doc_ids: list = []
            ids: list[np.ndarray] = []
            decoded: list[str] = []
            held = 0
            for doc_id, text in zip(*batch.columns, strict=True):
                words = table.marked_words(text.as_py() or "")
                own = np.frombuffer(b"".join(map(remembered.__getitem__, words)), "<i4")
                doc_ids.append(doc_id.as_py())
                ids.append(own)
                decoded.append(table.decode(own.tolist()))
                held += len(own)
                if held >= _AT_ONCE:
                    yield made(doc_ids, ids, decoded)
                    doc_ids, ids, decoded, held = [], [], [], 0
            yield made(doc_ids, ids, decoded)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(rows, change, "doc_id long, ids array<int>, decoded string")
