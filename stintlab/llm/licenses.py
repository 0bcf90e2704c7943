"""License texts in documents: winnowed fingerprints, then banded alignment.

Templates are cut into runs of three words; of every two neighbouring runs the one with the
lesser hash is kept. An inverted index leads from these hashes to places in templates. The
runs kept of a document in the same way find every template it shares four words in a row
with, and along which diagonal; a long template must share a part of its kept runs within a band of
diagonals. There the document's words are aligned with the template's, which gives what
share of the template matched and where. Words that tell a license from its relatives (family,
version, variant) must match exactly and in a row, or there is no find.
"""

from __future__ import annotations

import re
import string
from bisect import bisect
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlab.llm.common import map_batches
from stintlab.llm.license_notices import wordings

RUN_WORDS = 3
# Diagonals to either side of a find's, for a template of up to 400 words; a fiftieth beyond.
BAND = 8
LEAST_COVERAGE = 0.8
# The share of a template's kept runs that must be met along a band before it is aligned.
LEAST_SHARED = 0.1
# Gains and costs of the alignment: equal words, other words, a word left out.
EQUAL, OTHER, GAP = 2, -1, -1
# Words remembered per task; once full, the memory stays as it is.
_REMEMBERED = 200_000
_EDGES = bytes(string.punctuation, "ascii")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPDX_WORD = r"[A-Za-z0-9.+()-]+"
_SPDX_LINE = re.compile(
    rf"(?i:SPDX-License-Identifier):[ \t]*({_SPDX_WORD}(?:[ \t]+(?:AND|OR|WITH)[ \t]+{_SPDX_WORD})*)"
)
_SPDX_PART = re.compile(r"[A-Za-z0-9.+-]+")

_MARKED = wordings()
TEMPLATES = {name: text.replace("{", "").replace("}", "") for name, text in _MARKED.items()}


def plain_word(word: bytes) -> bytes:
    return word.strip(_EDGES).lower()


def run_hashes(words: np.ndarray) -> np.ndarray:
    """A hash of every run of ``RUN_WORDS`` words, from the words' hashes."""
    n = max(0, len(words) - RUN_WORDS + 1)
    mixed = np.zeros(n, np.uint64)
    for i in range(RUN_WORDS):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n].astype(np.uint64)
    return mixed ^ (mixed >> np.uint64(31))


def winnow(runs: np.ndarray) -> np.ndarray:
    """Places of the runs that are the lesser of two neighbours; a lone run stays."""
    if len(runs) < 2:
        return np.arange(len(runs))
    first = runs[:-1] <= runs[1:]
    return np.unique(np.arange(len(runs) - 1) + ~first)


def _telling(marked: str) -> list[tuple[int, int]]:
    """Where the words in braces stand, as ranges of word places."""
    found = []
    for part in re.finditer(r"\{(.*?)\}", marked):
        start = len(marked[: part.start()].split())
        found.append((start, start + len(part.group(1).split())))
    return found


class TemplateIndex:
    """The words of each template and an inverted index of their kept runs."""

    def __init__(self, templates: Mapping[str, str], least_shared: float = LEAST_SHARED):
        self.names = sorted(templates)
        # The plain wordings are taken with their telling words.
        marked = {n: _MARKED[n] if text == TEMPLATES.get(n) else text for n, text in templates.items()}
        plain = [templates[n].replace("{", "").replace("}", "") for n in self.names]
        self.words = [[plain_word(w) for w in text.encode().split()] for text in plain]
        self.telling = [_telling(marked[n]) for n in self.names]
        self.bands = [max(BAND, len(words) // 50) for words in self.words]
        self.needed = []
        postings = defaultdict(list)
        for t, words in enumerate(self.words):
            runs = run_hashes(np.array([crc32(w) for w in words], np.uint64))
            kept = winnow(runs)
            self.needed.append(max(1, int(least_shared * len(kept))))
            for place in kept:
                postings[int(runs[place])].append((t, int(place)))
        self.postings = dict(postings)
        self.hashes = np.array(sorted(self.postings), np.uint64)

    def hits(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(template, place in it, place in the document) of every shared kept run."""
        runs = run_hashes(words)
        if not len(runs) or not len(self.hashes):
            return
        places = winnow(runs)
        kept = runs[places]
        at = np.minimum(np.searchsorted(self.hashes, kept), len(self.hashes) - 1)
        for place in places[self.hashes[at] == kept]:
            for t, q in self.postings[int(runs[place])]:
                yield t, q, int(place)

    def diagonals(self, t: int, met: Counter) -> list[int]:
        """The diagonals to align template ``t`` along, given how often each was met.

        Within the band of one that is aligned, others of a long template add nothing: they
        differ by words left out or put in.
        """
        band, needed = self.bands[t], self.needed[t]
        if needed <= 1:
            return sorted(met)
        if met.total() < needed:
            return []
        ordered = np.array(sorted(met))
        upto = np.concatenate([[0], np.cumsum([met[d] for d in ordered])])
        around = upto[np.searchsorted(ordered, ordered + band, "right")] - upto[np.searchsorted(ordered, ordered - band)]
        chosen: list[int] = []
        for _, d in sorted((-met[d], d) for d, n in zip(ordered.tolist(), around, strict=True) if n >= needed):
            place = bisect(chosen, d)
            if (not place or d - chosen[place - 1] > band) and (place == len(chosen) or chosen[place] - d > band):
                chosen.insert(place, d)
        return chosen


def align(template: list[bytes], words: list[bytes], diagonal: int, band: int = BAND) -> tuple:
    """Best local alignment near ``diagonal`` (place in ``words`` less place in ``template``).

    (score, equal words, first, end): the stretch of ``words`` it covers. Of equally good
    ones that which ends nearest to the diagonal.
    """
    score, pairs = alignment(template, words, diagonal, band)
    return (score, len(pairs), pairs[0][1], pairs[-1][1] + 1) if pairs else (0, 0, -1, -1)


def alignment(
    template: list[bytes], words: list[bytes], diagonal: int, band: int = BAND
) -> tuple[int, list[tuple[int, int]]]:
    """The best alignment's score and its pairs of equal words (place in template, in words)."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(template))}
    wanted = np.array([numbers[w] for w in template], np.int32)
    given = np.array([numbers.get(w, -1) for w in words], np.int32)
    # Cell j of a row stands for the word at row + diagonal - band + j.
    width = 2 * band + 1
    reach = len(template) + width
    padded = np.full(max(0, -(diagonal - band)) + max(len(given), reach + diagonal) + width, -2, np.int32)
    shift = max(0, -(diagonal - band))
    padded[shift : shift + len(given)] = given
    steps = np.arange(width, dtype=np.int64)
    above = np.zeros(width + 1, np.int64)
    moves = np.zeros((len(template), width), np.int8)
    best, best_away, at = 0, 0, None
    for q in range(len(template)):
        low = q + diagonal - band + shift
        row = padded[low : low + width]
        same = row == wanted[q]
        slant = above[:-1] + np.where(same, EQUAL, OTHER)
        down = above[1:] + GAP
        cell = np.maximum(slant, down)
        # A word put in costs GAP each: the best start to the left, less the way from there.
        across = np.maximum.accumulate(cell - GAP * steps) + GAP * steps
        score = np.where(row == -2, 0, np.maximum(across, 0))
        moves[q] = np.where(score <= 0, 0, np.where(score > cell, 3, np.where(slant >= down, 1, 2)))
        ends = np.where(same, score, 0)
        top = int(ends.max()) if width else 0
        if top >= best and top > 0:
            tied = np.flatnonzero(ends == top)
            j = int(tied[np.argmin(np.abs(tied - band))])
            if top > best or abs(j - band) < best_away:
                best, best_away, at = top, abs(j - band), (q, j)
        above[:-1] = score
    pairs: list[tuple[int, int]] = []
    while at is not None:
        q, j = at
        move = moves[q, j] if q >= 0 and 0 <= j < width else 0
        if move == 1:
            p = q + diagonal - band + j
            if words[p] == template[q]:
                pairs.append((q, p))
            at = (q - 1, j)
        elif move == 2:
            at = (q - 1, j + 1)
        elif move == 3:
            at = (q, j - 1)
        else:
            at = None
    return best, pairs[::-1]


def _tells(telling: list[tuple[int, int]], pairs: list[tuple[int, int]]) -> bool:
    """Whether the telling words that the matched stretch reaches match whole and in a row."""
    place = dict(pairs)
    first, last = pairs[0][0], pairs[-1][0]
    for start, end in telling:
        if start <= last and end > first:
            offsets = {place.get(q, -1) - q for q in range(start, end)}
            if any(q not in place for q in range(start, end)) or len(offsets) > 1:
                return False
    return True


def find_licenses(
    text: str | None, index: TemplateIndex, word_hash: Mapping[bytes, int], least: float = LEAST_COVERAGE
) -> list[dict]:
    """The templates found in a text, in order: name, coverage, start and end (code points).

    SPDX lines are finds of the identifiers they list, in lower case.
    """
    named = [
        {"license": part.group().lower(), "coverage": 1.0, "start": part.start(), "end": part.end()}
        for line in (_SPDX_LINE.finditer(text) if text and "spdx-license-identifier:" in text.lower() else ())
        for part in _spdx_parts(text, line)
    ]
    raw = (text or "").encode().split()
    hashes = np.fromiter(map(word_hash.__getitem__, raw), np.uint64, len(raw))
    met: dict[int, Counter] = defaultdict(Counter)
    for t, q, p in index.hits(hashes):
        met[t][p - q] += 1
    if not met:
        return named
    found = []
    for t, counts in met.items():
        template, band = index.words[t], index.bands[t]
        for d in index.diagonals(t, counts):
            low = max(0, d - band)
            high = min(len(raw), d + len(template) + band)
            words = [plain_word(w) for w in raw[low:high]]
            score, pairs = alignment(template, words, d - low, band)
            if pairs and len(pairs) >= least * len(template) and _tells(index.telling[t], pairs):
                first, end = low + pairs[0][1], low + pairs[-1][1] + 1
                found.append((score, len(pairs) / len(template), first, end, index.names[t].split("#")[0]))
    # Of overlapping finds the one with more matched stays, of equal ones the later name, as
    # that of a later version.
    chosen: list[tuple] = []
    by_name = sorted(set(found), key=lambda e: e[4], reverse=True)
    for entry in sorted(by_name, key=lambda e: (-e[0], -e[1], e[2])):
        place = bisect(chosen, entry[2], key=lambda c: c[2])
        after_last = not place or chosen[place - 1][3] <= entry[2]
        if after_last and (place == len(chosen) or entry[3] <= chosen[place][2]):
            chosen.insert(place, entry)
    if not chosen:
        return named
    spans = [m.span() for m in _WORD.finditer(text)]
    worded = [
        {"license": name, "coverage": coverage, "start": spans[first][0], "end": spans[end - 1][1]}
        for _, coverage, first, end, name in chosen
    ]
    return sorted([*named, *worded], key=lambda m: (m["start"], m["end"]))


def _spdx_parts(text: str, line: re.Match) -> Iterator[re.Match]:
    """The identifiers of an SPDX line's expression; exceptions (after WITH) are none."""
    after_with = False
    for part in _SPDX_PART.finditer(text, *line.span(1)):
        if part.group() not in ("AND", "OR", "WITH") and not after_with:
            yield part
        after_with = part.group() == "WITH"


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = crc32(plain_word(word))
        if len(self) < _REMEMBERED:
            self[word] = value
        return value


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, str] | None = None,
    least: float = LEAST_COVERAGE,
) -> DataFrame:
    """(doc_id, n_licenses, coverage, matches) for every row of ``docs`` (doc_id, text).

    ``matches`` lists what was found: license, coverage (share of the template's words that
    matched), start and end in code points. ``templates`` are texts by name; words in braces must
    match exactly and in a row. A find covers at least ``least`` of its template; of overlapping
    finds the better one is listed. Identifiers on SPDX lines are found as well. ``coverage`` is the greatest, 0 without
    any. Null and empty texts hold nothing. Repeated rows are scanned each time. Other
    columns are not looked at. No rows give no rows.
    """
    index = TemplateIndex(_MARKED if templates is None else templates)

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        kind = pa.list_(
            pa.struct(
                [
                    ("license", pa.string()), ("coverage", pa.float64()),
                    ("start", pa.int64()), ("end", pa.int64()),
                ]
            )
        )
        for batch in batches:
            found = [find_licenses(t.as_py(), index, hashes, least) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([max((m["coverage"] for m in f), default=0.0) for f in found], pa.float64()),
                    pa.array(found, kind),
                ],
                ["doc_id", "n_licenses", "coverage", "matches"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(
        rows,
        change,
        "doc_id long, n_licenses long, coverage double,"
        " matches array<struct<license: string, coverage: double, start: bigint, end: bigint>>",
    )
