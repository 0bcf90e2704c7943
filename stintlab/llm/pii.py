"""Personal data: plain patterns, and a semi-Markov conditional random field beside them.

The patterns find e-mail and IP addresses, card and phone numbers in their usual forms. The
field reads the rest: stretches of words that could belong to such data. It scores whole
spans, of up to ``LONGEST`` words, by features of the span (its digits and how they are
grouped, checksums, marks, letters), and a dynamic program over the stretch chooses boundaries
and types of all its spans together. What it finds is added; the patterns' spans stay.

It is learned each time: from stretches of a bounded sample of documents, labelled by the
patterns, and from made-up examples in forms that patterns miss.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlab.llm.common import bounded_sample, map_batches
from stintlab.staging import settle

KINDS = ("email", "ip", "card", "phone")
# Words in a span at most.
LONGEST = 6
# Documents and stretches that are learned from, and characters of such a stretch.
MAX_DOCUMENTS = 2_000
MAX_STRETCHES = 800
LONGEST_STRETCH = 400
EXAMPLES = 25
SEED = 5
ROUNDS = 80
RIDGE = 2e-3
# Words of a stretch in learning; longer ones are passed over there.
LEARNED_WORDS = 8
OUTSIDE = 0
LABELS = ("outside", *KINDS)

# Fixed patterns.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _byte(part: str) -> bool:
    return len(short := part.lstrip("0")) <= 3 and int(short or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @: the run of name characters before it, and the
    domain after it. Both ends are read once, however long the run."""
    end, at = 0, text.find("@")
    seen = 0
    while at >= 0:
        if at >= end:
            before = text[max(end, seen) : at]
            size = len(before) - len(before.rstrip(_LOCAL))
            if size and (match := _DOMAIN.match(text, at)):
                yield at - size, match.end()
                end = match.end()
        seen = at + 1
        at = text.find("@", seen)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the patterns, per kind leftmost and without overlap."""
    found = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for match in _IP.finditer(text):
        if all(map(_byte, match.group().split("."))):
            found.append((1, *match.span()))
    for match in _CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(match.group())) <= 15:
                found.append((3, *match.span()))
    return found


# A stretch's words: those with a digit or @, and those around a spelled-out @.
_ACTIVE = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_HINT = re.compile(r"[\[({](?:at|AT)[\])}]| @ | (?:dot|DOT) ")
_SPELLED = re.compile(
    r"(?<!\S)\S++\s(?:[\[({](?:at|AT)[\])}]|@)\s\S++(?:\s[\[({]?(?:dot|DOT)[\])}]?\s\S++)*"
    r"|(?<!\S)\S++\s(?:at|AT)\s\S++(?:\s(?:dot|DOT)\s\S++)+"
    r"|(?<!\S)[^\s\[({]*+[\[({](?:at|AT)[\])}]\S*"
)
_FORMED = re.compile(r"\S+")
_TRIM = " \t\n\r\x0b\x0c.,;:!?\"'`<>{}[]|*#$%&=~^_/\\"
_AT = re.compile(r"@|[\[({](?:at|AT)[\])}]|\s(?:at|AT)\s")
_DOT = re.compile(r"[\[({](?:dot|DOT)[\])}]|\s(?:dot|DOT)\s|\.")
_GROUPS = re.compile(r"[0-9]+")

FEATURES = 48


def span_features(text: str, words: int) -> list[int]:
    """Numbers of the features that a span's text has."""
    digits = _GROUPS.findall(text)
    n = sum(map(len, digits))
    letters = sum(c.isalpha() for c in text)
    has = [0, 1 + min(words, 6)]
    steps = (0, 3, 6, 8, 9, 10, 11, 12, 15, 16, 19)
    has.append(8 + sum(n > s for s in steps))
    has.append(20 + min(len(digits), 5))
    if 13 <= n <= 19:
        has.append(26 if luhn("".join(digits)) else 27)
    if len(digits) == 4 and not letters:
        has.append(28 if all(map(_byte, digits)) else 29)
        if all(len(d) == 4 for d in digits):
            has.append(30)
    if digits and len(digits) > 1 and len(digits[-1]) == 4 and len(digits[-2]) == 3:
        has.append(31)
    if text.startswith(("+", "00")):
        has.append(32)
    if "(" in text and ")" in text:
        has.append(33)
    at = _AT.search(text)
    if at:
        has.append(34)
        dots = _DOT.search(text, at.end())
        has.append(35 if dots and text[-1:].isalpha() else 36)
        has.append(37 if len(_AT.findall(text)) == 1 else 38)
    if letters:
        has.append(39 if at else 40)
        if n and not at:
            has.append(41)
    if "[.]" in text or "(.)" in text:
        has.append(42)
    if re.search(r"[/:]", text):
        has.append(43)
    if re.search(r"[.,][0-9]{1,2}$", text) and len(digits) < 4:
        has.append(44)
    if "-" in text:
        has.append(45)
    if "." in text:
        has.append(46)
    if re.match(r"(?:19|20)[0-9][0-9]\b", text):
        has.append(47)
    return has


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    part = text[start:end]
    start += len(part) - len(part.lstrip(_TRIM + ")-"))
    part = text[start:end]
    return start, end - (len(part) - len(part.rstrip(_TRIM + "(-+")))


class Stretch:
    """Neighbouring words and the features of every span of up to ``LONGEST`` of them."""

    def __init__(self, text: str, words: Sequence[tuple[int, int]]):
        self.words = words
        self.spans: dict[tuple[int, int], tuple[int, int]] = {}
        self.features: dict[tuple[int, int], list[int]] = {}
        for i in range(len(words)):
            for j in range(i, min(len(words), i + LONGEST)):
                a, b = _trimmed(text, words[i][0], words[j][1])
                if j > i and ("\n" in text[a:b] or not a < b):
                    break
                self.spans[i, j] = (a, b)
                self.features[i, j] = span_features(text[a:b], j - i + 1)


def stretches(text: str, taken: Sequence[tuple[int, int]] = ()) -> Iterator[Stretch]:
    """Stretches of neighbouring active words that no span of ``taken``, sorted, touches."""
    active = [m.span() for m in _ACTIVE.finditer(text)]
    if _HINT.search(text):
        spelled = (w.span() for m in _SPELLED.finditer(text) for w in _FORMED.finditer(text, *m.span()))
        active = sorted({*active, *spelled})
    words: list[tuple[int, int]] = []
    place = 0
    for a, b in active:
        while place < len(taken) and taken[place][1] <= a:
            place += 1
        free = place == len(taken) or taken[place][0] >= b
        near = words and a - words[-1][1] <= 3 and not text[words[-1][1] : a].strip()
        if words and not (free and near):
            yield Stretch(text, words)
            words = []
        if free:
            words.append((a, b))
    if words:
        yield Stretch(text, words)


def made_up_examples(n: int = EXAMPLES, seed: int = SEED) -> list[tuple[str, int]]:
    """(text, label) of spans in forms the patterns miss, and of what only looks alike."""
    draw = np.random.default_rng(seed)

    def num(k: int) -> str:
        return "".join(map(str, draw.integers(0, 10, k)))

    def name() -> str:
        return "".join(draw.choice(list("abcdefghiklmnoprstuvwz"), draw.integers(3, 9)))

    def card(k: int = 16, good: bool = True) -> str:
        body = str(draw.integers(3, 7)) + num(k - 2)
        return next(body + str(d) for d in range(10) if luhn(body + str(d)) == good)

    def cut(s: str, by: str) -> str:
        return by.join(s[i : i + 4] for i in range(0, len(s), 4))

    def quad() -> list[str]:
        return [str(x) for x in draw.integers(0, 256, 4)]

    forms = [
        (lambda: f"{name()} at {name()} dot com", 1), (lambda: f"{name()}{num(2)}[at]{name()}.com", 1),
        (lambda: f"{name()} (at) {name()} (dot) org", 1), (lambda: f"{name()}.{name()}(at){name()}.net", 1),
        (lambda: f"{name()} @ {name()}.com", 1), (lambda: f"{name()} [at] {name()} [dot] net", 1),
        (lambda: "[.]".join(quad()), 2), (lambda: "(.)".join(quad()), 2), (lambda: "[dot]".join(quad()), 2),
        (lambda: cut(card(), "."), 3), (lambda: cut(card(), "/"), 3), (lambda: cut(card(), "  "), 3),
        (lambda: card(), 3), (lambda: cut(card(), "_"), 3),
        (lambda: f"({num(3)}) {num(3)}-{num(4)}", 4), (lambda: f"{num(3)}-{num(3)}-{num(4)}", 4),
        (lambda: f"{num(3)}.{num(3)}.{num(4)}", 4), (lambda: f"1 ({num(3)}) {num(3)}-{num(4)}", 4),
        (lambda: f"00{num(2)} {num(3)} {num(3)} {num(4)}", 4), (lambda: f"1-{num(3)}-{num(3)}-{num(4)}", 4),
        (lambda: f"20{num(2)}-{draw.integers(10, 13)}-{draw.integers(10, 29)}", 0),
        (lambda: f"{num(2)}/{num(2)}/20{num(2)}", 0), (lambda: f"{num(1)}.{num(1)}", 0),
        (lambda: f"{num(2)}:{num(2)}", 0), (lambda: f"{num(3)}.{num(2)}", 0), (lambda: num(4), 0),
        (lambda: f"{num(1)}.{num(2)}.{num(1)}", 0), (lambda: card(16, False), 0), (lambda: num(10), 0),
        (lambda: f"978-{num(1)}-{num(2)}-{num(6)}-{num(1)}", 0), (lambda: num(7), 0), (lambda: num(20), 0),
        (lambda: cut(card(16, False), "."), 0), (lambda: f"{name()}{num(2)}", 0), (lambda: f"@{name()}", 0),
        (lambda: f"{num(2)}{name()}{num(3)}{name()}", 0), (lambda: f"{num(3)} {num(2)} {num(3)}", 0),
        (lambda: f"token = \"{num(3)}{name()}{num(6)}{name()}{num(4)}\"", 0),
        (lambda: f"{draw.integers(256, 999)}[.]{num(3)}[.]{num(1)}[.]{num(2)}", 0),
        (lambda: f"{num(5)}-{num(4)}", 0), (lambda: f"{num(13)}", 0),
    ]
    return [(form(), label) for _ in range(n) for form, label in forms]


class SemiMarkovField:
    """Weights of span features and of a type following another."""

    def __init__(self, weights: np.ndarray, follow: np.ndarray):
        self.weights, self.follow = weights, follow

    def decode(self, stretch: Stretch) -> list[tuple[int, int, int]]:
        """(kind, start, end) of the best reading's spans."""
        n = len(stretch.words)
        best = [None] * (n + 1)
        best[0] = np.array([0.0] + [-np.inf] * (len(LABELS) - 1))
        back: list = [None] * (n + 1)
        for end in range(1, n + 1):
            top, came = np.full(len(LABELS), -np.inf), [None] * len(LABELS)
            for size in range(1, min(LONGEST, end) + 1):
                key = (end - size, end - 1)
                if key not in stretch.features:
                    continue
                own = self.weights[:, stretch.features[key]].sum(axis=1)
                if size > 1:
                    own[OUTSIDE] = -np.inf
                paths = best[end - size][:, None] + self.follow
                score, source = paths.max(axis=0) + own, paths.argmax(axis=0)
                for label in np.flatnonzero(score > top):
                    top[label], came[label] = score[label], (end - size, int(source[label]))
            best[end], back[end] = top, came
        found, end, label = [], n, int(np.argmax(best[n]))
        while end:
            start, source = back[end][label]
            if label != OUTSIDE:
                found.append((label - 1, *stretch.spans[start, end - 1]))
            end, label = start, source
        return found[::-1]

    @classmethod
    def learn(cls, examples: Sequence[tuple[Stretch, dict[tuple[int, int], int]]]) -> SemiMarkovField:
        """Maximise the conditional likelihood of the labelled spans; words in none are outside.

        All stretches are worked on side by side: one array per end and size of a span.
        """
        t, width = len(LABELS), max(len(s.words) for s, _ in examples)
        rows = len(examples)
        length = np.array([len(s.words) for s, _ in examples])
        x = np.zeros((rows, width, LONGEST, FEATURES), np.float32)
        there = np.zeros((rows, width, LONGEST), bool)
        gold_w, gold_f = np.zeros((t, FEATURES)), np.zeros((t, t))
        for r, (stretch, gold) in enumerate(examples):
            for (i, j), has in stretch.features.items():
                there[r, j, j - i] = True
                x[r, j, j - i, has] = 1
            at, last = 0, OUTSIDE
            while at < len(stretch.words):
                key = next((k for k in gold if k[0] == at), (at, at))
                label = gold.get(key, OUTSIDE)
                gold_w[label, stretch.features[key]] += 1
                gold_f[last, label] += 1
                at, last = key[1] + 1, label
        first = np.full((rows, t), -np.inf)
        first[:, OUTSIDE] = 0
        only_one = np.zeros((LONGEST, t))
        only_one[1:, OUTSIDE] = -np.inf
        weights, follow = np.zeros((t, FEATURES)), np.zeros((t, t))
        step_w, step_f = np.full_like(weights, 1e-8), np.full_like(follow, 1e-8)

        def log_sum(v: np.ndarray, axis: int) -> np.ndarray:
            top = v.max(axis=axis, keepdims=True)
            top = np.where(np.isfinite(top), top, 0)
            with np.errstate(divide="ignore"):
                return np.log(np.exp(v - top).sum(axis=axis)) + top.squeeze(axis)

        for _ in range(ROUNDS):
            own = np.where(there[..., None], x @ weights.T + only_one, -np.inf)
            ahead = [first] + [None] * width
            entered = [None] * width
            for end in range(width):
                # Scores of coming to a span that begins at each place, by its label.
                entered[end] = log_sum(ahead[end][:, :, None] + follow, 1)
                parts = [own[:, end, k] + entered[end - k] for k in range(min(LONGEST, end + 1))]
                ahead[end + 1] = log_sum(np.stack(parts), 0)
            total = log_sum(np.stack([ahead[n][r] for r, n in enumerate(length)]), 1)
            behind = [np.full((rows, t), -np.inf) for _ in range(width + 1)]
            hope_w, hope_f = np.zeros_like(weights), np.zeros_like(follow)
            for end in range(width, -1, -1):
                behind[end] = np.where((length == end)[:, None], 0.0, behind[end])
                if end == width:
                    continue
                parts = [
                    own[:, end + k, k] + behind[end + k + 1]
                    for k in range(min(LONGEST, width - end))
                ]
                out = log_sum(np.stack(parts), 0)
                through = log_sum(follow + out[:, None, :], 2)
                behind[end] = np.where((length == end)[:, None], 0.0, through)
                with np.errstate(invalid="ignore"):
                    share = ahead[end][:, :, None] + follow + out[:, None, :] - total[:, None, None]
                hope_f += np.exp(np.nan_to_num(share, nan=-np.inf)).sum(axis=0)
                for k, part in enumerate(parts):
                    with np.errstate(invalid="ignore"):
                        p = entered[end] + part - total[:, None]
                    p = np.exp(np.nan_to_num(p, nan=-np.inf))
                    hope_w += p.T @ x[:, end + k, k]
            slope_w = (gold_w - hope_w) / rows - RIDGE * weights
            slope_f = (gold_f - hope_f) / rows - RIDGE * follow
            step_w += slope_w**2
            step_f += slope_f**2
            weights = weights + 0.5 * slope_w / np.sqrt(step_w)
            follow = follow + 0.5 * slope_f / np.sqrt(step_f)
        return cls(weights, follow)


def _example(
    text: str, spans: Sequence[tuple[int, int, int]], learned_words: int = LEARNED_WORDS
) -> Iterator[tuple]:
    """Stretches of a text with its labelled spans in words."""
    for stretch in stretches(text):
        if len(stretch.words) > learned_words:
            continue
        by_place = {place: key for key, place in stretch.spans.items()}
        gold = {by_place[a, b]: kind + 1 for kind, a, b in spans if (a, b) in by_place}
        used: set[int] = set()
        clean = {}
        for key in sorted(gold):
            if used.isdisjoint(range(key[0], key[1] + 1)):
                used.update(range(key[0], key[1] + 1))
                clean[key] = gold[key]
        yield stretch, clean


def learn_field(
    docs: DataFrame,
    max_documents: int = MAX_DOCUMENTS,
    max_stretches: int = MAX_STRETCHES,
    learned_words: int = LEARNED_WORDS,
    longest_stretch: int = LONGEST_STRETCH,
) -> SemiMarkovField:
    """Learn from a bounded sample of ``docs`` (doc_id, text) and from made-up examples.

    The sample is those ``max_documents`` documents with a digit or @ whose id hashes lowest. Of
    them come texts around what could be personal data, of up to ``learned_words`` words and
    ``longest_stretch`` characters, and of these ``max_stretches``. The sample only sets the field's
    weights; finding covers every text whole.
    """
    likely = settle(
        docs.filter(F.col("doc_id").isNotNull() & F.col("text").rlike("[0-9@]")).select(
            F.col("doc_id").cast("long").alias("doc_id")
        )
    )
    drawn = settle(bounded_sample(likely, max_documents, "doc_id").distinct())

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                for stretch in stretches(text):
                    if len(stretch.words) <= learned_words:
                        pieces.append(text[stretch.words[0][0] : stretch.words[-1][1]])
            yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.string())], ["piece"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    found = map_batches(texts.join(F.broadcast(drawn), "doc_id").select("text"), change, "piece string")
    sample = (
        found.filter(F.length("piece") <= longest_stretch)
        .distinct()
        .orderBy(F.xxhash64("piece"), "piece")
        .limit(max_stretches)
        .toPandas()["piece"]
    )
    examples = [e for piece in sample for e in _example(piece, base_spans(piece), learned_words)]
    for text, label in made_up_examples():
        spans = [(label - 1, 0, len(text))] if label else []
        examples.extend(_example(text, spans))
    return SemiMarkovField.learn(examples)


def find_spans(text: str, field: SemiMarkovField) -> tuple[list, list]:
    """The patterns' spans and all spans of a text, as (kind, start, end), sorted."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    joined: list[tuple[int, int]] = []
    for a, b in taken:
        if joined and a < joined[-1][1]:
            joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
        else:
            joined.append((a, b))
    added = [span for stretch in stretches(text, joined) for span in field.decode(stretch)]
    return sorted(base), sorted([*base, *added])


def find_personal_data(docs: DataFrame, **sample: int) -> DataFrame:
    """(doc_id, base, spans) for every row of ``docs`` (doc_id, text).

    Both are lists of (kind, start, end), in order of ``KINDS`` and of place, in code points
    with the end exclusive: ``base`` those of the patterns, ``spans`` with those of the
    field. Null texts are empty and hold nothing. Repeated rows are searched each time.
    Other columns are not looked at. No rows give no rows.
    """
    field = learn_field(docs, **sample)

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        )
        for batch in batches:
            both = [find_spans(t.as_py() or "", field) for t in batch.column("text")]
            columns = [
                pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in s] for s in spans], kind)
                for spans in zip(*both, strict=True)
            ] or [pa.array([], kind)] * 2
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "base", "spans"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    spans = "array<struct<kind: string, start: bigint, end: bigint>>"
    return map_batches(rows, change, f"doc_id long, base {spans}, spans {spans}")


def mask(text: str, spans: Sequence[dict]) -> str:
    """The text with every span replaced by its kind in brackets."""
    out, at = [], 0
    for span in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if span["end"] <= at:
            continue
        out.append(text[at : max(at, span["start"])])
        if span["start"] >= at:
            out.append(f"[{span['kind'].upper()}]")
        at = span["end"]
    return "".join([*out, text[at:]])


def mask_personal_data(docs: DataFrame, **sample: int) -> DataFrame:
    """The rows and columns of ``docs`` with personal data in ``text`` replaced by its kind.

    ``n_chars``, if there, follows the text. A null text stays null.
    """
    field = learn_field(docs, **sample)
    columns = docs.columns

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masked = []
            for text in batch.column("text"):
                text = text.as_py()
                spans = find_spans(text, field)[1] if text else []
                named = [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans]
                masked.append(mask(text, named) if named else text)
            arrays = dict(zip(batch.schema.names, batch.columns, strict=True))
            arrays["text"] = pa.array(masked, pa.string())
            yield pa.RecordBatch.from_arrays([arrays[c] for c in columns], columns)

    rows = docs.withColumn("text", F.col("text").cast("string"))
    out = map_batches(rows, change, rows.schema)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out
