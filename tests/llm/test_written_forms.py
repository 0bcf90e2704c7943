"""Personal data in forms that were written down apart from those learned from."""

from __future__ import annotations

import pytest

from stintlab.llm.pii import KINDS, find_spans, learn_field

SF = "/root/testdata/sf0.01"

# Sentences with what stands in them, in angle brackets with its kind.
WRITTEN = [
    "Please write to <email:maria.keller@posteo.example> before Friday.",
    "My address is <email:tom (at) riverbank (dot) net>, in case you lost it.",
    "Reach the editor: <email:j.alvarez [at] gazette.org>.",
    "Send it to <email:olga at northwind dot com> please.",
    "Mail <email:support(at)harbour.io> or call.",
    "Write <email:kim @ lakeside.edu> about the room.",
    "The server answered from <ip:10.0.14.201> twice.",
    "Blocked host <ip:172[.]16[.]9[.]77> again last night.",
    "Seen from <ip:203(.)0(.)113(.)9> at noon.",
    "It was <ip:198[dot]51[dot]100[dot]23> all along.",
    "Card <card:5555 5555 5555 4444> was charged.",
    "She paid with <card:4012-8888-8888-1881>.",
    "Number <card:4222.2222.2222.2220> on the slip.",
    "He read out <card:3530/1113/3330/0000> slowly.",
    "Card on file <card:6011000990139424> expires soon.",
    "Call <phone:+44 20 7946 0958> after six.",
    "Ring <phone:(415) 555-0132> and ask for Lee.",
    "Phone <phone:212-555-0187> is answered all day.",
    "The desk is <phone:646.555.0149> until nine.",
    "From abroad dial <phone:0049 301 234 5678> instead.",
    "Toll free <phone:1-800-555-0199> on weekdays.",
    "Fax <phone:1 (303) 555-0110> still works.",
    # Nothing personal in these.
    "The meeting moved to 2024-11-28 at 14:30 sharp.",
    "Version 4.18.2 fixes issue 20931 at last.",
    "He ran 42.195 km in 3:58:21 on the day.",
    "ISBN 978-3-16-148410-0 is out of print.",
    "The total was 1.204.550 euros for 2023.",
    "Chapter 12 starts on page 345, not 354.",
    "Order 10048 ships in 3 to 5 days.",
    "Look at the dot on the map at home.",
    "See @riverbank for the news at ten.",
    "Ratio 16:9, size 1920x1080, depth 24.",
    "Serial 4012888888881882 is on the back.",
    "Room 555-12 is closed until 01/09/2025.",
    "We met at the station at 9 dot com was not yet a word.",
    "Coordinates 52.5200 and 13.4050 are the centre.",
]


def parsed(marked):
    text, spans, rest = "", [], marked
    while "<" in rest:
        before, _, rest = rest.partition("<")
        inner, _, rest = rest.partition(">")
        kind, _, value = inner.partition(":")
        text += before
        spans.append((KINDS.index(kind), len(text), len(text) + len(value)))
        text += value
    return text + rest, spans


@pytest.fixture(scope="module")
def field(spark):
    return learn_field(spark.read.parquet(f"{SF}/documents.parquet"))


def counts(field):
    right = found = there = 0
    missed = []
    for marked in WRITTEN:
        text, spans = parsed(marked)
        got = set(find_spans(text, field)[1])
        right += len(got & set(spans))
        found += len(got)
        there += len(spans)
        if got != set(spans):
            missed.append((text, [(KINDS[k], text[a:b]) for k, a, b in sorted(got)]))
    return right, found, there, missed


def test_precision_and_recall(field):
    right, found, there, missed = counts(field)
    assert there == 22
    assert right / there >= RECALL, missed
    assert right / found >= PRECISION, missed


# What is reached, less a little; README has the figures.
RECALL, PRECISION = 0.9, 0.85


def test_the_field_finds_what_the_patterns_miss(field):
    """Half of the written forms are none of the patterns'."""
    added = sum(
        len(set(find_spans(text, field)[1]) & set(spans)) - len(set(find_spans(text, field)[0]) & set(spans))
        for text, spans in map(parsed, WRITTEN)
    )
    assert added >= 8


def test_sample_sizes_are_parameters(spark):
    docs = spark.read.parquet(f"{SF.replace('0.01', '0.001')}/documents.parquet")
    small = learn_field(docs, max_documents=5, max_stretches=3, learned_words=4, longest_stretch=60)
    text, spans = parsed(WRITTEN[0])
    assert find_spans(text, small)[0] == spans
