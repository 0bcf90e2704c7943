"""Exact round trips, selective reads and the joining of ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from stintlab.llm.warc import (
    build_record,
    byte_ranges,
    parse_record,
    read_records,
    with_roles,
    write_archives,
)
from tests.conftest import rows


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


PAGES = [
    (5, "http://a/1", "<p>same</p>"), (3, "http://a/2", "<p>same</p>"), (9, None, "<p>same</p>"),
    (1, "http://b/ü?q=a b\r\nX: y", "é\r\n\r\nWARC/1.1\r\n"), (2, "http://c", None), (4, "http://d", ""),
    (7, "http://e", "x" * 300_000), (7, "http://e", "x" * 300_000), (None, "http://f", "no id"),
    (None, "http://g", "<p>same</p>"), (None, "http://h", "no id"),
]


def pages(spark, data=PAGES):
    return spark.createDataFrame(data, "page_id long, url string, html string").withColumns(
        {"same": F.lit(1), "first": F.lit(2), "digest": F.lit("x")}
    )


def test_round_trip(spark):
    got = rows(read_records(write_archives(pages(spark))))
    expected = []
    for page_id, _, html in PAGES:
        first = min(p for p, _, h in PAGES if (h or "") == (html or "") and p is not None) if any(
            p is not None and (h or "") == (html or "") for p, _, h in PAGES) else None
        revisit = first is not None and page_id != first
        expected.append((page_id, len((html or "").encode()), digest(html),
                         "revisit" if revisit else "response", first if revisit else None))
    assert got == sorted(expected, key=lambda r: [(v is None, str(v)) for v in r])


def test_short_payloads_are_all_responses(spark):
    got = read_records(write_archives(pages(spark), min_bytes=12))
    assert {r["record_type"] for r in got.filter("payload_bytes < 12").collect()} == {"response"}
    assert got.filter("record_type = 'revisit'").count() == 1 - 1
    assert got.count() == len(PAGES)


def test_selected_records_only(spark):
    index = write_archives(pages(spark))
    some = read_records(index.filter("url = 'http://a/2' OR page_id = 1"))
    assert rows(some.select("page_id")) == [(1,), (3,)]
    assert write_archives(pages(spark).limit(0)).count() == 0


def test_archives_are_plain_warc(spark, tmp_path):
    index = write_archives(pages(spark), str(tmp_path / "w")).orderBy("archive", "offset").collect()
    for name in {r["archive"] for r in index}:
        data = gzip.decompress(open(name.removeprefix("file://"), "rb").read())
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
    for r in index:
        with open(r["archive"].removeprefix("file://"), "rb") as f:
            f.seek(r["offset"])
            assert parse_record(gzip.decompress(f.read(r["length"])))["page_id"] == r["page_id"]


def test_damage_is_noticed():
    record, _ = build_record(1, "http://x", b"payload", False, None)
    assert parse_record(record)["payload_bytes"] == 7
    with pytest.raises(ValueError, match="digest"):
        parse_record(record.replace(b"payload\r", b"pAyload\r"))


def test_ranges_join_neighbours():
    entries = [("a", 0, 10), ("a", 10, 5), ("a", 30, 5), ("a", 200, 5), ("b", 0, 3), ("b", 0, 3)]
    got = list(byte_ranges(iter(entries), gap=20, most=100))
    assert [(g[0], g[1], g[2], len(g[3])) for g in got] == [("a", 0, 35, 3), ("a", 200, 205, 1), ("b", 0, 3, 2)]
    assert [g[2] - g[1] for g in byte_ranges(iter(entries), gap=1000, most=20)] == [15, 5, 5, 3]


def test_many_small_records_are_read_by_several_tasks(spark):
    small = spark.range(0, 64_000, 1, 2).selectExpr("id AS page_id", "concat('http://a/', id) AS url", "concat('page ', id) AS html")
    index = write_archives(small)
    assert index.select("archive").distinct().count() <= 2
    read = read_records(index)
    tasks = read.select("page_id", F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert len(tasks) >= 4
    assert max(r["count"] for r in tasks) < 2 * 64_000 / len(tasks)
    assert read.select("page_id").distinct().count() == 64_000


def test_payloads_stay_where_few_are_repeated(spark):
    """The list of repeated payloads is written first and then sent; payloads are not shuffled."""
    plan = with_roles(pages(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in plan
