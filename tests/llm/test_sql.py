"""Queries against SQL on another engine, and all queries over the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from stintlab.llm.queries import ORACLES, QUERIES
from tests.test_queries import TABLES, in_order, plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, engine, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = engine.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = in_order(tuple(plain(r[i]) for i in places) for r in cursor.fetchall())
    got = in_order(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got == expected
    assert got


def test_pipeline_keeps_its_promises(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.settle(stage(spark, docs, SF))
        assert docs.count() > 0, name
        if name != names[-1]:
            assert sorted(docs.columns) == sorted(before.columns)
            assert docs.dtypes == before.select(docs.columns).dtypes
            assert docs.filter("n_chars <> length(text)").count() == 0
    assert docs.groupBy("sequence_id").sum("length").filter("`sum(length)` > 1024").count() == 0


def test_pipeline_stands_awkward_documents(spark, awkward, nothing):
    for start in (awkward, nothing):
        docs = start.select("doc_id", "text", "source")
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.settle(stage(spark, docs, SF))
        docs.collect()
