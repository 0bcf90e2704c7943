"""Documents kept by way of text against the same by way of variants."""

from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from stintlab.sources import documents
from stintlab.sources.documents import keep_documents
from tests.conftest import rows

ITEMS = '[1, 1.0, 2.50, 0.1, 1e3, -7, 9007199254740993, "None", "1.50", null, true, "", "é\\u00e9", [1, 2.5], "\\"NaN\\""]'
ODD = [
    f'{{"lap": {ITEMS}, "drv": ["A"]}}',
    '{"lap": 7, "drv": ["B"]}',
    '{"drv": ["C"], "lap": {"x": [1]}}',
    '{"lap": "[1, 2]", "time": [3]}',
    '{"lap": [], "drv": null}',
    '{"other": [1]}',
    "null",
]
NAMES = ["lap", "drv", "time", "team"]


def save(path, docs, packed):
    text = f"[{','.join(docs)}]".encode()
    path.write_bytes(gzip.compress(text) if packed else text)


def texts(kept, names, *values):
    """What the documents with any of the arrays hold."""
    columns = [kept.text_array(n).alias(f"c{i}") for i, n in enumerate(names)]
    found = kept.rows.select(F.regexp_extract("path", "[^/]*$", 0).alias("file"), *values, *columns)
    return rows(found.filter(F.coalesce(*[f"c{i}" for i in range(len(names))]).isNotNull()))


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("spoil", [[], ["5"], ['{"lap": [NaN, 1]}', '{"lap": [-Infinity]}'], ["[[1]]", '"x"']])
def test_arrays_at_the_root(spark, tmp_path, packed, spoil):
    """Whatever stands in a file beside a document, no document is lost or spelled otherwise."""
    end = "json.gz" if packed else "json"
    save(tmp_path / f"a.{end}", [*ODD, *spoil, *ODD[:2]], packed)
    save(tmp_path / f"b.{end}", ODD[:3], packed)
    (tmp_path / "broken.json").write_text('[{"lap": [1]}, {"lap": [2')
    kept = keep_documents(spark, f"{tmp_path}/*.{end}", names=NAMES)
    variants = documents._as_variants(spark, f"{tmp_path}/*.{end}", None, (), NAMES, True)
    assert kept.names == variants.names == ("drv", "lap", "time")
    assert texts(kept, NAMES) == texts(variants, NAMES)


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("spoil", [[], ["5"], ['{"tel": {"lap": [NaN, -Infinity], "dataKey": "k"}}']])
@pytest.mark.parametrize("names", [None, ["lap", "drv"]])
def test_arrays_inside(spark, tmp_path, packed, spoil, names):
    end = "json.gz" if packed else "json"
    inner = [f'{{"tel": {d}}}' for d in ODD]
    keyed = '{"tel": {"dataKey": "a-b", "lap": [1], "note": "[1, 2]", "n": 5, "Lap": [2]}}'
    save(tmp_path / f"a.{end}", [*inner, *spoil, keyed], packed)
    save(tmp_path / f"b.{end}", ['{"tel": {"dataKey": 2.50, "drv": ["D"]}}', keyed], packed)
    kept = keep_documents(spark, f"{tmp_path}/*.{end}", "tel", ["dataKey"], names)
    variants = documents._as_variants(spark, f"{tmp_path}/*.{end}", "tel", ["dataKey"], names, True)
    assert kept.names == variants.names
    assert kept.names == (("Lap", "drv", "lap", "other", "time") if names is None else ("drv", "lap"))
    assert texts(kept, kept.names, "dataKey") == texts(variants, kept.names, "dataKey")


def test_arrays_that_turn_up_late(spark, tmp_path):
    """The first documents tell most arrays' names, not all."""
    docs = [json.dumps({"tel": {"dataKey": f"k{i}", "rpm": [i]}}) for i in range(100)]
    docs[70] = json.dumps({"tel": {"dataKey": "k70", "gear": [1, 2]}})
    docs[90] = json.dumps({"tel": {"dataKey": "k90", "drs": ["x"], "rpm": [90], "note": "[1]"}})
    save(tmp_path / "a.json.gz", docs, True)
    kept = keep_documents(spark, str(tmp_path), "tel", ["dataKey"])
    assert kept.names == ("drs", "gear", "rpm")
    assert kept.rows.count() == 100
    found = dict((r[1], r[2:]) for r in texts(kept, kept.names, "dataKey"))
    assert found["k70"] == (None, ["1", "2"], None) and found["k90"] == (["x"], None, ["90"])


def test_usual_documents_are_read_without_variants(spark, tmp_path, monkeypatch):
    """A value's way through a variant costs an expression made for it; settings stay as they were."""
    monkeypatch.setattr(documents, "_as_variants", None)
    monkeypatch.setattr(documents, "_text_items", None)
    settings = ("spark.sql.json.enableExactStringParsing", "spark.sql.codegen.hugeMethodLimit")
    before = [spark.conf.get(s) for s in settings]
    save(tmp_path / "a.json.gz", ['{"lap": [1, 2.50, "None", null]}', '{"lap": ["1"], "drv": ["A"]}'], True)
    save(tmp_path / "t.json", ['{"tel": {"dataKey": "k", "rpm": [1.50, "None"]}}'], False)
    assert keep_documents(spark, f"{tmp_path}/a.json.gz", names=NAMES).names == ("drv", "lap")
    kept = keep_documents(spark, f"{tmp_path}/t.json", "tel", ["dataKey"])
    assert texts(kept, ["rpm"], "dataKey") == [("t.json", "k", ["1.5", "None"])]
    assert [spark.conf.get(s) for s in settings] == before


def test_a_field_listed_twice_costs_no_other_document(spark, tmp_path):
    save(tmp_path / "a.json", ['{"lap": [1], "lap": [2]}', '{"lap": [3]}'], False)
    kept = keep_documents(spark, f"{tmp_path}/a.json", names=["lap"])
    assert [r[1] for r in texts(kept, ["lap"])] == [["2"], ["3"]]


def test_a_channel_listed_twice_costs_no_other_sample(spark, tmp_path):
    docs = ['{"tel": {"dataKey": "a", "rpm": [1], "rpm": [2]}}', '{"tel": {"dataKey": "b", "rpm": [3]}}']
    save(tmp_path / "1_tel.json.gz", docs, True)
    kept = keep_documents(spark, f"{tmp_path}/*.json.gz", "tel", ["dataKey"])
    assert texts(kept, ["rpm"], "dataKey") == [("1_tel.json.gz", "a", ["2"]), ("1_tel.json.gz", "b", ["3"])]
