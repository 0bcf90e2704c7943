"""Documents on disk to flat tables and on to the readers."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stintlab import schemas, sinks
from stintlab.operators.reshape import driver_rows, lap_rows, telemetry_rows
from stintlab.plans.convert import (
    convert_drivers,
    convert_laps,
    convert_telemetry,
    lap_table,
    telemetry_table,
)
from stintlab.sinks import write_csv
from stintlab.sources.cleaning import clean_stint_laps, clean_telemetry
from stintlab.sources.documents import keep_documents, read_documents
from stintlab.sources.tables import read_drivers, read_laps, read_telemetry
from stintlab.sources.typed import read_typed_laps, read_typed_telemetry, write_typed
from stintlab.staging import settle
from tests.conftest import rows


def save(path, document):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(document, indent=2))


def sample_document(key, n=3):
    names = [*schemas.TELEMETRY_CHANNELS, "distance", "gear", "DriverAhead"]
    tel = {c: [round(i + 0.25, 2) for i in range(n)] for c in names}
    tel["brake"] = [i % 2 for i in range(n)]
    tel["rel_distance"] = ["None", *[0.5] * (n - 1)]
    return {"tel": {"dataKey": key, **tel}}


def test_telemetry_to_table(spark, tmp_path):
    root = tmp_path / "season" / "Miami Grand Prix" / "Race"
    save(root / "VER" / "1_tel.json", sample_document("2025-Miami Grand Prix-Race-VER-1"))
    save(root / "HAM" / "2_tel.json", sample_document("2025-Miami Grand Prix-Race-HAM-2", 2))
    target = str(tmp_path / "telemetry")
    convert_telemetry(spark, f"{tmp_path}/season/*/*/*/*_tel.json", target)
    table = read_telemetry(spark, target)
    assert table.columns == [*schemas.TELEMETRY_KEYS, "DriverAhead", "acc_y", "brake", "distance",
                             "gear", "rel_distance", "rpm", "speed", "throttle"]
    keys = rows(table.select(*schemas.TELEMETRY_KEYS).distinct())
    assert keys == [("2025", "Miami Grand Prix", "Race", "HAM", "2"),
                    ("2025", "Miami Grand Prix", "Race", "VER", "1")]
    assert rows(table.filter("driverName = 'VER'").select("acc_y", "rel_distance")) == [
        ("0.25", "None"), ("1.25", "0.5"), ("2.25", "0.5"),
    ]
    assert clean_telemetry(table).count() == 5


def test_inferred_and_given_layout_agree(spark, tmp_path):
    save(tmp_path / "s" / "E" / "Race" / "VER" / "1_tel.json", sample_document("2025-E-Race-VER-1"))
    source = f"{tmp_path}/s/*/*/*/*_tel.json"
    names = list(keep_documents(spark, source, "tel").names)
    given = telemetry_rows(read_documents(spark, source, schemas.telemetry_document(names)))
    inferred = telemetry_rows(read_documents(spark, source))
    assert sorted(inferred.columns) == sorted(given.columns)
    as_text = inferred.select(*[inferred[c].cast("string") for c in given.columns])
    assert rows(as_text) == rows(given)
    kept = telemetry_table(spark, source)
    assert kept.columns == given.columns
    assert rows(kept) == rows(given)


def test_documents_are_parsed_once(spark, tmp_path, monkeypatch):
    """One JSON scan finds the names and the values; what follows reads what was written."""
    save(tmp_path / "s" / "E" / "Race" / "VER" / "1_tel.json", sample_document("2025-E-Race-VER-1"))
    save(tmp_path / "s" / "E" / "Race" / "VER" / "laptimes.json", LAPS)
    scans = []
    reader = type(spark.read)
    read_json = reader.json
    monkeypatch.setattr(reader, "json", lambda *args, **more: scans.append(args) or read_json(*args, **more))
    for convert, *given in (
        (telemetry_table, f"{tmp_path}/s/*/*/*/*_tel.json"),
        (telemetry_table, f"{tmp_path}/s/*/*/*/*_tel.json", ["acc_y", "rpm"]),
        (lap_table, f"{tmp_path}/s/*/*/*/laptimes.json"),
    ):
        table = convert(spark, *given)
        assert len(scans) == 1
        scans.clear()
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "json" not in plan.lower().replace(str(tmp_path).lower(), "")
        assert plan.count("Scan parquet") == 1
        assert table.count() == 3


def test_spelling_of_values(spark, tmp_path):
    """Whole numbers and text as they are; other numbers as doubles, so that 1.0 is not 1."""
    values = ["1", "1.0", "2.50", "0.1", "1e3", "-7", "9007199254740993", '"None"', '"1.50"', "null", "true", '""']
    text = f'{{"tel": {{"dataKey": "y-E-Race-VER-1", "mixed": [{",".join(values)}], "whole": [3, 4], "text": ["a"]}}}}'
    folder = tmp_path / "s"
    folder.mkdir()
    (folder / "1_tel.json").write_text(text)
    kept = keep_documents(spark, f"{folder}/*.json", "tel")
    assert list(kept.names) == ["mixed", "text", "whole"]
    row = kept.rows.select(*[kept.text_array(c).alias(c) for c in kept.names]).first()
    assert row["mixed"] == ["1", "1.0", "2.5", "0.1", "1000.0", "-7", "9007199254740993", "None", "1.50", None, "true", ""]
    assert (row["whole"], row["text"]) == (["3", "4"], ["a"])


def test_odd_documents(spark, tmp_path):
    """Arrays of documents in a file, broken files, files without the field, odd names."""
    good = sample_document("2025-E-Race-VER-1", 2)
    names = ["a b", "it's", 'say "x"', "OBJECT<x", "a`b", "dot.ted", "$"]
    odd = {"tel": {"dataKey": "2025-E-Race-HAM-1", **{n: [1, "None"] for n in names}, "single": 5, "held": {"x": [1]}}}
    save(tmp_path / "s" / "1_tel.json", [good, good])
    save(tmp_path / "s" / "2_tel.json", odd)
    save(tmp_path / "s" / "3_tel.json", {"other": [1]})
    save(tmp_path / "s" / "4_tel.json", [{"tel": None}])
    (tmp_path / "s" / "5_tel.json").write_text('{"tel": {"dataKey": "2025')
    source = f"{tmp_path}/s/*.json"
    kept = keep_documents(spark, source, "tel")
    assert set(names) < set(kept.names)
    assert not {"single", "held", "dataKey", "other"} & set(kept.names)
    assert telemetry_table(spark, source, ["acc_y", "rpm"]).count() == 4
    read = telemetry_table(spark, source, names)
    assert rows(read.select("driverName", *[f"`{n.replace('`', '``')}`" for n in names])) == [
        ("HAM", *["1"] * 7), ("HAM", *["None"] * 7),
    ]
    padded = telemetry_table(spark, source, pad_missing=True)
    assert rows(padded.groupBy("driverName").count()) == [("HAM", 2), ("VER", 4)]
    with pytest.raises(ValueError, match="quotes"):
        keep_documents(spark, source, values=["a'b\"c"])


def test_short_and_missing_arrays(spark):
    schema = "struct<tel: struct<dataKey: string, a: array<string>, b: array<string>>>"
    docs = spark.createDataFrame(
        [(("2025-E-Race-VER-1", ["1", "2", "3"], ["x", "y"]),),
         (("2025-E-Race-HAM-1", ["1", "2"], None),)],
        schema,
    )
    got = rows(telemetry_rows(docs).select("driverName", "a", "b"))
    assert got == [("VER", "1", "x"), ("VER", "2", "y"), ("VER", "3", None)]
    padded = rows(telemetry_rows(docs, pad_missing=True).filter("driverName = 'HAM'").select("a", "b"))
    assert padded == [("1", None), ("2", None)]


def test_dash_in_a_name_shifts_the_key(spark):
    schema = "struct<tel: struct<dataKey: string, a: array<string>>>"
    docs = spark.createDataFrame([(("2025-X-Race", ["1"]),), (("2025-A-B-Race-VER-9", ["1"]),)], schema)
    got = rows(telemetry_rows(docs).select("event", "sessionType", "driverName", "lapNumber"))
    assert got == [("A", "B", "Race", "VER"), ("X", "Race", None, None)]


LAPS = {
    "lap": [1, 2, 3], "drv": ["VER"] * 3, "time": [91.5, "None", 90.25],
    "compound": ["SOFT", "SOFT"], "life": [1.0, 2, "None"], "stint": ["1", 1, 1],
    "pout": ["None"] * 3,
}


def test_laps_to_table(spark, tmp_path):
    root = tmp_path / "season" / "Miami Grand Prix"
    save(root / "Race" / "VER" / "laptimes.json", LAPS)
    save(root / "Practice 1" / "HAM" / "laptimes.json", {k: v[:1] for k, v in LAPS.items()})
    target = str(tmp_path / "laps")
    convert_laps(spark, f"{tmp_path}/season/*/*/*/laptimes.json", target)
    table = read_laps(spark, target)
    assert table.columns == schemas.LAP_COLUMNS
    race = table.filter("sessionType = 'Race'")
    columns = ["event", "totalLaps", "lap", "lapTime", "tyreCompound", "tyreAgeLaps", "team"]
    assert rows(race.select(*columns)) == [
        ("Miami Grand Prix", "3", "1", "91.5", "SOFT", None, None),
        ("Miami Grand Prix", "3", "2", "None", "SOFT", "2", None),
        ("Miami Grand Prix", "3", "3", "90.25", None, None, None),
    ]
    assert rows(table.groupBy("sessionType").count()) == [("Practice 1", 1), ("Race", 3)]
    assert clean_stint_laps(table).count() == 4


def test_lap_document_without_an_array(spark, tmp_path):
    save(tmp_path / "s" / "E" / "Race" / "VER" / "laptimes.json", LAPS)
    partial = {k: v for k, v in LAPS.items() if k != "stint"}
    save(tmp_path / "s" / "E" / "Race" / "HAM" / "laptimes.json", partial)
    docs = read_documents(
        spark, f"{tmp_path}/s/*/*/*/laptimes.json", schemas.lap_document(list(LAPS)), with_path=True
    )
    assert lap_rows(docs).count() == 3
    assert lap_rows(docs, pad_missing=True).count() == 6


def test_arrays_absent_everywhere_and_unknown_ones(spark, tmp_path):
    """No row is lost for an array that no document has; telemetry keeps arrays it does not know."""
    document = sample_document("2025-E-Race-VER-1")
    del document["tel"]["gear"]
    document["tel"]["tyre_temp"] = [80.5, 81, 82]
    save(tmp_path / "s" / "E" / "Race" / "VER" / "1_tel.json", document)
    save(tmp_path / "s" / "E" / "Race" / "VER" / "laptimes.json", LAPS)
    convert_telemetry(spark, f"{tmp_path}/s/*/*/*/*_tel.json", str(tmp_path / "t"))
    table = read_telemetry(spark, str(tmp_path / "t"))
    assert rows(table.select("tyre_temp", "gear" if "gear" in table.columns else "rpm")) == [
        ("80.5", "0.25"), ("81", "1.25"), ("82", "2.25"),
    ]
    convert_laps(spark, f"{tmp_path}/s/*/*/*/laptimes.json", str(tmp_path / "l"))
    assert read_laps(spark, str(tmp_path / "l")).filter("isRaining IS NULL").count() == 3


def test_named_arrays_must_be_in_some_document(spark, tmp_path):
    save(tmp_path / "s" / "E" / "Race" / "VER" / "1_tel.json", sample_document("2025-E-Race-VER-1"))
    save(tmp_path / "s" / "E" / "Race" / "VER" / "laptimes.json", LAPS)
    with pytest.raises(ValueError, match="drs"):
        convert_telemetry(spark, f"{tmp_path}/s/*/*/*/*_tel.json", str(tmp_path / "t"), ["acc_y", "drs"])
    with pytest.raises(ValueError, match="wR"):
        convert_laps(spark, f"{tmp_path}/s/*/*/*/laptimes.json", str(tmp_path / "l"), ["lap", "wR"])
    with pytest.raises(ValueError, match="no telemetry"):
        convert_telemetry(spark, f"{tmp_path}/s/*/*/*/laptimes.json", str(tmp_path / "t"))
    with pytest.raises(ValueError, match="no lap"):
        convert_laps(spark, f"{tmp_path}/s/*/*/*/*_tel.json", str(tmp_path / "l"))
    convert_laps(spark, f"{tmp_path}/s/*/*/*/laptimes.json", str(tmp_path / "l"), ["lap", "time"])
    assert read_laps(spark, str(tmp_path / "l")).count() == 3


def test_typed_tables_as_target(spark, tmp_path):
    save(tmp_path / "s" / "E" / "Race" / "VER" / "1_tel.json", sample_document("2025-E-Race-VER-1"))
    save(tmp_path / "s" / "E" / "Race" / "VER" / "laptimes.json", LAPS)
    convert_telemetry(spark, f"{tmp_path}/s/*/*/*/*_tel.json", str(tmp_path / "t"), layout="parquet")
    convert_laps(spark, f"{tmp_path}/s/*/*/*/laptimes.json", str(tmp_path / "l"), layout="parquet")
    assert rows(read_typed_telemetry(spark, str(tmp_path / "t")).select("event", "session", "rpm")) == [
        ("E", "Race", 0.25), ("E", "Race", 1.25), ("E", "Race", 2.25),
    ]
    laps = read_typed_laps(spark, str(tmp_path / "l"))
    assert rows(laps.select("session", "lap", "lap_time")) == [
        ("Race", 1, 91.5), ("Race", 2, 0.0), ("Race", 3, 90.25),
    ]


def test_telemetry_files_need_the_channels(spark, tmp_path):
    write_csv(spark.createDataFrame([("1",)], "acc_y string"), str(tmp_path / "t"))
    with pytest.raises(ValueError, match="rpm"):
        read_telemetry(spark, str(tmp_path / "t"))


def test_inferred_laps_leave_absent_columns_null(spark, tmp_path):
    save(tmp_path / "s" / "E" / "Race" / "VER" / "laptimes.json", LAPS)
    docs = read_documents(spark, f"{tmp_path}/s/*/*/*/laptimes.json", with_path=True)
    got = lap_rows(docs)
    assert got.columns == schemas.LAP_COLUMNS
    assert rows(got.select("lap", "stintNumber", "airTemperature"))[0] == (1, 1, None)


def test_drivers_to_table(spark, tmp_path):
    entry = {"driver": "VER", "team": "Red", "dn": "1", "fn": "Max", "ln": "V", "tc": "0000ff"}
    save(tmp_path / "drivers.json", {"drivers": [entry, {**entry, "driver": "HAM", "dn": 44}]})
    target = str(tmp_path / "drivers")
    convert_drivers(spark, str(tmp_path / "drivers.json"), target)
    assert rows(read_drivers(spark, target)) == [
        ("HAM", "Red", "44", "Max", "V"), ("VER", "Red", "1", "Max", "V"),
    ]
    assert driver_rows(read_documents(spark, str(tmp_path / "drivers.json"))).count() == 2


def test_documents_as_lines(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"drivers": []}\n{"drivers": [{"driver": "A"}]}\n')
    docs = read_documents(
        spark, str(tmp_path / "d.json"), schemas.driver_document(), multi_line=False
    )
    assert (docs.count(), driver_rows(docs).count()) == (2, 1)


def test_existing_target_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1), (None, 2), ('say "x"', 3)], "k string, v int")
    target = str(tmp_path / "out")
    write_csv(df, target)
    with pytest.raises(AnalysisException):
        write_csv(df, target)
    write_csv(df, target, mode="overwrite")
    back = spark.read.option("header", True).option("escape", "\\").csv(target)
    assert back.count() == 3


def test_single_sorted_file(spark, tmp_path):
    df = spark.range(0, 100, 1, 8).selectExpr("id % 7 AS k", "id")
    target = tmp_path / "one"
    write_csv(df, str(target), order_by=["k", "id"], single_file=True)
    parts = list(target.glob("part-*.csv"))
    assert len(parts) == 1
    lines = [tuple(map(int, x.split(","))) for x in parts[0].read_text().split()[1:]]
    assert lines == sorted(lines) and len(lines) == 100


def test_sorted_files_stay_in_order(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8).selectExpr("(id * 7919) % 1000 AS k")
    write_csv(df, str(tmp_path / "many"), order_by=["k"])
    lines = [int(x) for p in sorted((tmp_path / "many").glob("part-*.csv"))
             for x in p.read_text().split()[1:]]
    assert lines == list(range(1000))


def test_every_file_has_a_header(spark, tmp_path):
    folder = tmp_path / "drivers"
    folder.mkdir()
    header = ",".join(schemas.DRIVER_COLUMNS)
    (folder / "a.csv").write_text(f"{header}\nVER,Red,1,Max,V\n")
    (folder / "b.csv").write_text(f'{header}\nHAM,"Ferrari, SF",44,Lewis,H\n')
    assert rows(read_drivers(spark, f"{folder}/*.csv").select("driverName", "team")) == [
        ("HAM", "Ferrari, SF"), ("VER", "Red"),
    ]


def test_shifted_layout_fails(spark, tmp_path):
    present = [c for c in schemas.LAP_COLUMNS if c != "team"]
    (tmp_path / "l.csv").write_text(",".join(present) + "\n" + ",".join("1" * len(present)) + "\n")
    with pytest.raises(Exception, match="header"):
        read_laps(spark, str(tmp_path / "l.csv")).collect()
    with pytest.raises(Exception, match="header"):
        read_laps(spark, str(tmp_path / "l.csv")).select("lapTime").collect()
    row = read_laps(spark, str(tmp_path / "l.csv"), present=present).first()
    assert (row["team"], row["driverCode"]) == (None, "1")


def csv_file(path, header, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([",".join(header), *[",".join(line) for line in lines], ""]))


def test_laps_of_several_layouts(spark, tmp_path):
    """Each file by its own header, whatever its path looks like; one scan per layout."""
    full = schemas.LAP_COLUMNS
    short = [c for c in full if c not in ("team", "windSpeed")]
    least = schemas.NEEDED_LAP_COLUMNS
    csv_file(tmp_path / "s" / "2023 a" / "l.csv", full, [f"{c}1" for c in full])
    csv_file(tmp_path / "s" / "2024 [b]" / "l{1}.csv", short, [f"{c}2" for c in short], [f"{c}3" for c in short])
    csv_file(tmp_path / "s" / "2024 [b]" / "x+%20.csv", short, [f"{c}4" for c in short])
    csv_file(tmp_path / "s" / "2025" / "l.csv", least, [f"{c}5" for c in least])
    (tmp_path / "s" / "2025" / "empty.csv").write_text("")
    table = read_laps(spark, f"{tmp_path}/s/*/*.csv", layouts=True)
    assert table.columns == full
    present = {"1": full, "2": short, "3": short, "4": short, "5": least}
    assert rows(table) == sorted(
        (tuple(f"{c}{n}" if c in names else None for c in full) for n, names in present.items()),
        key=lambda r: [(v is None, str(v)) for v in r],
    )
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 3


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda h: [h[1], h[0], *h[2:]], "out of order"),
        (lambda h: [*h, "speed"], "unknown"),
        (lambda h: [c for c in h if c != "lapTime"], "lacks lapTime"),
        (lambda h: [*h, h[0]], "twice"),
    ],
)
def test_shifted_layouts_fail(spark, tmp_path, change, message):
    header = change(schemas.LAP_COLUMNS)
    csv_file(tmp_path / "s" / "a.csv", schemas.LAP_COLUMNS, ["1"] * len(schemas.LAP_COLUMNS))
    csv_file(tmp_path / "s" / "b.csv", header, ["1"] * len(header))
    with pytest.raises(ValueError, match=message):
        read_laps(spark, f"{tmp_path}/s/*.csv", layouts=True)


def test_telemetry_of_several_layouts(spark, tmp_path):
    needed = [*schemas.TELEMETRY_KEYS, *schemas.TELEMETRY_CHANNELS]
    csv_file(tmp_path / "s" / "a.csv", [*needed, "gear"], ["1"] * (len(needed) + 1))
    csv_file(tmp_path / "s" / "b.csv", ["drs", *reversed(needed)], ["2"] * (len(needed) + 1))
    table = read_telemetry(spark, f"{tmp_path}/s/*.csv", layouts=True)
    assert table.columns == [*needed, "drs", "gear"]
    assert rows(table.select("year", "rpm", "drs", "gear")) == [("1", "1", None, "1"), ("2", "2", "2", None)]
    csv_file(tmp_path / "s" / "c.csv", needed[1:], ["3"] * (len(needed) - 1))
    with pytest.raises(ValueError, match="year"):
        read_telemetry(spark, f"{tmp_path}/s/*.csv", layouts=True)


def files(root):
    return {str(p.relative_to(root)) for p in root.rglob("part-*")}


def test_a_weekend_is_written_alone(spark, tmp_path):
    """Other sessions' files stay as they are; a rerun changes no row."""
    for event in ("Miami", "Monza"):
        for driver in ("VER", "HAM"):
            save(tmp_path / "s" / event / "Race" / driver / "laptimes.json", LAPS)
    target = tmp_path / "laps"
    glob = "/*/*/laptimes.json"
    convert_laps(spark, f"{tmp_path}/s/M*{glob}", str(target), layout="parquet", mode="refresh")
    before, first = files(target), rows(read_typed_laps(spark, str(target)))
    assert len(first) == 12

    save(tmp_path / "s" / "Monza" / "Race" / "VER" / "laptimes.json", {k: v[:2] for k, v in LAPS.items()})
    save(tmp_path / "s" / "Spa" / "Race" / "VER" / "laptimes.json", LAPS)
    for event in ("Monza", "Spa", "Monza"):
        convert_laps(spark, f"{tmp_path}/s/{event}{glob}", str(target), layout="parquet", mode="refresh")
    again = rows(read_typed_laps(spark, str(target)).groupBy("event").count())
    assert again == [("Miami", 6), ("Monza", 5), ("Spa", 3)]
    kept = {f for f in before if "Miami" in f}
    assert kept and kept == {f for f in files(target) if "Miami" in f}
    assert not {f for f in before if "Monza" in f} & files(target)

    convert_laps(spark, f"{tmp_path}/s/*{glob}", str(target), layout="parquet", mode="overwrite")
    assert rows(read_typed_laps(spark, str(target)).groupBy("event").count()) == again
    with pytest.raises(ValueError, match="refresh"):
        convert_laps(spark, f"{tmp_path}/s/*{glob}", str(tmp_path / "text"), mode="refresh")


def test_overwriting_is_whole_unless_asked_otherwise(spark, tmp_path, setting):
    """A session that replaces partitions by default does not change what overwrite means."""
    setting("spark.sql.sources.partitionOverwriteMode", "dynamic")
    laps = spark.createDataFrame([("A", "Race", 1), ("B", "Race", 2)], "event string, session string, lap int")
    write_typed(laps, str(tmp_path / "t"), "overwrite")
    write_typed(laps.filter("event = 'B'"), str(tmp_path / "t"), "overwrite")
    assert {f.split("/")[0] for f in files(tmp_path / "t")} == {"event=B"}


def test_reports_are_worked_out_by_many_tasks(spark, tmp_path, monkeypatch):
    """One file asks for one task to write it, not to reduce what goes into it."""
    staged = []
    monkeypatch.setattr(sinks, "settle", lambda df: staged.append(df) or settle(df))
    counts = spark.range(0, 1000, 1, 8).groupBy((F.col("id") % 50).alias("k")).count()
    write_csv(counts, str(tmp_path / "one"), order_by=["k"], single_file=True)
    assert len(list((tmp_path / "one").glob("part-*.csv"))) == 1
    (reduced,) = staged
    text = reduced._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "Coalesce" not in text
    assert spark.read.option("header", True).csv(str(tmp_path / "one")).count() == 50
