"""Laps, telemetry and drivers seen in the given tables.

The tables hold no racing data, so each operator runs over a projection of ``lineitem``:
a ship year is an event, a supplier a driver, six days of the year a lap. Every column is
computed from its own row, so a projection shuffles nothing, keeps every row and lets
filters and column pruning through to the Parquet scan.

Telemetry channels are whole numbers or eighths, and the strategy report's lap times
decimals: their sums are the same in whatever order they are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stintlab.sinks import GZIP_LEVEL

EVENT = "concat('GP ', year(l_shipdate)) AS event"
SESSION = "CASE WHEN l_linestatus = 'F' THEN 'Race' ELSE 'Practice 1' END AS session"
DRIVER = "concat('D', l_suppkey) AS driver"
KEYS = [EVENT, SESSION, DRIVER]

LAP = "CAST(1 + (dayofyear(l_shipdate) - 1) DIV 6 AS INT) AS lap"
TOTAL_LAPS = "61 AS total_laps"
# Constant tables rather than CASE: filters repeat these expressions at every mention.
COMPOUND = (
    "coalesce(try_element_at(map(0, 'INTERMEDIATE', 1, 'WET', 2, ''), "
    "CAST(l_partkey % 16 AS INT)), "
    "try_element_at(map('A', 'SOFT', 'N', 'MEDIUM', 'R', 'HARD'), l_returnflag)) AS compound"
)

# Documents in a file of the tables written as JSON, on average at most.
DOCUMENTS_PER_FILE = 5_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stint_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned laps of the strategy report."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        *KEYS,
        LAP,
        TOTAL_LAPS,
        COMPOUND,
        "CASE WHEN l_quantity = 50 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(18, 2)) END "
        "AS lap_time",
        "CAST(l_linenumber % (2 + l_suppkey % 7) AS INT) AS stint",
    )


def wear_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned laps of the wear reports."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        *KEYS,
        LAP,
        TOTAL_LAPS,
        COMPOUND,
        "CASE WHEN l_quantity = 50 THEN 0.0D ELSE l_extendedprice / 1000.0D END AS lap_time",
        "CAST((l_orderkey + l_linenumber) % 24 AS INT) AS tyre_age",
        "CASE WHEN l_linenumber = 7 THEN 'True' ELSE 'None' END AS pit_out",
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned telemetry samples."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        *KEYS,
        "l_quantity - 25 + round(l_tax * 100) / 8.0D AS acc_y",
        "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS brake",
        "CAST(floor(l_extendedprice / 8.0D) AS DOUBLE) AS rpm",
        "l_quantity * 6 AS speed",
        "l_discount * 1000 AS throttle",
        "CASE WHEN l_discount = 0.1D THEN 'None' ELSE '0.5' END AS rel_distance",
    )


def all_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver table: one row per supplier."""
    suppliers = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation")
    return suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey).selectExpr(
        "concat('D', s_suppkey) AS driverName",
        "n_name AS team",
        "CAST(s_suppkey AS STRING) AS driverNumber",
        "s_name AS firstName",
        "CAST(s_nationkey AS STRING) AS lastName",
    )


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver table with a gap, for joins: the suppliers of nation 3 are missing."""
    return all_drivers(spark, sf_dir).filter("lastName <> '3'")


def lap_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lap table as it comes from a file: text with gaps, blanks and bad numbers."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('GP ', year(l_shipdate)) AS event",
        "CASE WHEN l_linestatus = 'F' THEN ' Race ' ELSE 'Practice 1' END AS sessionType",
        "CASE WHEN l_tax = 0.05D THEN 'n/a' ELSE '61' END AS totalLaps",
        "concat('T', l_suppkey % 10) AS team",
        "concat('D', l_suppkey) AS driverCode",
        "CAST(l_suppkey AS STRING) AS driverNumber",
        "CASE WHEN l_quantity = 1 THEN NULL WHEN l_quantity = 2 THEN '1.5' "
        "ELSE CAST(1 + (dayofyear(l_shipdate) - 1) DIV 6 AS STRING) END AS lap",
        "CASE WHEN l_quantity = 50 THEN 'None' WHEN l_quantity = 49 THEN NULL "
        "WHEN l_quantity = 48 THEN 'NaN' WHEN l_quantity = 47 THEN 'fast' "
        "WHEN l_quantity = 46 THEN '-1.25' "
        "ELSE CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS STRING) END AS lapTime",
        "CASE WHEN l_linenumber = 7 THEN 'True' WHEN l_linenumber = 6 THEN NULL "
        "ELSE 'None' END AS pitOut",
        "CASE WHEN l_partkey % 16 = 2 THEN 'None' WHEN l_partkey % 16 = 3 THEN NULL "
        "WHEN l_returnflag = 'A' THEN 'SOFT' WHEN l_returnflag = 'N' THEN ' MEDIUM' "
        "ELSE 'HARD' END AS tyreCompound",
        "CASE WHEN l_quantity = 30 THEN NULL WHEN l_quantity = 31 THEN 'None' "
        "ELSE CAST((l_orderkey + l_linenumber) % 24 AS STRING) END AS tyreAgeLaps",
        "CASE WHEN l_quantity = 32 THEN NULL WHEN l_quantity = 33 THEN 'None' "
        "ELSE CAST(l_linenumber AS STRING) END AS stintNumber",
    )


def telemetry_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The telemetry table as text, likewise."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('GP ', year(l_shipdate)) AS event",
        "CASE WHEN l_linestatus = 'F' THEN 'Race' ELSE 'Practice 1' END AS sessionType",
        "concat(' D', l_suppkey) AS driverName",
        "CASE WHEN l_quantity = 1 THEN 'None' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END "
        "AS acc_y",
        "CASE WHEN l_quantity = 2 THEN '1.0' WHEN l_returnflag = 'R' THEN '1' ELSE '0' END "
        "AS brake",
        "CASE WHEN l_quantity = 3 THEN NULL "
        "ELSE CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS STRING) END AS rpm",
        "CAST(CAST(l_quantity AS INT) * 6 AS STRING) AS speed",
        "CASE WHEN l_quantity = 4 THEN 'x' ELSE '50' END AS throttle",
        "CASE WHEN l_discount = 0.1D THEN 'None' WHEN l_discount = 0.09D THEN NULL "
        "ELSE '0.5' END AS rel_distance",
    )


def result_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Official results as text, one per order."""
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('GP ', year(o_orderdate)) AS event",
        "concat('D', o_custkey) AS driverCode",
        "CASE WHEN o_orderstatus = 'P' THEN 'DNF' ELSE CAST(o_orderkey AS STRING) END "
        "AS finalPosition",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL "
        "ELSE CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS STRING) END AS totalTime",
    )


def _numbers(first: str) -> str:
    """As many numbers from ``first`` + 1 as the line number, as texts."""
    return f"CAST(sequence({first} + 1, {first} + l_linenumber) AS ARRAY<STRING>)"


def _none_first(first: str) -> str:
    """``None`` and then the numbers from ``first`` + 1, of the same length."""
    return f"slice(concat(array('None'), {_numbers(first)}), 1, l_linenumber)"


def _one_short(array: str) -> str:
    return f"slice({array}, 1, l_linenumber - 1)"


_TELEMETRY_FIELDS = (
    "'dataKey', concat_ws('-', year(l_shipdate), 'GP', 'Race', "
    "IF(l_quantity = 50, NULL, concat('D', l_suppkey, '-', l_orderkey))), "
    f"'acc_y', {_numbers('l_partkey')}, "
    f"'rpm', {_none_first('l_orderkey')}, "
    f"'speed', {_one_short(_numbers('l_suppkey'))}, "
    f"'drs', IF(l_returnflag = 'R', NULL, {_numbers('0')})"
)
# The channels that a telemetry table must have besides.
_MORE_TELEMETRY_FIELDS = (
    f"'brake', {_numbers('0')}, 'throttle', {_numbers('0')}, 'rel_distance', {_none_first('0')}"
)
LAP_DOCUMENT = [
    "array_repeat(concat('D', l_suppkey), l_linenumber) AS drv",
    f"{_numbers('0')} AS lap",
    f"{_none_first('l_partkey')} AS time",
    f"{_none_first('1')} AS life",
    f"{_numbers('l_suppkey')} AS stint",
    f"{_one_short('array_repeat(l_returnflag, l_linenumber)')} AS compound",
]
DRIVER_DOCUMENT = (
    "slice(array("
    "named_struct('driver', concat('D', c_custkey), 'team', c_mktsegment, "
    "'dn', CAST(c_custkey AS STRING), 'fn', c_name, 'ln', CAST(c_nationkey AS STRING)), "
    "named_struct('driver', concat('R', c_custkey), 'team', c_mktsegment, "
    "'dn', CAST(NULL AS STRING), 'fn', 'Reserve', 'ln', c_name)), "
    "1, IF(c_acctbal > 0, 2, 1))"
)


def telemetry_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One telemetry document per line item, of as many samples as its line number.

    ``speed`` is one sample short, and the documents of returned items lack ``drs``.
    """
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"named_struct({_TELEMETRY_FIELDS}) AS tel"
    )


def lap_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lap document per line item, with its file's path and without weather arrays."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "split(concat('file:///season/', 'Grand%20Prix%20', year(l_shipdate), '/', "
        "IF(l_linestatus = 'F', 'Race', 'Practice%201'), '/D', l_suppkey, "
        "'/laptimes.json'), '/') AS full_file_uri",
        *LAP_DOCUMENT,
    )


def driver_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One driver list per customer: the customer and, for some, a reserve driver."""
    return table(spark, sf_dir, "customer").selectExpr(f"{DRIVER_DOCUMENT} AS drivers")


def lap_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lap documents with their event and session as columns, for writing to files."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('Grand Prix ', year(l_shipdate)) AS event",
        "CASE WHEN l_linestatus = 'F' THEN 'Race' ELSE 'Practice 1' END AS session",
        "array(CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING)) AS lap",
        "array(concat('D', l_suppkey), concat('D', l_suppkey)) AS drv",
        "array(CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS STRING), 'None') AS time",
    )


def write_array_files(
    docs: DataFrame,
    folders: list[str],
    order: list[str],
    path: str,
    documents_per_file: int = DOCUMENTS_PER_FILE,
    fields: Sequence[str] = (),
    compression: str = "none",
) -> None:
    """Write documents as multi-line files, each an array of them, by ``folders`` and part.

    ``docs`` has the folder columns, those of ``order``, which tell its rows apart, and the
    document's own, or those that its ``fields``, as SQL, are worked out from. That is done once rows
    are in their places, so that only what the fields are made of is shuffled and sorted. A hash of the latter deals each folder's documents to as many parts as its
    largest folder needs to have ``documents_per_file`` in a file on average, so a file
    stays as small at any scale. Lines are put out one by one in order: nothing is gathered.
    """
    most = docs.groupBy(*folders).count().agg(F.max("count")).first()[0] or 1
    part = F.concat(F.lit("D"), F.pmod(F.xxhash64(*order), F.lit(-(-most // documents_per_file))))
    dealt = docs.withColumn("part", part)
    places = [*folders, "part"]
    inside = Window.partitionBy(*places).orderBy(*order)
    own = [F.expr(f) for f in fields] or [c for c in docs.columns if c not in {*folders, *order}]
    text = F.to_json(F.struct(*own), {"pretty": "true"})
    opening = F.when(F.row_number().over(inside) == 1, "[").otherwise("")
    last = F.lead(F.lit(1)).over(inside).isNull()
    closing = F.when(last, "]").otherwise(",")
    lines = dealt.select(*places, F.concat(opening, text, closing).alias("value"))
    lines.write.partitionBy(*places).options(compression=compression, **GZIP_LEVEL).text(path)


_RACE_FOLDERS = {
    "event": "concat('Grand Prix ', year(l_shipdate))",
    "session": "IF(l_linestatus = 'F', 'Race', 'Practice 1')",
}


def _write_item_files(spark: SparkSession, sf_dir: str, fields: Sequence[str], path: str) -> str:
    """A document per line item in compressed files by event, session and part; returns their glob."""
    items = table(spark, sf_dir, "lineitem").withColumns({c: F.expr(e) for c, e in _RACE_FOLDERS.items()})
    write_array_files(
        items, list(_RACE_FOLDERS), ["l_orderkey", "l_linenumber"], path, fields=fields, compression="gzip"
    )
    return f"{path}/*/*/*/*.txt.gz"


def telemetry_files(spark: SparkSession, sf_dir: str, path: str) -> str:
    """The telemetry documents in files by event, session and part; returns their glob."""
    tel = f"named_struct({_TELEMETRY_FIELDS}, {_MORE_TELEMETRY_FIELDS}) AS tel"
    return _write_item_files(spark, sf_dir, [tel], path)


def lap_files(spark: SparkSession, sf_dir: str, path: str) -> str:
    """The lap documents in files by event, session and part; returns their glob."""
    return _write_item_files(spark, sf_dir, LAP_DOCUMENT, path)


def driver_files(spark: SparkSession, sf_dir: str, path: str) -> str:
    """The driver lists in files by market segment and part; returns their glob."""
    customers = table(spark, sf_dir, "customer").withColumn("segment", F.col("c_mktsegment"))
    write_array_files(
        customers, ["segment"], ["c_custkey"], path, fields=[f"{DRIVER_DOCUMENT} AS drivers"], compression="gzip"
    )
    return f"{path}/*/*/*.txt.gz"


# Columns that the laps of odd years are written without.
ABSENT_IN_ODD_YEARS = ["team", "pitOut", "tyreAgeLaps"]


def season_files(spark: SparkSession, sf_dir: str, path: str) -> str:
    """The lap table as text files of two layouts, one for even and one for odd years."""
    laps = lap_text(spark, sf_dir)
    odd = F.right("event", F.lit(1)).cast("int") % 2 == 1
    for folder, rows in (("even", laps.filter(~odd)), ("odd", laps.filter(odd).drop(*ABSENT_IN_ODD_YEARS))):
        rows.write.option("header", True).csv(f"{path}/{folder}")
    return f"{path}/*/*.csv"
