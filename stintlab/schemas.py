"""Column layouts of the raw documents and the flat tables.

On disk every flat table is text with a header line, so the read schemas are all
strings; ``sources.cleaning`` turns them into typed rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

# The parts of a telemetry document's key, and the channels the reports use.
# Which other channels there are, and their order, is the data's own business.
TELEMETRY_KEYS = ["year", "event", "sessionType", "driverName", "lapNumber"]
TELEMETRY_CHANNELS = ["acc_y", "brake", "rpm", "speed", "throttle", "rel_distance"]

# The short array names of a lap document, in table order, with the
# name each one has in the lap table.
LAP_FIELDS = {
    "team": "team",
    "drv": "driverCode",
    "dNum": "driverNumber",
    "lap": "lap",
    "time": "lapTime",
    "pb": "isPersonalBest",
    "pos": "position",
    "pout": "pitOut",
    "compound": "tyreCompound",
    "life": "tyreAgeLaps",
    "stint": "stintNumber",
    "s1": "sector1Time",
    "s2": "sector2Time",
    "s3": "sector3Time",
    "vi1": "speedTrapIntermediate1",
    "vi2": "speedTrapIntermediate2",
    "vfl": "speedFinishLine",
    "vst": "speedStraight",
    "wAT": "airTemperature",
    "wH": "humidity",
    "wP": "atmPressure",
    "wR": "isRaining",
    "wTT": "trackTemperature",
    "wWD": "windDirection",
    "wWS": "windSpeed",
}
LAP_COLUMNS = ["event", "sessionType", "totalLaps", *LAP_FIELDS.values()]
# Without these a row is no lap; seasons differ in the others.
NEEDED_LAP_COLUMNS = ["event", "sessionType", "totalLaps", "driverCode", "lap", "lapTime"]

# The driver table's columns, with the document field each comes from.
DRIVER_FIELDS = {
    "driver": "driverName",
    "team": "team",
    "dn": "driverNumber",
    "fn": "firstName",
    "ln": "lastName",
}
DRIVER_COLUMNS = list(DRIVER_FIELDS.values())

RESULT_COLUMNS = ["event", "driverCode", "finalPosition", "totalTime"]


def text_table(columns: Sequence[str]) -> T.StructType:
    """Read schema of a flat table: every column as text."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def telemetry_document(samples: Sequence[str]) -> T.StructType:
    """One document per lap: a key and parallel sample arrays.

    Arrays are read as text because the data mixes numbers with ``"None"``; the
    JSON reader keeps a number's own spelling when it is read as a string.
    """
    arrays = [T.StructField(c, T.ArrayType(T.StringType())) for c in samples]
    tel = T.StructType([T.StructField("dataKey", T.StringType()), *arrays])
    return T.StructType([T.StructField("tel", tel)])


def lap_document(fields: Sequence[str] = tuple(LAP_FIELDS)) -> T.StructType:
    """One document per event, session and driver: parallel arrays, one item per lap."""
    return T.StructType([T.StructField(c, T.ArrayType(T.StringType())) for c in fields])


def driver_document() -> T.StructType:
    entry = T.StructType([T.StructField(c, T.StringType()) for c in DRIVER_FIELDS])
    return T.StructType([T.StructField("drivers", T.ArrayType(entry))])
