"""SQL giving the registered queries' answers, for an independent engine.

The SQL works from the given tables and takes its own way to each answer: medians by row
number, strategies from one row per stint, document rows from generated indices.
"""

from __future__ import annotations

_KEYS = """
    'GP ' || year(l_shipdate) AS event,
    CASE WHEN l_linestatus = 'F' THEN 'Race' ELSE 'Practice 1' END AS session,
    'D' || l_suppkey AS driver"""

_LAP = """
    CAST(1 + (dayofyear(l_shipdate) - 1) // 6 AS INTEGER) AS lap,
    61 AS total_laps,
    CASE l_partkey % 16 WHEN 0 THEN 'INTERMEDIATE' WHEN 1 THEN 'WET' WHEN 2 THEN ''
        ELSE CASE l_returnflag WHEN 'A' THEN 'SOFT' WHEN 'N' THEN 'MEDIUM' ELSE 'HARD' END
    END AS compound"""

# Race laps of the strategy report, and their stints.
_STINT_LAPS = f"""
laps AS (
    SELECT * FROM (
        SELECT {_KEYS}, {_LAP},
            CASE WHEN l_quantity = 50 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(18, 2)) END
                AS lap_time,
            CAST(l_linenumber % (2 + l_suppkey % 7) AS INTEGER) AS stint
        FROM lineitem) all_laps
    WHERE session = 'Race' AND lap_time > 0 AND compound <> ''
),
totals AS (
    SELECT event, driver, CAST(sum(lap_time) AS DOUBLE) AS total_time, max(lap) AS last_lap
    FROM laps GROUP BY event, driver
),
stints AS (
    SELECT event, driver, stint, compound, laps FROM (
        SELECT event, driver, stint, compound,
            count(*) OVER (PARTITION BY event, driver, stint) AS laps,
            row_number() OVER (PARTITION BY event, driver, stint ORDER BY lap, compound) AS nth
        FROM laps WHERE stint > 0) numbered
    WHERE nth = 1
),
stint_stats AS (
    SELECT event, driver, CAST(count(*) AS INTEGER) AS num_stints,
        CAST(sum(laps) AS DOUBLE) / count(*) AS avg_stint_length,
        string_agg(compound, '>' ORDER BY stint) AS compounds,
        CAST(count(DISTINCT compound) AS INTEGER) AS distinct_compounds,
        max(CASE WHEN compound = 'SOFT' THEN 1 ELSE 0 END) AS has_soft,
        min_by(compound, stint) AS first_compound
    FROM stints GROUP BY event, driver
),
strategies AS (
    SELECT t.event, t.driver, t.total_time, s.num_stints, s.avg_stint_length, s.compounds,
        coalesce(s.distinct_compounds, 0) AS distinct_compounds,
        CASE WHEN has_soft = 1 AND avg_stint_length < 12 THEN 'AGGRESSIVE'
             WHEN first_compound = 'HARD' AND avg_stint_length > 18 THEN 'CONSERVATIVE'
             WHEN distinct_compounds = 1 THEN 'CONSERVATIVE'
             ELSE 'BALANCED' END AS strategy
    FROM totals t LEFT JOIN stint_stats s ON s.event = t.event AND s.driver = t.driver
),
positions AS (
    SELECT event, driver, total_time, CAST(row_number() OVER (
        PARTITION BY event ORDER BY total_time, driver) AS INTEGER) AS position
    FROM totals
)"""

_DRIVERS = """
drivers AS (
    SELECT 'D' || s_suppkey AS driver, n_name AS team, CAST(s_suppkey AS VARCHAR) AS number
    FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_nationkey <> 3
)"""

_TELEMETRY = f"""
telemetry AS (
    SELECT {_KEYS},
        l_quantity - 25 + round(l_tax * 100) / 8 AS acc_y,
        CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS brake,
        floor(l_extendedprice / 8) AS rpm,
        l_quantity * 6 > 120 AND l_discount * 1000 > 35 AS at_speed
    FROM lineitem WHERE l_discount <> 0.1
)"""

_STYLES_OF_RANKED = """
stats AS (
    SELECT event, driver, avg(CASE WHEN nth <= 5 THEN acc_y END) AS acc_y, avg(brake) AS brake,
        coalesce(avg(CASE WHEN at_speed THEN rpm END), 0) AS rpm
    FROM ranked GROUP BY event, driver
),
baselines AS (
    SELECT event, avg(acc_y) AS acc_y, avg(brake) AS brake, avg(rpm) AS rpm
    FROM stats GROUP BY event
),
styles AS (
    SELECT s.event, s.driver, CASE
        (CASE WHEN s.acc_y > b.acc_y THEN 1 ELSE 0 END)
        + (CASE WHEN s.brake < b.brake THEN 1 ELSE 0 END)
        + (CASE WHEN s.rpm > b.rpm THEN 1 ELSE 0 END)
        WHEN 0 THEN 'CONSERVATIVE' WHEN 1 THEN 'BALANCED' ELSE 'AGRESSIVE' END AS style
    FROM stats s JOIN baselines b ON s.event = b.event
)"""

_STATS = f"""{_TELEMETRY},
ranked AS (
    SELECT event, driver, acc_y, brake, rpm, at_speed, row_number() OVER (
        PARTITION BY event, driver ORDER BY acc_y DESC) AS nth
    FROM telemetry WHERE session = 'Race'
),
{_STYLES_OF_RANKED}"""

_PROTOTYPE_STATS = f"""{_TELEMETRY},
stats AS (
    SELECT event, session, driver, greatest(max(acc_y), CAST(-30 AS DOUBLE)) AS acc_y,
        avg(brake) AS brake,
        coalesce(avg(CASE WHEN at_speed THEN rpm END), CAST(sum(brake) AS DOUBLE)) AS rpm
    FROM telemetry GROUP BY event, session, driver
),
styles AS (
    SELECT event, session, driver, CASE
        (CASE WHEN acc_y > (SELECT avg(acc_y) FROM stats) THEN 1 ELSE 0 END)
        + (CASE WHEN brake > (SELECT avg(brake) FROM stats) THEN 1 ELSE 0 END)
        + (CASE WHEN rpm > (SELECT avg(rpm) FROM stats) THEN 1 ELSE 0 END)
        WHEN 0 THEN 'CONSERVATIVE' WHEN 1 THEN 'BALANCED' ELSE 'AGRESSIVE' END AS style
    FROM stats
)"""


def _state(warm_up: bool) -> str:
    drop = "tyre_age = 1"
    if warm_up:
        drop += " OR (tyre_age <= 2 AND compound IN ('HARD', 'MEDIUM'))"
    return f"""CASE WHEN {drop} THEN 'DROP'
        WHEN tyre_age <= CASE compound
            WHEN 'HARD' THEN CASE WHEN lap <= 15 THEN 16 ELSE 18 END
            WHEN 'MEDIUM' THEN 12
            WHEN 'INTERMEDIATE' THEN CASE WHEN lap <= 15 THEN 6 ELSE 7 END
            ELSE CASE WHEN lap <= 15 THEN 6 ELSE 5 END END
        THEN 'OPTIMAL' ELSE 'DEGRADED' END"""


def _wear_laps(warm_up: bool, condition: str) -> str:
    return f"""
worn AS (
    SELECT *, {_state(warm_up)} AS state FROM (
        SELECT {_KEYS}, {_LAP},
            CASE WHEN l_quantity = 50 THEN 0 ELSE l_extendedprice / 1000 END AS lap_time,
            CAST((l_orderkey + l_linenumber) % 24 AS INTEGER) AS tyre_age,
            l_linenumber <> 7 AS no_pit
        FROM lineitem) all_laps
    WHERE lap_time <> 0 AND compound <> '' AND tyre_age <> 0 AND {condition}
)"""


_RACE = "session = 'Race'"
_FUEL = "(100 * (1 - CAST(lap AS DOUBLE) / total_laps)) * CAST(0.03 AS DOUBLE)"
_PACED = f"""
paced AS (
    SELECT event, session, driver, lap, compound, state, lap_time - {_FUEL} AS pace,
        lap_time + {_FUEL} AS prototype_pace
    FROM worn WHERE state <> 'DROP' AND no_pit AND lap > 3
)"""
_DRY = "compound NOT IN ('INTERMEDIATE', 'WET')"


def _medians(source: str, keys: str, value: str) -> str:
    return f"""
    SELECT {keys}, {value} AS median, n AS count, mean FROM (
        SELECT {keys}, {value},
            row_number() OVER (PARTITION BY {keys} ORDER BY {value}) - 1 AS nth,
            count(*) OVER (PARTITION BY {keys}) AS n,
            avg({value}) OVER (PARTITION BY {keys}) AS mean
        FROM {source}) numbered
    WHERE nth = n // 2"""


def _wear(keys: str, output_keys: str, condition: str) -> str:
    return f"""
    SELECT {output_keys}, round(optimal, 3) AS optimal_median,
        round(degraded, 3) AS degraded_median, round(degraded - optimal, 3) AS pace_dropoff_s,
        CAST(optimal_n AS INTEGER) AS optimal_count, CAST(degraded_n AS INTEGER) AS degraded_count
    FROM (
        SELECT {keys},
            max(CASE WHEN state = 'OPTIMAL' THEN median END) AS optimal,
            max(CASE WHEN state = 'DEGRADED' THEN median END) AS degraded,
            max(CASE WHEN state = 'OPTIMAL' THEN count ELSE 0 END) AS optimal_n,
            max(CASE WHEN state = 'DEGRADED' THEN count ELSE 0 END) AS degraded_n
        FROM medians GROUP BY {keys}) sides
    WHERE {condition}"""


_STYLED = f"""{_STATS}, {_wear_laps(True, _RACE)}, {_PACED},
styled AS (
    SELECT p.event, p.driver, p.compound, p.state, p.pace, s.style
    FROM paced p JOIN styles s ON s.event = p.event AND s.driver = p.driver WHERE {_DRY}
)"""

_WEAR_REPORT = f"""WITH {_STYLED},
medians AS ({_medians("styled", "event, style, compound, state", "pace")})
{_wear("event, style, compound", "event, style, compound AS tyre_compound",
       "optimal_n >= 15 AND degraded_n >= 15")}"""

_PROTOTYPE_MEDIANS = f"""{_PROTOTYPE_STATS}, {_wear_laps(False, "TRUE")}, {_PACED},
styled AS (
    SELECT s.style, p.compound, p.state, p.prototype_pace AS pace
    FROM paced p JOIN styles s
        ON s.event = p.event AND s.session = p.session AND s.driver = p.driver
    WHERE p.session = 'Race'
),
medians AS ({_medians("styled", "style, compound, state", "pace")})"""

_STYLED_PROTOTYPE = f"""{_PROTOTYPE_STATS}, {_wear_laps(False, "TRUE")},
styled AS (
    SELECT w.event, w.session, w.driver, w.lap, w.total_laps, w.compound, w.lap_time,
        w.tyre_age, CASE WHEN w.no_pit THEN 'None' ELSE 'True' END AS pit_out, s.style
    FROM worn w JOIN styles s
        ON s.event = w.event AND s.session = w.session AND s.driver = w.driver
)"""

# The text tables, as the proxies spell them.
_LAP_TEXT = """
lap_text AS (
    SELECT 'GP ' || year(l_shipdate) AS event,
        CASE WHEN l_linestatus = 'F' THEN 'Race' ELSE 'Practice 1' END AS session,
        'D' || l_suppkey AS driver,
        CASE WHEN l_tax = 0.05 THEN NULL ELSE 61 END AS total_laps,
        CASE WHEN l_quantity IN (1, 2) THEN NULL
            ELSE CAST(1 + (dayofyear(l_shipdate) - 1) // 6 AS INTEGER) END AS lap,
        CASE WHEN l_quantity IN (49, 50) THEN 0
            WHEN l_quantity = 48 THEN CAST('NaN' AS DOUBLE)
            WHEN l_quantity = 47 THEN NULL
            WHEN l_quantity = 46 THEN -1.25
            ELSE l_extendedprice END AS lap_time,
        CASE l_linenumber WHEN 7 THEN 'True' WHEN 6 THEN '' ELSE 'None' END AS pit_out,
        CASE WHEN l_partkey % 16 IN (2, 3) THEN ''
            WHEN l_returnflag = 'A' THEN 'SOFT' WHEN l_returnflag = 'N' THEN 'MEDIUM'
            ELSE 'HARD' END AS compound,
        CASE WHEN l_quantity = 30 THEN 0 WHEN l_quantity = 31 THEN NULL
            ELSE CAST((l_orderkey + l_linenumber) % 24 AS INTEGER) END AS tyre_age,
        CASE WHEN l_quantity = 32 THEN 0 WHEN l_quantity = 33 THEN NULL
            ELSE l_linenumber END AS stint
    FROM lineitem
),
stint_rows AS (
    SELECT event, session, driver, lap_time, stint, lap, total_laps, compound FROM lap_text
    WHERE lap_time IS NOT NULL AND stint IS NOT NULL AND lap IS NOT NULL
        AND total_laps IS NOT NULL
),
wear_rows AS (
    SELECT event, session, driver, lap_time, compound, tyre_age, lap, total_laps, pit_out
    FROM lap_text
    WHERE lap_time IS NOT NULL AND tyre_age IS NOT NULL AND lap IS NOT NULL
        AND total_laps IS NOT NULL
)"""

_CLEAN_TELEMETRY = """
SELECT 'GP ' || year(l_shipdate) AS event, 'Race' AS session, 'D' || l_suppkey AS driver,
    CAST(l_quantity AS DOUBLE) AS acc_y, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS brake,
    l_extendedprice AS rpm, l_quantity * 6 AS speed, CAST(50 AS DOUBLE) AS throttle,
    CASE WHEN l_discount = 0.09 THEN '' ELSE '0.5' END AS rel_distance
FROM lineitem
WHERE l_linestatus = 'F' AND l_quantity NOT IN (1, 2, 3, 4) AND l_discount <> 0.1"""

_WEAR_FROM_FILES = f"""WITH {_LAP_TEXT},
clean AS ({_CLEAN_TELEMETRY}),
ranked AS (
    SELECT *, speed > 120 AND throttle > 35 AS at_speed,
        row_number() OVER (PARTITION BY event, driver ORDER BY acc_y DESC) AS nth
    FROM clean
),
{_STYLES_OF_RANKED},
worn AS (
    SELECT *, {_state(True)} AS state FROM wear_rows
    WHERE session = 'Race' AND lap_time <> 0 AND compound <> '' AND tyre_age <> 0
),
styled AS (
    SELECT p.event, s.style, p.compound, p.state, p.lap_time - {_FUEL} AS pace
    FROM worn p JOIN styles s ON s.event = p.event AND s.driver = p.driver
    WHERE p.state <> 'DROP' AND p.pit_out = 'None' AND p.lap > 3 AND {_DRY}
),
medians AS ({_medians("styled", "event, style, compound, state", "pace")})
{_wear("event, style, compound", "event, style, compound AS tyre_compound",
       "optimal_n >= 15 AND degraded_n >= 15")}"""

_CLEAN_RESULTS = """
SELECT 'GP ' || year(o_orderdate) AS event, 'Race' AS session, 'D' || o_custkey AS driver,
    CAST(o_orderkey AS INTEGER) AS final_position, o_totalprice AS total_time
FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT'"""

_INDEXED = """
indexed AS (
    SELECT li.*, i.i FROM lineitem li
    JOIN (SELECT unnest(range(1, 8)) AS i) i ON i.i <= li.l_linenumber
)"""

_TELEMETRY_ROWS = f"""WITH {_INDEXED}
SELECT CAST(year(l_shipdate) AS VARCHAR) AS year, 'GP' AS event, 'Race' AS "sessionType",
    CASE WHEN l_quantity <> 50 THEN 'D' || l_suppkey END AS "driverName",
    CASE WHEN l_quantity <> 50 THEN CAST(l_orderkey AS VARCHAR) END AS "lapNumber",
    CAST(l_partkey + i AS VARCHAR) AS acc_y,
    CASE WHEN i = 1 THEN 'None' ELSE CAST(l_orderkey + i - 1 AS VARCHAR) END AS rpm,
    CASE WHEN i < l_linenumber THEN CAST(l_suppkey + i AS VARCHAR) END AS speed,
    CAST(i AS VARCHAR) AS drs
FROM indexed WHERE l_returnflag <> 'R'"""

_TELEMETRY_FILES = f"""
SELECT *, drs AS brake, drs AS throttle,
    CASE WHEN drs = '1' THEN 'None' ELSE CAST(CAST(drs AS INTEGER) - 1 AS VARCHAR) END
        AS rel_distance
FROM ({_TELEMETRY_ROWS}) written"""

_LAP_ROWS_ABSENT = ", ".join(
    f'CAST(NULL AS VARCHAR) AS "{c}"'
    for c in [
        "team", "driverNumber", "isPersonalBest", "position", "pitOut", "sector1Time",
        "sector2Time", "sector3Time", "speedTrapIntermediate1", "speedTrapIntermediate2",
        "speedFinishLine", "speedStraight", "airTemperature", "humidity", "atmPressure",
        "isRaining", "trackTemperature", "windDirection", "windSpeed",
    ]
)

_LAP_ROWS = f"""WITH {_INDEXED}
SELECT 'Grand Prix ' || year(l_shipdate) AS event,
    CASE WHEN l_linestatus = 'F' THEN 'Race' ELSE 'Practice 1' END AS "sessionType",
    l_linenumber AS "totalLaps", 'D' || l_suppkey AS "driverCode", CAST(i AS INTEGER) AS lap,
    CASE WHEN i = 1 THEN 'None' ELSE CAST(l_partkey + i - 1 AS VARCHAR) END AS "lapTime",
    CASE WHEN i < l_linenumber THEN l_returnflag END AS "tyreCompound",
    CASE WHEN i <> 1 THEN CAST(i AS INTEGER) END AS "tyreAgeLaps",
    CAST(l_suppkey + i AS INTEGER) AS "stintNumber",
    {_LAP_ROWS_ABSENT}
FROM indexed"""

_LAP_FILES = f"""WITH {_INDEXED}
SELECT 'event=Grand Prix ' || year(l_shipdate) AS event,
    'session=' || CASE WHEN l_linestatus = 'F' THEN 'Race' ELSE 'Practice 1' END AS "sessionType",
    CAST(l_linenumber AS VARCHAR) AS "totalLaps", 'D' || l_suppkey AS "driverCode",
    CAST(i AS VARCHAR) AS lap,
    CASE WHEN i = 1 THEN 'None' ELSE CAST(l_partkey + i - 1 AS VARCHAR) END AS "lapTime",
    CASE WHEN i < l_linenumber THEN l_returnflag END AS "tyreCompound",
    CASE WHEN i <> 1 THEN CAST(i AS VARCHAR) END AS "tyreAgeLaps",
    CAST(l_suppkey + i AS VARCHAR) AS "stintNumber",
    {_LAP_ROWS_ABSENT}
FROM indexed"""

_DRIVER_ROWS = """
SELECT 'D' || c_custkey AS "driverName", c_mktsegment AS team,
    CAST(c_custkey AS VARCHAR) AS "driverNumber", c_name AS "firstName",
    CAST(c_nationkey AS VARCHAR) AS "lastName" FROM customer
UNION ALL
SELECT 'R' || c_custkey, c_mktsegment, NULL, 'Reserve', c_name FROM customer WHERE c_acctbal > 0"""

_SEGMENTS = ", ".join(f"url_decode(parts[-{i}]) AS segment_{i}" for i in range(1, 6))

_LAP_CSV = f"""
SELECT 'GP ' || year(l_shipdate) AS event,
    CASE WHEN l_linestatus = 'F' THEN 'Race' ELSE 'Practice 1' END AS "sessionType",
    CASE WHEN l_tax = 0.05 THEN 'n/a' ELSE '61' END AS "totalLaps",
    'T' || l_suppkey % 10 AS team, 'D' || l_suppkey AS "driverCode",
    CAST(l_suppkey AS VARCHAR) AS "driverNumber",
    CASE WHEN l_quantity = 1 THEN NULL WHEN l_quantity = 2 THEN '1.5'
        ELSE CAST(1 + (dayofyear(l_shipdate) - 1) // 6 AS VARCHAR) END AS lap,
    CASE l_quantity WHEN 50 THEN 'None' WHEN 49 THEN NULL WHEN 48 THEN 'NaN' WHEN 47 THEN 'fast'
        WHEN 46 THEN '-1.25' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR) END
        AS "lapTime",
    CASE l_linenumber WHEN 7 THEN 'True' WHEN 6 THEN NULL ELSE 'None' END AS "pitOut",
    CASE WHEN l_partkey % 16 = 2 THEN 'None' WHEN l_partkey % 16 = 3 THEN NULL
        WHEN l_returnflag = 'A' THEN 'SOFT' WHEN l_returnflag = 'N' THEN 'MEDIUM'
        ELSE 'HARD' END AS "tyreCompound",
    CASE WHEN l_quantity = 30 THEN NULL WHEN l_quantity = 31 THEN 'None'
        ELSE CAST((l_orderkey + l_linenumber) % 24 AS VARCHAR) END AS "tyreAgeLaps",
    CASE WHEN l_quantity = 32 THEN NULL WHEN l_quantity = 33 THEN 'None'
        ELSE CAST(l_linenumber AS VARCHAR) END AS "stintNumber",
    {", ".join(
        f'CAST(NULL AS VARCHAR) AS "{c}"'
        for c in [
            "isPersonalBest", "position", "sector1Time", "sector2Time", "sector3Time",
            "speedTrapIntermediate1", "speedTrapIntermediate2", "speedFinishLine",
            "speedStraight", "airTemperature", "humidity", "atmPressure", "isRaining",
            "trackTemperature", "windDirection", "windSpeed",
        ]
    )}
FROM lineitem"""

_TEAMS_TWICE = f"""{_STINT_LAPS}, {_DRIVERS},
entries AS (
    SELECT driver, team FROM drivers
    UNION ALL SELECT driver, 'NATION_0' FROM drivers WHERE number < '5'
)"""

ORACLES: dict[str, str] = {
    "pit_strategy_report": f"""WITH {_STINT_LAPS}, {_DRIVERS}
        SELECT s.strategy, s.event, d.team, avg(p.position) AS "avgPosition",
            CAST(sum(CAST(s.total_time AS DECIMAL(28, 2))) AS DOUBLE) / count(*)
                AS "avgTotalTime"
        FROM strategies s
        JOIN positions p ON p.event = s.event AND p.driver = s.driver
        JOIN drivers d ON d.driver = s.driver
        GROUP BY s.strategy, s.event, d.team""",
    "strategy_profile": f"""WITH {_STINT_LAPS},
        times AS (
            SELECT event, driver, CAST(sum(lap_time) AS DOUBLE) / count(*) AS avg_lap,
                CAST(sum(CAST(lap_time * lap_time AS DECIMAL(38, 4))) AS DOUBLE) / count(*)
                    AS avg_square
            FROM laps GROUP BY event, driver)
        SELECT t.event, t.driver, coalesce(s.num_stints, 0) AS num_stints,
            t.avg_lap, round(t.avg_square - t.avg_lap * t.avg_lap, 2) AS lap_variance,
            s.avg_stint_length, coalesce(s.compounds, '') AS compounds
        FROM times t LEFT JOIN strategies s ON s.event = t.event AND s.driver = t.driver""",
    "race_totals": f"WITH {_STINT_LAPS} SELECT event, driver, total_time, last_lap FROM totals",
    "race_positions": f"""WITH {_STINT_LAPS}
        SELECT event, driver, total_time, position FROM positions""",
    "race_positions_by_range": f"""WITH {_STINT_LAPS}
        SELECT event, driver, total_time, position FROM positions""",
    "stint_summary": f"""WITH {_STINT_LAPS}
        SELECT event, driver, stint, compound, laps FROM stints""",
    "strategy_labels": f"""WITH {_STINT_LAPS}
        SELECT event, driver, distinct_compounds, strategy FROM strategies""",
    "driver_team_lookup": f"""WITH {_TEAMS_TWICE}
        SELECT t.event, t.driver, t.total_time, t.last_lap, e.team
        FROM totals t JOIN (SELECT driver, max(team) AS team FROM entries GROUP BY driver) e
            ON e.driver = t.driver""",
    "driver_team_lookup_latest": f"""WITH {_STINT_LAPS}, {_DRIVERS}
        SELECT t.event, t.driver, t.total_time, t.last_lap,
            CASE WHEN d.number < '5' THEN 'EARLY ' ELSE '' END || d.team AS team
        FROM totals t JOIN drivers d ON d.driver = t.driver""",
    "driver_team_lookup_all": f"""WITH {_TEAMS_TWICE}
        SELECT t.event, t.driver, t.total_time, t.last_lap, e.team
        FROM totals t JOIN entries e ON e.driver = t.driver""",
    "driving_stats": f"WITH {_STATS} SELECT event, driver, acc_y, brake, rpm FROM stats",
    "event_baselines": f"""WITH {_STATS}
        SELECT event, round(acc_y, 6) AS acc_y, round(brake, 6) AS brake, round(rpm, 6) AS rpm
        FROM baselines""",
    "driving_style": f"WITH {_STATS} SELECT event, driver, style FROM styles",
    "driving_stats_prototype": f"""WITH {_PROTOTYPE_STATS}
        SELECT event, session, driver, acc_y, brake, rpm FROM stats""",
    "driving_style_prototype": f"""WITH {_PROTOTYPE_STATS}
        SELECT event, session, driver, style FROM styles""",
    "tyre_state_laps": f"""WITH {_wear_laps(True, _RACE)}
        SELECT event, driver, compound, lap, tyre_age, state FROM worn""",
    "tyre_state_prototype": f"""WITH {_wear_laps(False, "TRUE")}
        SELECT event, driver, compound, lap, tyre_age, state FROM worn""",
    "fuel_corrected_laps": f"""WITH {_wear_laps(True, _RACE)}, {_PACED}
        SELECT event, driver, lap, state, pace, prototype_pace FROM paced WHERE {_DRY}""",
    "styled_laps": f"""WITH {_STYLED}
        SELECT event, driver, compound, state, pace, style FROM styled""",
    "state_medians": f"""WITH {_wear_laps(True, _RACE)}, {_PACED},
        dry AS (SELECT * FROM paced WHERE {_DRY}),
        medians AS ({_medians("dry", "event, compound, state", "pace")})
        SELECT event, compound, state, median, count, round(mean, 4) AS mean FROM medians""",
    "state_medians_prototype": f"""WITH {_PROTOTYPE_MEDIANS}
        SELECT style, compound, state, median, count, round(mean, 4) AS mean FROM medians""",
    "wear_report": _WEAR_REPORT,
    "wear_report_prototype": f"""WITH {_PROTOTYPE_MEDIANS}
        {_wear("style, compound", "style, compound",
               "optimal IS NOT NULL AND degraded IS NOT NULL")}""",
    "clean_stint_laps": f"WITH {_LAP_TEXT} SELECT * FROM stint_rows",
    "timed_race_laps": f"""WITH {_LAP_TEXT} SELECT * FROM stint_rows
        WHERE session = 'Race' AND lap_time > 0 AND NOT isnan(lap_time) AND compound <> ''""",
    "clean_wear_laps": f"WITH {_LAP_TEXT} SELECT * FROM wear_rows",
    "worn_laps": f"""WITH {_LAP_TEXT} SELECT * FROM wear_rows
        WHERE session = 'Race' AND lap_time <> 0 AND compound <> '' AND tyre_age <> 0""",
    "clean_telemetry": _CLEAN_TELEMETRY,
    "clean_results": _CLEAN_RESULTS,
    "telemetry_explode": _TELEMETRY_ROWS,
    "laps_explode": _LAP_ROWS,
    "drivers_explode": _DRIVER_ROWS,
    "path_segments": f"""SELECT page_id, {_SEGMENTS}
        FROM (SELECT page_id, string_split(url, '/') AS parts FROM pages) split_pages""",
    "csv_scan_roundtrip": _LAP_CSV,
    "seasons_csv_scan": f"""
        SELECT * EXCLUDE (odd) REPLACE (
            CASE WHEN odd THEN NULL ELSE team END AS team,
            CASE WHEN odd THEN NULL ELSE "pitOut" END AS "pitOut",
            CASE WHEN odd THEN NULL ELSE "tyreAgeLaps" END AS "tyreAgeLaps")
        FROM (SELECT *, CAST(right(event, 1) AS INT) % 2 = 1 AS odd FROM ({_LAP_CSV}) laps)""",
    "refreshed_sessions": """
        SELECT 'GP ' || year(l_shipdate) AS event,
            CASE WHEN l_linestatus = 'F' THEN 'Race' ELSE 'Practice 1' END AS session,
            count(*) AS laps,
            CAST(sum(CASE WHEN l_quantity > 2 THEN 1 + (dayofyear(l_shipdate) - 1) // 6
                + CASE WHEN year(l_shipdate) < 1994 THEN 1 ELSE 0 END END) AS BIGINT) AS lap_sum,
            CAST(sum(CASE l_quantity WHEN 32 THEN 0 WHEN 33 THEN NULL ELSE l_linenumber END)
                AS BIGINT) AS stint_sum
        FROM lineitem GROUP BY 1, 2""",
    "drivers_csv_roundtrip": """
        SELECT 'D' || s_suppkey AS "driverName", n_name AS team,
            CAST(s_suppkey AS VARCHAR) AS "driverNumber", s_name AS "firstName",
            CAST(s_nationkey AS VARCHAR) AS "lastName"
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "convert_telemetry_roundtrip": _TELEMETRY_FILES,
    "convert_laps_roundtrip": _LAP_FILES,
    "convert_drivers_roundtrip": _DRIVER_ROWS,
    "wear_report_from_files": _WEAR_FROM_FILES,
    "report_csv_roundtrip": f"""
        SELECT event, style, tyre_compound, CAST(optimal_median AS VARCHAR) AS optimal_median,
            CAST(degraded_median AS VARCHAR) AS degraded_median,
            CAST(pace_dropoff_s AS VARCHAR) AS pace_dropoff_s,
            CAST(optimal_count AS VARCHAR) AS optimal_count,
            CAST(degraded_count AS VARCHAR) AS degraded_count
        FROM ({_WEAR_REPORT}) report""",
    "json_scan": """
        SELECT 'event=Grand Prix ' || year(l_shipdate) AS event,
            'session=' || CASE WHEN l_linestatus = 'F' THEN 'Race' ELSE 'Practice 1' END
                AS session,
            l_orderkey || ',' || l_linenumber AS lap,
            'D' || l_suppkey || ',D' || l_suppkey AS drv,
            CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR) || ',None' AS time
        FROM lineitem""",
    "styled_laps_prototype": f"""WITH {_STYLED_PROTOTYPE}
        SELECT event, session, driver, lap, total_laps, compound, lap_time, tyre_age, pit_out,
            style FROM styled""",
    "top_laps": f"""WITH {_STYLED_PROTOTYPE}
        SELECT event, session, driver, style, lap_time, compound, tyre_age, lap, total_laps,
            pit_out
        FROM styled ORDER BY event DESC, session DESC, driver DESC, style DESC, lap_time DESC,
            compound DESC, tyre_age DESC, lap DESC, total_laps DESC, pit_out DESC LIMIT 50""",
    "top_groups": f"""WITH {_PROTOTYPE_MEDIANS}
        SELECT style, compound, state, median, count FROM medians
        ORDER BY style DESC, compound DESC, state DESC, median DESC, count DESC LIMIT 50""",
}
