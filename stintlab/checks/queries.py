"""The registered queries: each operator and report over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlab.checks import proxies
from stintlab import schemas
from stintlab.functions.labels import pit_strategy, wear_state
from stintlab.functions.text import path_segment
from stintlab.functions.timing import fuel_corrected
from stintlab.operators.driving import (
    driving_stats,
    driving_stats_prototype,
    event_baselines,
    styles_prototype,
)
from stintlab.operators.filters import (
    representative_laps,
    timed_race_laps,
    valid_telemetry,
    worn_laps,
)
from stintlab.operators.medians import upper_medians
from stintlab.operators.ranking import race_positions, top_rows
from stintlab.operators.reshape import driver_rows, lap_rows, telemetry_rows
from stintlab.operators.stints import race_totals, stint_summary, strategy_profile
from stintlab.operators.wear import paced_laps, with_style, with_tyre_state
from stintlab.plans.convert import convert_drivers, convert_laps, convert_telemetry
from stintlab.plans.strategy import all_teams, one_team_per_driver, pit_strategy_report
from stintlab.plans.wear import (
    OUTPUT_ORDER,
    driver_styles,
    prototype_medians,
    prototype_styles,
    wear_report,
    wear_report_prototype,
)
from stintlab.sinks import write_csv
from stintlab.sources.cleaning import (
    clean_results,
    clean_stint_laps,
    clean_telemetry,
    clean_wear_laps,
    telemetry_of,
    typed_laps,
    typed_telemetry,
    wear_laps_of,
)
from stintlab.sources.documents import read_documents
from stintlab.sources.tables import read_drivers, read_laps, read_table, read_telemetry
from stintlab.sources.typed import read_typed_laps, read_typed_telemetry, write_typed
from stintlab.staging import new_path, settle

DRIVER = ["event", "driver"]
LAP_VALUES = ["compound", "lap", "tyre_age"]


def _strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pit_strategy_report(proxies.stint_laps(spark, sf_dir), proxies.drivers(spark, sf_dir))


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = strategy_profile(timed_race_laps(proxies.stint_laps(spark, sf_dir)))
    return profile.select(
        *DRIVER,
        "num_stints",
        "avg_lap",
        F.round("lap_variance", 2).alias("lap_variance"),
        "avg_stint_length",
        F.array_join("compounds", ">").alias("compounds"),
    )


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return race_totals(timed_race_laps(proxies.stint_laps(spark, sf_dir)))


def _as_double(df: DataFrame) -> DataFrame:
    return df.withColumn("total_time", F.col("total_time").cast("double"))


def _race_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(_totals(spark, sf_dir))


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(race_positions(_totals(spark, sf_dir))).drop("last_lap")


def _stints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stint_summary(timed_race_laps(proxies.stint_laps(spark, sf_dir)))


def _strategy_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = strategy_profile(timed_race_laps(proxies.stint_laps(spark, sf_dir)))
    return profile.select(
        *DRIVER,
        F.size(F.array_distinct("compounds")).alias("distinct_compounds"),
        pit_strategy(F.col("compounds"), F.col("avg_stint_length")).alias("strategy"),
    )


def _driver_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Race totals with team: drivers listed twice count once, unknown ones vanish."""
    listed = proxies.drivers(spark, sf_dir)
    second = listed.filter("driverNumber < '5'").withColumn("team", F.lit("NATION_0"))
    teams = one_team_per_driver(listed.unionByName(second))
    return _race_totals(spark, sf_dir).join(teams, "driver")


def _driver_teams_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, with the later of two entries, here that of another team's name before it."""
    listed = proxies.drivers(spark, sf_dir).withColumn("entered", F.lit(1))
    later = listed.filter("driverNumber < '5'").withColumns(
        {"team": F.concat(F.lit("EARLY "), "team"), "entered": F.lit(2)}
    )
    teams = one_team_per_driver(listed.unionByName(later), order_by="entered")
    return _race_totals(spark, sf_dir).join(teams, "driver")


def _driver_teams_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, but one row per entry of the driver table."""
    listed = proxies.drivers(spark, sf_dir)
    second = listed.filter("driverNumber < '5'").withColumn("team", F.lit("NATION_0"))
    return _race_totals(spark, sf_dir).join(all_teams(listed.unionByName(second)), "driver")


def _driving_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driving_stats(valid_telemetry(proxies.telemetry(spark, sf_dir)))


def _event_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = event_baselines(_driving_stats(spark, sf_dir))
    return means.select("event", *[F.round(c, 6).alias(c) for c in ["acc_y", "brake", "rpm"]])


def _driving_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_styles(proxies.telemetry(spark, sf_dir))


def _driving_stats_prototype(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driving_stats_prototype(
        valid_telemetry(proxies.telemetry(spark, sf_dir), race_only=False)
    )


def _driving_style_prototype(spark: SparkSession, sf_dir: str) -> DataFrame:
    return styles_prototype(settle(_driving_stats_prototype(spark, sf_dir)))


def _tyre_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    laps = with_tyre_state(worn_laps(proxies.wear_laps(spark, sf_dir)))
    return laps.select(*DRIVER, *LAP_VALUES, "state")


def _tyre_states_prototype(spark: SparkSession, sf_dir: str) -> DataFrame:
    laps = with_tyre_state(worn_laps(proxies.wear_laps(spark, sf_dir), False), warm_up=False)
    return laps.select(*DRIVER, *LAP_VALUES, "state")


def _fuel_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    laps = representative_laps(worn_laps(proxies.wear_laps(spark, sf_dir)))
    args = F.col("lap_time"), F.col("lap"), F.col("total_laps")
    return laps.select(
        *DRIVER,
        "lap",
        wear_state(F.col("compound"), F.col("lap"), F.col("tyre_age")).alias("state"),
        fuel_corrected(*args).alias("pace"),
        fuel_corrected(*args, add=True).alias("prototype_pace"),
    )


def _styled_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    styles = settle(driver_styles(proxies.telemetry(spark, sf_dir)))
    laps = paced_laps(worn_laps(proxies.wear_laps(spark, sf_dir)), DRIVER)
    return with_style(laps, styles, DRIVER)


def _state_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    laps = paced_laps(worn_laps(proxies.wear_laps(spark, sf_dir)), ["event"])
    medians = upper_medians(laps, ["event", "compound", "state"], "pace")
    return medians.withColumn("mean", F.round("mean", 4))


def _state_medians_prototype(spark: SparkSession, sf_dir: str) -> DataFrame:
    medians = prototype_medians(
        proxies.telemetry(spark, sf_dir), proxies.wear_laps(spark, sf_dir)
    )
    return medians.withColumn("mean", F.round("mean", 4))


def _wear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wear_report(proxies.telemetry(spark, sf_dir), proxies.wear_laps(spark, sf_dir))


def _wear_prototype(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wear_report_prototype(
        proxies.telemetry(spark, sf_dir), proxies.wear_laps(spark, sf_dir)
    )


def _clean_stint_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_stint_laps(proxies.lap_text(spark, sf_dir))


def _lap_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lap text written to CSV files and read back, NULL filling the columns not written."""
    laps = proxies.lap_text(spark, sf_dir)
    path = new_path(spark)
    write_csv(laps, path)
    return read_laps(spark, path, present=laps.columns)


def _seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lap text in files of two layouts, read as one table."""
    return read_laps(spark, proxies.season_files(spark, sf_dir, new_path(spark)), layouts=True)


def _refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed laps written in two goes, the second of which adds sessions and rewrites some."""
    laps = typed_laps(proxies.lap_text(spark, sf_dir))
    path = new_path(spark)
    stale = laps.filter("event < 'GP 1996'").withColumn("lap", F.col("lap") + 1)
    write_typed(stale, path, "refresh")
    write_typed(laps.filter("event >= 'GP 1994'"), path, "refresh")
    kept = read_typed_laps(spark, path)
    return kept.groupBy("event", "session").agg(
        F.count("*").alias("laps"), F.sum("lap").alias("lap_sum"), F.sum("stint").alias("stint_sum")
    )


def _timed_race_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed_race_laps(clean_stint_laps(_lap_file(spark, sf_dir)))


def _clean_wear_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_wear_laps(proxies.lap_text(spark, sf_dir))


def _worn_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worn_laps(clean_wear_laps(_lap_file(spark, sf_dir)))


def _clean_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_telemetry(clean_telemetry(proxies.telemetry_text(spark, sf_dir)))


def _clean_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_results(proxies.result_text(spark, sf_dir))


def _telemetry_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_rows(proxies.telemetry_docs(spark, sf_dir))


def _laps_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lap_rows(proxies.lap_docs(spark, sf_dir))


def _drivers_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_rows(proxies.driver_docs(spark, sf_dir))


def _path_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = proxies.table(spark, sf_dir, "pages").select("page_id", F.split("url", "/").alias("u"))
    return pages.select(
        "page_id", *[path_segment("u", -i).alias(f"segment_{i}") for i in range(1, 6)]
    )


def _drivers_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark)
    write_csv(proxies.all_drivers(spark, sf_dir), path)
    return read_drivers(spark, path)


def _converted_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry documents to files, to a text table and back."""
    source, target = proxies.telemetry_files(spark, sf_dir, new_path(spark)), new_path(spark)
    convert_telemetry(spark, source, target, compression="gzip")
    return read_telemetry(spark, target)


def _converted_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lap documents to files, to a text table and back."""
    source, target = proxies.lap_files(spark, sf_dir, new_path(spark)), new_path(spark)
    convert_laps(spark, source, target, compression="gzip")
    return read_laps(spark, target)


def _converted_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver lists to files, to a text table and back."""
    source, target = proxies.driver_files(spark, sf_dir, new_path(spark)), new_path(spark)
    convert_drivers(spark, source, target, compression="gzip")
    return read_drivers(spark, target)


def _wear_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry and laps from text files to typed tables, and the wear report over them."""
    text = proxies.telemetry_text(spark, sf_dir)
    keys = {c: F.lit(None).cast("string") for c in ("year", "lapNumber")}
    csv, typed = new_path(spark), new_path(spark)
    write_csv(text.withColumns(keys), csv)
    write_typed(typed_telemetry(read_telemetry(spark, csv)), typed)
    typed_lap_path = new_path(spark)
    write_typed(typed_laps(_lap_file(spark, sf_dir)), typed_lap_path)
    return wear_report(
        telemetry_of(read_typed_telemetry(spark, typed)),
        wear_laps_of(read_typed_laps(spark, typed_lap_path)),
    )


def _report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wear report as one sorted CSV file, read back as text."""
    report = _wear(spark, sf_dir)
    path = new_path(spark)
    write_csv(report, path, mode="overwrite", order_by=OUTPUT_ORDER, single_file=True)
    return read_table(spark, path, report.columns)


def _json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lap documents written under event and session folders, read back by path."""
    path = new_path(spark)
    proxies.lap_lines(spark, sf_dir).write.partitionBy("event", "session").json(path)
    docs = read_documents(
        spark,
        f"{path}/*/*/*.json",
        schemas.lap_document(["lap", "drv", "time"]),
        multi_line=False,
        with_path=True,
    )
    return docs.select(
        path_segment("full_file_uri", -3).alias("event"),
        path_segment("full_file_uri", -2).alias("session"),
        F.array_join("lap", ",").alias("lap"),
        F.array_join("drv", ",").alias("drv"),
        F.array_join("time", ",").alias("time"),
    )


def _styled_laps_prototype(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sessions' laps joined with their drivers' styles on three keys."""
    styles = settle(prototype_styles(proxies.telemetry(spark, sf_dir)))
    laps = worn_laps(proxies.wear_laps(spark, sf_dir), race_only=False)
    return with_style(laps, styles, ["event", "session", "driver"])


def _top_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    laps = _styled_laps_prototype(spark, sf_dir)
    columns = ["event", "session", "driver", "style", "lap_time", "compound", "tyre_age", "lap",
               "total_laps", "pit_out"]
    return top_rows(laps.select(columns), columns)


def _top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["style", "compound", "state", "median", "count"]
    return top_rows(_state_medians_prototype(spark, sf_dir).select(columns), columns)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pit_strategy_report": _strategy,
    "strategy_profile": _profile,
    "race_totals": _race_totals,
    "race_positions": _positions,
    "race_positions_by_range": _positions,
    "stint_summary": _stints,
    "strategy_labels": _strategy_labels,
    "driver_team_lookup": _driver_teams,
    "driver_team_lookup_all": _driver_teams_all,
    "driver_team_lookup_latest": _driver_teams_latest,
    "driving_stats": _driving_stats,
    "event_baselines": _event_baselines,
    "driving_style": _driving_style,
    "driving_stats_prototype": _driving_stats_prototype,
    "driving_style_prototype": _driving_style_prototype,
    "tyre_state_laps": _tyre_states,
    "tyre_state_prototype": _tyre_states_prototype,
    "fuel_corrected_laps": _fuel_corrected,
    "styled_laps": _styled_laps,
    "state_medians": _state_medians,
    "state_medians_prototype": _state_medians_prototype,
    "wear_report": _wear,
    "wear_report_prototype": _wear_prototype,
    "clean_stint_laps": _clean_stint_laps,
    "timed_race_laps": _timed_race_laps,
    "clean_wear_laps": _clean_wear_laps,
    "worn_laps": _worn_laps,
    "clean_telemetry": _clean_telemetry,
    "clean_results": _clean_results,
    "telemetry_explode": _telemetry_explode,
    "laps_explode": _laps_explode,
    "drivers_explode": _drivers_explode,
    "path_segments": _path_segments,
    "csv_scan_roundtrip": _lap_file,
    "seasons_csv_scan": _seasons,
    "refreshed_sessions": _refreshed,
    "drivers_csv_roundtrip": _drivers_csv_roundtrip,
    "report_csv_roundtrip": _report_csv,
    "convert_telemetry_roundtrip": _converted_telemetry,
    "convert_laps_roundtrip": _converted_laps,
    "convert_drivers_roundtrip": _converted_drivers,
    "wear_report_from_files": _wear_from_files,
    "json_scan": _json_scan,
    "styled_laps_prototype": _styled_laps_prototype,
    "top_laps": _top_laps,
    "top_groups": _top_groups,
}
