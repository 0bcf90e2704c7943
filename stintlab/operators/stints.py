"""Race totals and stint structure per event and driver.

Laps are first reduced to one row per (event, driver, stint, compound) with numeric
partial sums, so they combine before the shuffle however many laps one driver has, and
everything after that works on a few rows per driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlab.functions.labels import exceeds

DRIVER_KEY = ["event", "driver"]

# Seconds: ordinary lap times all lie in the first such span.
SPAN = 1024


def ratio(total: Column, count: Column) -> Column:
    """Mean as double from a sum of any numeric type, NULL for no rows."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def race_totals(laps: DataFrame) -> DataFrame:
    """Total time and last lap number per event and driver, where the total is positive.

    Drivers who retired have few laps, hence a small total, and are kept.
    """
    totals = laps.groupBy(*DRIVER_KEY).agg(
        F.sum("lap_time").alias("total_time"), F.max("lap").alias("last_lap")
    )
    return totals.filter(exceeds(F.col("total_time"), 0))


def stint_parts(laps: DataFrame, *more_keys: str) -> DataFrame:
    """Partial sums per (event, driver, stint, compound) and further keys."""
    keys = [*DRIVER_KEY, "stint", "compound", *more_keys]
    spread = [F.var_pop("above_span").alias("variance"), F.sum("above_span").alias("above_sum")]
    return laps.groupBy(*keys).agg(
        F.count("*").alias("laps"),
        F.sum("lap_time").alias("time_sum"),
        F.min("lap").alias("first_lap"),
        *(spread if "span" in more_keys else []),
    )


def _in_spans(laps: DataFrame) -> DataFrame:
    """Add the start of the span of SPAN seconds that a lap time lies in, and its distance
    from there, both exact."""
    time = F.col("lap_time").cast("double")
    above = F.pmod(time, F.lit(float(SPAN)))
    return laps.withColumns({"above_span": above, "span": time - above})


def _squared_deviations(parts: DataFrame) -> DataFrame:
    """Add ``deviations``: the sum of the squared distances of a part's lap times from the mean
    of all the driver's laps.

    Each part brings its own variance, to which the distance of its mean from the driver's is
    added. Both are taken from the start of the driver's first span, so no digits are
    lost where times are large and close, as they are in a mean of squares less a squared mean.
    One row per part is moved, to where the next step needs it.
    """
    driver = Window.partitionBy(*DRIVER_KEY)
    start = F.col("span") - F.min("span").over(driver)
    placed = parts.withColumn("placed_sum", F.col("above_sum") + F.col("laps") * start)
    mean = ratio(F.sum("placed_sum").over(driver), F.sum("laps").over(driver))
    offset = ratio(F.col("placed_sum"), F.col("laps")) - mean
    return placed.withColumn("deviations", F.col("laps") * (F.col("variance") + offset * offset))


def stint_summary(laps: DataFrame) -> DataFrame:
    """Compound and lap count per stint. Stint numbers below 1 are no stints.

    A stint with more than one compound is given the one of its first lap (the
    alphabetically first if that lap has several).
    """
    parts = stint_parts(laps.filter(F.col("stint") > 0))
    return parts.groupBy(*DRIVER_KEY, "stint").agg(
        F.min_by("compound", F.struct("first_lap", "compound")).alias("compound"),
        F.sum("laps").alias("laps"),
    )


def strategy_profile(laps: DataFrame) -> DataFrame:
    """Stint structure and lap-time statistics per event and driver.

    Columns: num_stints, avg_lap, lap_variance (population), avg_stint_length (NULL
    without a stint), compounds (in stint order), total_time.
    """
    in_stint = F.col("stint") > 0
    stint_part = F.when(in_stint, F.struct("stint", "first_lap", "compound"))
    drivers = (
        _squared_deviations(stint_parts(_in_spans(laps), "span"))
        .groupBy(*DRIVER_KEY)
        .agg(
            F.sum("laps").alias("laps"),
            F.sum("time_sum").alias("total_time"),
            F.sum("deviations").alias("deviations"),
            F.sum(F.when(in_stint, F.col("laps")).otherwise(0)).alias("stint_laps"),
            # An element per stint and compound (and span), which is the size of the answer.
            F.sort_array(F.collect_list(stint_part)).alias("parts"),
        )
    )

    def opens_stint(part: Column, i: Column) -> Column:
        before = F.get(F.col("parts"), i - 1)["stint"]
        return before.isNull() | (before != part["stint"])

    stints = drivers.withColumn("parts", F.filter("parts", opens_stint))
    avg_lap = ratio(F.col("total_time"), F.col("laps"))
    return stints.select(
        *DRIVER_KEY,
        F.size("parts").alias("num_stints"),
        avg_lap.alias("avg_lap"),
        ratio(F.col("deviations"), F.col("laps")).alias("lap_variance"),
        ratio(F.col("stint_laps"), F.size("parts")).alias("avg_stint_length"),
        F.transform("parts", lambda part: part["compound"]).alias("compounds"),
        "total_time",
    )
