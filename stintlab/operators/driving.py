"""Driving statistics from telemetry, and the style they point to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlab.functions.labels import driving_style, exceeds, falls_below
from stintlab.staging import settle

CHANNELS = ["acc_y", "brake", "rpm", "speed", "throttle"]
STATISTICS = ["acc_y", "brake", "rpm"]

# Fixed values of the rules.
TOP_SAMPLES = 5
FAST = 120
OPEN_THROTTLE = 35
LOWEST_ACC_Y = -30.0

# Width of the counting bins: some hundred bins over the accelerations of one driver.
BIN_WIDTH = 0.25


def _rpm_samples() -> Column:
    at_speed = exceeds(F.col("speed"), FAST) & exceeds(F.col("throttle"), OPEN_THROTTLE)
    return F.when(at_speed, F.col("rpm"))


def _bin() -> Column:
    # rint keeps the order of the values, infinities and NaN (last) included.
    return F.rint(F.col("acc_y") / F.lit(BIN_WIDTH))


def _binned(telemetry: DataFrame, keys: Sequence[str], *sums: Column) -> DataFrame:
    """Written counts of samples per key and bin of acceleration, with other sums over them."""
    return settle(
        telemetry.groupBy(*keys, _bin().alias("bin")).agg(F.count("acc_y").alias("rows"), *sums)
    )


def _top_mean(telemetry: DataFrame, bins: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Mean of the ``n`` largest accelerations per key, given the counts per bin.

    The bin of the n-th largest is at most the n-th from the top, so few bins per key are
    looked at. Only samples from there up are read again, and these are counted by value:
    samples themselves are neither sorted nor shuffled, even if all fall into one bin.
    """
    from_top = Window.partitionBy(*keys).orderBy(F.desc("bin"))
    earlier = from_top.rowsBetween(Window.unboundedPreceding, -1)
    few = (
        bins.filter(F.col("bin").isNotNull())
        .select(*keys, "bin", "rows")
        .withColumn("nth", F.row_number().over(from_top))
        .filter(F.col("nth") <= n)
        .withColumn("above", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    )
    lowest = few.filter(F.col("above") < n).groupBy(*keys).agg(F.min("bin").alias("lowest"))
    values = (
        telemetry.select(*keys, "acc_y")
        .join(lowest, list(keys))
        .filter(_bin() >= F.col("lowest"))
        .groupBy(*keys, "acc_y")
        .agg(F.count("*").alias("rows"))
    )
    largest = Window.partitionBy(*keys).orderBy(F.desc("acc_y"))
    before = F.coalesce(F.sum("rows").over(largest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = (
        values.withColumn("nth", F.row_number().over(largest))
        .filter(F.col("nth") <= n)
        .withColumn("taken", F.least(F.col("rows"), F.lit(n) - before))
        .filter(F.col("taken") > 0)
    )
    return taken.groupBy(*keys).agg(
        (F.sum(F.col("acc_y") * F.col("taken")) / F.sum("taken")).alias("acc_y")
    )


def top_acceleration(
    telemetry: DataFrame, keys: Sequence[str] = ("event", "driver"), n: int = TOP_SAMPLES
) -> DataFrame:
    """Mean of the ``n`` largest lateral accelerations per key, or of all if fewer.

    Samples are counted per bin before the shuffle, so a key with a third of all samples
    costs no more than any other. Keys without an acceleration are left out.
    """
    return _top_mean(telemetry, _binned(telemetry, keys), keys, n)


def driving_stats(telemetry: DataFrame) -> DataFrame:
    """Peak lateral acceleration, braking share and full-throttle rpm per event and driver.

    One pass counts accelerations per bin and adds up brakes and rpm beside them; the second
    reads the largest accelerations. Runs a job when called.
    """
    keys = ["event", "driver"]
    bins = _binned(
        telemetry, keys,
        F.sum("brake").alias("brake_sum"), F.count("brake").alias("brakes"),
        F.sum(_rpm_samples()).alias("rpm_sum"), F.count(_rpm_samples()).alias("rpms"),
    )
    means = bins.groupBy(*keys).agg(
        F.try_divide(F.sum("brake_sum"), F.sum("brakes")).alias("brake"),
        F.coalesce(F.try_divide(F.sum("rpm_sum"), F.sum("rpms")), F.lit(0.0)).alias("rpm"),
    )
    return _top_mean(telemetry, bins, keys, TOP_SAMPLES).join(means, keys)


def driving_stats_prototype(telemetry: DataFrame) -> DataFrame:
    """The prototype's statistics, per event, session and driver.

    The single largest acceleration, at least -30; without a full-throttle sample the rpm
    is the sum of the brake flags.
    """
    return telemetry.groupBy("event", "session", "driver").agg(
        F.greatest(F.max("acc_y"), F.lit(LOWEST_ACC_Y)).alias("acc_y"),
        F.avg("brake").alias("brake"),
        F.coalesce(F.avg(_rpm_samples()), F.sum("brake").cast("double")).alias("rpm"),
    )


def event_baselines(stats: DataFrame) -> DataFrame:
    """Unweighted mean over an event's drivers of each statistic."""
    return stats.groupBy("event").agg(*[F.avg(c).alias(c) for c in STATISTICS])


def _score(*attacking: Column) -> Column:
    total = F.lit(0)
    for condition in attacking:
        total = total + F.when(condition, 1).otherwise(0)
    return total


def styles_by_event(stats: DataFrame) -> DataFrame:
    """Style per event and driver, against the event's own baselines.

    Attacking means more lateral acceleration, **less** braking and more rpm than the
    mean; a driver alone in an event equals the mean and scores nothing.
    """
    base = event_baselines(stats).select(
        "event", *[F.col(c).alias(f"{c}_mean") for c in STATISTICS]
    )
    score = _score(
        exceeds(F.col("acc_y"), F.col("acc_y_mean")),
        falls_below(F.col("brake"), F.col("brake_mean")),
        exceeds(F.col("rpm"), F.col("rpm_mean")),
    )
    return stats.join(base, "event").select("event", "driver", driving_style(score).alias("style"))


def styles_prototype(stats: DataFrame) -> DataFrame:
    """Style per event, session and driver, against the means of the whole table.

    Here **more** braking counts as attacking. The means are scalar subqueries.
    """
    conditions = [
        exceeds(F.col(c), stats.select(F.avg(c)).scalar()) for c in STATISTICS
    ]
    return stats.select(
        "event", "session", "driver", driving_style(_score(*conditions)).alias("style")
    )
