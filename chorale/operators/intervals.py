"""Samples inside intervals: a band join by time bucket, and statistics of what lies inside."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def samples_in_intervals(intervals: DataFrame, samples: DataFrame, keys: list[str], width: float, start: str = "start", end: str = "end", at: str = "t") -> DataFrame:
    """Pairs of an interval and a sample with the same keys and ``f32(start) <= t <= f32(end)``.

    Each interval is listed under the buckets of ``width`` seconds that it touches and each sample under its own, so the
    join is an equi-join on keys and bucket; AQE splits crowded buckets.
    """
    low, high = F.col(start).cast("float"), F.col(end).cast("float")
    listed = intervals.where(low <= high).withColumn("__bucket", F.explode(F.sequence(F.floor(low / width), F.floor(high / width))))
    placed = samples.withColumn("__bucket", F.floor(F.col(at).cast("float") / width))
    inside = (F.col(at).cast("float") >= low) & (F.col(at).cast("float") <= high)
    return listed.join(placed, [*keys, "__bucket"]).where(inside).drop("__bucket")


def interval_stats(pairs: DataFrame, by: list[str], value: str, prefix: str) -> DataFrame:
    """Population mean and deviation of the values in each interval; fewer than three: 0 and 0."""
    enough = F.count(value) >= 3
    return pairs.groupBy(*by).agg(
        F.when(enough, F.avg(F.col(value).cast("double"))).otherwise(F.lit(0.0)).alias(f"{prefix}_mean"),
        F.when(enough, F.stddev_pop(F.col(value).cast("double"))).otherwise(F.lit(0.0)).alias(f"{prefix}_std"),
        F.count(value).alias(f"{prefix}_n"),
    )


def oscillation_rate(pairs: DataFrame, by: list[str], value: str, order: list[str], duration: str) -> DataFrame:
    """Sum of absolute changes between consecutive samples inside, per second; up to two samples: 0."""
    window = Window.partitionBy(*by).orderBy(*order)
    steps = pairs.withColumn("__step", F.abs(F.col(value) - F.lag(value).over(window)).cast("double"))
    rate = F.coalesce(F.sum("__step"), F.lit(0.0)) / F.greatest(F.max(duration), F.lit(1e-6))
    return steps.groupBy(*by).agg(F.when(F.count(value) > 2, rate).otherwise(F.lit(0.0)).alias("rate"))


def interval_profile(pairs: DataFrame, by: list[str], value: str, flag: str, order: list[str], duration: str) -> DataFrame:
    """``interval_stats`` of the value (spd_mean, spd_std) and the mean of the flag (open_mean), and its ``oscillation_rate`` (rate), in one pass."""
    window = Window.partitionBy(*by).orderBy(*order)
    stepped = pairs.withColumn("__step", F.abs(F.col(flag) - F.lag(flag).over(window)).cast("double"))
    zero = F.lit(0.0)
    enough = lambda c: F.count(c) >= 3
    return stepped.groupBy(*by).agg(
        F.when(enough(value), F.avg(F.col(value).cast("double"))).otherwise(zero).alias("spd_mean"),
        F.when(enough(value), F.stddev_pop(F.col(value).cast("double"))).otherwise(zero).alias("spd_std"),
        F.when(enough(flag), F.avg(F.col(flag).cast("double"))).otherwise(zero).alias("open_mean"),
        F.when(enough(flag), F.coalesce(F.sum("__step"), zero) / F.greatest(F.max(duration), F.lit(1e-6))).otherwise(zero).alias("rate"),
    )
