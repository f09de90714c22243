"""The batch views. Inputs are trips with features; every group key has a small domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.trip import day_name, grid
from tripweave.operators.statistics import frequencies, weighted_stddev


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def hourly_stats_basic(trips: DataFrame) -> DataFrame:
    return trips.groupBy("hour").agg(
        F.avg("trip_duration").alias("avg_duration"),
        F.count("trip_duration").alias("trip_count"),
        F.avg("distance_km").alias("avg_distance"),
        F.avg("passenger_count").alias("avg_passengers"),
    )


def hourly_stats(clean: DataFrame) -> DataFrame:
    return clean.groupBy("hour").agg(
        F.avg("trip_duration").alias("avg_duration"),
        F.stddev_samp("trip_duration").alias("std_duration"),
        F.min("trip_duration").alias("min_duration"),
        F.max("trip_duration").alias("max_duration"),
        F.count("trip_duration").alias("trip_count"),
        F.avg("distance_km").alias("avg_distance"),
        F.stddev_samp("distance_km").alias("std_distance"),
        F.avg("passenger_count").alias("avg_passengers"),
        _total("passenger_count").alias("total_passengers"),
        F.avg("speed_kmh").alias("avg_speed"),
        F.max("is_rush_hour").alias("is_rush_hour"),
    )


def daily_summary_basic(trips: DataFrame, run_date: str) -> DataFrame:
    """One row over the whole input, dated by the run."""
    return trips.agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.avg("trip_duration").alias("avg_duration"),
        F.avg("distance_km").alias("avg_distance"),
        _total("passenger_count").alias("total_passengers"),
        F.avg("passenger_count").alias("avg_passengers"),
    ).select(F.lit(run_date).alias("date"), "*")


_SUMMED = ("distance_km", "passenger_count", "speed_kmh", "is_rush_hour", "is_weekend")


def duration_partials(clean: DataFrame, *keys: Column) -> DataFrame:
    """Per distinct duration (and key) the rows and sums that ``daily_summary`` needs.

    Partials of different rows can be stored apart and united in any order: median and deviation follow exactly from the counts,
    so a new day costs its own rows only. Cleaning bounds the durations to some 7,000 values.
    """
    known = clean.filter(F.col("trip_duration").isNotNull())
    return known.groupBy(*keys, "trip_duration").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"sum_{c}") for c in _SUMMED], *[F.count(c).alias(f"count_{c}") for c in _SUMMED[:3]])


def daily_summary(clean: DataFrame, run_date: str) -> DataFrame:
    """One row over the whole cleaned input, with exact median and deviation.

    Sums are first kept per distinct duration, so the final task sees a table of fixed size instead of one partial state
    per input task.
    """
    return summary_of_partials(duration_partials(clean), run_date)


def summary_of_partials(partials: DataFrame, run_date: str) -> DataFrame:
    """The same from partials, of one table or of many days united."""
    n = F.col("n")

    def mean(c: str) -> Column:
        return F.try_divide(F.sum(f"sum_{c}"), F.sum(f"count_{c}").cast("double"))

    # Days of one duration are summed first, which bounds what reaches the last task.
    per_duration = partials.groupBy("trip_duration").agg(*[F.sum(c).alias(c) for c in partials.columns if c == "n" or c.startswith(("sum_", "count_"))])
    return per_duration.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_trips"),
        F.try_divide(F.sum(F.col("trip_duration") * n).cast("double"), F.sum(n).cast("double")).alias("avg_duration"),
        F.percentile("trip_duration", F.lit(0.5), n).alias("median_duration"),
        weighted_stddev("trip_duration", "n").alias("std_duration"),
        mean("distance_km").alias("avg_distance"),
        F.coalesce(F.sum("sum_distance_km"), F.lit(0.0)).alias("total_distance"),
        _total("sum_passenger_count").alias("total_passengers"),
        mean("passenger_count").alias("avg_passengers"),
        mean("speed_kmh").alias("avg_speed"),
        _total("sum_is_rush_hour").alias("rush_hour_trips"),
        _total("sum_is_weekend").alias("weekend_trips"),
    ).select(F.lit(run_date).alias("date"), "*")


def vendor_stats_basic(trips: DataFrame) -> DataFrame:
    return trips.groupBy("vendor_id").agg(
        F.avg("trip_duration").alias("avg_duration"),
        F.avg("distance_km").alias("avg_distance"),
        F.count("id").alias("trip_count"),
    )


def vendor_stats(clean: DataFrame) -> DataFrame:
    return clean.groupBy("vendor_id").agg(
        F.avg("trip_duration").alias("avg_duration"),
        F.stddev_samp("trip_duration").alias("std_duration"),
        F.count("trip_duration").alias("trip_count"),
        F.avg("distance_km").alias("avg_distance"),
        F.avg("passenger_count").alias("avg_passengers"),
        _total("passenger_count").alias("total_passengers"),
        F.avg("speed_kmh").alias("avg_speed"),
    )


def geographic_stats(clean: DataFrame) -> DataFrame:
    """Trips per tenth-of-a-degree pickup cell."""
    cells = clean.withColumns({"lat": grid(F.col("pickup_latitude")), "lon": grid(F.col("pickup_longitude"))})
    return (
        cells.groupBy("lat", "lon")
        .agg(
            F.avg("trip_duration").alias("avg_duration"),
            F.count("trip_duration").alias("trip_count"),
            F.avg("distance_km").alias("avg_distance"),
            F.avg("passenger_count").alias("avg_passengers"),
        )
        .select(
            F.concat_ws(",", F.col("lat").cast("string"), F.col("lon").cast("string")).alias("zone"),
            "avg_duration", "trip_count", "avg_distance", "avg_passengers", "lat", "lon",
        )
    )


def temporal_patterns(clean: DataFrame) -> DataFrame:
    return (
        clean.groupBy("hour", "day_of_week")
        .agg(
            F.avg("trip_duration").alias("avg_duration"),
            F.count("trip_duration").alias("trip_count"),
            F.avg("distance_km").alias("avg_distance"),
            F.avg("speed_kmh").alias("avg_speed"),
        )
        .withColumn("day_name", day_name(F.col("day_of_week")))
    )
