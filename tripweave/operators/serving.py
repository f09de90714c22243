"""Serving queries over speed rows and batch views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave import settings as S
from tripweave.functions.rows import side_by_side
from tripweave.functions.trip import vendor_label
from tripweave.operators.filters import within_map
from tripweave.operators.quality import value_counts
from tripweave.schemas import select_present

LATEST_COLUMNS = [
    "id", "pickup_datetime", "passenger_count", "distance_km",
    "trip_duration", "predicted_duration", "prediction_error",
]


def speed_kpis(speed: DataFrame) -> DataFrame:
    """Trips, mean kilometres, mean minutes and mean absolute prediction error."""
    return speed.agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.avg("distance_km").alias("avg_distance_km"),
        (F.avg("trip_duration") / F.lit(60.0)).alias("avg_duration_min"),
        F.avg("prediction_error").alias("prediction_mae"),
    )


def prediction_accuracy(speed: DataFrame) -> DataFrame:
    """Share of predictions within one and five minutes, of those that have an error."""
    err = F.abs("prediction_error")
    within = [
        F.avg(F.when(err <= seconds, 100.0).otherwise(0.0)).alias(f"w{seconds}") for seconds in (60, 300)
    ]
    return speed.filter(err.isNotNull()).agg(*within).select(F.inline(F.array(
        F.struct(F.lit("Within 1 min").alias("threshold"), F.col("w60").alias("accuracy_pct")),
        F.struct(F.lit("Within 5 min").alias("threshold"), F.col("w300").alias("accuracy_pct")),
    )))


def trips_by(speed: DataFrame, key: str) -> DataFrame:
    return value_counts(speed, key)


def vendor_performance(speed: DataFrame) -> DataFrame:
    """Mean duration and distance per vendor, two decimals, with display labels."""
    return (
        speed.filter(F.col("vendor_id").isNotNull())
        .groupBy("vendor_id")
        .agg(F.avg("trip_duration").alias("d"), F.avg("distance_km").alias("k"))
        .select(
            vendor_label(F.col("vendor_id")).alias("vendor"),
            F.round(F.round("d", 6), 2).alias("avg_duration_s"),
            F.round(F.round("k", 6), 2).alias("avg_distance_km"),
        )
    )


def scatter_sample(speed: DataFrame, order: list[str], n: int = S.SCATTER_LIMIT) -> DataFrame:
    """The first ``n`` pairs of actual and predicted duration that are both known."""
    return (
        speed.dropna(subset=["trip_duration", "predicted_duration"])
        .orderBy(*order).limit(n)
        .select("trip_duration", "predicted_duration")
    )


def latest_trips(speed: DataFrame, n: int = S.LATEST_TRIPS) -> DataFrame:
    """The ``n`` most recently processed trips."""
    newest = speed.orderBy(F.col("processed_time").desc(), F.col("id")).limit(n)
    return select_present(newest, LATEST_COLUMNS)


def pickup_map_points(speed: DataFrame) -> DataFrame:
    points = speed.select(F.col("pickup_latitude").alias("lat"), F.col("pickup_longitude").alias("lon"))
    return within_map(points)


def _speed_summary(speed: DataFrame) -> DataFrame:
    return speed.agg(
        F.count(F.lit(1)).alias("speed_records"),
        F.avg("distance_km").alias("speed_avg_distance"),
        F.avg("trip_duration").alias("speed_avg_duration"),
        F.avg("predicted_duration").alias("speed_avg_predicted"),
    )


def _both(speed: DataFrame, daily: DataFrame) -> DataFrame:
    """One row with the summaries of both layers as structs ``s`` and ``b``."""
    return side_by_side({"s": _speed_summary(speed), "b": daily})


def combined_view(speed: DataFrame, daily: DataFrame) -> DataFrame:
    """One row with both layers' headline figures; ``daily`` is the daily summary, or nothing."""
    return _both(speed, daily).select(
        "s.speed_records", "s.speed_avg_distance", "s.speed_avg_predicted",
        F.col("b.total_trips").alias("batch_records"),
        F.col("b.avg_distance").alias("batch_avg_distance"),
        F.col("b.avg_duration").alias("batch_avg_duration"),
    )


def layer_comparison(speed: DataFrame, daily: DataFrame) -> DataFrame:
    """(metric, speed_layer, batch_layer)."""
    lines = [
        ("Avg Distance (km)", "s.speed_avg_distance", "b.avg_distance"),
        ("Avg Duration (sec)", "s.speed_avg_duration", "b.avg_duration"),
    ]
    return _both(speed, daily).select(F.inline(F.array(*[
        F.struct(F.lit(label).alias("metric"), F.col(live).alias("speed_layer"), F.col(batch).alias("batch_layer"))
        for label, live, batch in lines
    ])))


def reconcile_layers(
    daily: DataFrame, speed: DataFrame, run_date: str, max_diff_pct: float = S.RECONCILE_MAX_DIFF_PCT
) -> DataFrame:
    """Compare mean durations of both layers; one row, whichever side is missing.

    ``daily`` holds the summary of ``run_date`` or nothing. A speed row without a duration counts as 0.
    """
    batch = daily.select("total_trips", "avg_duration")
    live = speed.agg(
        F.count(F.lit(1)).alias("speed_records"),
        F.avg(F.coalesce(F.col("trip_duration"), F.lit(0))).alias("speed_avg_duration"),
    )
    b, s = F.col("b.avg_duration"), F.col("s.speed_avg_duration")
    diff = F.try_divide(F.abs(b - s), b) * F.lit(100.0)
    over = F.col("diff_pct") > max_diff_pct
    return (
        side_by_side({"b": batch, "s": live})
        .select(
            F.lit(run_date).alias("date"), F.col("b.total_trips").alias("batch_trips"),
            b.alias("batch_avg_duration"), "s.speed_records", s.alias("speed_avg_duration"), diff.alias("diff_pct"),
        )
        .withColumn(
            "status",
            F.when(F.col("diff_pct").isNull(), "incomplete_data")
            .when(over, "discrepancy_detected").otherwise("consistent"),
        )
        .withColumn(
            "discrepancies",
            F.when(over, F.format_string("Mean durations are apart by %.2f%%", F.col("diff_pct"))).otherwise(""),
        )
    )
