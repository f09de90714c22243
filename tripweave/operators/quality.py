"""Validation, profile, anomalies and the quality gate.

``raw_facts`` gathers every raw-table figure in one scan; the reports are projections of that row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tripweave import settings as S
from tripweave.operators.filters import is_clean
from tripweave.operators.statistics import frequencies, frequency_median
from tripweave.schemas import REQUIRED_COLUMNS


COORDINATES = ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")


def _holds(condition: Column) -> Column:
    """Count of rows where the condition is true; null counts as false."""
    return F.count(F.when(condition, 1))


def known(column: str) -> Column:
    """The column, its coordinates with NaN as null: a coordinate that is not a number is missing, not out of bounds."""
    return F.nanvl(column, F.lit(None).cast("double")) if column in COORDINATES else F.col(column)


def geo_anomaly() -> Column:
    lat, lon = known("pickup_latitude"), known("pickup_longitude")
    return (lat < S.LAT_MIN) | (lat > S.LAT_MAX) | (lon < S.LON_MIN) | (lon > S.LON_MAX)


def duration_anomaly() -> Column:
    d = F.col("trip_duration")
    return (d < S.MIN_DURATION_S) | (d > S.MAX_ANOMALY_DURATION_S)


def passenger_anomaly() -> Column:
    p = F.col("passenger_count")
    return (p < 0) | (p > S.MAX_PASSENGERS)


def _fact_columns() -> list[Column]:
    masks = [geo_anomaly(), duration_anomaly(), passenger_anomaly()]
    either = reduce(lambda a, b: a | b, [F.coalesce(m, F.lit(False)) for m in masks])
    return [
        F.count(F.lit(1)).alias("row_count"),
        *[_holds(known(c).isNull()).alias(f"nulls_{c}") for c in REQUIRED_COLUMNS],
        _holds(masks[0]).alias("geographic_anomalies"),
        _holds(masks[1]).alias("duration_anomalies"),
        _holds(masks[2]).alias("passenger_anomalies"),
        _holds(either).alias("total_anomalies"),
        _holds(is_clean()).alias("clean_count"),
    ]


def raw_facts(trips: DataFrame) -> DataFrame:
    """One row: size, nulls per required column, anomaly counts and the number of clean rows."""
    return trips.agg(*_fact_columns())


class ObservedFacts:
    """The row of ``raw_facts``, gathered by whichever job reads the trips first, such as the one that stores them.

    ``trips`` must be used in place of the frame; a filter behind it does not change the facts, as they are taken where it stands.
    """

    def __init__(self, trips: DataFrame):
        self._seen = Observation()
        self._schema = raw_facts(trips).schema
        self._spark = trips.sparkSession
        self.trips = trips.observe(self._seen, *_fact_columns())

    def frame(self) -> DataFrame:
        """One row, once a job over ``trips`` has ended; it waits for that job."""
        return self._spark.createDataFrame([tuple(self._seen.get[c] for c in self._schema.names)], self._schema)


def _null_pct(column: str) -> Column:
    share = F.try_divide(F.col(f"nulls_{column}").cast("double"), F.col("row_count").cast("double"))
    return F.rint(share * F.lit(100.0) * F.lit(100.0)) / F.lit(100.0)


def null_percentages(facts: DataFrame) -> DataFrame:
    """(column_name, null_pct) for each required column."""
    pairs = [F.struct(F.lit(c).alias("column_name"), _null_pct(c).alias("null_pct")) for c in REQUIRED_COLUMNS]
    return facts.select(F.inline(F.array(*pairs)))


def _score() -> Column:
    total = reduce(lambda a, b: a + b, [F.coalesce(_null_pct(c), F.lit(0.0)) for c in REQUIRED_COLUMNS])
    return F.greatest(F.lit(0.0), F.lit(1.0) - total / F.lit(len(REQUIRED_COLUMNS) * 100.0))


def _anomaly_share() -> Column:
    share = F.try_divide(F.col("total_anomalies").cast("double"), F.col("row_count").cast("double"))
    return F.coalesce(share * F.lit(100.0), F.lit(0.0))


def quality_score(facts: DataFrame) -> DataFrame:
    """(row_count, quality_score)."""
    return facts.select("row_count", _score().alias("quality_score"))


def checked(facts: DataFrame) -> DataFrame:
    """One row with what the run report says of validation, anomalies and cleaning."""
    return facts.select(
        "row_count", _score().alias("quality_score"), _anomaly_share().alias("anomaly_percentage"), "clean_count"
    )


def quality_gate(facts: DataFrame, threshold: float = S.QUALITY_THRESHOLD) -> DataFrame:
    return quality_score(facts).withColumn("passed", F.col("quality_score") >= threshold)


def anomaly_counts(facts: DataFrame) -> DataFrame:
    """Counts per kind; the total counts a row once even if several kinds apply."""
    return facts.select(
        "geographic_anomalies", "duration_anomalies", "passenger_anomalies", "total_anomalies",
        _anomaly_share().alias("anomaly_percentage"),
    )


def data_profile(trips: DataFrame) -> DataFrame:
    """One row of table size, date range and duration statistics.

    The plain figures need one partial row per task. The exact median scans the duration column
    alone and counts its distinct values first.
    """
    d = F.col("trip_duration")
    outside = (d < S.MIN_DURATION_S) | (d > S.MAX_DURATION_S)
    rows = F.count(F.lit(1)).cast("double")
    plain = trips.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min("pickup_datetime").alias("min_pickup"),
        F.max("pickup_datetime").alias("max_pickup"),
        F.avg(d).alias("mean_duration"),
        F.stddev_samp(d).alias("std_duration"),
        F.min(d).alias("min_duration"),
        F.max(d).alias("max_duration"),
        F.try_divide(_holds(outside).cast("double") * 100.0, rows).alias("outliers_pct"),
    )
    middle = frequency_median(frequencies(trips, "trip_duration"), "trip_duration", out="median_duration")
    return plain.withColumn("median_duration", middle.scalar())


def data_distributions(trips: DataFrame) -> DataFrame:
    """(dimension, key, count) for vendor, passengers and hour.

    Counted once on all three keys together, then summed per dimension from that small table.
    """
    cube = trips.groupBy(
        F.col("vendor_id"), F.col("passenger_count"), F.hour("pickup_datetime").alias("hour")
    ).agg(F.count(F.lit(1)).alias("n"))
    parts = [
        F.struct(F.lit(label).alias("dimension"), F.col(c).cast("long").alias("key"))
        for label, c in (("vendor", "vendor_id"), ("passenger", "passenger_count"), ("hour", "hour"))
    ]
    return (
        cube.select("n", F.inline(F.array(*parts)))
        .filter(F.col("key").isNotNull())
        .groupBy("dimension", "key")
        .agg(F.sum("n").alias("count"))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(column, count) ordered by the key; nulls are not counted."""
    return frequencies(df, column, count="count").orderBy(column)


def missing_column_report(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """(column_name, rows_affected) for every required column the frame lacks."""
    absent = [F.lit(c) for c in (required or REQUIRED_COLUMNS) if c not in df.columns]
    names = F.array(*absent) if absent else F.array().cast("array<string>")
    return df.agg(F.count(F.lit(1)).alias("rows_affected")).select(
        F.explode(names).alias("column_name"), "rows_affected"
    )
