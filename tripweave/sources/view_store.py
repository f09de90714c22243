"""Dated snapshots of batch views, one Parquet table per view partitioned by run date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.operators.views import duration_partials, summary_of_partials

PARTITION = "run_date"


def write_view(view: DataFrame, base: str, name: str, run_date: str) -> str:
    """Replace the snapshot of ``run_date`` and leave the other dates alone."""
    path = f"{base}/{name}"
    (
        view.withColumn(PARTITION, F.lit(int(run_date)))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION).parquet(path)
    )
    return path


def read_view(spark: SparkSession, base: str, name: str, run_date: str) -> DataFrame:
    """The snapshot of one date; empty if there is none."""
    table = spark.read.parquet(f"{base}/{name}")
    return table.filter(F.col(PARTITION) == int(run_date)).drop(PARTITION)


def read_latest_view(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The snapshot of the newest date. The date is found first and prunes the scan."""
    table = spark.read.parquet(f"{base}/{name}")
    newest = table.select(F.max(PARTITION)).scalar()
    return table.filter(F.col(PARTITION) == newest).drop(PARTITION)


def write_partials(clean: DataFrame, base: str, name: str = "duration_partials") -> str:
    """Replace the stored partials of the pickup days in ``clean`` and leave the other days alone.

    A day must come whole, as what is stored of it is replaced.
    """
    path = f"{base}/{name}"
    day = F.date_format("pickup_datetime", "yyyyMMdd").cast("int").alias("day")
    duration_partials(clean, day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    return path


def read_summary(spark: SparkSession, base: str, run_date: str, first: str | None = None, last: str | None = None,
                 name: str = "duration_partials") -> DataFrame:
    """The daily summary over the stored days, or those from ``first`` to ``last``; only their partials are read."""
    partials = spark.read.parquet(f"{base}/{name}")
    for bound, keep in ((first, lambda d, b: d >= b), (last, lambda d, b: d <= b)):
        if bound is not None:
            partials = partials.filter(keep(F.col("day"), int(bound)))
    return summary_of_partials(partials.drop("day"), run_date)
