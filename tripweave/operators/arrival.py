"""Figures that depend on the order in which rows arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave import settings as S
from tripweave.operators.positions import with_positions


def count_batches(rows: DataFrame, order: list[str], size: int = S.CONSUMER_BATCH) -> DataFrame:
    """Number consecutive groups of ``size`` arrivals; the last group may be short."""
    placed = with_positions(rows, order, "_at")
    return placed.withColumn("batch_id", F.floor(F.col("_at") / F.lit(float(size)))).drop("_at")


def running_error(scored: DataFrame, order: list[str]) -> DataFrame:
    """Mean prediction error over all arrivals so far; an arrival without a prediction adds 0."""
    placed = with_positions(
        scored, order, "_at", {"_total": F.coalesce(F.col("prediction_error"), F.lit(0.0))}
    )
    processed = F.col("_at") + 1
    return placed.withColumns({
        "processed": processed, "avg_error": F.col("_total") / processed.cast("double")
    }).drop("_at", "_total")


def offsets_within(rows: DataFrame, partition: str, order: list[str]) -> DataFrame:
    """Number the rows of each topic partition from 0, however large one of them is.

    The join has one row per topic partition; whether it is broadcast is left to its size.
    """
    placed = with_positions(rows, [partition, *order], "_at")
    first = placed.groupBy(partition).agg(F.min("_at").alias("_first"))
    return (
        placed.join(first, partition)
        .withColumn("offset", F.col("_at") - F.col("_first")).drop("_at", "_first")
    )
