"""The immutable master data set, partitioned by ingestion date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.functions.trip import batch_key
from tripweave.schemas import MASTER_FULL_SCHEMA, MASTER_SIMPLE_SCHEMA, conform

_DEFAULTS = {"store_and_fwd_flag": "N", "dropoff_datetime": ""}


def master_simple(trips: DataFrame, run_date: str) -> DataFrame:
    """Raw trips as typed records stamped with the ingestion date."""
    return conform(trips.withColumn("ingestion_date", F.lit(run_date)), MASTER_SIMPLE_SCHEMA, _DEFAULTS)


def master_batch_id(clean: DataFrame, run_date: str) -> DataFrame:
    """(ingestion_date, row_count, batch_id)."""
    counted = clean.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(
        F.lit(run_date).alias("ingestion_date"), "row_count",
        batch_key(F.lit(run_date), F.col("row_count")).alias("batch_id"),
    )


def master_full(clean: DataFrame, run_date: str) -> DataFrame:
    """Cleaned trips with features as typed records stamped with date and batch id."""
    batch_id = master_batch_id(clean, run_date).select("batch_id").scalar()
    stamped = clean.withColumns({"ingestion_date": F.lit(run_date), "batch_id": batch_id})
    return conform(stamped, MASTER_FULL_SCHEMA, _DEFAULTS)


def write_master(records: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write the partitions of the records' ingestion dates.

    ``fmt='avro'`` needs the spark-avro package on the class path; the default does not.
    """
    (
        records.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingestion_date").format(fmt).save(path)
    )
    return path
