"""Column contracts of trips, messages, speed rows and master records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType, DoubleType, IntegerType, StringType, StructType, TimestampNTZType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(), "int": IntegerType(), "double": DoubleType(), "timestamp_ntz": TimestampNTZType(),
}


def _record(text: str) -> StructType:
    """``name type, ...`` as a schema; unlike the DDL parser this needs no running session."""
    schema = StructType()
    for field in text.split(","):
        name, kind = field.split()
        schema = schema.add(name, _TYPES[kind])
    return schema


# Column names and types of the exchanged records.
REQUIRED_COLUMNS = [
    "id", "vendor_id", "pickup_datetime", "passenger_count", "pickup_longitude",
    "pickup_latitude", "dropoff_longitude", "dropoff_latitude", "trip_duration",
]

TRIP_SCHEMA = _record(
    "id string, vendor_id int, pickup_datetime timestamp_ntz, dropoff_datetime string, passenger_count int, "
    "pickup_longitude double, pickup_latitude double, dropoff_longitude double, dropoff_latitude double, "
    "store_and_fwd_flag string, trip_duration int"
)

MESSAGE_SCHEMA = _record(
    "id string, vendor_id int, pickup_datetime string, original_pickup_datetime string, passenger_count int, "
    "pickup_longitude double, pickup_latitude double, dropoff_longitude double, dropoff_latitude double, "
    "store_and_fwd_flag string, trip_duration int"
)

SPEED_SCHEMA = _record(
    "id string, vendor_id int, pickup_datetime string, original_pickup_datetime string, passenger_count int, "
    "pickup_longitude double, pickup_latitude double, dropoff_longitude double, dropoff_latitude double, "
    "store_and_fwd_flag string, trip_duration int, hour int, day_of_week int, month int, distance_km double, "
    "predicted_duration double, prediction_error double, processed_time string, batch_id int"
)

MASTER_SIMPLE_SCHEMA = _record(
    "id string, vendor_id int, pickup_datetime string, dropoff_datetime string, passenger_count int, "
    "pickup_longitude double, pickup_latitude double, dropoff_longitude double, dropoff_latitude double, "
    "store_and_fwd_flag string, trip_duration int, ingestion_date string"
)

MASTER_FULL_SCHEMA = _record(
    "id string, vendor_id int, pickup_datetime string, passenger_count int, "
    "pickup_longitude double, pickup_latitude double, dropoff_longitude double, dropoff_latitude double, "
    "store_and_fwd_flag string, trip_duration int, hour int, day_of_week int, month int, is_weekend int, "
    "is_rush_hour int, distance_km double, speed_kmh double, ingestion_date string, batch_id string"
)

TRAINING_FEATURES = [
    "passenger_count", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
    "hour", "day_of_week", "month", "distance_km",
]

BATCH_FEATURES = [
    "vendor_id", "passenger_count", "hour", "day_of_week", "is_weekend", "is_rush_hour", "distance_km",
]


def missing_columns(df: DataFrame, required: list[str] | None = None) -> list[str]:
    """Required names the frame does not have, in contract order."""
    present = set(df.columns)
    return [c for c in (required or REQUIRED_COLUMNS) if c not in present]


def require_columns(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """The frame itself, or an error that names what is missing."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def conform(df: DataFrame, schema: StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """Project onto ``schema`` with casts. A default is used only where the whole column is absent."""
    defaults = defaults or {}

    def one(field) -> Column:
        if field.name not in df.columns:
            return F.lit(defaults.get(field.name)).cast(field.dataType).alias(field.name)
        source = F.col(field.name)
        if field.dataType.simpleString() == "string" and "timestamp" in dict(df.dtypes)[field.name]:
            source = F.date_format(source, "yyyy-MM-dd HH:mm:ss")
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[one(f) for f in schema.fields])


def select_present(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])
