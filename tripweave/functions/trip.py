"""Derived trip columns: calendar parts, distance, speed, zones and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave import settings as S

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_pickup(text: Column) -> Column:
    """Timestamp of a ``yyyy-MM-dd HH:mm:ss`` text; text of another shape gives null."""
    return F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT)).cast("timestamp_ntz")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres; null where a coordinate is null."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_lat = F.sin((phi2 - phi1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(phi1) * F.cos(phi2) * half_lon * half_lon
    return F.lit(2.0 * S.EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))


def speed_kmh(distance: Column, seconds: Column) -> Column:
    """Mean speed; 0 where it is undefined."""
    moving = (seconds != 0) & distance.isNotNull() & ~F.isnan(distance)
    return F.when(moving, distance / (seconds / F.lit(3600.0))).otherwise(F.lit(0.0))


def member_flag(value: Column, members: list[int]) -> Column:
    return F.when(value.isin(members), 1).otherwise(0)


def day_name(day_of_week: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in S.DAY_NAMES]), day_of_week + 1)


def vendor_label(vendor_id: Column) -> Column:
    pairs = [F.lit(x) for item in S.VENDOR_LABELS.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), vendor_id)


def grid(degrees: Column) -> Column:
    """Nearest tenth of a degree; ties go to the even tenth."""
    return F.rint(degrees * 10) / F.lit(10.0)


def with_time_parts(df: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    t = F.col(ts)
    return df.withColumns({"hour": F.hour(t), "day_of_week": F.weekday(t), "month": F.month(t)})


def with_distance(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "distance_km",
        haversine_km(
            F.col("pickup_latitude"), F.col("pickup_longitude"),
            F.col("dropoff_latitude"), F.col("dropoff_longitude"),
        ),
    )


def with_trip_features(df: DataFrame) -> DataFrame:
    """Calendar parts, weekend and rush-hour flags, distance and speed."""
    return with_distance(with_time_parts(df)).withColumns(
        {
            "is_weekend": member_flag(F.col("day_of_week"), S.WEEKEND_DAYS),
            "is_rush_hour": member_flag(F.col("hour"), S.RUSH_HOURS),
            "speed_kmh": speed_kmh(F.col("distance_km"), F.col("trip_duration")),
        }
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Fractional seconds from ``start`` to ``end``."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(1e6)


def batch_key(date: Column, rows: Column) -> Column:
    """Twelve hex digits naming one ingestion of ``rows`` rows on ``date``."""
    return F.substring(F.md5(F.concat_ws("_", date, rows.cast("string"))), 1, 12)


def computed_once(df: DataFrame, *columns: Column) -> DataFrame:
    """A projection that later filters and projections do not copy.

    Catalyst moves a filter below a plain projection by repeating the expressions it tests, which
    parses a JSON text again for every use. It leaves a generator in place.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Every double column rounded, so that results compare across engines."""
    return df.select(*[
        F.round(F.col(n), digits).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes
    ])
