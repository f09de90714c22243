"""Row predicates. A null operand drops the row."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave import settings as S
from tripweave.sources.batch_store import Batch, BatchStore


def duration_in_range() -> Column:
    return F.col("trip_duration").between(S.MIN_DURATION_S, S.MAX_DURATION_S)


def is_clean() -> Column:
    """What the batch layer keeps: sane duration and passengers, pickup inside the city bounds."""
    return (
        duration_in_range()
        & (F.col("passenger_count") > 0)
        & (F.col("passenger_count") <= S.MAX_PASSENGERS)
        & F.col("pickup_latitude").between(S.LAT_MIN, S.LAT_MAX)
        & F.col("pickup_longitude").between(S.LON_MIN, S.LON_MAX)
    )


def training_rows(trips: DataFrame) -> DataFrame:
    return trips.filter(duration_in_range())


def clean_rows(trips: DataFrame) -> DataFrame:
    return trips.filter(is_clean())


def within_map(points: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Points strictly inside the map frame."""
    return points.filter(
        (F.col(lat) > S.MAP_LAT_MIN) & (F.col(lat) < S.MAP_LAT_MAX)
        & (F.col(lon) > S.LON_MIN) & (F.col(lon) < S.LON_MAX)
    )


def written_since(ts: Column, as_of: Column, hours: int = 1) -> Column:
    """True for rows written less than ``hours`` before ``as_of``."""
    return ts > as_of - F.make_dt_interval(hours=F.lit(hours))


def retain_recent(df: DataFrame, ts: str, as_of: Column, hours: int = S.RETENTION_HOURS) -> DataFrame:
    """Rows no older than ``hours``."""
    return df.filter(F.col(ts) >= as_of - F.make_dt_interval(hours=F.lit(hours)))


def expire_batches(store: BatchStore, as_of: str, hours: int = S.RETENTION_HOURS) -> list[Batch]:
    """Take the stored batches off whose newest row is older than ``hours`` before ``as_of`` (``yyyy-MM-dd HH:mm:ss``).

    Whole batches go, so one that straddles the bound stays; ``retain_recent`` cuts its rows on read. The files are
    deleted by the store's ``vacuum``.
    """
    before = datetime.fromisoformat(as_of) - timedelta(hours=hours)
    return store.expire(before.isoformat(sep=" "))
