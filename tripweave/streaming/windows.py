"""Windowed trip statistics in which late rows are counted, not lost.

Rows are split before they reach a window: the watermark of a micro-batch is the newest event time of the batches before it,
less the allowed delay. A row whose window ended before that is late and is counted per window; all others go into
their window, which stays open until a later watermark passes its end. Each batch stores the windows it closes,
the late counts, and all open windows behind one manifest entry, so the newest batch alone holds the state, and
a batch that runs again starts from the same state and replaces its own entry.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tripweave import settings as S
from tripweave.functions.trip import parse_pickup
from tripweave.sources.batch_store import Batch, BatchStore
from tripweave.sources.messages import decode
from tripweave.streaming.speed_layer import _triggered

#: What a stored row is: a window that closed, one that is open, rows too late for their window, rows without a time.
CLOSED, OPEN, LATE, UNDATED = "closed", "open", "late", "undated"
_ROW = "kind string, start long, trips long, duration long"
_SECOND = 1_000_000


def _sums(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("trips").alias("trips"), F.sum("duration").alias("duration"))


def _before(store: BatchStore, batch_id: int) -> Batch | None:
    """The newest batch before this one, also if this one is stored already."""
    held = [b for i, b in store.snapshot().batches.items() if i < batch_id]
    return max(held, key=lambda b: b.batch_id, default=None)


def _watermark(batch: Batch | None, delay: int) -> int | None:
    newest = batch and batch.facts.get("newest_event")
    return None if newest is None else newest - delay


def window_writer(spark: SparkSession, out: str, width: int, delay: int, ts: str = "pickup_datetime") -> Callable[[DataFrame, int], None]:
    """The function that handles one micro-batch of trips; ``width`` and ``delay`` are seconds."""
    wide, behind = width * _SECOND, delay * _SECOND

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        store = BatchStore(spark, out)
        before = _before(store, batch_id)
        watermark = _watermark(before, behind)
        at = F.unix_micros(F.col(ts).cast("timestamp"))
        start = at - F.pmod(at, F.lit(wide))
        late = F.lit(False) if watermark is None else start + wide <= watermark
        kind = F.when(at.isNull(), UNDATED).when(late, LATE).otherwise(OPEN)
        new = batch.select(kind.alias("kind"), start.alias("start"), at.alias("at"), F.col("trip_duration").cast("long").alias("d")).groupBy(
            "kind", "start").agg(F.count(F.lit(1)).alias("trips"), F.coalesce(F.sum("d"), F.lit(0)).alias("duration"), F.max("at").alias("newest"))
        seen = Observation()
        counted = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("trips"))), F.lit(0)).alias(k)
        new = new.observe(seen, F.sum("trips").alias("records"), F.max("newest").alias("newest"), counted(LATE), counted(UNDATED)).drop("newest")
        if before is not None:
            held = spark.read.schema(_ROW).json(store.paths([before])).where(F.col("kind") == OPEN)
            over = F.lit(False) if watermark is None else F.col("start") + wide <= watermark
            new = new.unionByName(held.withColumn("kind", F.when(over, CLOSED).otherwise(OPEN)))
        folder = store.stage(_sums(new, "kind", "start"), batch_id)
        found = dict(seen.get)
        newest = max((x for x in (found["newest"], before and before.facts.get("newest_event")) if x is not None), default=None)
        written = datetime.now(timezone.utc).isoformat(timespec="microseconds")
        store.commit(Batch(batch_id, folder, found["records"], written, facts={"newest_event": newest, LATE: found[LATE], UNDATED: found[UNDATED]}))

    return handle


def start_windowed_counts(
    messages: DataFrame, out: str, checkpoint: str, trigger: str | None = S.TRIGGER, width: int = 86_400, delay: int = 3_600,
) -> StreamingQuery:
    """Keep windowed statistics of a stream with a ``value`` column; ``read_windows`` and ``read_late`` read them."""
    trips = decode(messages).withColumn("pickup_datetime", parse_pickup(F.col("pickup_datetime")))
    handle = window_writer(messages.sparkSession, out, width, delay)
    writer = trips.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return _triggered(writer.foreachBatch(handle), trigger).start()


def _stored(spark: SparkSession, out: str) -> tuple[DataFrame, Batch | None]:
    store = BatchStore(spark, out)
    live = store.snapshot().batches
    last = max(live.values(), key=lambda b: b.batch_id, default=None)
    if last is None:
        return spark.createDataFrame([], f"{_ROW}, last boolean"), None
    rows = spark.read.schema(_ROW).json(store.paths(list(live.values())))
    # Open windows are those of the newest batch; all else was stored once.
    is_last = F.col("_metadata.file_path").contains(last.folder)
    return rows.select("*", is_last.alias("last")).where((F.col("kind") != OPEN) | F.col("last")), last


def _bounds(width: int) -> list[Column]:
    return [F.timestamp_micros(F.col("start")).alias("window_start"), F.timestamp_micros(F.col("start") + width * _SECOND).alias("window_end")]


def read_windows(spark: SparkSession, out: str, width: int = 86_400, delay: int = 3_600) -> DataFrame:
    """(window_start, window_end, trip_count, total_duration, late_count, late_duration, is_final), one row for each window.

    A window is final once the watermark has passed its end. Trips counted late are in no window's trip_count, so that both
    counts together, and the rows without a time (``read_undated``), are all rows of the stream.
    """
    rows, last = _stored(spark, out)
    watermark = _watermark(last, delay * _SECOND)
    late = F.col("kind") == LATE
    part = lambda c, of: F.coalesce(F.sum(F.when(of, F.col(c))), F.lit(0))
    final = F.lit(False) if watermark is None else F.col("start") + width * _SECOND <= watermark
    return rows.where(F.col("kind") != UNDATED).groupBy("start").agg(
        part("trips", ~late).alias("trip_count"), part("duration", ~late).alias("total_duration"),
        part("trips", late).alias("late_count"), part("duration", late).alias("late_duration"),
    ).select(*_bounds(width), "trip_count", "total_duration", "late_count", "late_duration", final.alias("is_final"))


def read_undated(spark: SparkSession, out: str) -> DataFrame:
    """One row: how many rows had no event time."""
    rows, _ = _stored(spark, out)
    return rows.agg(F.coalesce(F.sum(F.when(F.col("kind") == UNDATED, F.col("trips"))), F.lit(0)).alias("undated"))
