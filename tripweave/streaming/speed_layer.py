"""The speed layer: decode, enrich, score and keep each micro-batch, and show its live view."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from tripweave import settings as S
from tripweave.functions.trip import parse_pickup, with_distance, with_time_parts
from tripweave.operators.scoring import score, validated
from tripweave.schemas import BATCH_FEATURES, SPEED_SCHEMA, TRAINING_FEATURES
from tripweave.sources import speed_files
from tripweave.sources.messages import decode, rejected

TRIPS_VIEW = "speed_layer_trips"
HOURLY_VIEW = "speed_layer_hourly_stats"


def enrich(decoded: DataFrame, model=None, processed_time: Column | None = None) -> DataFrame:
    """Features, distance, prediction, error and processing time as columns of decoded messages."""
    stamp = F.date_format(F.current_timestamp() if processed_time is None else processed_time,
                          "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    timed = with_time_parts(decoded.withColumn("_pickup", parse_pickup(F.col("pickup_datetime"))), "_pickup")
    scored = score(with_distance(timed), model)
    return scored.withColumn("processed_time", stamp).select(
        *[f.name for f in SPEED_SCHEMA.fields if f.name != "batch_id"]
    )


def hourly_view(trips: DataFrame) -> DataFrame:
    """Live statistics per hour of the trips given."""
    return trips.groupBy("hour").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.avg("distance_km").alias("avg_distance"),
        F.avg("trip_duration").alias("avg_actual_duration"),
        F.avg("predicted_duration").alias("avg_predicted_duration"),
    ).orderBy("hour")


def register_live_views(spark: SparkSession, base: str, batch_id: int) -> None:
    """Point the live views at one batch, replacing the batch before. They read its stored rows."""
    rows = speed_files.read_batches(spark, base, batch_id)
    rows.createOrReplaceTempView(TRIPS_VIEW)
    hourly_view(rows).createOrReplaceTempView(HOURLY_VIEW)


def batch_writer(
    spark: SparkSession, out: str, model=None, processed_time: Column | None = None,
    after: Callable[[int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """The function that handles one micro-batch of decoded messages. Empty batches leave no trace.

    The rows are written beside the stored batches and become visible with their manifest entry, which also says how many got no
    prediction though there is a model.
    """
    unscored = F.count(F.when(F.col("predicted_duration").isNull(), 1)) if model is not None else F.lit(0).cast("long")

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        written = datetime.now(timezone.utc).isoformat(timespec="microseconds")
        speed_files.store_batch(enrich(batch, model, processed_time), out, batch_id, written, unscored=unscored)
        register_live_views(spark, out, batch_id)
        if after:
            after(batch_id)

    return handle


def _model_inputs(spark: SparkSession) -> DataFrame:
    """An empty frame with the columns that a model finds on the stream."""
    names = {f.name: f for f in SPEED_SCHEMA.fields}
    schema = StructType([names[c] for c in dict.fromkeys(TRAINING_FEATURES + BATCH_FEATURES) if c in names])
    return spark.createDataFrame([], schema)


def _triggered(writer, trigger: str | None):
    return writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)


def start_speed_layer(
    messages: DataFrame, out: str, checkpoint: str, model=None, trigger: str | None = S.TRIGGER,
    processed_time: Column | None = None, after: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Run the speed layer over a stream with a ``value`` column.

    ``trigger=None`` handles what is there and stops. A batch replaces its own manifest entry and the
    checkpoint records what was handled, so a restart neither repeats nor loses a message. A model that cannot score such
    messages is refused before the stream starts.
    """
    validated(model, _model_inputs(messages.sparkSession))
    handle = batch_writer(messages.sparkSession, out, model, processed_time, after)
    writer = decode(messages).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return _triggered(writer.foreachBatch(handle), trigger).start()


def start_ingest(messages: DataFrame, out: str, checkpoint: str, trigger: str | None = S.TRIGGER, name: str | None = None) -> StreamingQuery:
    """Land decoded messages as Parquet, exactly once; the name is that of its progress reports."""
    writer = (
        decode(messages).writeStream.outputMode("append").format("parquet")
        .option("path", out).option("checkpointLocation", checkpoint)
    )
    writer = writer.queryName(name) if name else writer
    return _triggered(writer, trigger).start()


def start_quarantine(messages: DataFrame, out: str, checkpoint: str, trigger: str | None = S.TRIGGER) -> StreamingQuery:
    """Keep the values that do not parse as text, for later inspection; run beside the speed layer."""
    writer = (
        rejected(messages).writeStream.outputMode("append").format("text")
        .option("path", out).option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, trigger).start()


def windowed_stats(trips: DataFrame, ts: str = "pickup_datetime", width: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Trips per tumbling window of event time; rows later than ``delay`` behind the newest are dropped."""
    timed = trips.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", delay)
    return timed.groupBy(F.window("_at", width).alias("w")).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("trip_duration").alias("total_duration"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "trip_count", "total_duration")


def start_windowed_stats(messages: DataFrame, out: str, checkpoint: str, trigger: str | None = S.TRIGGER,
                         width: str = "1 day", delay: str = "1 hour") -> StreamingQuery:
    """Append each window once it is final."""
    trips = decode(messages).withColumn("pickup_datetime", parse_pickup(F.col("pickup_datetime")))
    writer = (
        windowed_stats(trips, width=width, delay=delay).writeStream.outputMode("append").format("parquet")
        .option("path", out).option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, trigger).start()
