"""The registered queries: name -> function of (session, table folder)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripweave import settings as S
from tripweave.functions.rows import the_row
from tripweave.functions.trip import parse_pickup, rounded, with_time_parts
from tripweave.operators import (
    arrival, filters, monitoring, quality, reporting, scoring, serving, statistics, training, views,
)
from tripweave.operators.positions import replay_bounds, slice_by_position
from tripweave.plans import fixtures as fx
from tripweave.plans.monitor_run import health_checks
from tripweave.schemas import BATCH_FEATURES, TRAINING_FEATURES
from tripweave.session import fresh_dir
from tripweave.sources import documents, master, messages, speed_files, trips, view_store
from tripweave.sources.batch_store import BatchStore
from tripweave.streaming import progress as stream_progress
from tripweave.streaming import running, speed_layer, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ARRIVAL = ["pickup_datetime", "id"]
TRIP_TEXT = "yyyy-MM-dd HH:mm:ss"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _as_of():
    return fx.timestamp(fx.AS_OF)


def _text(column: str, fmt: str = TRIP_TEXT):
    return F.date_format(F.col(column), fmt).alias(column)


# -- sources and sinks -----------------------------------------------------------------------

@query
def csv_roundtrip(spark, sf_dir):
    path = trips.write_trips(fx.trips(spark, sf_dir), fresh_dir(spark, "csv"), "csv")
    back = trips.read_trips_csv(spark, f"{path}-absent", path)
    return rounded(back.withColumn("pickup_datetime", _text("pickup_datetime")))


@query
def cleaned_csv(spark, sf_dir):
    path = trips.write_trips(fx.clean(spark, sf_dir), fresh_dir(spark, "cleaned"), "csv")
    back = spark.read.schema(fx.clean(spark, sf_dir).schema).options(
        header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return rounded(back.select("id", "hour", "is_rush_hour", "trip_duration", "distance_km", "speed_kmh"))


@query
def encode_messages(spark, sf_dir):
    return messages.encode(fx.trips(spark, sf_dir), fx.TOPIC, fx.timestamp(fx.AS_OF))


@query
def decode_messages(spark, sf_dir):
    decoded = messages.decode(fx.messages(spark, sf_dir))
    parsed = decoded.withColumn("at", parse_pickup(F.col("pickup_datetime")))
    return rounded(with_time_parts(parsed, "at").drop("at"))


@query
def rejected_messages(spark, sf_dir):
    return messages.rejected(fx.messages(spark, sf_dir)).agg(F.count(F.lit(1)).alias("rejected"))


@query
def stream_ingest(spark, sf_dir):
    log, out = fresh_dir(spark, "topic"), fresh_dir(spark, "ingest")
    messages.append_to_folder(fx.messages(spark, sf_dir), log)
    stream = messages.read_folder_stream(spark, log)
    speed_layer.start_ingest(stream, out, fresh_dir(spark, "progress"), trigger=None).awaitTermination()
    return rounded(spark.read.parquet(out))


@query
def stream_quarantine(spark, sf_dir):
    log, out = fresh_dir(spark, "topic"), fresh_dir(spark, "quarantine")
    messages.append_to_folder(fx.messages(spark, sf_dir), log)
    stream = messages.read_folder_stream(spark, log)
    speed_layer.start_quarantine(stream, out, fresh_dir(spark, "progress"), trigger=None).awaitTermination()
    return spark.read.text(out)


@query
def stream_restart(spark, sf_dir):
    log, out, progress = (fresh_dir(spark, n) for n in ("topic", "speed", "progress"))
    for half in fx.message_halves(spark, sf_dir):
        messages.append_to_folder(half, log)
        for _ in range(2):  # the second run finds nothing new
            stream = messages.read_folder_stream(spark, log)
            speed_layer.start_speed_layer(
                stream, out, progress, trigger=None, processed_time=_as_of()
            ).awaitTermination()
    rows = speed_files.read_batches(spark, out)
    return rows.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("records"), F.sum("trip_duration").alias("total_duration")
    )


def _line(spark, sf_dir) -> scoring.LinearModel:
    return scoring.LinearModel.fit(fx.clean(spark, sf_dir))


@query
def speed_layer_sink(spark, sf_dir):
    log, out = fresh_dir(spark, "topic"), fresh_dir(spark, "speed")
    messages.append_to_folder(fx.messages(spark, sf_dir), log)
    speed_layer.start_speed_layer(
        messages.read_folder_stream(spark, log), out, fresh_dir(spark, "progress"),
        _line(spark, sf_dir), trigger=None, processed_time=_as_of(),
    ).awaitTermination()
    rows = speed_files.read_batches(spark, out)
    return rounded(rows.drop("original_pickup_datetime", "store_and_fwd_flag"), 4)


@query
def speed_hourly_stats(spark, sf_dir):
    log, out, kept, progress = (fresh_dir(spark, n) for n in ("topic", "speed", "hourly", "progress"))
    model = _line(spark, sf_dir)

    def keep(batch_id: int) -> None:
        spark.table(speed_layer.HOURLY_VIEW).write.mode("overwrite").parquet(f"{kept}/batch_id={batch_id}")

    for half in fx.message_halves(spark, sf_dir):
        messages.append_to_folder(half, log)
        stream = messages.read_folder_stream(spark, log)
        speed_layer.start_speed_layer(
            stream, out, progress, model, trigger=None, processed_time=_as_of(), after=keep
        ).awaitTermination()
    return rounded(spark.read.parquet(kept), 4)


@query
def stream_windowed_stats(spark, sf_dir):
    """Every decoded trip counts in a window or as late for it."""
    log, out, progress = (fresh_dir(spark, n) for n in ("topic", "windows", "progress"))
    for part in fx.message_deliveries(spark, sf_dir):
        messages.append_to_folder(part, log)
        stream = messages.read_folder_stream(spark, log)
        windows.start_windowed_counts(stream, out, progress, trigger=None).awaitTermination()
    rows = windows.read_windows(spark, out)
    return rows.withColumns({c: _text(c) for c in ("window_start", "window_end")})


@query
def stream_running_error(spark, sf_dir):
    """Two deliveries with a restart between them; full batches of arrivals of each vendor."""
    log, out, progress = (fresh_dir(spark, n) for n in ("topic", "running", "progress"))
    model = _line(spark, sf_dir)
    for part in fx.message_deliveries(spark, sf_dir)[:2]:
        messages.append_to_folder(part, log)
        decoded = messages.decode(messages.read_folder_stream(spark, log)).filter("vendor_id IS NOT NULL")
        running.start_running_error(
            speed_layer.enrich(decoded, model, _as_of()), out, progress, "vendor_id", ARRIVAL, flush_ms=3_600_000, trigger=None).awaitTermination()
    return rounded(spark.read.parquet(out), 4)


@query
def stream_scoring_failures(spark, sf_dir):
    """Rows and rows without a prediction in each stored batch, as counted by the pass that wrote it."""
    log, out = fresh_dir(spark, "topic"), fresh_dir(spark, "speed")
    messages.append_to_folder(fx.unscorable_messages(spark, sf_dir), log)
    speed_layer.start_speed_layer(
        messages.read_folder_stream(spark, log), out, fresh_dir(spark, "progress"), _line(spark, sf_dir), trigger=None, processed_time=_as_of(),
    ).awaitTermination()
    return BatchStore(spark, out).facts("unscored")


@query
def stream_lag(spark, sf_dir):
    """What a query has not read of its folder, by the query's own progress reports."""
    log, reports, name = fresh_dir(spark, "topic"), fresh_dir(spark, "reports"), f"reader-{uuid.uuid4().hex}"
    first, second = fx.message_halves(spark, sf_dir)
    messages.append_to_folder(first, log)
    listener = stream_progress.ProgressLog(spark, reports).attach()
    try:
        speed_layer.start_ingest(
            messages.read_folder_stream(spark, log), fresh_dir(spark, "ingest"), fresh_dir(spark, "progress"), trigger=None, name=name).awaitTermination()
        stream_progress.wait_for_reports(spark)
    finally:
        listener.detach()
    messages.append_to_folder(second, log)
    read = stream_progress.rows_read(stream_progress.read_progress(spark, reports).filter(F.col("name") == name), fx.TOPIC)
    lag = monitoring.consumer_lag(stream_progress.folder_ends(spark, log, fx.TOPIC), read)
    return lag.withColumn("group_id", F.lit("reader"))


@query
def speed_recent_batches(spark, sf_dir):
    rows = fx.stamped(fx.featured(spark, sf_dir)).withColumns({
        "batch_id": F.floor(F.col("batch_id") / F.lit(24.0)).cast("int"),
        "pickup_datetime": _text("pickup_datetime"), "processed_time": _text("processed_time"),
    })
    full, plain = fresh_dir(spark, "speed"), fresh_dir(spark, "plain")
    kept = ["batch_id", "id", "vendor_id", "trip_duration", "distance_km", "processed_time"]
    speed_files.write_batches(rows.filter("vendor_id = 1").select(*kept, "hour", "day_of_week", "month"), full)
    speed_files.write_batches(rows.filter("vendor_id = 2").select(*kept), plain)
    return rounded(speed_files.read_recent(spark, [full, plain], n=5).select(*kept, "hour", "day_of_week", "month"))


@query
def file_inventory(spark, sf_dir):
    out = fresh_dir(spark, "speed")
    rows = fx.stamped(fx.trips(spark, sf_dir)).withColumn("batch_id", F.floor(F.col("batch_id") / F.lit(24.0)).cast("int"))
    speed_files.write_batches(rows.select("batch_id", "id", "trip_duration"), out)
    return speed_files.inventory(spark, out).drop("modified")


@query
def master_simple(spark, sf_dir):
    path = master.write_master(master.master_simple(fx.trips(spark, sf_dir), fx.RUN_DATE), fresh_dir(spark, "master"))
    back = spark.read.parquet(path)
    return rounded(back.withColumn("ingestion_date", F.col("ingestion_date").cast("string")))


@query
def master_full(spark, sf_dir):
    path = master.write_master(master.master_full(fx.clean(spark, sf_dir), fx.RUN_DATE), fresh_dir(spark, "master"))
    back = spark.read.parquet(path)
    return rounded(back.withColumn("ingestion_date", F.col("ingestion_date").cast("string")))


@query
def master_batch_id(spark, sf_dir):
    return master.master_batch_id(filters.clean_rows(fx.trips(spark, sf_dir)), fx.RUN_DATE)


@query
def view_roundtrip(spark, sf_dir):
    base = fresh_dir(spark, "views")
    view_store.write_view(views.vendor_stats(fx.clean(spark, sf_dir)), base, "vendor_stats", fx.RUN_DATE)
    view_store.write_view(views.vendor_stats(fx.clean(spark, sf_dir)), base, "vendor_stats", fx.RUN_DATE)
    return rounded(view_store.read_view(spark, base, "vendor_stats", fx.RUN_DATE))


@query
def latest_view(spark, sf_dir):
    base = fresh_dir(spark, "views")
    view_store.write_view(views.hourly_stats_basic(fx.featured(spark, sf_dir)), base, "hourly", "20240130")
    view_store.write_view(views.hourly_stats_basic(fx.clean(spark, sf_dir)), base, "hourly", "20240131")
    return rounded(view_store.read_latest_view(spark, base, "hourly"))


# -- projections and filters -----------------------------------------------------------------

@query
def trip_features(spark, sf_dir):
    return rounded(fx.featured(spark, sf_dir).select(
        "id", "hour", "day_of_week", "month", "is_weekend", "is_rush_hour", "distance_km", "speed_kmh"
    ))


@query
def impute_median(spark, sf_dir):
    rows = fx.trips(spark, sf_dir)
    filled = statistics.fill_with(rows, statistics.medians(rows, ["passenger_count", "trip_duration"]))
    return filled.select("id", "passenger_count", "trip_duration")


@query
def training_filter(spark, sf_dir):
    return filters.training_rows(fx.trips(spark, sf_dir)).select("id", "trip_duration")


@query
def clean_trips(spark, sf_dir):
    return rounded(filters.clean_rows(fx.trips(spark, sf_dir)).withColumn("pickup_datetime", _text("pickup_datetime")))


@query
def retain_recent(spark, sf_dir):
    kept = filters.retain_recent(
        fx.stamped(fx.trips(spark, sf_dir, "id", "pickup_datetime")), "processed_time", _as_of())
    return kept.select("id", _text("processed_time"))


def _hourly_store(spark, sf_dir) -> BatchStore:
    """All trips as stored hourly batches, of which those past retention are taken off."""
    rows = fx.stamped(fx.trips(spark, sf_dir, "id", "pickup_datetime"))
    store = BatchStore(spark, fresh_dir(spark, "speed"))
    store.write_many(rows.select("batch_id", "id", F.date_format("processed_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("processed_time")), fx.AS_OF)
    return store


@query
def stored_batches(spark, sf_dir):
    return _hourly_store(spark, sf_dir).counts().select("batch_id", "records", F.substring("newest", 1, 19).alias("newest"))


@query
def expired_batches(spark, sf_dir):
    """Batches that retention takes off the manifest and whose folders are then deleted, beside what stays."""
    store = _hourly_store(spark, sf_dir)
    gone = filters.expire_batches(store, fx.AS_OF)
    deleted = store.vacuum(0)
    left = store.counts()
    stored = spark.read.schema("id string").json(store.paths(list(store.snapshot().batches.values())) or [store.base + "/batches"])
    return left.agg(F.count(F.lit(1)).alias("batches_left"), F.coalesce(F.sum("records"), F.lit(0)).alias("records_left")).withColumns({
        "batches_expired": F.lit(len(gone)).cast("long"), "records_expired": F.lit(sum(b.records for b in gone)).cast("long"),
        "folders_deleted": F.lit(len(deleted)).cast("long"),
        "rows_readable": stored.agg(F.count(F.lit(1))).scalar(),
    })


@query
def pickup_map_points(spark, sf_dir):
    return rounded(serving.pickup_map_points(fx.trips(spark, sf_dir, "pickup_latitude", "pickup_longitude")))


# -- batch views -----------------------------------------------------------------------------

@query
def hourly_stats_basic(spark, sf_dir):
    return rounded(views.hourly_stats_basic(fx.featured(spark, sf_dir)))


@query
def hourly_stats(spark, sf_dir):
    return rounded(views.hourly_stats(fx.clean(spark, sf_dir)))


@query
def daily_summary_basic(spark, sf_dir):
    return rounded(views.daily_summary_basic(fx.featured(spark, sf_dir), fx.RUN_DATE))


@query
def daily_summary(spark, sf_dir):
    return rounded(views.daily_summary(fx.clean(spark, sf_dir), fx.RUN_DATE), 4)


@query
def daily_summary_incremental(spark, sf_dir):
    """Stored partials of the days, the last week delivered later and one week twice, merged on read."""
    base, rows = fresh_dir(spark, "partials"), fx.clean(spark, sf_dir)
    late = F.col("pickup_datetime") >= fx.timestamp("2024-01-24 00:00:00")
    again = F.col("pickup_datetime") >= fx.timestamp("2024-01-17 00:00:00")
    for part in (~late, again):
        view_store.write_partials(rows.filter(part), base)
    return rounded(view_store.read_summary(spark, base, fx.RUN_DATE), 4)


@query
def vendor_stats_basic(spark, sf_dir):
    return rounded(views.vendor_stats_basic(fx.featured(spark, sf_dir)))


@query
def vendor_stats(spark, sf_dir):
    return rounded(views.vendor_stats(fx.clean(spark, sf_dir)))


@query
def geographic_stats(spark, sf_dir):
    return rounded(views.geographic_stats(fx.clean(spark, sf_dir)))


@query
def temporal_patterns(spark, sf_dir):
    return rounded(views.temporal_patterns(fx.clean(spark, sf_dir)))


# -- validation ------------------------------------------------------------------------------

@query
def data_profile(spark, sf_dir):
    profile = quality.data_profile(fx.trips(spark, sf_dir))
    return rounded(profile.withColumns({c: _text(c) for c in ("min_pickup", "max_pickup")}))


@query
def data_distributions(spark, sf_dir):
    return quality.data_distributions(fx.trips(spark, sf_dir, "vendor_id", "passenger_count", "pickup_datetime"))


@query
def null_percentages(spark, sf_dir):
    return quality.null_percentages(quality.raw_facts(fx.trips(spark, sf_dir)))


@query
def quality_score(spark, sf_dir):
    return rounded(quality.quality_score(quality.raw_facts(fx.trips(spark, sf_dir))))


@query
def quality_gate(spark, sf_dir):
    return rounded(quality.quality_gate(quality.raw_facts(fx.trips(spark, sf_dir))))


@query
def quality_gate_while_writing(spark, sf_dir):
    """The gate by facts that the pass storing the trips has counted; no second scan."""
    counted = quality.ObservedFacts(fx.trips(spark, sf_dir))
    trips.write_trips(counted.trips, fresh_dir(spark, "raw"))
    return rounded(quality.quality_gate(counted.frame()))


@query
def anomaly_counts(spark, sf_dir):
    return rounded(quality.anomaly_counts(quality.raw_facts(fx.trips(spark, sf_dir))))


@query
def missing_columns(spark, sf_dir):
    lacking = fx.trips(spark, sf_dir).drop("trip_duration").withColumnRenamed("vendor_id", "vendor")
    return quality.missing_column_report(lacking)


# -- ordering --------------------------------------------------------------------------------

@query
def scatter_sample(spark, sf_dir):
    return rounded(serving.scatter_sample(fx.speed(spark, sf_dir), ARRIVAL), 4)


@query
def latest_trips(spark, sf_dir):
    newest = serving.latest_trips(fx.speed(spark, sf_dir))
    return rounded(newest.withColumn("pickup_datetime", _text("pickup_datetime")), 4)


@query
def publish_head(spark, sf_dir):
    head = messages.replay_limit(fx.trips(spark, sf_dir), ARRIVAL)
    return head.select("id", _text("pickup_datetime"), "trip_duration")


@query
def replay_slice(spark, sf_dir):
    source = fx.trips(spark, sf_dir)
    start, stop = replay_bounds(source.count(), hour=13, size=50)
    return slice_by_position(source, ARRIVAL, start, stop).select("id", "vendor_id", "trip_duration")


@query
def quality_sample(spark, sf_dir):
    return monitoring.quality_sample(
        fx.stamped(fx.trips(spark, sf_dir, "id", "pickup_datetime")), "batch_id").select("batch_id", "id")


@query
def count_batches(spark, sf_dir):
    numbered = arrival.count_batches(fx.trips(spark, sf_dir).select(*ARRIVAL, "trip_duration"), ARRIVAL)
    return numbered.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("records"), F.sum("trip_duration").alias("total_duration")
    )


@query
def running_error(spark, sf_dir):
    tracked = arrival.running_error(fx.speed(spark, sf_dir).select(*ARRIVAL, "prediction_error"), ARRIVAL)
    return rounded(tracked.select("id", "processed", "avg_error"), 4)


# -- serving ---------------------------------------------------------------------------------

@query
def speed_kpis(spark, sf_dir):
    return rounded(serving.speed_kpis(fx.speed(spark, sf_dir)), 4)


@query
def prediction_accuracy(spark, sf_dir):
    return rounded(serving.prediction_accuracy(fx.speed(spark, sf_dir)))


@query
def trips_by_hour(spark, sf_dir):
    return serving.trips_by(with_time_parts(fx.trips(spark, sf_dir, "pickup_datetime")), "hour")


@query
def trips_by_vendor(spark, sf_dir):
    return serving.trips_by(fx.trips(spark, sf_dir, "vendor_id"), "vendor_id")


@query
def vendor_performance(spark, sf_dir):
    return serving.vendor_performance(fx.featured(spark, sf_dir))


@query
def reconcile_layers(spark, sf_dir):
    daily = views.daily_summary(fx.clean(spark, sf_dir), fx.RUN_DATE)
    return rounded(serving.reconcile_layers(daily, fx.trips(spark, sf_dir), fx.RUN_DATE))


@query
def layer_comparison(spark, sf_dir):
    daily = views.daily_summary(fx.clean(spark, sf_dir), fx.RUN_DATE)
    return rounded(serving.layer_comparison(fx.speed(spark, sf_dir), daily))


@query
def combined_view(spark, sf_dir):
    daily = views.daily_summary(fx.clean(spark, sf_dir), fx.RUN_DATE)
    return rounded(serving.combined_view(fx.speed(spark, sf_dir), daily), 4)


# -- monitoring ------------------------------------------------------------------------------

@query
def topic_message_counts(spark, sf_dir):
    log = arrival.offsets_within(fx.topic_log(spark, sf_dir), "partition", ["timestamp", "id"])
    return monitoring.topic_message_counts(monitoring.topic_offsets(log))


@query
def topic_health(spark, sf_dir):
    return monitoring.topic_health(fx.topic_ends(spark, sf_dir), fx.TOPIC)


@query
def consumer_lag(spark, sf_dir):
    offsets = fx.topic_ends(spark, sf_dir)
    return monitoring.consumer_lag(offsets, fx.group_commits(offsets))


@query
def producer_activity(spark, sf_dir):
    return rounded(monitoring.producer_activity(fx.topic_log(spark, sf_dir), _as_of()))


def _writes(spark, sf_dir) -> DataFrame:
    """Processing time and batch of every trip; monitoring needs no scores."""
    return fx.stamped(fx.trips(spark, sf_dir, "pickup_datetime")).select("batch_id", "processed_time")


@query
def speed_freshness(spark, sf_dir):
    fresh = monitoring.speed_freshness(_writes(spark, sf_dir), "processed_time", _as_of())
    return rounded(fresh.withColumn("latest", _text("latest")))


@query
def speed_throughput(spark, sf_dir):
    return rounded(monitoring.speed_throughput(_writes(spark, sf_dir), "batch_id", "processed_time", _as_of()))


@query
def records_per_file(spark, sf_dir):
    return monitoring.records_per_file(_writes(spark, sf_dir), "batch_id")


@query
def speed_record_errors(spark, sf_dir):
    return monitoring.speed_record_errors(fx.messages(spark, sf_dir))


@query
def speed_record_quality(spark, sf_dir):
    return rounded(monitoring.speed_record_quality(fx.messages(spark, sf_dir)))


def _verdict(spark, sf_dir, age: float, share: float, rate: float = S.MIN_THROUGHPUT_PER_MINUTE) -> DataFrame:
    writes = _writes(spark, sf_dir)
    return monitoring.circuit_breaker(health_checks(
        monitoring.topic_health(fx.topic_ends(spark, sf_dir), fx.TOPIC),
        monitoring.speed_freshness(writes, "processed_time", _as_of(), limit=age),
        monitoring.speed_throughput(writes, "batch_id", "processed_time", _as_of(), rate),
        monitoring.speed_record_quality(fx.messages(spark, sf_dir), threshold=share),
    ))


@query
def circuit_breaker(spark, sf_dir):
    """The verdict under strict limits."""
    return _verdict(spark, sf_dir, 0.001, 0.99)


@query
def circuit_breaker_default(spark, sf_dir):
    return _verdict(spark, sf_dir, S.MAX_DATA_AGE_MINUTES, S.RECORD_QUALITY_THRESHOLD)


@query
def alerts(spark, sf_dir):
    return monitoring.alerts(_verdict(spark, sf_dir, 0.001, 0.99))


@query
def ops_dashboard(spark, sf_dir):
    writes, offsets = _writes(spark, sf_dir), fx.topic_ends(spark, sf_dir)
    return monitoring.dashboard_document(
        {
            "kafka": {"topic_health": monitoring.topic_health(offsets, fx.TOPIC)},
            "speed_layer": {
                "throughput": rounded(
                    monitoring.speed_throughput(writes, "batch_id", "processed_time", _as_of()), 4),
                "quality": rounded(monitoring.speed_record_quality(fx.messages(spark, sf_dir)), 4),
            },
        },
        F.lit(fx.AS_OF),
    )


@query
def healthy_metrics(spark, sf_dir):
    """The metrics document of a healthy round; none where a check of the round fails."""
    return monitoring.healthy_metrics(
        _verdict(spark, sf_dir, S.MAX_DATA_AGE_MINUTES, S.RECORD_QUALITY_THRESHOLD, rate=0.01),
        {
            "topic_health": monitoring.topic_health(fx.topic_ends(spark, sf_dir), fx.TOPIC),
            "freshness": monitoring.speed_freshness(_writes(spark, sf_dir), "processed_time", _as_of()).select("is_fresh"),
            "throughput": rounded(monitoring.speed_throughput(_writes(spark, sf_dir), "batch_id", "processed_time", _as_of(), 0.01), 4),
            "data_quality": rounded(monitoring.speed_record_quality(fx.messages(spark, sf_dir)), 4),
        },
        F.lit(fx.AS_OF),
    )


# -- models ----------------------------------------------------------------------------------

@query
def training_features(spark, sf_dir):
    return rounded(training.training_features(fx.trips(spark, sf_dir)).select("id", *[
        F.col(c).cast("double").alias(c) for c in TRAINING_FEATURES
    ], "trip_duration"))


@query
def train_test_split(spark, sf_dir):
    rows = filters.clean_rows(fx.trips(spark, sf_dir))
    part = F.when(training.is_test_row(), "test").otherwise("train")
    return rows.select("id", part.alias("part"), "trip_duration")


@query
def scale_features(spark, sf_dir):
    rows = fx.clean(spark, sf_dir).select("id", *BATCH_FEATURES)
    train, _ = training.train_test_split(rows)
    return rounded(training.scale_with(rows, training.scaling(train, BATCH_FEATURES), BATCH_FEATURES))


@query
def linear_baseline(spark, sf_dir):
    return rounded(scoring.linear_baseline(fx.clean(spark, sf_dir)), 4)


@query
def score_trips(spark, sf_dir):
    decoded = messages.decode(fx.messages(spark, sf_dir))
    scored = speed_layer.enrich(decoded, _line(spark, sf_dir), _as_of())
    return rounded(scored.select("id", "predicted_duration", "prediction_error"), 4)


@query
def score_isolated(spark, sf_dir):
    """Messages that no model can score have no prediction; all others have theirs."""
    scored = speed_layer.enrich(messages.decode(fx.unscorable_messages(spark, sf_dir)), _line(spark, sf_dir), _as_of())
    return rounded(scored.select("id", "predicted_duration", "prediction_error"), 4)


@query
def score_without_model(spark, sf_dir):
    scored = speed_layer.enrich(messages.decode(fx.messages(spark, sf_dir)), None, _as_of())
    return rounded(scored.select("id", "distance_km", "predicted_duration", "prediction_error"))


def _test_metrics(spark, sf_dir) -> DataFrame:
    train, test = training.train_test_split(fx.clean(spark, sf_dir))
    return scoring.regression_metrics(scoring.score_with_line(test, scoring.linear_baseline(train)))


@query
def regression_metrics(spark, sf_dir):
    return rounded(_test_metrics(spark, sf_dir))


@query
def model_gate(spark, sf_dir):
    return rounded(scoring.model_gate(_test_metrics(spark, sf_dir)))


def _fit_facts(figures: DataFrame, *names: str) -> DataFrame:
    """What must hold of a fitted model in any engine, in place of its figures."""
    return figures.select(*names, "samples", (F.col("mae") <= F.col("rmse")).alias("mae_within_rmse"))


def _beats_line(model, fitted_on: DataFrame):
    """Whether the model follows the rows it was fitted on more closely than the closed-form line of these rows."""
    line = scoring.regression_metrics(scoring.score_with_line(fitted_on, scoring.linear_baseline(fitted_on)))
    return the_row(training.evaluate(model, fitted_on))["rmse"] < the_row(line)["rmse"]


@query
def train_gbt(spark, sf_dir):
    rows = fx.trips(spark, sf_dir)
    trained = training.train_gbt(rows)
    train, _ = training.train_test_split(training.training_features(rows))
    return _fit_facts(trained.summary().withColumn("beats_line", _beats_line(trained.model, train)), "name", "type", "beats_line")


@query
def train_linear(spark, sf_dir):
    """Residuals of least squares have mean 0 and no covariance with any feature."""
    rows = fx.trips(spark, sf_dir)
    trained = training.train_linear(rows)
    train, _ = training.train_test_split(training.training_features(rows))
    residual = F.col("trip_duration") - F.col("prediction")
    facts = trained.model.transform(train).agg(
        F.count(F.lit(1)).alias("training_samples"), F.avg(residual).alias("mean_residual"),
        *[F.covar_pop(residual, F.col(f"x_{c}")).alias(f"residual_{c}") for c in TRAINING_FEATURES],
    )
    # Adding 0 turns a negative zero into zero.
    zeros = {c: F.round(c, 3) + F.lit(0.0) for c in facts.columns if c != "training_samples"}
    return facts.withColumns({"name": F.lit(trained.name), "type": F.lit(trained.kind), **zeros})


@query
def train_neural(spark, sf_dir):
    """Four hidden layers; figures on unseen rows, and whether it follows the rows of the fit more closely than their line."""
    train, test = training.train_test_split(training.training_features(fx.trips(spark, sf_dir)))
    trained = training.fit_neural(train, test)
    return _fit_facts(trained.summary().withColumn("beats_line", _beats_line(trained.model, train)), "name", "type", "beats_line")


@query
def model_leaderboard(spark, sf_dir):
    board = training.leaderboard(training.train_all(fx.trips(spark, sf_dir)))
    # Three rows.
    place = Window.orderBy(F.monotonically_increasing_id())
    ordered = board.withColumn("in_order", F.coalesce(F.lag("rmse").over(place) <= F.col("rmse"), F.lit(True)))
    return _fit_facts(ordered, "name", "type", "in_order")


@query
def best_model(spark, sf_dir):
    board = training.leaderboard(training.train_all(fx.trips(spark, sf_dir)))
    least = F.col("rmse") == the_row(board.agg(F.min("rmse").alias("rmse")))["rmse"]
    return _fit_facts(training.best_model(board).withColumn("is_least", least), "is_least")


@query
def evaluate_model(spark, sf_dir):
    """A stored model on the rows it was not fitted on: the same figures as before it was stored."""
    rows = fx.clean(spark, sf_dir)
    trained = training.train_batch_gbt(rows)
    stored = training.load_model(training.save_model(trained.model, fresh_dir(spark, "model")))
    seen, unseen = training.train_test_split(rows)
    before = the_row(trained.metrics)
    again = training.evaluate(stored, unseen)
    same = [F.abs(F.col(c) - before[c]) < 1e-6 for c in ("rmse", "mae", "r2")]
    facts = again.withColumns({"as_before": same[0] & same[1] & same[2], "beats_line": _beats_line(stored, seen)})
    return _fit_facts(facts, "as_before", "beats_line")


@query
def model_roundtrip(spark, sf_dir):
    rows = fx.clean(spark, sf_dir)
    trained = training.train_linear(fx.trips(spark, sf_dir))
    stored = training.load_model(training.save_model(trained.model, fresh_dir(spark, "model")))
    once = trained.model.transform(rows).select("id", *TRAINING_FEATURES, F.col("prediction").alias("kept"))
    return stored.transform(once).agg(
        F.count(F.lit(1)).alias("scored"), F.count(F.when(F.col("kept") == F.col("prediction"), 1)).alias("equal")
    )


@query
def experiment_log(spark, sf_dir):
    rows = fx.trips(spark, sf_dir)
    trained = training.train_linear(rows)
    path = fresh_dir(spark, "experiments")
    train, _ = training.train_test_split(filters.training_rows(rows))
    training.log_experiment(trained, train.count(), fx.RUN_DATE, path)
    return training.read_experiments(spark, path).select(
        "name", "type", "run_date", F.concat_ws(",", "features").alias("features"), "training_samples", "test_samples"
    )


# -- reports ---------------------------------------------------------------------------------

def _report(spark, sf_dir) -> DataFrame:
    facts = quality.raw_facts(fx.trips(spark, sf_dir))
    daily = views.daily_summary(fx.clean(spark, sf_dir), fx.RUN_DATE)
    return reporting.run_report(
        quality.checked(facts), _test_metrics(spark, sf_dir),
        serving.reconcile_layers(daily, fx.trips(spark, sf_dir), fx.RUN_DATE),
    )


@query
def run_report(spark, sf_dir):
    return rounded(_report(spark, sf_dir))


@query
def completion_summary(spark, sf_dir):
    return reporting.completion_summary(_report(spark, sf_dir), fx.RUN_DATE)


@query
def report_document(spark, sf_dir):
    report = rounded(_report(spark, sf_dir), 4)
    path = fresh_dir(spark, "report")
    documents.write_document(reporting.report_document(report, fx.RUN_DATE, fx.AS_OF), path)
    return spark.read.text(path).select(F.col("value").alias("document"))
