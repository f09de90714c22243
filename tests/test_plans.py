import json

import pytest
from pyspark.sql import functions as F

from tripweave.plans import fixtures as fx
from tripweave.plans.batch_run import GateFailed, run_batch, run_simple_batch
from tripweave.plans.monitor_run import run_monitor
from tripweave.session import fresh_dir, shared_dir
from tripweave.sources import messages, speed_files, trips, view_store
from tripweave.streaming.speed_layer import enrich


@pytest.fixture
def base(spark):
    return fresh_dir(spark, "run")


def test_batch_run_end_to_end(spark, sf_dir, base):
    raw = fx.trips(spark, sf_dir)
    speed_files.write_batch(enrich(messages.decode(fx.messages(spark, sf_dir))), f"{base}/speed", 0)
    # The pickups outside the bounds are many in these tables, but no column is short of values.
    first = run_batch(raw, base, "20240131", "now", f"{base}/speed", trees=8, depth=4, model_threshold=0.5)
    stages = {r.stage: r for r in first.report.collect()}
    assert set(stages) == {"data_validation", "anomaly_detection", "batch_processing", "ml_pipeline", "reconciliation"}
    assert stages["batch_processing"].records_processed == spark.read.parquet(first.paths["master"]).count()
    document = json.loads(spark.read.text(first.paths["report"]).first().value)
    assert document["stages"]["data_validation"]["row_count"] == raw.count()

    # A second date finds the stored model, adds its snapshots and leaves the others alone.
    run_batch(raw.filter("vendor_id = 1"), base, "20240201", "now", trees=8, depth=4, model_threshold=0.5)
    views = f"{base}/views"
    assert view_store.read_view(spark, views, "vendor_stats", "20240131").count() == 2
    assert view_store.read_latest_view(spark, views, "vendor_stats").count() == 1
    assert view_store.read_view(spark, views, "vendor_stats", "20240130").count() == 0
    assert spark.read.parquet(f"{base}/model/experiments").count() == 1


def test_gates_stop_the_run(spark, trip_frame, base):
    empty = {"passenger_count": None, "pickup_latitude": None, "trip_duration": None}
    with pytest.raises(GateFailed, match="quality"):
        run_batch(trip_frame({}, empty), base, "20240131", "now")
    assert not trips.path_exists(spark, f"{base}/cleaned")


def test_simple_batch(spark, sf_dir, base):
    paths = run_simple_batch(fx.trips(spark, sf_dir), base, "20240131")
    assert spark.read.parquet(paths["master"]).count() == 1000
    assert view_store.read_latest_view(spark, f"{base}/views", "daily_summary_basic").first().total_trips == 1000


def _monitor(spark, sf_dir, base, as_of):
    offsets = fx.topic_ends(spark, sf_dir)
    return run_monitor(
        offsets, fx.group_commits(offsets), fx.topic_log(spark, sf_dir), fx.stamped(fx.trips(spark, sf_dir)),
        fx.messages(spark, sf_dir), fx.TOPIC, fx.timestamp(as_of), base, "stamp",
    )


def test_monitor_alerts_when_data_is_old(spark, sf_dir, base):
    assert _monitor(spark, sf_dir, base, "2024-03-01 00:00:00") == "alert"
    alert = json.loads(spark.read.text(f"{base}/alert-stamp").first().value)
    assert alert["failed_checks"] == "data_fresh, throughput_ok" and alert["severity"] == "warning"
    dashboard = json.loads(spark.read.text(f"{base}/dashboard").first().value)
    assert set(dashboard) == {"generated_at", "kafka", "speed_layer", "producer"}


def test_monitor_stores_metrics_when_healthy(spark, sf_dir, base):
    rows = fx.stamped(fx.trips(spark, sf_dir))
    dense = rows.withColumn("processed_time", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    offsets = fx.topic_ends(spark, sf_dir)
    action = run_monitor(
        offsets, fx.group_commits(offsets), fx.topic_log(spark, sf_dir), dense, fx.messages(spark, sf_dir),
        fx.TOPIC, fx.timestamp("2024-02-01 00:05:00"), base, "stamp",
    )
    assert action == "continue" and trips.path_exists(spark, f"{base}/metrics-stamp")


def test_csv_contract(spark, trip_frame, base):
    trips.write_trips(trip_frame({}).drop("trip_duration"), f"{base}/short", "csv")
    with pytest.raises(ValueError, match="trip_duration"):
        trips.read_trips_csv(spark, f"{base}/short")
    with pytest.raises(FileNotFoundError):
        trips.read_trips_csv(spark, f"{base}/none", f"{base}/neither")
    trips.write_trips(trip_frame({}), f"{base}/full", "csv")
    back = trips.read_trips_csv(spark, f"{base}/none", f"{base}/full")
    assert dict(back.dtypes)["pickup_datetime"] == "timestamp_ntz" and back.first().trip_duration == 600


def test_filters_reach_the_parquet_scan(spark, trip_frame, base):
    from tripweave.functions.trip import with_trip_features
    from tripweave.operators import views
    from tripweave.operators.filters import clean_rows

    trips.write_trips(trip_frame({}), f"{base}/trips")
    view = views.vendor_stats_basic(with_trip_features(clean_rows(trips.read_trips_parquet(spark, f"{base}/trips"))))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = view._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(trip_duration,60)" in plan and "GreaterThan(passenger_count,0)" in plan
    assert "store_and_fwd_flag" not in plan


def test_shared_folder_is_the_configured_one(spark):
    assert fresh_dir(spark, "x").startswith(shared_dir(spark))
