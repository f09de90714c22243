import pytest
from pyspark.sql import functions as F

from tripweave.operators.scoring import LinearModel
from tripweave.plans import fixtures as fx
from tripweave.schemas import SPEED_SCHEMA
from tripweave.session import fresh_dir
from tripweave.sources import messages, speed_files
from tripweave.streaming import speed_layer

LINE = LinearModel(100.0, 60.0)
CLOCK = "2024-02-01 00:00:00"


@pytest.fixture
def dirs(spark):
    return {name: fresh_dir(spark, name) for name in ("log", "out", "progress")}


def deliver(spark, dirs, lines):
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    messages.append_to_folder(frame, dirs["log"])


def run(spark, dirs, model=LINE, **options):
    stream = messages.read_folder_stream(spark, dirs["log"])
    query = speed_layer.start_speed_layer(
        stream, dirs["out"], dirs["progress"], model, trigger=None, processed_time=fx.timestamp(CLOCK), **options)
    query.awaitTermination()


def line(i, hour=8, duration=600):
    return (
        f'{{"id":"t{i}","vendor_id":1,"pickup_datetime":"2024-01-01 {hour:02d}:00:00","passenger_count":1,'
        '"pickup_longitude":-73.98,"pickup_latitude":40.75,"dropoff_longitude":-73.95,"dropoff_latitude":40.78,'
        f'"store_and_fwd_flag":"N","trip_duration":{duration}}}'
    )


def test_stream_equals_batch(spark, sf_dir, dirs):
    everything = fx.messages(spark, sf_dir)
    messages.append_to_folder(everything, dirs["log"])
    run(spark, dirs)
    batch = speed_layer.enrich(messages.decode(everything), LINE, fx.timestamp(CLOCK))
    stored = speed_files.read_batches(spark, dirs["out"]).drop("batch_id").select(*batch.columns)
    assert stored.exceptAll(batch).count() == 0 and batch.exceptAll(stored).count() == 0


def test_every_speed_column_is_written(spark, dirs):
    deliver(spark, dirs, [line(1)])
    run(spark, dirs)
    row = speed_files.read_batches(spark, dirs["out"]).first().asDict()
    assert set(row) == set(SPEED_SCHEMA.names)
    assert (row["hour"], row["day_of_week"], row["month"], row["batch_id"]) == (8, 0, 1, 0)
    assert row["prediction_error"] == pytest.approx(abs(600 - row["predicted_duration"]))


def test_restart_neither_repeats_nor_loses(spark, dirs):
    deliver(spark, dirs, [line(1), line(2)])
    run(spark, dirs)
    run(spark, dirs)
    deliver(spark, dirs, [line(3)])
    run(spark, dirs)
    rows = speed_files.read_batches(spark, dirs["out"]).orderBy("id").collect()
    assert [(r.id, r.batch_id) for r in rows] == [("t1", 0), ("t2", 0), ("t3", 1)]


def test_a_batch_run_twice_replaces_itself(spark, dirs):
    decoded = messages.decode(spark.createDataFrame([(line(1),), (line(2),)], "value string"))
    handle = speed_layer.batch_writer(spark, dirs["out"], LINE)
    handle(decoded, 4)
    handle(decoded, 4)
    assert speed_files.read_batches(spark, dirs["out"]).count() == 2


def test_empty_batches_leave_no_trace(spark, dirs):
    seen = []
    decoded = messages.decode(spark.createDataFrame([("broken",)], "value string"))
    speed_layer.batch_writer(spark, dirs["out"], LINE, after=seen.append)(decoded, 0)
    assert seen == []


def test_live_views_show_the_newest_batch_only(spark, dirs):
    deliver(spark, dirs, [line(1, hour=8), line(2, hour=9)])
    run(spark, dirs)
    deliver(spark, dirs, [line(3, hour=23, duration=100)])
    run(spark, dirs)
    assert [(r.hour, r.trip_count, r.avg_actual_duration) for r in spark.table(speed_layer.HOURLY_VIEW).collect()] == [(23, 1, 100.0)]
    assert spark.table(speed_layer.TRIPS_VIEW).count() == 1


def test_no_model_gives_null_predictions(spark, dirs):
    deliver(spark, dirs, [line(1)])
    run(spark, dirs, model=None)
    row = speed_files.read_batches(spark, dirs["out"]).first()
    assert row.predicted_duration is None and row.prediction_error is None and row.distance_km > 0


def test_decode_and_quarantine(spark):
    lines = [line(1), "not json", "", "  ", '{"id":"x","vendor_id":null}', "null", '{"id":"y","trip_duration":"many"}']
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    assert sorted(r.id for r in messages.decode(frame).collect()) == ["t1", "x"]
    assert messages.rejected(frame).count() == 3


def test_kafka_style_binary_values(spark):
    frame = spark.createDataFrame([(bytearray(line(1), "utf8"),)], "value binary")
    assert messages.decode(frame).first().id == "t1"


def test_encode_then_decode(spark, sf_dir):
    trips = fx.trips(spark, sf_dir)
    sent = messages.encode(trips, "t", F.lit("2030-01-01 00:00:00"))
    back = messages.decode(sent)
    assert back.select("pickup_datetime").distinct().first()[0] == "2030-01-01 00:00:00"
    same = ["id", "vendor_id", "passenger_count", "pickup_longitude", "dropoff_latitude", "store_and_fwd_flag", "trip_duration"]
    assert back.select(*same).exceptAll(trips.select(*same)).count() == 0
    short = messages.encode(trips, "t", F.lit("now"), keep_original=False)
    assert "original_pickup_datetime" not in short.first().value


def test_other_documents_are_not_data(spark, dirs):
    decoded = messages.decode(spark.createDataFrame([(line(1),)], "value string"))
    speed_files.write_batch(speed_layer.enrich(decoded), dirs["out"], 12)
    spark.createDataFrame([('{"topic": "x",',), ('"n": 1}',)], "value string").write.text(f"{dirs['out']}/config.json")
    assert speed_files.read_batches(spark, dirs["out"]).count() == 1
    found = speed_files.inventory(spark, dirs["out"]).collect()
    assert [(r.name, r.records) for r in found] == [("batch_id=00012", 1)]


def test_newest_batches_by_number_and_by_time(spark, dirs):
    decoded = messages.decode(spark.createDataFrame([(line(1),)], "value string"))
    for batch_id in (7, 9, 8):
        speed_files.write_batch(speed_layer.enrich(decoded), dirs["out"], batch_id)
    assert speed_files.recent_batch_ids(spark, dirs["out"], 2) == [9, 8]
    assert speed_files.recent_batch_ids(spark, dirs["out"], 2, by="modified") == [8, 9]
    assert speed_files.read_recent(spark, [dirs["out"]], 2).select("batch_id").distinct().count() == 2


def test_processing_time_trigger(spark, dirs):
    deliver(spark, dirs, [line(1), line(2)])
    stream = messages.read_folder_stream(spark, dirs["log"])
    query = speed_layer.start_speed_layer(stream, dirs["out"], dirs["progress"], LINE, trigger="1 second")
    try:
        query.processAllAvailable()
        deliver(spark, dirs, [line(3)])
        query.processAllAvailable()
    finally:
        query.stop()
    rows = speed_files.read_batches(spark, dirs["out"])
    assert sorted(r.id for r in rows.collect()) == ["t1", "t2", "t3"]
    assert rows.select("batch_id").distinct().count() == 2


def test_late_rows_are_dropped(spark, dirs):
    for lines in ([line(1, hour=1), line(2, hour=23)], [line(3, hour=2)], [line(4, hour=23)]):
        deliver(spark, dirs, lines)
        stream = messages.read_folder_stream(spark, dirs["log"])
        speed_layer.start_windowed_stats(
            stream, dirs["out"], dirs["progress"], trigger=None, width="1 hour", delay="1 hour").awaitTermination()
    rows = spark.read.parquet(dirs["out"]).collect()
    assert [(r.window_start.hour, r.trip_count) for r in rows] == [(1, 1)]


def test_offsets_of_a_progress_report(spark):
    ends = messages.offsets_from_progress(spark, '{"trips":{"0":100,"1":50}}', "end_offset")
    read = messages.offsets_from_progress(spark, '{"trips":{"0":90,"1":50}}', "committed").withColumn("group_id", F.lit("g"))
    from tripweave.operators.monitoring import consumer_lag

    assert consumer_lag(ends, read).first().lag == 10
