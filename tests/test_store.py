"""The batch store, late rows, isolated scoring, keyed state, progress and stored partials."""

import json
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_streaming import CLOCK, LINE, deliver, line
from tripweave.functions.trip import with_trip_features
from tripweave.operators import arrival, filters, monitoring, positions, quality, scoring, views
from tripweave.plans import fixtures as fx
from tripweave.session import fresh_dir, materialize, release
from tripweave.sources import messages, speed_files, trips, view_store
from tripweave.sources.batch_store import CHECKPOINT_EVERY, Batch, BatchStore
from tripweave.streaming import progress, running, speed_layer, windows


@pytest.fixture
def base(spark):
    return fresh_dir(spark, "store")


@pytest.fixture
def dirs(spark):
    return {name: fresh_dir(spark, name) for name in ("log", "out", "progress")}


def scored(spark, *lines):
    return speed_layer.enrich(messages.decode(spark.createDataFrame([(x,) for x in lines], "value string")), LINE, fx.timestamp(CLOCK))


def ids(spark, base, **options):
    return sorted(r.id for r in speed_files.read_batches(spark, base, **options).collect())


def test_no_reader_sees_half_a_batch(spark, base):
    speed_files.store_batch(scored(spark, line(1)), base, 0, "t0")
    store = BatchStore(spark, base)
    folder = store.stage(scored(spark, line(2), line(3)), 1)
    assert ids(spark, base) == ["t1"]
    before = speed_files.read_batches(spark, base)
    store.commit(Batch(1, folder, 2, "t1"))
    assert ids(spark, base) == ["t1", "t2", "t3"] and [r.id for r in before.collect()] == ["t1"]


def test_an_interrupted_batch_leaves_the_old_one(spark, base):
    speed_files.store_batch(scored(spark, line(1)), base, 4, "t0")
    failing = scored(spark, line(2), line(3)).withColumn("id", F.when(F.col("id") == "t3", F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        speed_files.store_batch(failing, base, 4, "t1")
    assert ids(spark, base) == ["t1"]
    batch = speed_files.store_batch(scored(spark, line(2), line(3)), base, 4, "t2", far=F.count(F.when(F.col("distance_km") > 1, 1)))
    assert ids(spark, base) == ["t2", "t3"] and (batch.records, batch.facts, batch.newest) == (2, {"far": 2}, "2024-02-01T00:00:00.000000")


def test_only_the_newest_folders_are_listed(spark, base):
    """Of a thousand batches in the manifest only those asked for exist at all."""
    store = BatchStore(spark, base)
    store.commit(*[Batch(i, f"batches/{i:05d}-gone", 1, f"2024-01-01T{i:06d}") for i in range(1000)])
    for i in (1000, 1001, 1002):
        speed_files.store_batch(scored(spark, line(i)), base, i, f"2024-01-02T{i}")
    assert speed_files.recent_batch_ids(spark, base, 3) == [1002, 1001, 1000]
    assert sorted(r.id for r in speed_files.read_recent(spark, [base], 3).collect()) == ["t1000", "t1001", "t1002"]
    assert ids(spark, base, batch_id=1001) == ["t1001"]
    assert speed_files.inventory(spark, base).count() == 1003


def test_writers_do_not_overwrite_each_other(spark, base):
    one, two = BatchStore(spark, base), BatchStore(spark, base)
    seen = one.snapshot()
    two.commit(Batch(1, "batches/a", 1, "t"))
    # A writer that still believes in the old version cannot take the version again.
    assert not one._create(f"{base}/_manifest/{seen.version + 1:020d}.json", "{}")
    one.commit(Batch(2, "batches/b", 1, "t"))
    assert sorted(two.snapshot().batches) == [1, 2] and two.snapshot().version == 2


def test_the_manifest_is_compacted(spark, base):
    store = BatchStore(spark, base)
    for i in range(3 * CHECKPOINT_EVERY + 7):
        store.commit(Batch(i, f"batches/{i}", i, "t"))
    names = [n for n in store._names(f"{base}/_manifest") if not n.startswith(".")]
    assert len(names) <= 2 * CHECKPOINT_EVERY + 10
    assert {i: b.records for i, b in store.snapshot().batches.items()} == {i: i for i in range(3 * CHECKPOINT_EVERY + 7)}


def test_retention_deletes_expired_batches_only(spark, base):
    store = BatchStore(spark, base)
    rows = spark.createDataFrame([(b, f"t{b}{k}", f"2024-01-0{b} 0{k}:00:00") for b in (1, 2, 3) for k in (1, 2)], "batch_id int, id string, processed_time string")
    store.write_many(rows, "t")
    speed_files.store_batch(scored(spark, line(9)), base, 9, "t")
    reader = speed_files.read_batches(spark, base)
    gone = filters.expire_batches(store, "2024-01-03 02:00:00")
    assert [(b.batch_id, b.records) for b in gone] == [(1, 2)]
    assert sorted(store.snapshot().batches) == [2, 3, 9] and reader.count() == 7
    assert store.vacuum(3600) == [] and reader.count() == 7
    staged = store.stage(scored(spark, line(8)), 8)
    deleted = store.vacuum(0)
    assert len(deleted) == 2 and staged in deleted and deleted[-1].endswith("batch_id=1")
    assert ids(spark, base) == ["t21", "t22", "t31", "t32", "t9"]
    assert filters.expire_batches(store, "2024-01-03 02:00:00") == [] == store.vacuum(0)


def run_windows(spark, dirs, *deliveries):
    for lines in deliveries:
        deliver(spark, dirs, lines)
        stream = messages.read_folder_stream(spark, dirs["log"])
        windows.start_windowed_counts(stream, dirs["out"], dirs["progress"], trigger=None, width=3600, delay=3600).awaitTermination()
    return {r.window_start.hour: (r.trip_count, r.late_count, r.is_final) for r in windows.read_windows(spark, dirs["out"], 3600, 3600).collect()}


def test_late_rows_are_counted(spark, dirs):
    untimed = line(9).replace("2024-01-01 08:00:00", "soon")
    found = run_windows(spark, dirs, [line(1, 1), line(2, 5)], [line(3, 2), line(4, 4), line(5, 1), untimed], [line(6, 9)], [line(7, 5), line(8, 2)])
    assert found == {1: (1, 1, True), 2: (0, 2, True), 4: (1, 0, True), 5: (1, 1, True), 9: (1, 0, False)}
    assert windows.read_undated(spark, dirs["out"]).first().undated == 1


def test_a_window_batch_run_twice_counts_once(spark, base):
    handle = windows.window_writer(spark, base, 3600, 3600)
    def batch(*lines):
        return messages.decode(spark.createDataFrame([(x,) for x in lines], "value string")).withColumn(
            "pickup_datetime", F.try_to_timestamp("pickup_datetime", F.lit("yyyy-MM-dd HH:mm:ss")))

    handle(batch(line(1, 1), line(2, 6)), 0)
    for _ in range(2):
        handle(batch(line(3, 1), line(4, 6)), 1)
    handle(batch(), 2)
    found = {r.window_start.hour: (r.trip_count, r.late_count) for r in windows.read_windows(spark, base, 3600, 3600).collect()}
    assert found == {1: (1, 1), 6: (2, 0)}
    empty = fresh_dir(spark, "none")
    assert windows.read_windows(spark, empty).count() == 0 and windows.read_undated(spark, empty).first().undated == 0


def test_rows_no_model_can_score_are_null_and_counted(spark, dirs):
    bad = [line(2).replace("2024-01-01 08:00:00", "soon"), line(3).replace("40.75", "NaN"), line(4).replace("-73.95", "null")]
    for lines in ([line(1), *bad], [line(5)]):
        deliver(spark, dirs, lines)
        stream = messages.read_folder_stream(spark, dirs["log"])
        speed_layer.start_speed_layer(stream, dirs["out"], dirs["progress"], LINE, trigger=None).awaitTermination()
    found = {r.id: r.predicted_duration is None for r in speed_files.read_batches(spark, dirs["out"]).collect()}
    assert found == {"t1": False, "t2": True, "t3": True, "t4": False, "t5": False}
    assert [tuple(r) for r in BatchStore(spark, dirs["out"]).facts("unscored").collect()] == [(0, 4, 2), (1, 1, 0)]


def test_a_foreign_model_fails_on_its_rows_only(spark):
    def predict(frame: pd.DataFrame):
        if (frame["passenger_count"] == 7).any():
            raise RuntimeError("seven")
        return frame["distance_km"] * 2

    lines = [line(i).replace('"passenger_count":1', f'"passenger_count":{i % 10}') for i in range(100)]
    decoded = messages.decode(spark.createDataFrame([(x,) for x in lines], "value string"))
    found = speed_layer.enrich(decoded, scoring.ForeignModel(predict)).collect()
    assert len(found) == 100 and all((r.predicted_duration is None) == (r.passenger_count == 7) for r in found)
    short = scoring.ForeignModel(lambda frame: [1.0])
    assert {r.predicted_duration for r in speed_layer.enrich(decoded, short).collect()} == {1.0}


def test_a_model_of_other_columns_is_refused_before_the_stream(spark, dirs):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rows = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 3.0, 4.0), (3.0, 1.0, 1.0)], "distance_km double, weather double, trip_duration double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["distance_km", "weather"], outputCol="features"), LinearRegression(labelCol="trip_duration")]).fit(rows)
    stream = spark.readStream.format("rate").load().selectExpr("CAST(value AS STRING) AS value")
    with pytest.raises(ValueError, match="weather"):
        speed_layer.start_speed_layer(stream, dirs["out"], dirs["progress"], model)

    class NoPrediction:
        def transform(self, frame):
            return frame

    with pytest.raises(ValueError, match="prediction"):
        speed_layer.start_speed_layer(stream, dirs["out"], dirs["progress"], NoPrediction())


def test_running_error_on_the_stream_equals_the_batch_form(spark, dirs):
    def run(trigger=None, size=4):
        decoded = messages.decode(messages.read_folder_stream(spark, dirs["log"]))
        return running.start_running_error(speed_layer.enrich(decoded, LINE), dirs["out"], dirs["progress"], "vendor_id", ["pickup_datetime", "id"],
                                           size=size, flush_ms=500, trigger=trigger)

    first = [line(i, hour=i % 5, duration=100 * i) for i in range(1, 7)] + [line(50, 4).replace("40.75", "NaN")]
    second = [line(i, hour=6 + i % 3, duration=10 * i) for i in range(7, 13)]
    deliver(spark, dirs, first)
    run().awaitTermination()
    assert spark.read.parquet(dirs["out"]).count() == 4
    deliver(spark, dirs, second)
    query = run(trigger="200 milliseconds")
    try:
        for _ in range(60):
            if spark.read.parquet(dirs["out"]).count() == 13:
                break
            time.sleep(1)
    finally:
        query.stop()
    got = {r.id: (r.processed, round(r.avg_error, 6), r.batch_id) for r in spark.read.parquet(dirs["out"]).collect()}
    everything = speed_layer.enrich(messages.decode(spark.createDataFrame([(x,) for x in first + second], "value string")), LINE)
    want = arrival.running_error(everything, ["pickup_datetime", "id"]).collect()
    assert got == {r.id: (r.processed, round(r.avg_error, 6), (r.processed - 1) // 4) for r in want}


def test_progress_outlives_the_query(spark, dirs):
    reports = fresh_dir(spark, "reports")
    listener = progress.ProgressLog(spark, reports).attach()
    try:
        for lines in ([line(1), line(2)], [line(3)]):
            deliver(spark, dirs, lines)
            stream = messages.read_folder_stream(spark, dirs["log"])
            speed_layer.start_ingest(stream, dirs["out"], dirs["progress"], trigger=None, name="reader").awaitTermination()
        progress.wait_for_reports(spark)
    finally:
        listener.detach()
    deliver(spark, dirs, [line(4), line(5)])
    table = progress.read_progress(spark, reports).filter("name = 'reader'")
    assert sorted((r.batch_id, r.input_rows) for r in table.filter("input_rows > 0").collect()) == [(0, 2), (1, 1)]
    lag = monitoring.consumer_lag(progress.folder_ends(spark, dirs["log"], "t"), progress.rows_read(table, "t")).first()
    assert (lag.group_id, lag.lag, lag.committed_total) == ("reader", 2, 3)


def test_offsets_of_reports_on_a_topic(spark):
    rows = [dict(query_id="q", name="g", batch_id=b, source="Kafka[t]", end_offset=json.dumps({"t": {"0": 10 * b, "1": 5}}),
                 latest_offset=json.dumps({"t": {"0": 40, "1": 9}})) for b in (1, 3, 2)]
    table = spark.createDataFrame(rows, progress.PROGRESS)
    read, ends = progress.offsets_read(table), progress.offsets_read(table, "latest_offset", "end_offset").drop("group_id")
    assert sorted((r.topic, r.partition, r.group_id, r.committed) for r in read.collect()) == [("t", 0, "g", 30), ("t", 1, "g", 5)]
    assert monitoring.consumer_lag(ends, read).first().lag == 14


def test_facts_come_from_the_pass_that_writes(spark, sf_dir):
    rows = fx.trips(spark, sf_dir)
    counted = quality.ObservedFacts(rows)
    trips.write_trips(with_trip_features(filters.clean_rows(counted.trips)), fresh_dir(spark, "clean"))
    assert counted.frame().collect() == quality.raw_facts(rows).collect()
    plan = counted.trips._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "CollectMetrics" in plan


def test_stored_days_merge_into_the_summary(spark, sf_dir):
    rows, base = fx.clean(spark, sf_dir), fresh_dir(spark, "partials")
    cut = fx.timestamp("2024-01-12 00:00:00")
    for part in (rows.filter(F.col("pickup_datetime") < cut), rows.filter(F.col("pickup_datetime") >= cut), rows.filter(F.col("pickup_datetime") >= cut)):
        view_store.write_partials(part, base)
    near = lambda f: [round(x, 6) if isinstance(x, float) else x for x in f.first()]
    assert near(view_store.read_summary(spark, base, "d")) == near(views.daily_summary(rows, "d"))
    some = rows.filter((F.col("pickup_datetime") >= cut) & (F.col("pickup_datetime") < fx.timestamp("2024-01-15 00:00:00")))
    assert near(view_store.read_summary(spark, base, "d", "20240112", "20240114")) == near(views.daily_summary(some, "d"))


def test_healthy_rounds_leave_metrics(spark):
    row = lambda **c: spark.createDataFrame([tuple(c.values())], list(c))
    checks = {"a": row(ok=True, n=1), "b": row(ok=True, n=2)}
    good = monitoring.circuit_breaker({k: (f, "ok") for k, f in checks.items()})
    document = json.loads(monitoring.healthy_metrics(good, checks, F.lit("now")).first().document)
    assert document == {"generated_at": "now", "metrics": {"a": {"ok": True, "n": 1}, "b": {"ok": True, "n": 2}}}
    bad = monitoring.circuit_breaker({"a": (row(ok=False), "ok")})
    assert monitoring.healthy_metrics(bad, checks, F.lit("now")).count() == 0


def test_positions_are_sized_by_the_input_and_released(spark):
    rows = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("k"))
    assert positions._sort_partitions(rows) == 8
    placed = positions.with_positions(rows, ["k", "id"], "at", {"total": F.when(F.col("id") > 3, F.col("id"))})
    got = [(r["at"], r["total"]) for r in placed.orderBy("at").collect()]
    want, total = [], 0
    for i, x in enumerate(sorted(range(1000), key=lambda x: (x % 7, x))):
        total += x if x > 3 else 0
        want.append((i, float(total)))
    assert got == want
    assert "SortMergeJoin" not in placed._jdf.queryExecution().toString()
    kept = materialize(rows)
    assert kept.count() == 1000 and release(spark) >= 2 and release(spark) == 0


def test_running_error_holds_no_more_than_a_chunk(spark):
    """Chunks of a key come in order and leave as they come; nothing but the partial batch waits."""
    class Value:
        def __init__(self):
            self.v = None

        exists = lambda self: self.v is not None
        get = lambda self: self.v

        def update(self, v):
            self.v = v

        put, clear = update, lambda self: self.update(None)

    class Clock:
        getCurrentProcessingTimeInMs = staticmethod(lambda: 0)

    p, read = running.RunningError(4, 500), []
    p.totals, p.waiting, p._set_timer = Value(), Value(), lambda at: None

    def chunks():
        for k in range(5):
            read.append(k)
            yield pd.DataFrame({"id": [f"t{k}{i}" for i in range(6)], "prediction_error": [1.0 * k] * 6})

    out = p.handleInputRows(("1",), chunks(), Clock)
    first = next(out)
    assert read == [0] and first["id"].tolist() == ["t00", "t01", "t02", "t03"]
    rest = pd.concat([first, *out])
    assert rest["processed"].tolist() == list(range(1, 29)) and p.totals.v == (30, 60.0) and [x[0] for x in p.waiting.v] == ["t44", "t45"]
    assert rest["avg_error"].tolist()[6] == pytest.approx(1 / 7)
