import datetime
import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tripweave.functions import trip as fn
from tripweave.operators import arrival, filters, monitoring, positions, quality, scoring, serving, statistics, views
from tripweave.operators.training import is_test_row, scale_with, scaling
from tripweave.schemas import MASTER_SIMPLE_SCHEMA, conform, missing_columns, require_columns
from tripweave.sources.master import master_batch_id, master_simple

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def values(df, column):
    return [r[column] for r in df.collect()]


# -- scalars ---------------------------------------------------------------------------------

def test_haversine_of_known_points(spark):
    km = spark.range(1).select(fn.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)).alias("km")).first().km
    assert km == pytest.approx(math.pi * 6371 / 2)


def test_haversine_of_null_is_null(spark):
    null = F.lit(None).cast("double")
    assert spark.range(1).select(fn.haversine_km(null, F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("km")).first().km is None


def test_speed_is_zero_where_undefined(trip_frame):
    rows = fn.with_trip_features(trip_frame({"trip_duration": 0}, {"dropoff_latitude": None}, {}))
    speeds = values(rows.orderBy("id"), "speed_kmh")
    assert speeds[0] == 0.0 and speeds[1] == 0.0 and speeds[2] > 0


def test_grid_ties_go_to_even(spark):
    cells = spark.createDataFrame([(0.25,), (0.75,), (-0.25,), (40.75,)], "x double").select(fn.grid(F.col("x")).alias("g"))
    assert values(cells, "g") == [0.2, 0.8, -0.2, 40.8]


def test_calendar(trip_frame):
    rows = fn.with_trip_features(trip_frame(
        {"pickup_datetime": datetime.datetime(2024, 1, 6, 19)}, {"pickup_datetime": datetime.datetime(2024, 1, 8, 10)},
    )).orderBy("id").collect()
    assert [(r.day_of_week, r.is_weekend, r.is_rush_hour, r.month) for r in rows] == [(5, 1, 1, 1), (0, 0, 0, 1)]


def test_parse_pickup_gives_null_for_other_shapes(spark):
    parsed = spark.createDataFrame([("2024-01-01 10:11:12",), ("01/02/2024",), (None,)], "t string").select(
        fn.parse_pickup(F.col("t")).alias("p"))
    assert values(parsed, "p") == [datetime.datetime(2024, 1, 1, 10, 11, 12), None, None]


def test_batch_key_golden_value(spark):
    key = spark.range(1).select(fn.batch_key(F.lit("20251229"), F.lit(1447670)).alias("k")).first().k
    assert key == "de40b6a5ed94"


def test_unknown_vendor_has_no_label(spark):
    labels = spark.createDataFrame([(1,), (2,), (3,)], "v int").select(fn.vendor_label(F.col("v")).alias("l"))
    assert values(labels, "l") == ["Vendor 1", "Vendor 2", None]


# -- filters and quality ---------------------------------------------------------------------

def test_clean_bounds(trip_frame):
    keep = [
        {"trip_duration": 60}, {"trip_duration": 7200}, {"passenger_count": 9},
        {"pickup_latitude": 40.4}, {"pickup_latitude": 41.0}, {"pickup_longitude": -74.3}, {"pickup_longitude": -73.7},
        {"dropoff_latitude": 0.0},
    ]
    drop = [
        {"trip_duration": 59}, {"trip_duration": 7201}, {"trip_duration": None}, {"passenger_count": 0},
        {"passenger_count": 10}, {"passenger_count": None}, {"pickup_latitude": 40.39}, {"pickup_longitude": -73.69},
    ]
    assert filters.clean_rows(trip_frame(*keep)).count() == len(keep)
    assert filters.clean_rows(trip_frame(*drop)).count() == 0


def test_map_bounds_are_strict(trip_frame):
    points = trip_frame({"pickup_latitude": 40.5}, {"pickup_latitude": 41.0}, {"pickup_longitude": -74.3}, {})
    assert serving.pickup_map_points(points).count() == 1


def test_anomalies_are_a_union(trip_frame):
    rows = trip_frame(
        {"trip_duration": 59, "pickup_latitude": 10.0}, {"trip_duration": 10800}, {"trip_duration": 10801},
        {"passenger_count": 0}, {"passenger_count": -1}, {"passenger_count": None, "trip_duration": None},
    )
    found = quality.anomaly_counts(quality.raw_facts(rows)).first()
    assert (found.geographic_anomalies, found.duration_anomalies, found.passenger_anomalies, found.total_anomalies) == (1, 2, 1, 3)
    assert found.anomaly_percentage == 50.0


def test_quality_of_empty_table(trip_frame, spark):
    facts = quality.raw_facts(trip_frame({}).filter("false"))
    assert quality.quality_score(facts).first().row_count == 0
    assert quality.anomaly_counts(facts).first().anomaly_percentage == 0.0


def test_quality_gate(trip_frame):
    bad = {"passenger_count": None, "pickup_latitude": None, "trip_duration": None}
    gate = quality.quality_gate(quality.raw_facts(trip_frame({}, bad))).first()
    assert gate.quality_score == pytest.approx(1 - 150 / 900) and not gate.passed


def test_missing_columns(trip_frame):
    lacking = trip_frame({}).drop("id", "trip_duration")
    assert missing_columns(lacking) == ["id", "trip_duration"]
    with pytest.raises(ValueError, match="id, trip_duration"):
        require_columns(lacking)
    assert quality.missing_column_report(trip_frame({})).count() == 0


# -- statistics ------------------------------------------------------------------------------

@FEW
@given(st.lists(st.integers(-20000, 20000), min_size=1, max_size=60))
def test_medians_equal_sorting(spark, numbers):
    ordered, n = sorted(numbers), len(numbers)
    want = (ordered[(n - 1) // 2] + ordered[n // 2]) / 2
    df = spark.createDataFrame([(x,) for x in numbers], "v int")
    assert statistics.exact_median(df, "v") == want
    assert statistics.frequency_median(statistics.frequencies(df, "v"), "v").first().median == want


def test_exact_median_of_skewed_doubles(spark):
    numbers = [0.1] * 50 + [1e12, 1e-9, 0.1000000001, 0.2, None] + [0.3] * 49
    known = sorted(x for x in numbers if x is not None)
    df = spark.createDataFrame([(x,) for x in numbers], "v double")
    assert statistics.exact_median(df, "v") == (known[(len(known) - 1) // 2] + known[len(known) // 2]) / 2
    assert statistics.exact_median(df.filter("v is null"), "v") is None


def test_fill_uses_half_for_even_counts(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    filled = statistics.fill_with(df, statistics.medians(df, ["v"]))
    assert sorted(values(filled, "v")) == [1.0, 1.5, 2.0]


def test_weighted_stddev(spark):
    df = spark.createDataFrame([(60, 3), (7200, 2), (100, 1)], "v int, n bigint")
    flat = [60] * 3 + [7200] * 2 + [100]
    mean = sum(flat) / 6
    want = math.sqrt(sum((x - mean) ** 2 for x in flat) / 5)
    assert df.agg(statistics.weighted_stddev("v", "n").alias("s")).first().s == pytest.approx(want, rel=1e-12)
    assert df.filter("n = 1").agg(statistics.weighted_stddev("v", "n").alias("s")).first().s is None


def test_scaling_of_constant_feature(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0)], "id string, x double, c double")
    rows = scale_with(df, scaling(df, ["x", "c"]), ["x", "c"]).orderBy("id").collect()
    assert [(r.x, r.c) for r in rows] == [(-1.0, 0.0), (1.0, 0.0)]


# -- views -----------------------------------------------------------------------------------

def test_one_trip_has_no_deviation(trip_frame):
    clean = fn.with_trip_features(trip_frame({}))
    assert views.hourly_stats(clean).first().std_duration is None
    daily = views.daily_summary(clean, "20240101").first()
    assert daily.std_duration is None and daily.median_duration == 600.0 and daily.date == "20240101"


def test_daily_summary_of_nothing(trip_frame):
    daily = views.daily_summary(fn.with_trip_features(trip_frame({}).filter("false")), "20240101").first()
    assert (daily.total_trips, daily.total_passengers, daily.avg_duration, daily.median_duration) == (0, 0, None, None)


# -- positions -------------------------------------------------------------------------------

def test_positions_with_a_hot_key_and_copies(spark):
    rows = [(1, f"a{i:03d}") for i in range(40)] + [(1, "copy")] * 60 + [(i, "z") for i in range(2, 52)]
    df = spark.createDataFrame(rows, "ts int, id string").repartition(7)
    placed = positions.with_positions(df, ["ts", "id"], "at", {"total": F.col("ts")}).orderBy("at").collect()
    assert [r.at for r in placed] == list(range(150))
    assert [(r.ts, r.id) for r in placed] == sorted(rows)
    running, total = [], 0
    for ts, _ in sorted(rows):
        total += ts
        running.append(total)
    assert [r.total for r in placed] == running


def test_positions_split_a_hot_group_over_tasks(spark):
    df = spark.range(20000).select(F.lit(1).alias("k"), F.lit("same").alias("id"))
    placed = positions.with_positions(df, ["k", "id"], "at")
    assert placed.select(F.countDistinct("at")).first()[0] == 20000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows here are few
    try:
        ordered = df.withColumn("_tie", F.monotonically_increasing_id()).orderBy("k", "id", "_tie")
        assert max(ordered.rdd.glom().map(len).collect()) < 10000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_count_batches_flushes_the_rest(spark):
    df = spark.range(23).withColumnRenamed("id", "n")
    sizes = arrival.count_batches(df, ["n"]).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [(r.batch_id, r["count"]) for r in sizes] == [(0, 10), (1, 10), (2, 3)]


def test_running_error_counts_unscored_rows(spark):
    df = spark.createDataFrame([(1, 4.0), (2, None), (3, 5.0)], "n int, prediction_error double")
    rows = arrival.running_error(df, ["n"]).orderBy("n").collect()
    assert [r.avg_error for r in rows] == [4.0, 2.0, 3.0]


def test_offsets_restart_in_each_partition(spark):
    df = spark.range(1000).select((F.col("id") % 10 == 0).cast("int").alias("p"), "id")
    found = arrival.offsets_within(df, "p", ["id"]).groupBy("p").agg(F.min("offset"), F.max("offset"), F.count("*"))
    assert sorted(tuple(r) for r in found.collect()) == [(0, 0, 899, 900), (1, 0, 99, 100)]


@pytest.mark.parametrize("rows,hour,want", [(5000, 3, (150, 200)), (200, 13, (50, 100)), (20, 13, (0, 50))])
def test_replay_bounds(rows, hour, want):
    assert positions.replay_bounds(rows, hour, 50) == want


# -- scoring and serving ---------------------------------------------------------------------

def test_metrics_equal_the_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    df = spark.createDataFrame([(600, 580.0), (300, 410.0), (900, 850.0), (100, 120.0)],
                               "trip_duration int, predicted_duration double")
    row = scoring.regression_metrics(df).first()
    typed = df.withColumn("trip_duration", F.col("trip_duration").cast("double"))
    for name in ("rmse", "mae", "r2"):
        judge = RegressionEvaluator(labelCol="trip_duration", predictionCol="predicted_duration", metricName=name)
        assert row[name] == pytest.approx(judge.evaluate(typed))


def test_missing_features_score_as_zero_and_stay_null(spark):
    df = spark.createDataFrame([("a", None, 100)], "id string, distance_km double, trip_duration int")
    row = scoring.score(df, scoring.LinearModel(10.0, 60.0)).first()
    assert row.distance_km is None and row.predicted_duration == 60.0 and row.prediction_error == 40.0


def test_model_gate_without_metrics(spark):
    assert not scoring.model_gate(spark.createDataFrame([], "r2 double")).first().passed
    assert scoring.model_gate(spark.createDataFrame([(0.7,)], "r2 double")).first().passed


def test_reconcile_verdicts(spark):
    daily = spark.createDataFrame([(10, 100.0)], "total_trips bigint, avg_duration double")
    speed = spark.createDataFrame([(100,), (None,)], "trip_duration int")
    row = serving.reconcile_layers(daily, speed, "d").first()
    assert (row.status, row.discrepancies, row.diff_pct) == ("discrepancy_detected", "Mean durations are apart by 50.00%", 50.0)
    assert serving.reconcile_layers(daily, speed.filter("trip_duration = 100"), "d").first().status == "consistent"
    assert serving.reconcile_layers(daily, speed.filter("false"), "d").first().status == "incomplete_data"
    assert serving.reconcile_layers(daily.filter("false"), speed, "d").first().status == "incomplete_data"


def test_split_is_stable(spark):
    ids = spark.range(1000).select(F.concat(F.lit("id"), "id").alias("id"))
    marked = {r.id for r in ids.filter(is_test_row()).collect()}
    again = {r.id for r in ids.repartition(5).filter(is_test_row()).collect()}
    assert marked == again and 140 < len(marked) < 260


# -- master records --------------------------------------------------------------------------

def test_master_defaults_apply_to_absent_columns_only(trip_frame):
    rows = trip_frame({"store_and_fwd_flag": None})
    given, absent = master_simple(rows, "d").first(), master_simple(rows.drop("store_and_fwd_flag"), "d").first()
    assert given.store_and_fwd_flag is None and absent.store_and_fwd_flag == "N"
    assert given.dropoff_datetime == "" and given.pickup_datetime == "2024-01-01 08:30:00"
    assert conform(rows, MASTER_SIMPLE_SCHEMA).schema.names == MASTER_SIMPLE_SCHEMA.names


def test_master_batch_id_depends_on_count(trip_frame):
    one = master_batch_id(trip_frame({}), "20240101").first()
    two = master_batch_id(trip_frame({}, {}), "20240101").first()
    assert one.batch_id != two.batch_id and len(one.batch_id) == 12


# -- monitoring ------------------------------------------------------------------------------

LINES = [
    '{"id":"a","vendor_id":1,"passenger_count":2,"trip_duration":100}',
    '{"id":"b","vendor_id":null,"passenger_count":-1,"trip_duration":5}',
    '{"id":"c","trip_duration":-3}',
    "not json", "", "   ",
]


def test_record_errors(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    found = {r.error: r.n for r in monitoring.speed_record_errors(lines).collect()}
    assert found == {"negative_passengers": 1, "missing_vendor_id": 1, "missing_passenger_count": 1, "negative_duration": 1}
    row = monitoring.speed_record_quality(lines).first()
    assert (row.line_count, row.sample_size, row.valid_records, row.is_acceptable) == (4, 3, 1, False)


def test_record_quality_without_lines_or_without_records(spark):
    none = spark.createDataFrame([], "value string")
    junk = spark.createDataFrame([("nope",)], "value string")
    assert monitoring.speed_record_quality(none).first().is_acceptable
    row = monitoring.speed_record_quality(junk).first()
    assert row.quality_score == 0.0 and not row.is_acceptable


def test_lag(spark):
    offsets = spark.createDataFrame([("t", 0, 0, 100), ("t", 1, 0, 50)], "topic string, partition int, begin_offset bigint, end_offset bigint")
    commits = spark.createDataFrame([("g", "t", 0, 90), ("g", "t", 1, 50), ("h", "t", 7, 3)],
                                    "group_id string, topic string, partition int, committed bigint")
    rows = {r.group_id: r for r in monitoring.consumer_lag(offsets, commits).collect()}
    assert (rows["g"].lag, rows["g"].committed_total, rows["h"].lag, rows["g"].total_lag) == (10, 140, 0, 10)
    assert not {r.group_id: r for r in monitoring.consumer_lag(offsets, commits, limit=9).collect()}["g"].is_acceptable


def _at(text):
    return F.lit(text).cast("timestamp_ntz")


def test_freshness_and_activity(spark):
    writes = spark.createDataFrame([(datetime.datetime(2024, 1, 1, 10),)], "t timestamp_ntz")
    assert monitoring.speed_freshness(writes, "t", _at("2024-01-01 10:10:00")).first().is_fresh
    assert not monitoring.speed_freshness(writes, "t", _at("2024-01-01 10:10:01")).first().is_fresh
    assert monitoring.speed_freshness(writes.filter("false"), "t", _at("2024-01-01 10:10:00")).first().is_fresh
    log = writes.withColumnRenamed("t", "timestamp")
    assert monitoring.producer_activity(log, _at("2024-01-01 10:04:59")).first().producer_active
    assert not monitoring.producer_activity(log, _at("2024-01-01 10:05:00")).first().producer_active
    assert not monitoring.producer_activity(log.filter("false"), _at("2024-01-01 10:05:00")).first().producer_active


def test_throughput(spark):
    rows = spark.createDataFrame(
        [(1, datetime.datetime(2024, 1, 1, 9)), (1, datetime.datetime(2024, 1, 1, 9, 30)), (2, datetime.datetime(2024, 1, 1, 8))],
        "f int, t timestamp_ntz")
    row = monitoring.speed_throughput(rows, "f", "t", _at("2024-01-01 10:00:00")).first()
    assert (row.files, row.total_records, row.files_last_hour, row.records_last_hour, row.is_healthy) == (2, 3, 1, 2, False)
    edge = monitoring.speed_throughput(rows, "f", "t", _at("2024-01-01 10:30:00")).first()
    assert edge.files_last_hour == 0
    assert monitoring.speed_throughput(rows.filter("false"), "f", "t", _at("2024-01-01 10:00:00")).first().is_healthy


def test_circuit_breaker(spark):
    def check(value):
        return spark.createDataFrame([(value,)], "ok boolean"), "ok"

    verdict = monitoring.circuit_breaker({"a": check(True), "b": check(False), "c": None, "d": check(None), "e": check(False)})
    row = verdict.first()
    assert (row.failed_checks, row.failed_count, row.action) == ("b, e", 2, "alert")
    assert monitoring.alerts(verdict).first().message == "Checks of the stream failed: b, e"
    healthy = monitoring.circuit_breaker({"a": check(True), "c": None})
    assert healthy.first().action == "continue" and monitoring.alerts(healthy).count() == 0


def test_topic_health_of_absent_topic(spark):
    offsets = spark.createDataFrame([], "topic string, partition int, begin_offset bigint, end_offset bigint")
    row = monitoring.topic_health(offsets, "t").first()
    assert (row.topic_exists, row.partitions, row.message_count_estimate, row.topic_healthy) == (False, 0, 0, False)


@pytest.mark.parametrize("values, want", [
    ([1.0, 2.0, 5.0, float("inf"), float("inf")], 5.0), ([float("-inf"), 1.0, 2.0], 1.0), ([-1.7e308, 2.0, 1.7e308], 2.0),
    ([float("-inf"), float("inf"), 3.0, 4.0, 5.0, float("nan"), None], 4.0),
])
def test_median_ends_whatever_the_range(spark, values, want):
    from tripweave.operators.statistics import exact_median

    assert exact_median(spark.createDataFrame([(v,) for v in values], "x double"), "x") == want


def test_not_a_number_is_missing(spark, trip_frame):
    from tripweave.functions.trip import speed_kmh
    from tripweave.operators.quality import raw_facts

    facts = raw_facts(trip_frame({}, {"pickup_latitude": float("nan")}, {"pickup_latitude": 0.0})).first()
    assert (facts.geographic_anomalies, facts.nulls_pickup_latitude) == (1, 1)
    assert spark.range(1).select(speed_kmh(F.lit(float("nan")), F.lit(60)).alias("v")).first().v == 0.0


def test_speed_files_give_the_same_rows_for_any_columns(spark, tmp_path):
    from tripweave.sources import speed_files

    folder = tmp_path / "batch_id=00003"
    folder.mkdir()
    (folder / "part-0.json").write_text("\n".join([
        '{"id":"a","vendor_id":1,"passenger_count":1.0,"trip_duration":100}', '{"id":"b","vendor_id":1,"trip_duration":"long"}',
        '{"id":"c","passenger_count":1.5,"trip_duration":7}', "not json", "\t", "", '{"id":"d","trip_duration":9}']))
    base = str(tmp_path)
    rows = speed_files.read_batches(spark, base)
    assert sorted((r.id, r.passenger_count, r.batch_id) for r in rows.collect()) == [("a", 1, 3), ("d", None, 3)]
    assert {rows.select(c).count() for c in rows.columns} == {2} and rows.count() == 2
    assert speed_files.read_rejects(spark, base).count() == 3
    assert speed_files.inventory(spark, base).first().records == 5


def test_the_live_view_opens_one_batch(spark, tmp_path):
    from tripweave.sources import speed_files
    from tripweave.streaming import speed_layer

    for i in range(4):
        speed_files.write_batch(spark.createDataFrame([(f"t{i}",)], "id string"), str(tmp_path), i)
    speed_layer.register_live_views(spark, str(tmp_path), 2)
    view = spark.table(speed_layer.TRIPS_VIEW)
    assert [r.id for r in view.collect()] == ["t2"] and all("batch_id=00002" in f for f in view.inputFiles())


def test_medians_of_many_columns_share_their_passes(spark):
    import statistics as plain

    rows = spark.range(4000).select(*[
        F.when(F.col("id") % (k + 7) != 0, F.pow(F.col("id") * (k + 1) % 997, F.lit(k)) / 3).alias(f"c{k}") for k in range(1, 7)])
    names = rows.columns
    spark.sparkContext.setJobGroup("medians", "medians")
    found = statistics.medians(rows, names)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("medians"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    data = rows.collect()
    for c in names:
        assert found[c] == pytest.approx(plain.median([r[c] for r in data if r[c] is not None]))
    # The facts and at most four passes for six columns; each action is up to three jobs.
    assert 0 < jobs <= 15
