"""DuckDB SQL equivalent of each registered query, over the provided tables."""

from __future__ import annotations

from tripweave.plans.fixtures import AS_OF, DELIVERY_CUT, HELD_BACK, MESSAGE_KIND, RUN_DATE, STREAM_START, TOPIC, TRIP_COLUMNS, UNSCORABLE_KIND
from tripweave.schemas import TRAINING_FEATURES
from tripweave.settings import MAX_DATA_AGE_MINUTES, RECORD_QUALITY_THRESHOLD

_TRIPS = ", ".join(f"{expr} AS {name}" for name, expr in TRIP_COLUMNS.items())
_CLEAN = (
    "trip_duration BETWEEN 60 AND 7200 AND passenger_count > 0 AND passenger_count <= 9 "
    "AND pickup_latitude BETWEEN 40.4 AND 41.0 AND pickup_longitude BETWEEN -74.3 AND -73.7"
)
_GEO = "(pickup_latitude < 40.4 OR pickup_latitude > 41.0 OR pickup_longitude < -74.3 OR pickup_longitude > -73.7)"
_DUR = "(trip_duration < 60 OR trip_duration > 10800)"
_PAS = "(passenger_count < 0 OR passenger_count > 9)"
_REQUIRED = [
    "id", "vendor_id", "pickup_datetime", "passenger_count", "pickup_longitude",
    "pickup_latitude", "dropoff_longitude", "dropoff_latitude", "trip_duration",
]
_SECOND = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"12742 * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) "
        f"* cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))"
    )


_KM = _haversine("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")


def _verdict(age: float, share: float) -> str:
    """The failed checks, by age in minutes and share of valid records."""
    return (
        "SELECT concat_ws(', ', fresh, rate, valid) AS failed, "
        "CAST((fresh IS NOT NULL)::INT + (rate IS NOT NULL)::INT + (valid IS NOT NULL)::INT AS INT) AS n FROM (SELECT "
        f"CASE WHEN (SELECT epoch(TIMESTAMP '{AS_OF}' - max(processed_time)) / 60 FROM stamped) > {age} THEN 'data_fresh' END AS fresh, "
        "CASE WHEN NOT (SELECT is_healthy FROM throughput) THEN 'throughput_ok' END AS rate, "
        f"CASE WHEN (SELECT valid_records / sample_size::DOUBLE FROM records) < {share} THEN 'quality_ok' END AS valid)"
    )


# What must hold of a fitted model, counted over the rows it is measured on.
_FITTED = "count(*) AS samples, true AS mae_within_rmse"
_TEST_PART = (
    "(SELECT id FROM trips WHERE trip_duration BETWEEN 60 AND 7200 AND substr(md5(id), 1, 2) < '33') AS unseen"
)

# Named relations; each may use those above it.
_RELATIONS = {
    "trips": f"SELECT {_TRIPS} FROM events",
    "feat": (
        "SELECT *, CASE WHEN day_of_week IN (5, 6) THEN 1 ELSE 0 END AS is_weekend, "
        "CASE WHEN hour IN (7, 8, 9, 17, 18, 19) THEN 1 ELSE 0 END AS is_rush_hour, "
        "CASE WHEN trip_duration <> 0 THEN distance_km / (trip_duration / 3600.0::DOUBLE) ELSE 0 END AS speed_kmh "
        "FROM (SELECT *, CAST(hour(pickup_datetime) AS INT) AS hour, "
        "CAST(isodow(pickup_datetime) - 1 AS INT) AS day_of_week, CAST(month(pickup_datetime) AS INT) AS month, "
        f"{_KM} AS distance_km FROM trips)"
    ),
    "clean": f"SELECT * FROM feat WHERE {_CLEAN}",
    "line": (
        "SELECT regr_slope(trip_duration, distance_km) AS slope, regr_intercept(trip_duration, distance_km) AS intercept, "
        "regr_r2(trip_duration, distance_km) AS r2, regr_count(trip_duration, distance_km) AS n FROM clean"
    ),
    "stamped": (
        "SELECT *, pickup_datetime + INTERVAL 2 SECOND AS processed_time, "
        f"CAST(floor(epoch(pickup_datetime + INTERVAL 2 SECOND - TIMESTAMP '{STREAM_START}') / 3600) AS INT) AS batch_id "
        "FROM feat"
    ),
    "speed": (
        "SELECT *, abs(trip_duration - predicted_duration) AS prediction_error "
        "FROM (SELECT stamped.*, intercept + slope * distance_km AS predicted_duration FROM stamped, line)"
    ),
    "daily": (
        f"SELECT '{RUN_DATE}' AS date, count(*) AS total_trips, avg(trip_duration) AS avg_duration, "
        "median(trip_duration) AS median_duration, stddev_samp(trip_duration) AS std_duration, "
        "avg(distance_km) AS avg_distance, sum(distance_km) AS total_distance, sum(passenger_count) AS total_passengers, "
        "avg(passenger_count) AS avg_passengers, avg(speed_kmh) AS avg_speed, sum(is_rush_hour) AS rush_hour_trips, "
        "sum(is_weekend) AS weekend_trips FROM clean"
    ),
    # What a decoder sees of the damaged messages.
    "msgs": f"SELECT *, {MESSAGE_KIND} AS kind FROM trips",
    "decoded": (
        "SELECT id, CASE WHEN kind = 'no_vendor' THEN NULL ELSE vendor_id END AS vendor_id, vendor_id - 1 AS half, "
        "strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_datetime, "
        "strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS original_pickup_datetime, "
        "CASE WHEN kind = 'negative_passengers' THEN -1 ELSE passenger_count END AS passenger_count, "
        "pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude, store_and_fwd_flag, "
        "CASE WHEN kind = 'negative_duration' THEN -5 ELSE trip_duration END AS trip_duration, "
        "CAST(hour(pickup_datetime) AS INT) AS hour, CAST(isodow(pickup_datetime) - 1 AS INT) AS day_of_week, "
        "CAST(month(pickup_datetime) AS INT) AS month, date_trunc('second', pickup_datetime) AS pickup_at, "
        f"{_KM} AS distance_km FROM msgs WHERE kind NOT IN ('malformed', 'blank')"
    ),
    "delivered": (
        f"SELECT *, CASE WHEN CAST(substr(id, 3) AS BIGINT) % {HELD_BACK} = 0 THEN 2 WHEN pickup_datetime < '{DELIVERY_CUT}' THEN 0 ELSE 1 END AS delivery FROM decoded"
    ),
    "scored": (
        "SELECT *, abs(trip_duration - predicted_duration) AS prediction_error "
        "FROM (SELECT decoded.*, intercept + slope * distance_km AS predicted_duration FROM decoded, line)"
    ),
    "ends": (
        f"SELECT '{TOPIC}' AS topic, vendor_id - 1 AS partition, CAST(0 AS BIGINT) AS begin_offset, "
        "count(*) AS end_offset FROM trips GROUP BY vendor_id"
    ),
    "commits": (
        "SELECT 'dashboard' AS group_id, partition, end_offset - (partition + 1) * 10 AS committed, end_offset FROM ends "
        "UNION ALL SELECT 'speed-layer', partition, CAST(floor(end_offset * 9 / 10.0) AS BIGINT), end_offset FROM ends "
        "UNION ALL SELECT 'archiver', partition, end_offset, end_offset FROM ends WHERE partition = 0"
    ),
    "lag": (
        "SELECT group_id, CAST(sum(greatest(end_offset - committed, 0)) AS BIGINT) AS lag, "
        "CAST(sum(committed) AS BIGINT) AS committed_total FROM commits GROUP BY group_id"
    ),
    "nulls": "SELECT column_name, null_pct FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round_even(count(*) FILTER (WHERE {c} IS NULL) / count(*)::DOUBLE * 100 * 100, 0) "
        f"/ 100 AS null_pct FROM trips" for c in _REQUIRED) + ")",
    "quality": (
        "SELECT (SELECT count(*) FROM trips) AS row_count, "
        "greatest(0, 1 - sum(null_pct) / 900) AS quality_score FROM nulls"
    ),
    "anomalies": (
        f"SELECT count(*) FILTER (WHERE {_GEO}) AS geographic_anomalies, count(*) FILTER (WHERE {_DUR}) AS duration_anomalies, "
        f"count(*) FILTER (WHERE {_PAS}) AS passenger_anomalies, "
        f"count(*) FILTER (WHERE coalesce({_GEO}, false) OR coalesce({_DUR}, false) OR coalesce({_PAS}, false)) "
        "AS total_anomalies, count(*) AS n FROM trips"
    ),
    "files": "SELECT batch_id, count(*) AS records, max(processed_time) AS written FROM stamped GROUP BY batch_id",
    "throughput": (
        "SELECT *, records_last_hour / 60.0::DOUBLE AS throughput_per_minute, "
        "(records_last_hour / 60.0::DOUBLE >= 10 OR total_records = 0) AS is_healthy FROM ("
        "SELECT count(*) AS files, CAST(sum(records) AS BIGINT) AS total_records, "
        f"count(*) FILTER (WHERE written > TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR) AS files_last_hour, "
        f"CAST(coalesce(sum(records) FILTER (WHERE written > TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR), 0) AS BIGINT) "
        "AS records_last_hour FROM files)"
    ),
    "records": (
        "SELECT count(*) FILTER (WHERE kind <> 'blank') AS line_count, "
        "count(*) FILTER (WHERE kind NOT IN ('blank', 'malformed')) AS sample_size, "
        "count(*) FILTER (WHERE kind = 'ok') AS valid_records FROM msgs"
    ),
    "verdict": _verdict(0.001, 0.99),
    "verdict_default": _verdict(10, 0.9),
    "test_fit": (
        "SELECT regr_slope(trip_duration, distance_km) AS slope, regr_intercept(trip_duration, distance_km) AS intercept "
        "FROM clean WHERE substr(md5(id), 1, 2) >= '33'"
    ),
    "test_rows": (
        "SELECT trip_duration AS y, intercept + slope * distance_km AS p FROM clean, test_fit "
        "WHERE substr(md5(id), 1, 2) < '33'"
    ),
    "metrics": (
        "SELECT sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae, "
        "1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2, count(*) AS samples FROM test_rows"
    ),
    "reconciled": (
        "SELECT *, CASE WHEN diff_pct > 10 THEN 'discrepancy_detected' ELSE 'consistent' END AS status, "
        "CASE WHEN diff_pct > 10 THEN printf('Mean durations are apart by %.2f%%', diff_pct) ELSE '' END AS discrepancies "
        f"FROM (SELECT '{RUN_DATE}' AS date, total_trips AS batch_trips, avg_duration AS batch_avg_duration, "
        "(SELECT count(*) FROM trips) AS speed_records, "
        "(SELECT avg(coalesce(trip_duration, 0)) FROM trips) AS speed_avg_duration, "
        "abs(avg_duration - (SELECT avg(coalesce(trip_duration, 0)) FROM trips)) / avg_duration * 100 AS diff_pct FROM daily)"
    ),
    "stages": (
        "SELECT 'data_validation' AS stage, 'success' AS status, row_count, round(quality_score, 6) AS quality_score, "
        "CAST(NULL AS DOUBLE) AS anomaly_percentage, CAST(NULL AS BIGINT) AS records_processed, "
        "CAST(NULL AS DOUBLE) AS r2_score, CAST(NULL AS DOUBLE) AS rmse, CAST(NULL AS VARCHAR) AS discrepancies FROM quality "
        "UNION ALL SELECT 'anomaly_detection', 'success', NULL, NULL, round(total_anomalies * 100 / n::DOUBLE, 6), NULL, "
        "NULL, NULL, NULL FROM anomalies "
        "UNION ALL SELECT 'batch_processing', 'success', NULL, NULL, NULL, (SELECT count(*) FROM clean), NULL, NULL, NULL "
        "UNION ALL SELECT 'ml_pipeline', 'success', NULL, NULL, NULL, NULL, round(r2, 6), round(rmse, 6), NULL FROM metrics "
        "UNION ALL SELECT 'reconciliation', status, NULL, NULL, NULL, NULL, NULL, NULL, discrepancies FROM reconciled"
    ),
}


def _uses(sql: str) -> list[str]:
    """Relations a text needs, in order of definition."""
    import re

    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _RELATIONS:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s*{name}\b", text):
                needed.add(name)
                visit(_RELATIONS[name])

    visit(sql)
    return [name for name in _RELATIONS if name in needed]


def _sql(body: str) -> str:
    steps = ", ".join(f"{name} AS ({_RELATIONS[name]})" for name in _uses(body))
    return f"WITH {steps} {body}"


def _round(columns: str, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns.split())


_COORDINATES = "pickup_longitude pickup_latitude dropoff_longitude dropoff_latitude"
_TRIP_ROUNDED = (
    f"id, vendor_id, {_SECOND.format('pickup_datetime')} AS pickup_datetime, passenger_count, "
    f"{_round(_COORDINATES)}, store_and_fwd_flag, trip_duration"
)
_VENDOR_STATS = (
    "SELECT vendor_id, round(avg(trip_duration), 6) AS avg_duration, round(stddev_samp(trip_duration), 6) AS std_duration, "
    "count(trip_duration) AS trip_count, round(avg(distance_km), 6) AS avg_distance, "
    "round(avg(passenger_count), 6) AS avg_passengers, CAST(sum(passenger_count) AS BIGINT) AS total_passengers, "
    "round(avg(speed_kmh), 6) AS avg_speed FROM clean GROUP BY vendor_id"
)


def _hourly_basic(source: str) -> str:
    return (
        "SELECT hour, round(avg(trip_duration), 6) AS avg_duration, count(trip_duration) AS trip_count, "
        "round(avg(distance_km), 6) AS avg_distance, round(avg(passenger_count), 6) AS avg_passengers "
        f"FROM {source} GROUP BY hour"
    )


def _counts(column: str) -> str:
    return f"SELECT {column}, count(*) AS count FROM feat WHERE {column} IS NOT NULL GROUP BY {column}"


_DAY = "CAST(floor(batch_id / 24) AS INT)"
_PROCESSED = f"strftime(TIMESTAMP '{AS_OF}', '%Y-%m-%dT%H:%M:%S.%f')"
_FEATURES = "vendor_id passenger_count hour day_of_week is_weekend is_rush_hour distance_km".split()
_FIRST_KM = "feat WHERE trip_duration BETWEEN 60 AND 7200"

_BODIES = {
    "csv_roundtrip": f"SELECT {_TRIP_ROUNDED} FROM trips",
    "cleaned_csv": f"SELECT id, hour, is_rush_hour, trip_duration, {_round('distance_km speed_kmh')} FROM clean",
    "encode_messages": (
        f"SELECT '{TOPIC}' AS topic, CAST(to_json(struct_pack(id := id, vendor_id := vendor_id, "
        f"pickup_datetime := '{AS_OF}', original_pickup_datetime := {_SECOND.format('pickup_datetime')}, "
        "passenger_count := passenger_count, pickup_longitude := pickup_longitude, pickup_latitude := pickup_latitude, "
        "dropoff_longitude := dropoff_longitude, dropoff_latitude := dropoff_latitude, "
        "store_and_fwd_flag := store_and_fwd_flag, trip_duration := trip_duration)) AS VARCHAR) AS value FROM trips"
    ),
    "decode_messages": (
        f"SELECT id, vendor_id, pickup_datetime, original_pickup_datetime, passenger_count, {_round(_COORDINATES)}, "
        "store_and_fwd_flag, trip_duration, hour, day_of_week, month FROM decoded"
    ),
    "rejected_messages": "SELECT count(*) AS rejected FROM msgs WHERE kind = 'malformed'",
    "stream_ingest": (
        f"SELECT id, vendor_id, pickup_datetime, original_pickup_datetime, passenger_count, {_round(_COORDINATES)}, "
        "store_and_fwd_flag, trip_duration FROM decoded"
    ),
    "stream_quarantine": (
        "SELECT substr('{\"id\":\"' || id || '\",\"vendor_id\":' || vendor_id || ',\"pickup', 1, 20) AS value "
        "FROM msgs WHERE kind = 'malformed'"
    ),
    "stream_restart": (
        "SELECT half AS batch_id, count(*) AS records, CAST(sum(trip_duration) AS BIGINT) AS total_duration "
        "FROM decoded GROUP BY half"
    ),
    "speed_layer_sink": (
        f"SELECT id, vendor_id, pickup_datetime, passenger_count, {_round(_COORDINATES, 4)}, trip_duration, hour, "
        f"day_of_week, month, {_round('distance_km predicted_duration prediction_error', 4)}, "
        f"{_PROCESSED} AS processed_time, 0 AS batch_id FROM scored"
    ),
    "speed_hourly_stats": (
        "SELECT half AS batch_id, hour, count(*) AS trip_count, round(avg(distance_km), 4) AS avg_distance, "
        "round(avg(trip_duration), 4) AS avg_actual_duration, round(avg(predicted_duration), 4) AS avg_predicted_duration "
        "FROM scored GROUP BY half, hour"
    ),
    "stream_windowed_stats": (
        "SELECT strftime(d, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(d + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end, "
        "count(*) FILTER (WHERE NOT late) AS trip_count, CAST(coalesce(sum(trip_duration) FILTER (WHERE NOT late), 0) AS BIGINT) AS total_duration, "
        "count(*) FILTER (WHERE late) AS late_count, CAST(coalesce(sum(trip_duration) FILTER (WHERE late), 0) AS BIGINT) AS late_duration, "
        "d + INTERVAL 1 DAY <= max(w3) AS is_final FROM (SELECT *, coalesce(d + INTERVAL 1 DAY <= CASE delivery WHEN 1 THEN w1 WHEN 2 THEN w2 END, false) "
        "AS late FROM (SELECT *, date_trunc('day', pickup_at) AS d, max(pickup_at) FILTER (WHERE delivery = 0) OVER () - INTERVAL 1 HOUR AS w1, "
        "max(pickup_at) FILTER (WHERE delivery <= 1) OVER () - INTERVAL 1 HOUR AS w2, max(pickup_at) OVER () - INTERVAL 1 HOUR AS w3 FROM delivered)) GROUP BY d"
    ),
    "stream_running_error": (
        "SELECT CAST(vendor_id AS VARCHAR) AS key, id, processed, round(avg_error, 4) AS avg_error, (processed - 1) // 10 AS batch_id FROM ("
        "SELECT vendor_id, id, row_number() OVER w AS processed, avg(coalesce(prediction_error, 0)) OVER w AS avg_error, "
        "count(*) OVER (PARTITION BY vendor_id) AS n FROM scored JOIN (SELECT id, delivery FROM delivered) USING (id) "
        "WHERE vendor_id IS NOT NULL AND delivery < 2 WINDOW w AS (PARTITION BY vendor_id ORDER BY pickup_datetime, id ROWS UNBOUNDED PRECEDING)) "
        "WHERE processed <= n - n % 10"
    ),
    "stream_scoring_failures": (
        f"SELECT 0 AS batch_id, count(*) AS records, count(*) FILTER (WHERE {UNSCORABLE_KIND} <> 'ok') AS unscored FROM scored HAVING count(*) > 0"
    ),
    "stream_lag": (
        "SELECT 'reader' AS group_id, count(*) FILTER (WHERE half = 1) AS lag, count(*) FILTER (WHERE half = 0) AS committed_total, "
        "count(*) FILTER (WHERE half = 1) AS total_lag, count(*) FILTER (WHERE half = 1) <= 1000 AS is_acceptable FROM (SELECT vendor_id - 1 AS half FROM trips)"
    ),
    "speed_recent_batches": (
        f"SELECT {_DAY} AS batch_id, id, vendor_id, trip_duration, round(distance_km, 6) AS distance_km, "
        f"{_SECOND.format('processed_time')} AS processed_time, CASE WHEN vendor_id = 1 THEN hour END AS hour, "
        "CASE WHEN vendor_id = 1 THEN day_of_week END AS day_of_week, CASE WHEN vendor_id = 1 THEN month END AS month "
        f"FROM stamped WHERE {_DAY} > (SELECT max({_DAY}) - 5 FROM stamped)"
    ),
    "file_inventory": (
        f"SELECT printf('batch_id=%05d', {_DAY}) AS name, count(*) AS records FROM stamped GROUP BY {_DAY}"
    ),
    "master_simple": (
        f"SELECT id, vendor_id, {_SECOND.format('pickup_datetime')} AS pickup_datetime, '' AS dropoff_datetime, "
        f"passenger_count, {_round(_COORDINATES)}, store_and_fwd_flag, trip_duration, '{RUN_DATE}' AS ingestion_date FROM trips"
    ),
    "master_full": (
        f"SELECT {_TRIP_ROUNDED}, hour, day_of_week, month, is_weekend, is_rush_hour, {_round('distance_km speed_kmh')}, "
        f"'{RUN_DATE}' AS ingestion_date, "
        f"substr(md5('{RUN_DATE}_' || (SELECT count(*) FROM clean)), 1, 12) AS batch_id FROM clean"
    ),
    "master_batch_id": (
        f"SELECT '{RUN_DATE}' AS ingestion_date, count(*) AS row_count, "
        f"substr(md5('{RUN_DATE}_' || count(*)), 1, 12) AS batch_id FROM clean"
    ),
    "view_roundtrip": _VENDOR_STATS,
    "latest_view": _hourly_basic("clean"),
    "trip_features": (
        f"SELECT id, hour, day_of_week, month, is_weekend, is_rush_hour, {_round('distance_km speed_kmh')} FROM feat"
    ),
    "impute_median": (
        "SELECT id, coalesce(CAST(passenger_count AS DOUBLE), (SELECT median(passenger_count) FROM trips)) "
        "AS passenger_count, trip_duration FROM trips"
    ),
    "training_filter": "SELECT id, trip_duration FROM trips WHERE trip_duration BETWEEN 60 AND 7200",
    "clean_trips": f"SELECT {_TRIP_ROUNDED} FROM clean",
    "retain_recent": (
        f"SELECT id, {_SECOND.format('processed_time')} AS processed_time FROM stamped "
        f"WHERE processed_time >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR"
    ),
    "stored_batches": f"SELECT batch_id, records, {_SECOND.format('written')} AS newest FROM files",
    "expired_batches": (
        "SELECT count(*) FILTER (WHERE NOT old) AS batches_left, CAST(coalesce(sum(records) FILTER (WHERE NOT old), 0) AS BIGINT) AS records_left, "
        "count(*) FILTER (WHERE old) AS batches_expired, CAST(coalesce(sum(records) FILTER (WHERE old), 0) AS BIGINT) AS records_expired, "
        "count(*) FILTER (WHERE old) AS folders_deleted, CAST(coalesce(sum(records) FILTER (WHERE NOT old), 0) AS BIGINT) AS rows_readable "
        f"FROM (SELECT *, written < TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR AS old FROM files)"
    ),
    "pickup_map_points": (
        "SELECT round(pickup_latitude, 6) AS lat, round(pickup_longitude, 6) AS lon FROM trips "
        "WHERE pickup_latitude > 40.5 AND pickup_latitude < 41 AND pickup_longitude > -74.3 AND pickup_longitude < -73.7"
    ),
    "hourly_stats_basic": _hourly_basic("feat"),
    "hourly_stats": (
        "SELECT hour, round(avg(trip_duration), 6) AS avg_duration, round(stddev_samp(trip_duration), 6) AS std_duration, "
        "min(trip_duration) AS min_duration, max(trip_duration) AS max_duration, count(trip_duration) AS trip_count, "
        "round(avg(distance_km), 6) AS avg_distance, round(stddev_samp(distance_km), 6) AS std_distance, "
        "round(avg(passenger_count), 6) AS avg_passengers, CAST(sum(passenger_count) AS BIGINT) AS total_passengers, "
        "round(avg(speed_kmh), 6) AS avg_speed, max(is_rush_hour) AS is_rush_hour FROM clean GROUP BY hour"
    ),
    "daily_summary_basic": (
        f"SELECT '{RUN_DATE}' AS date, count(*) AS total_trips, round(avg(trip_duration), 6) AS avg_duration, "
        "round(avg(distance_km), 6) AS avg_distance, CAST(sum(passenger_count) AS BIGINT) AS total_passengers, "
        "round(avg(passenger_count), 6) AS avg_passengers FROM feat"
    ),
    "daily_summary": (
        "SELECT date, total_trips, "
        + _round("avg_duration median_duration std_duration avg_distance total_distance avg_passengers avg_speed", 4)
        + ", CAST(total_passengers AS BIGINT) AS total_passengers, CAST(rush_hour_trips AS BIGINT) AS rush_hour_trips, "
        "CAST(weekend_trips AS BIGINT) AS weekend_trips FROM daily"
    ),
    "daily_summary_incremental": (
        "SELECT date, total_trips, "
        + _round("avg_duration median_duration std_duration avg_distance total_distance avg_passengers avg_speed", 4)
        + ", CAST(total_passengers AS BIGINT) AS total_passengers, CAST(rush_hour_trips AS BIGINT) AS rush_hour_trips, "
        "CAST(weekend_trips AS BIGINT) AS weekend_trips FROM daily"
    ),
    "vendor_stats_basic": (
        "SELECT vendor_id, round(avg(trip_duration), 6) AS avg_duration, round(avg(distance_km), 6) AS avg_distance, "
        "count(id) AS trip_count FROM feat GROUP BY vendor_id"
    ),
    "vendor_stats": _VENDOR_STATS,
    "geographic_stats": (
        "SELECT lat::VARCHAR || ',' || lon::VARCHAR AS zone, round(avg(trip_duration), 6) AS avg_duration, "
        "count(trip_duration) AS trip_count, round(avg(distance_km), 6) AS avg_distance, "
        "round(avg(passenger_count), 6) AS avg_passengers, lat, lon FROM ("
        "SELECT *, round_even(pickup_latitude * 10, 0) / 10 AS lat, round_even(pickup_longitude * 10, 0) / 10 AS lon "
        "FROM clean) GROUP BY lat, lon"
    ),
    "temporal_patterns": (
        "SELECT hour, day_of_week, round(avg(trip_duration), 6) AS avg_duration, count(trip_duration) AS trip_count, "
        "round(avg(distance_km), 6) AS avg_distance, round(avg(speed_kmh), 6) AS avg_speed, "
        "dayname(DATE '2024-01-01' + day_of_week) AS day_name FROM clean GROUP BY hour, day_of_week"
    ),
    "data_profile": (
        f"SELECT count(*) AS total_records, {_SECOND.format('min(pickup_datetime)')} AS min_pickup, "
        f"{_SECOND.format('max(pickup_datetime)')} AS max_pickup, round(avg(trip_duration), 6) AS mean_duration, "
        "median(trip_duration) AS median_duration, round(stddev_samp(trip_duration), 6) AS std_duration, "
        "min(trip_duration) AS min_duration, max(trip_duration) AS max_duration, "
        "round(count(*) FILTER (WHERE trip_duration < 60 OR trip_duration > 7200) * 100 / count(*)::DOUBLE, 6) "
        "AS outliers_pct FROM trips"
    ),
    "data_distributions": " UNION ALL ".join(
        f"SELECT '{label}' AS dimension, CAST({c} AS BIGINT) AS key, count(*) AS count FROM feat "
        f"WHERE {c} IS NOT NULL GROUP BY {c}"
        for label, c in (("vendor", "vendor_id"), ("passenger", "passenger_count"), ("hour", "hour"))
    ),
    "null_percentages": "SELECT column_name, null_pct FROM nulls",
    "quality_score": "SELECT row_count, round(quality_score, 6) AS quality_score FROM quality",
    "quality_gate": (
        "SELECT row_count, round(quality_score, 6) AS quality_score, quality_score >= 0.95 AS passed FROM quality"
    ),
    "quality_gate_while_writing": (
        "SELECT row_count, round(quality_score, 6) AS quality_score, quality_score >= 0.95 AS passed FROM quality"
    ),
    "anomaly_counts": (
        "SELECT geographic_anomalies, duration_anomalies, passenger_anomalies, total_anomalies, "
        "round(total_anomalies * 100 / n::DOUBLE, 6) AS anomaly_percentage FROM anomalies"
    ),
    "missing_columns": (
        "SELECT column_name, (SELECT count(*) FROM trips) AS rows_affected FROM ("
        "SELECT unnest(" + repr(_REQUIRED) + ") AS column_name EXCEPT SELECT unnest("
        + repr([c if c != "vendor_id" else "vendor" for c in TRIP_COLUMNS if c != "trip_duration"]) + "))"
    ),
    "scatter_sample": (
        "SELECT trip_duration, round(predicted_duration, 4) AS predicted_duration FROM speed "
        "ORDER BY pickup_datetime, id LIMIT 100"
    ),
    "latest_trips": (
        f"SELECT id, {_SECOND.format('pickup_datetime')} AS pickup_datetime, passenger_count, "
        + _round("distance_km predicted_duration prediction_error", 4)
        + ", trip_duration FROM (SELECT * FROM speed ORDER BY processed_time DESC, id LIMIT 10)"
    ),
    "publish_head": (
        f"SELECT id, {_SECOND.format('pickup_datetime')} AS pickup_datetime, trip_duration FROM ("
        "SELECT * FROM trips ORDER BY pickup_datetime, id LIMIT 5000)"
    ),
    "replay_slice": (
        "SELECT id, vendor_id, trip_duration FROM (SELECT *, row_number() OVER (ORDER BY pickup_datetime, id) AS rn, "
        "13 % greatest(count(*) OVER () // 50, 1) AS b FROM trips) WHERE rn > b * 50 AND rn <= b * 50 + 50"
    ),
    "quality_sample": (
        "SELECT batch_id, id FROM stamped WHERE batch_id IN "
        "(SELECT DISTINCT batch_id FROM stamped ORDER BY batch_id DESC LIMIT 5) ORDER BY md5(id), id LIMIT 100"
    ),
    "count_batches": (
        "SELECT batch_id, count(*) AS records, CAST(sum(trip_duration) AS BIGINT) AS total_duration FROM ("
        "SELECT *, CAST(floor((row_number() OVER (ORDER BY pickup_datetime, id) - 1) / 10) AS BIGINT) AS batch_id "
        "FROM trips) GROUP BY batch_id"
    ),
    "running_error": (
        "SELECT id, row_number() OVER w AS processed, round(avg(coalesce(prediction_error, 0)) OVER w, 4) AS avg_error "
        "FROM speed WINDOW w AS (ORDER BY pickup_datetime, id ROWS UNBOUNDED PRECEDING)"
    ),
    "speed_kpis": (
        "SELECT count(*) AS total_trips, round(avg(distance_km), 4) AS avg_distance_km, "
        "round(avg(trip_duration) / 60, 4) AS avg_duration_min, round(avg(prediction_error), 4) AS prediction_mae FROM speed"
    ),
    "prediction_accuracy": " UNION ALL ".join(
        f"SELECT '{label}' AS threshold, round(avg(CASE WHEN abs(prediction_error) <= {s} THEN 100.0::DOUBLE ELSE 0 END), 6) "
        "AS accuracy_pct FROM speed WHERE prediction_error IS NOT NULL"
        for label, s in (("Within 1 min", 60), ("Within 5 min", 300))
    ),
    "trips_by_hour": _counts("hour"),
    "trips_by_vendor": _counts("vendor_id"),
    "vendor_performance": (
        "SELECT 'Vendor ' || vendor_id AS vendor, round(round(avg(trip_duration), 6), 2) AS avg_duration_s, "
        "round(round(avg(distance_km), 6), 2) AS avg_distance_km FROM feat GROUP BY vendor_id"
    ),
    "reconcile_layers": (
        "SELECT date, batch_trips, round(batch_avg_duration, 6) AS batch_avg_duration, speed_records, "
        "round(speed_avg_duration, 6) AS speed_avg_duration, round(diff_pct, 6) AS diff_pct, status, discrepancies "
        "FROM reconciled"
    ),
    "layer_comparison": (
        "SELECT 'Avg Distance (km)' AS metric, round((SELECT avg(distance_km) FROM speed), 6) AS speed_layer, "
        "round(avg_distance, 6) AS batch_layer FROM daily UNION ALL "
        "SELECT 'Avg Duration (sec)', round((SELECT avg(trip_duration) FROM speed), 6), round(avg_duration, 6) FROM daily"
    ),
    "combined_view": (
        "SELECT (SELECT count(*) FROM speed) AS speed_records, "
        "round((SELECT avg(distance_km) FROM speed), 4) AS speed_avg_distance, "
        "round((SELECT avg(predicted_duration) FROM speed), 4) AS speed_avg_predicted, total_trips AS batch_records, "
        "round(avg_distance, 4) AS batch_avg_distance, round(avg_duration, 4) AS batch_avg_duration FROM daily"
    ),
    "topic_message_counts": "SELECT topic, partition, begin_offset, end_offset, end_offset - begin_offset AS messages FROM ends",
    "topic_health": (
        f"SELECT '{TOPIC}' AS topic, count(*) > 0 AS topic_exists, count(*) AS partitions, "
        "CAST(sum(end_offset - begin_offset) AS BIGINT) AS message_count_estimate, count(*) > 0 AS topic_healthy FROM ends"
    ),
    "consumer_lag": (
        "SELECT group_id, lag, committed_total, (SELECT CAST(sum(lag) AS BIGINT) FROM lag) AS total_lag, "
        "(SELECT sum(lag) FROM lag) <= 1000 AS is_acceptable FROM lag"
    ),
    "producer_activity": (
        f"SELECT round(epoch(TIMESTAMP '{AS_OF}' - max(pickup_datetime)), 6) AS last_message_age, "
        f"epoch(TIMESTAMP '{AS_OF}' - max(pickup_datetime)) < 300 AS producer_active FROM trips"
    ),
    "speed_freshness": (
        f"SELECT {_SECOND.format('max(processed_time)')} AS latest, "
        f"round(epoch(TIMESTAMP '{AS_OF}' - max(processed_time)) / 60, 6) AS age_minutes, "
        f"epoch(TIMESTAMP '{AS_OF}' - max(processed_time)) / 60 <= 10 AS is_fresh FROM stamped"
    ),
    "speed_throughput": (
        "SELECT files, total_records, files_last_hour, records_last_hour, "
        "round(throughput_per_minute, 6) AS throughput_per_minute, is_healthy FROM throughput"
    ),
    "records_per_file": "SELECT batch_id, records FROM files",
    "speed_record_errors": (
        "SELECT error, count(*) AS n FROM (SELECT CASE kind WHEN 'no_vendor' THEN 'missing_vendor_id' "
        "WHEN 'negative_passengers' THEN 'negative_passengers' WHEN 'negative_duration' THEN 'negative_duration' END AS error "
        "FROM msgs) WHERE error IS NOT NULL GROUP BY error"
    ),
    "speed_record_quality": (
        "SELECT line_count, sample_size, valid_records, sample_size - valid_records AS invalid_records, "
        "round(valid_records / sample_size::DOUBLE, 6) AS quality_score, valid_records / sample_size::DOUBLE >= 0.9 "
        "AS is_acceptable FROM records"
    ),
    "circuit_breaker": (
        "SELECT failed AS failed_checks, n AS failed_count, "
        "n = 0 AS overall_healthy, CASE WHEN n = 0 THEN 'continue' ELSE 'alert' END AS action FROM verdict"
    ),
    "circuit_breaker_default": (
        "SELECT failed AS failed_checks, n AS failed_count, "
        "n = 0 AS overall_healthy, CASE WHEN n = 0 THEN 'continue' ELSE 'alert' END AS action FROM verdict_default"
    ),
    "alerts": (
        "SELECT 'streaming_alert' AS type, 'warning' AS severity, failed AS failed_checks, "
        "'Checks of the stream failed: ' || failed AS message FROM verdict WHERE n > 0"
    ),
    "healthy_metrics": (
        f"SELECT CAST(to_json(struct_pack(generated_at := '{AS_OF}', metrics := struct_pack(topic_health := "
        f"struct_pack(topic := '{TOPIC}', topic_exists := true, partitions := (SELECT count(*) FROM ends), "
        "message_count_estimate := (SELECT CAST(sum(end_offset) AS BIGINT) FROM ends), topic_healthy := true), "
        "freshness := struct_pack(is_fresh := true), throughput := (SELECT struct_pack(files := files, total_records := total_records, "
        "files_last_hour := files_last_hour, records_last_hour := records_last_hour, "
        "throughput_per_minute := round(throughput_per_minute, 4), is_healthy := true) FROM throughput), "
        "data_quality := (SELECT struct_pack(line_count := line_count, sample_size := sample_size, "
        "valid_records := valid_records, invalid_records := sample_size - valid_records, "
        "quality_score := round(valid_records / sample_size::DOUBLE, 4), is_acceptable := true) FROM records)))) AS VARCHAR) AS document "
        f"FROM throughput, records WHERE (SELECT epoch(TIMESTAMP '{AS_OF}' - max(processed_time)) / 60 FROM stamped) <= {MAX_DATA_AGE_MINUTES} "
        f"AND throughput_per_minute >= 0.01 AND valid_records / sample_size::DOUBLE >= {RECORD_QUALITY_THRESHOLD}"
    ),
    "ops_dashboard": (
        f"SELECT CAST(to_json(struct_pack(generated_at := '{AS_OF}', kafka := struct_pack(topic_health := "
        f"struct_pack(topic := '{TOPIC}', topic_exists := true, partitions := (SELECT count(*) FROM ends), "
        "message_count_estimate := (SELECT CAST(sum(end_offset) AS BIGINT) FROM ends), topic_healthy := true)), "
        "speed_layer := struct_pack(throughput := (SELECT struct_pack(files := files, total_records := total_records, "
        "files_last_hour := files_last_hour, records_last_hour := records_last_hour, "
        "throughput_per_minute := round(throughput_per_minute, 4), is_healthy := is_healthy) FROM throughput), "
        "quality := (SELECT struct_pack(line_count := line_count, sample_size := sample_size, "
        "valid_records := valid_records, invalid_records := sample_size - valid_records, "
        "quality_score := round(valid_records / sample_size::DOUBLE, 4), "
        "is_acceptable := valid_records / sample_size::DOUBLE >= 0.9) FROM records)))) AS VARCHAR) AS document"
    ),
    "training_features": (
        "SELECT id, coalesce(CAST(passenger_count AS DOUBLE), (SELECT median(passenger_count) FROM "
        f"{_FIRST_KM})) AS passenger_count, {_round(_COORDINATES)}, "
        "CAST(hour AS DOUBLE) AS hour, CAST(day_of_week AS DOUBLE) AS day_of_week, CAST(month AS DOUBLE) AS month, "
        f"round(distance_km, 6) AS distance_km, trip_duration FROM {_FIRST_KM}"
    ),
    "train_test_split": (
        "SELECT id, CASE WHEN substr(md5(id), 1, 2) < '33' THEN 'test' ELSE 'train' END AS part, trip_duration FROM clean"
    ),
    "scale_features": (
        "SELECT id, " + ", ".join(
            f"round((clean.{c} - m.mean_{c}) / CASE WHEN m.std_{c} = 0 THEN 1 ELSE m.std_{c} END, 6) AS {c}"
            for c in _FEATURES)
        + " FROM clean, (SELECT " + ", ".join(
            f"avg({c}) AS mean_{c}, stddev_pop({c}) AS std_{c}" for c in _FEATURES)
        + " FROM clean WHERE substr(md5(id), 1, 2) >= '33') AS m"
    ),
    "linear_baseline": f"SELECT {_round('slope intercept r2', 4)}, CAST(n AS BIGINT) AS n FROM line",
    "score_trips": f"SELECT id, {_round('predicted_duration prediction_error', 4)} FROM scored",
    "score_isolated": (
        f"SELECT id, CASE WHEN {UNSCORABLE_KIND} = 'ok' THEN round(predicted_duration, 4) END AS predicted_duration, "
        f"CASE WHEN {UNSCORABLE_KIND} = 'ok' THEN round(prediction_error, 4) END AS prediction_error FROM scored"
    ),
    "score_without_model": (
        "SELECT id, round(distance_km, 6) AS distance_km, CAST(NULL AS DOUBLE) AS predicted_duration, "
        "CAST(NULL AS DOUBLE) AS prediction_error FROM decoded"
    ),
    "regression_metrics": f"SELECT {_round('rmse mae r2')}, samples FROM metrics",
    "model_gate": "SELECT round(r2, 6) AS r2, r2 >= 0.7 AS passed FROM metrics",
    "train_gbt": f"SELECT 'GradientBoosting' AS name, 'gbt' AS type, true AS beats_line, {_FITTED} FROM {_TEST_PART}",
    "train_neural": f"SELECT 'NeuralNetwork' AS name, 'mlp' AS type, true AS beats_line, {_FITTED} FROM {_TEST_PART}",
    "train_linear": (
        "SELECT 'LinearRegression' AS name, 'linear' AS type, count(*) AS training_samples, 0.0::DOUBLE AS mean_residual, "
        + ", ".join(f"0.0::DOUBLE AS residual_{c}" for c in TRAINING_FEATURES)
        + " FROM trips WHERE trip_duration BETWEEN 60 AND 7200 AND substr(md5(id), 1, 2) >= '33'"
    ),
    "model_leaderboard": (
        f"SELECT name, type, true AS in_order, {_FITTED} FROM {_TEST_PART}, (VALUES ('GradientBoosting', 'gbt'), "
        "('LinearRegression', 'linear'), ('RandomForest', 'forest')) AS m(name, type) GROUP BY name, type"
    ),
    "best_model": f"SELECT true AS is_least, {_FITTED} FROM {_TEST_PART}",
    "evaluate_model": f"SELECT true AS as_before, true AS beats_line, {_FITTED} FROM clean WHERE substr(md5(id), 1, 2) < '33'",
    "model_roundtrip": "SELECT count(*) AS scored, count(*) AS equal FROM clean",
    "experiment_log": (
        f"SELECT 'LinearRegression' AS name, 'linear' AS type, '{RUN_DATE}' AS run_date, "
        "'passenger_count,pickup_longitude,pickup_latitude,dropoff_longitude,dropoff_latitude,hour,day_of_week,month,"
        "distance_km' AS features, count(*) FILTER (WHERE substr(md5(id), 1, 2) >= '33') AS training_samples, "
        "count(*) FILTER (WHERE substr(md5(id), 1, 2) < '33') AS test_samples "
        "FROM trips WHERE trip_duration BETWEEN 60 AND 7200"
    ),
    "run_report": "SELECT * FROM stages",
    "report_document": (
        f"SELECT CAST(to_json(struct_pack(execution_date := '{RUN_DATE}', generated_at := '{AS_OF}', "
        "status := 'completed', stages := struct_pack("
        "anomaly_detection := (SELECT struct_pack(status := 'success', "
        "anomaly_percentage := round(total_anomalies * 100 / n::DOUBLE, 4)) FROM anomalies), "
        "batch_processing := (SELECT struct_pack(status := 'success', records_processed := count(*)) FROM clean), "
        "data_validation := (SELECT struct_pack(status := 'success', row_count := row_count, "
        "quality_score := round(quality_score, 4)) FROM quality), "
        "ml_pipeline := (SELECT struct_pack(status := 'success', r2_score := round(r2, 4), rmse := round(rmse, 4)) FROM metrics), "
        "reconciliation := (SELECT struct_pack(status := status, discrepancies := discrepancies) FROM reconciled)"
        "))) AS VARCHAR) AS document"
    ),
    "completion_summary": f"SELECT 'Run complete - {RUN_DATE}' AS subject, stage, status FROM stages",
}

REFERENCE_SQL = {name: _sql(body) for name, body in _BODIES.items()}
