"""Trip data derived from the provided ``events`` table, in SQL that Spark and DuckDB both read.

The tables hold no trips. Each event becomes one trip; the arithmetic plants null and zero
passengers, too short and too long trips, and pickups outside the bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions.trip import computed_once, with_trip_features
from tripweave.operators.filters import clean_rows
from tripweave.operators.scoring import linear_baseline, score_with_line
from tripweave.sources.messages import encode

TOPIC = "trips"
RUN_DATE = "20240131"
AS_OF = "2024-01-31 00:00:00"
STREAM_START = "2024-01-01 00:00:00"

# Fixed values of the derivation.
_PLON = "CAST(-743500 + (event_id*104729 % 1000)*7 AS BIGINT)"
_PLAT = "CAST(403500 + (event_id*7919 % 1000)*7 AS BIGINT)"
_DLON = "CAST(-742000 + (event_id*32452843 % 1000)*4 AS BIGINT)"
_DLAT = "CAST(405000 + (event_id*15485863 % 1000)*4 AS BIGINT)"


def _degrees(units: str) -> str:
    return f"CAST({units} AS DOUBLE) / CAST(10000 AS DOUBLE)"


TRIP_COLUMNS = {
    "id": "concat('id', CAST(event_id AS VARCHAR(20)))",
    "vendor_id": "CAST(event_id % 2 + 1 AS INT)",
    "pickup_datetime": "ts",
    "passenger_count": "CASE WHEN event_id % 211 = 0 THEN NULL ELSE CAST(user_id % 7 AS INT) END",
    "pickup_longitude": _degrees(_PLON),
    "pickup_latitude": _degrees(_PLAT),
    "dropoff_longitude": _degrees(_DLON),
    "dropoff_latitude": _degrees(_DLAT),
    "store_and_fwd_flag": "CASE WHEN event_type = 'error' THEN 'Y' ELSE 'N' END",
    "trip_duration": (
        "CASE WHEN event_id % 97 = 0 THEN 30 WHEN event_id % 101 = 0 THEN 9000 WHEN event_id % 103 = 0 THEN 12000 "
        "ELSE CAST(60 + floor(value * CAST(6 AS DOUBLE)) "
        f"+ floor(CAST(abs({_PLON}-{_DLON}) + abs({_PLAT}-{_DLAT}) AS DOUBLE) "
        "* CAST(2 AS DOUBLE) / CAST(5 AS DOUBLE)) AS INT) END"
    ),
}

# What is done to a trip's message text, by its number; the first that applies.
MESSAGE_KIND = (
    "CASE WHEN CAST(substr(id, 3) AS BIGINT) % 53 = 0 THEN 'malformed' "
    "WHEN CAST(substr(id, 3) AS BIGINT) % 61 = 0 THEN 'blank' "
    "WHEN CAST(substr(id, 3) AS BIGINT) % 59 = 0 THEN 'no_vendor' "
    "WHEN CAST(substr(id, 3) AS BIGINT) % 67 = 0 THEN 'negative_passengers' "
    "WHEN CAST(substr(id, 3) AS BIGINT) % 71 = 0 THEN 'negative_duration' ELSE 'ok' END"
)


def timestamp(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def trips(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The derived trips, or only some of their columns.

    The long duration term sits in a generator, so that a filter on it is not repeated in the scan
    stage of every query, which would outgrow what the JVM compiles. A generator is not pruned:
    queries that need no duration name their columns.
    """
    terms = {name: TRIP_COLUMNS[name] for name in columns or TRIP_COLUMNS}
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    if "trip_duration" in terms:
        duration = F.expr(terms["trip_duration"]).alias("trip_duration")
        events = events.select("*", F.inline(F.array(F.struct(duration))))
        terms["trip_duration"] = "trip_duration"
    return events.selectExpr(*[f"{expr} AS {name}" for name, expr in terms.items()])


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_trip_features(trips(spark, sf_dir))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_trip_features(clean_rows(trips(spark, sf_dir)))


def stamped(rows: DataFrame) -> DataFrame:
    """Processing time, two seconds after pickup, and the number of the hourly batch."""
    done = F.col("pickup_datetime") + F.expr("INTERVAL 2 SECONDS")
    hours = F.timestamp_diff("HOUR", timestamp(STREAM_START), F.col("processed_time"))
    return rows.withColumn("processed_time", done).withColumn("batch_id", hours.cast("int"))


def speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored trips as the speed layer leaves them."""
    return stamped(score_with_line(featured(spark, sf_dir), linear_baseline(clean(spark, sf_dir))))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, value): one message per trip, some of them damaged."""
    sent = encode(trips(spark, sf_dir), TOPIC, F.col("pickup_datetime"), key="id")
    text, kind = F.col("value"), F.col("kind")
    damaged = (
        F.when(kind == "malformed", F.substring(text, 1, 20))
        .when(kind == "blank", F.lit(" "))
        .when(kind == "no_vendor", F.regexp_replace(text, r'"vendor_id":\d+,', ""))
        .when(kind == "negative_passengers", F.regexp_replace(text, r'"passenger_count":[^,]+', '"passenger_count":-1'))
        .when(kind == "negative_duration", F.regexp_replace(text, r'"trip_duration":\d+', '"trip_duration":-5'))
        .otherwise(text)
    )
    marked = sent.withColumn("id", F.col("key")).withColumn("kind", F.expr(MESSAGE_KIND))
    return computed_once(marked, F.col("key"), damaged.alias("value"))


def message_halves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The same messages as two deliveries, one per vendor."""
    everything = messages(spark, sf_dir)
    odd = F.substring("key", 3, 20).cast("bigint") % 2
    return [everything.filter(odd == 0), everything.filter(odd == 1)]


#: Deliveries in order of time: before and after this, and rows held back until the end, almost all of them late by then.
DELIVERY_CUT = "2024-01-15 00:00:00"
HELD_BACK = 37


def message_deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The messages as three deliveries in order of time; one message in ``HELD_BACK`` comes with the last, however old it is."""
    sent = messages(spark, sf_dir).withColumns({
        "n": F.substring("key", 3, 20).cast("bigint"), "at": F.get_json_object("value", "$.pickup_datetime")})
    held = F.col("n") % HELD_BACK == 0
    early = F.coalesce(F.col("at") < DELIVERY_CUT, F.lit(True))
    return [sent.filter(f).select("key", "value") for f in (~held & early, ~held & ~early, held)]


# What makes a message unscorable, by the trip's number; the first that applies.
UNSCORABLE_KIND = (
    "CASE WHEN CAST(substr(id, 3) AS BIGINT) % 73 = 0 THEN 'no_time' WHEN CAST(substr(id, 3) AS BIGINT) % 79 = 0 THEN 'no_number' ELSE 'ok' END"
)


def unscorable_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages, some with a pickup time that is none or a latitude that is not a number."""
    text, kind = F.col("value"), F.expr(UNSCORABLE_KIND)
    damaged = F.when(kind == "no_time", F.regexp_replace(text, r'"pickup_datetime":"[^"]*"', '"pickup_datetime":"soon"')).when(
        kind == "no_number", F.regexp_replace(text, r'"pickup_latitude":[^,]+', '"pickup_latitude":NaN')).otherwise(text)
    return computed_once(messages(spark, sf_dir).withColumn("id", F.col("key")), F.col("key"), damaged.alias("value"))


def topic_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message log without offsets: one topic partition per vendor."""
    return trips(spark, sf_dir, "id", "vendor_id", "pickup_datetime").select(
        F.lit(TOPIC).alias("topic"), (F.col("vendor_id") - 1).alias("partition"),
        F.col("pickup_datetime").alias("timestamp"), "id",
    )


def topic_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets per partition of that log, whose offsets run from 0 without gaps."""
    return topic_log(spark, sf_dir).groupBy("topic", "partition").agg(
        F.lit(0).cast("bigint").alias("begin_offset"), F.count(F.lit(1)).alias("end_offset")
    )


def group_commits(offsets: DataFrame) -> DataFrame:
    """Committed offsets of three consumer groups, one of which has read a single partition."""
    end = F.col("end_offset")

    def group(name: str, committed: Column):
        return F.struct(F.lit(name).alias("group_id"), committed.cast("bigint").alias("committed"))

    groups = F.array(
        group("dashboard", end - (F.col("partition") + 1) * 10),
        group("speed-layer", F.floor(end * 9 / F.lit(10.0))),
        group("archiver", F.when(F.col("partition") == 0, end)),
    )
    return offsets.select("topic", "partition", F.inline(groups)).filter(F.col("committed").isNotNull())
