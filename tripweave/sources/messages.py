"""Trip messages: JSON values on a topic, or lines in a folder that stands in for one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave import settings as S
from tripweave.schemas import MESSAGE_SCHEMA, conform
from tripweave.sources.json_rows import is_record, parsed_lines, typed



# -- transport -------------------------------------------------------------------------------

def read_topic_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Streaming frame of a Kafka topic, from the latest offset, tolerating expired data."""
    base = {"startingOffsets": "latest", "failOnDataLoss": "false"}
    return (
        spark.readStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "subscribe": topic, **base, **options})
        .load()
    )


def read_topic(spark: SparkSession, servers: str, topic: str, since_ms: int | None = None) -> DataFrame:
    """Batch frame of a Kafka topic, or of its messages since a time, which is all an activity check needs."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if since_ms is not None:
        options |= {"startingTimestamp": str(since_ms), "startingOffsetsByTimestampStrategy": "latest"}
    return spark.read.format("kafka").options(**options).load().select(
        "topic", "partition", "offset", "timestamp", "value"
    )


def offsets_from_progress(spark: SparkSession, text: str, column: str) -> DataFrame:
    """(topic, partition, <column>) of an offset text such as a streaming query's progress reports.

    ``latestOffset`` of a Kafka source gives the ends of its topic and ``endOffset`` what the query
    has read, so lag and message counts need no scan of the topic.
    """
    per_topic = F.from_json(F.col("text"), "map<string,map<string,bigint>>")
    topics = spark.createDataFrame([(text,)], "text string").select(F.explode(per_topic).alias("topic", "p"))
    return topics.select("topic", F.explode("p").alias("partition", column)).withColumn(
        "partition", F.col("partition").cast("int")
    )


def read_folder_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of message lines that arrive as files."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def publish(messages: DataFrame, servers: str) -> None:
    """Send (topic, value) rows to Kafka."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def append_to_folder(messages: DataFrame, path: str) -> str:
    messages.select("value").write.mode("append").text(path)
    return path


# -- encode ----------------------------------------------------------------------------------

def encode(
    trips: DataFrame, topic: str, now: Column, keep_original: bool = True, key: str | None = None
) -> DataFrame:
    """(topic, value): each trip as a typed JSON record whose pickup time is the time of sending.

    Messages carry no key unless a column is named for it.
    """
    stamped = trips.withColumns({
        "original_pickup_datetime": F.col("pickup_datetime"),
        "pickup_datetime": now,
    })
    typed = conform(stamped, MESSAGE_SCHEMA, {"store_and_fwd_flag": "N"})
    fields = [c for c in typed.columns if keep_original or c != "original_pickup_datetime"]
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    keyed = [F.col(key).cast("string").alias("key")] if key else []
    return typed.select(F.lit(topic).alias("topic"), *keyed, value.alias("value"))


def replay_limit(trips: DataFrame, order: list[str], n: int = S.PUBLISH_LIMIT) -> DataFrame:
    """The first ``n`` trips, as the stand-alone publisher sends them."""
    return trips.orderBy(*order).limit(n)


# -- decode ----------------------------------------------------------------------------------

def decode(messages: DataFrame) -> DataFrame:
    """Typed columns of the values that parse; blank values are skipped."""
    return parsed_lines(messages, F.col("value").cast("string"), MESSAGE_SCHEMA).filter(is_record(MESSAGE_SCHEMA)).select(*typed(MESSAGE_SCHEMA))


def rejected(messages: DataFrame) -> DataFrame:
    """The non-blank values that do not parse, for quarantine."""
    return parsed_lines(messages, F.col("value").cast("string"), MESSAGE_SCHEMA).filter(~is_record(MESSAGE_SCHEMA)).select("value")
