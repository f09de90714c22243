"""Health figures of topic, speed layer and producer, and the verdicts drawn from them.

Each check is a one-row frame; a verdict reads them side by side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave import settings as S
from tripweave.functions.rows import side_by_side, the_row
from tripweave.functions.trip import computed_once, seconds_between
from tripweave.operators.filters import written_since
from tripweave.sources.json_rows import not_blank

REQUIRED_FIELDS = ["vendor_id", "passenger_count", "trip_duration"]


# -- topic -----------------------------------------------------------------------------------

def topic_offsets(log: DataFrame) -> DataFrame:
    """Begin and end offset per partition of a message log; the end is one past the last."""
    return log.groupBy("topic", "partition").agg(
        F.min("offset").alias("begin_offset"), (F.max("offset") + 1).alias("end_offset")
    )


def topic_message_counts(offsets: DataFrame) -> DataFrame:
    return offsets.select(
        "topic", "partition", "begin_offset", "end_offset",
        (F.col("end_offset") - F.col("begin_offset")).alias("messages"),
    )


def topic_health(offsets: DataFrame, topic: str) -> DataFrame:
    """(topic, topic_exists, partitions, message_count_estimate, topic_healthy), also if absent."""
    found = offsets.filter(F.col("topic") == topic).agg(
        F.count(F.lit(1)).alias("partitions"),
        F.coalesce(F.sum(F.col("end_offset") - F.col("begin_offset")), F.lit(0)).alias("message_count_estimate"),
    )
    exists = F.col("partitions") > 0
    return found.select(
        F.lit(topic).alias("topic"), exists.alias("topic_exists"), "partitions",
        "message_count_estimate", exists.alias("topic_healthy"),
    )


def consumer_lag(offsets: DataFrame, commits: DataFrame, limit: int = S.MAX_CONSUMER_LAG) -> DataFrame:
    """Per group: messages behind the end, the sum of committed offsets, and whether the total is acceptable.

    Commits are matched to the end offsets of their topic partition; a commit on a partition that no
    longer exists has no lag.
    """
    behind = F.greatest(F.coalesce(F.col("end_offset") - F.col("committed"), F.lit(0)), F.lit(0))
    per_group = (
        commits.join(offsets.select("topic", "partition", "end_offset"), ["topic", "partition"], "left")
        .groupBy("group_id")
        .agg(F.sum(behind).alias("lag"), F.sum("committed").alias("committed_total"))
    )
    total = per_group.agg(F.coalesce(F.sum("lag"), F.lit(0)).alias("total_lag"))
    return per_group.withColumn("total_lag", total.scalar()).withColumn("is_acceptable", F.col("total_lag") <= limit)


def producer_activity(log: DataFrame, as_of: Column, limit: int = S.PRODUCER_ACTIVE_SECONDS) -> DataFrame:
    """Age of the newest message in seconds; a topic without messages is not active."""
    newest = log.agg(F.max("timestamp").alias("last_message"))
    age = seconds_between(F.col("last_message"), as_of)
    return newest.select(
        age.alias("last_message_age"), F.coalesce(age < limit, F.lit(False)).alias("producer_active")
    )


# -- speed layer -----------------------------------------------------------------------------

def speed_freshness(writes: DataFrame, ts: str, as_of: Column, limit: float = S.MAX_DATA_AGE_MINUTES) -> DataFrame:
    """Age of the newest write in minutes; nothing written counts as fresh."""
    newest = writes.agg(F.max(ts).alias("latest"))
    age = seconds_between(F.col("latest"), as_of) / F.lit(60.0)
    return newest.select(
        "latest", age.alias("age_minutes"), F.coalesce(age <= limit, F.lit(True)).alias("is_fresh")
    )


def records_per_file(rows: DataFrame, file: str) -> DataFrame:
    return rows.groupBy(file).agg(F.count(F.lit(1)).alias("records"))


def speed_throughput(
    rows: DataFrame, file: str, ts: str, as_of: Column, minimum: float = S.MIN_THROUGHPUT_PER_MINUTE
) -> DataFrame:
    """One row: files, records, those of the last hour, records per minute and the verdict.

    A file is dated by its newest record, as a file's modification time would date it.
    """
    files = rows.groupBy(file).agg(F.count(F.lit(1)).alias("records"), F.max(ts).alias("written"))
    recent = written_since(F.col("written"), as_of)
    per_minute = F.col("records_last_hour") / F.lit(60.0)
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"),
        F.count(F.when(recent, 1)).alias("files_last_hour"),
        F.coalesce(F.sum(F.when(recent, F.col("records"))), F.lit(0)).alias("records_last_hour"),
    ).select(
        "*", per_minute.alias("throughput_per_minute"),
        ((per_minute >= minimum) | (F.col("total_records") == 0)).alias("is_healthy"),
    )


def quality_sample(rows: DataFrame, file: str, id_column: str = "id", files: int = S.QUALITY_FILES,
                   n: int = S.QUALITY_SAMPLE) -> DataFrame:
    """A repeatable sample: ``n`` rows of the newest ``files`` files, in the order of a hash of the id."""
    newest = rows.select(file).distinct().orderBy(F.col(file).desc()).limit(files)
    # ``newest`` holds at most ``files`` names.
    recent = rows.join(F.broadcast(newest), file, "left_semi")
    return recent.orderBy(F.md5(F.col(id_column)), id_column).limit(n)


def _checked(lines: DataFrame, text: str) -> DataFrame:
    """Non-blank lines as (fields, errors); both are null for a line that does not parse."""
    fields = F.from_json(F.col(text), "map<string,string>")
    parsed = computed_once(lines.filter(not_blank(F.col(text))), fields.alias("m"))

    def number(name: str) -> Column:
        return F.try_element_at("m", F.lit(name)).try_cast("double")

    checks = [(f"missing_{f}", ~F.map_contains_key("m", f)) for f in REQUIRED_FIELDS] + [
        ("negative_passengers", number("passenger_count") < 0),
        ("negative_duration", number("trip_duration") < 0),
    ]
    flags = F.array(*[F.when(bad, F.lit(name)) for name, bad in checks])
    return parsed.withColumn("errors", F.when(F.col("m").isNotNull(), F.array_compact(flags)))


def speed_record_errors(lines: DataFrame, text: str = "value") -> DataFrame:
    """(error, n) over JSON lines. An explicit null is not a missing field."""
    return _checked(lines, text).select(F.explode("errors").alias("error")).groupBy("error").agg(
        F.count(F.lit(1)).alias("n")
    )


def speed_record_quality(
    lines: DataFrame, text: str = "value", threshold: float = S.RECORD_QUALITY_THRESHOLD
) -> DataFrame:
    """One row: lines seen, parsed, valid, the score and whether it is acceptable.

    No lines at all is acceptable; lines of which none parses score 0.
    """
    counts = _checked(lines, text).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count("m").alias("sample_size"),
        F.count(F.when(F.size("errors") == 0, 1)).alias("valid_records"),
    )
    rate = F.coalesce(
        F.try_divide(F.col("valid_records").cast("double"), F.col("sample_size").cast("double")), F.lit(0.0)
    )
    return counts.select(
        "line_count", "sample_size", "valid_records",
        (F.col("sample_size") - F.col("valid_records")).alias("invalid_records"),
        rate.alias("quality_score"),
        ((F.col("line_count") == 0) | (rate >= threshold)).alias("is_acceptable"),
    )


# -- verdicts --------------------------------------------------------------------------------

def circuit_breaker(checks: dict[str, tuple[DataFrame, str] | None]) -> DataFrame:
    """Verdict over named checks, each a one-row frame and the name of its boolean column.

    A check without a frame, or with a null verdict, counts as healthy.
    """
    given = {name: frame.select(F.col(verdict).alias("ok")) for name, (frame, verdict) in
             ((n, c) for n, c in checks.items() if c is not None)}
    row = side_by_side(given)
    failed = F.array_compact(F.array(*[F.when(~F.col(f"{name}.ok"), F.lit(name)) for name in given]))
    ok = F.size("failed") == 0
    return row.select(failed.alias("failed")).select(
        F.concat_ws(", ", "failed").alias("failed_checks"),
        F.size("failed").alias("failed_count"),
        ok.alias("overall_healthy"),
        F.when(ok, "continue").otherwise("alert").alias("action"),
    )


def alerts(verdict: DataFrame) -> DataFrame:
    """One alert row where the verdict is unhealthy, none otherwise."""
    return verdict.filter(~F.col("overall_healthy")).select(
        F.lit("streaming_alert").alias("type"),
        F.lit("warning").alias("severity"),
        "failed_checks",
        F.concat(F.lit("Checks of the stream failed: "), F.col("failed_checks")).alias("message"),
    )


def dashboard_document(sections: dict[str, dict[str, DataFrame]], stamp: Column) -> DataFrame:
    """One JSON document with a nested object per section, from one-row frames."""
    parts = {f"{section}_{name}": frame for section, named in sections.items() for name, frame in named.items()}
    layout = [
        F.struct(*[F.col(f"{section}_{name}").alias(name) for name in named]).alias(section)
        for section, named in sections.items()
    ]
    body = F.struct(stamp.alias("generated_at"), *layout)
    return side_by_side(parts).select(F.to_json(body, {"ignoreNullFields": "false"}).alias("document"))


def healthy_metrics(verdict: DataFrame, checks: dict[str, DataFrame], stamp: Column) -> DataFrame:
    """The metrics document of a round in which all checks passed, from one-row frames; no row otherwise."""
    document = dashboard_document({"metrics": checks}, stamp)
    return document.filter(the_row(verdict)["overall_healthy"])
