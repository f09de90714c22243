"""One round of streaming health checks, ending in an alert or in stored metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.rows import taken
from tripweave.operators import monitoring
from tripweave.sources import documents


def health_checks(
    topic: DataFrame | None, freshness: DataFrame | None, throughput: DataFrame | None, quality: DataFrame | None,
    broker: DataFrame | None = None,
) -> dict[str, tuple[DataFrame, str] | None]:
    """The five checks of the circuit breaker; consumer lag is reported but is not one of them."""
    def given(frame, verdict):
        return None if frame is None else (frame, verdict)

    return {
        "kafka_healthy": given(broker, "is_healthy"),
        "topic_healthy": given(topic, "topic_healthy"),
        "data_fresh": given(freshness, "is_fresh"),
        "throughput_ok": given(throughput, "is_healthy"),
        "quality_ok": given(quality, "is_acceptable"),
    }


def run_monitor(
    offsets: DataFrame, commits: DataFrame, log: DataFrame, speed: DataFrame, lines: DataFrame,
    topic: str, as_of: Column, out: str, stamp: str,
) -> str:
    """Evaluate all checks, store an alert or the healthy metrics, and the dashboard; return the action.

    Each check is computed once; verdict, dashboard, alert and metrics use its one row.
    """
    parts = {
        "topic_health": taken(monitoring.topic_health(offsets, topic)),
        "freshness": taken(monitoring.speed_freshness(speed, "processed_time", as_of)),
        "throughput": taken(monitoring.speed_throughput(speed, "batch_id", "processed_time", as_of)),
        "data_quality": taken(monitoring.speed_record_quality(lines)),
    }
    verdict = monitoring.circuit_breaker(health_checks(*parts.values()))
    outcome = verdict.first()
    lag = taken(monitoring.consumer_lag(offsets, commits).agg(
        F.max("total_lag").alias("total_lag"), F.max("is_acceptable").alias("is_acceptable")
    ))
    dashboard = monitoring.dashboard_document(
        {
            "kafka": {"topic_health": parts["topic_health"], "consumer_lag": lag},
            "speed_layer": {k: parts[k] for k in ("freshness", "throughput", "data_quality")},
            "producer": {"activity": monitoring.producer_activity(log, as_of)},
        },
        F.lit(stamp),
    )
    documents.write_document(dashboard, f"{out}/dashboard")
    if outcome.action == "alert":
        alert = monitoring.alerts(verdict).withColumn("timestamp", F.lit(stamp))
        documents.write_document(documents.as_document(alert), f"{out}/alert-{stamp}")
    else:
        metrics = monitoring.dashboard_document({"metrics": parts | {"consumer_lag": lag}}, F.lit(stamp))
        documents.write_document(metrics, f"{out}/metrics-{stamp}")
    return outcome.action
