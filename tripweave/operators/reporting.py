"""The run report: one row per stage that produced something."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.rows import side_by_side

_METRICS = {
    "row_count": "bigint", "quality_score": "double", "anomaly_percentage": "double",
    "records_processed": "bigint", "r2_score": "double", "rmse": "double", "discrepancies": "string",
}


def _stage(name: str, status: Column, present: Column, metrics: dict[str, Column]) -> Column:
    """The report row of one stage, or null if the stage is not present."""
    row = F.struct(
        F.lit(name).alias("stage"), status.alias("status"),
        *[metrics.get(m, F.lit(None)).cast(t).alias(m) for m, t in _METRICS.items()],
    )
    return F.when(present, row)


def run_report(
    checked: DataFrame | None = None, model: DataFrame | None = None, reconciliation: DataFrame | None = None
) -> DataFrame:
    """(stage, status, metrics...) from one-row frames; what did not run is absent.

    ``checked`` may carry ``row_count`` and ``quality_score``, ``anomaly_percentage`` and
    ``clean_count``; each stands for one stage. Every frame is computed once.
    """
    given = {n: f for n, f in (("c", checked), ("m", model), ("r", reconciliation)) if f is not None}
    if not given:
        raise ValueError("a report needs at least one stage")
    success, stages = F.lit("success"), []
    if checked is not None and "quality_score" in checked.columns:
        stages.append(_stage("data_validation", success, F.col("c").isNotNull(), {
            "row_count": F.col("c.row_count"), "quality_score": F.col("c.quality_score")}))
    if checked is not None and "anomaly_percentage" in checked.columns:
        stages.append(_stage("anomaly_detection", success, F.col("c").isNotNull(), {
            "anomaly_percentage": F.col("c.anomaly_percentage")}))
    if checked is not None and "clean_count" in checked.columns:
        stages.append(_stage("batch_processing", success, F.col("c.clean_count") > 0, {
            "records_processed": F.col("c.clean_count")}))
    if model is not None:
        stages.append(_stage("ml_pipeline", success, F.col("m").isNotNull(), {
            "r2_score": F.col("m.r2"), "rmse": F.col("m.rmse")}))
    if reconciliation is not None:
        stages.append(_stage("reconciliation", F.col("r.status"), F.col("r").isNotNull(), {
            "discrepancies": F.col("r.discrepancies")}))
    return side_by_side(given).select(F.inline(F.array_compact(F.array(*stages))))


def report_document(report: DataFrame, run_date: str, generated_at: str) -> DataFrame:
    """The report as one JSON document: a map from stage to its status and metrics."""
    body = F.struct("status", *_METRICS)
    by_stage = report.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("stage", body.alias("b"))))).alias("s"))
    return by_stage.select(F.to_json(F.struct(
        F.lit(run_date).alias("execution_date"), F.lit(generated_at).alias("generated_at"),
        F.lit("completed").alias("status"), F.col("s").alias("stages"),
    )).alias("document"))


def completion_summary(report: DataFrame, run_date: str) -> DataFrame:
    """(subject, stage, status) for the notice that a run has ended."""
    return report.select(F.lit(f"Run complete - {run_date}").alias("subject"), "stage", "status")
