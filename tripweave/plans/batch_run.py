"""The batch layer from raw trips to report, as one Spark application."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tripweave import settings as S
from tripweave.functions.trip import with_trip_features
from tripweave.operators import quality, reporting, scoring, serving, training, views
from tripweave.operators.filters import clean_rows
from tripweave.schemas import require_columns
from tripweave.sources import documents, master, speed_files, trips, view_store


class GateFailed(RuntimeError):
    """A gate stopped the run."""


@dataclass
class BatchRun:
    """Results of one run; the frames are small and already stored where a path is given."""

    facts: DataFrame
    report: DataFrame
    paths: dict[str, str] = field(default_factory=dict)


def build_views(clean: DataFrame, base: str, run_date: str) -> dict[str, str]:
    """Store the five batch views of one date, as five jobs at once; each scans its own columns."""
    built = {
        "hourly_stats": views.hourly_stats(clean),
        "daily_summary": views.daily_summary(clean, run_date),
        "vendor_stats": views.vendor_stats(clean),
        "geographic_stats": views.geographic_stats(clean),
        "temporal_patterns": views.temporal_patterns(clean),
    }

    def store(name: str) -> str:
        return view_store.write_view(built[name], base, name, run_date)

    with ThreadPoolExecutor(len(built)) as pool:
        return dict(zip(built, pool.map(inheritable_thread_target(clean.sparkSession)(store), built)))


def run_batch(
    raw: DataFrame, base: str, run_date: str, generated_at: str, speed_base: str | None = None,
    master_format: str = "parquet", trees: int = 100, depth: int = 6,
    quality_threshold: float = S.QUALITY_THRESHOLD, model_threshold: float = S.MODEL_R2_THRESHOLD,
) -> BatchRun:
    """Validate, clean, store, summarise, train or evaluate, reconcile and report.

    The raw table is read once: the pass that stages the cleaned trips also counts what validation asks of the raw ones. They take
    their place only once the gate has passed.
    Master data, views and training each scan only their own columns of the stored table, which survives the loss of any executor.
    """
    spark: SparkSession = raw.sparkSession
    require_columns(raw)
    counted = quality.ObservedFacts(raw)
    paths = {"cleaned": f"{base}/cleaned/run_date={run_date}"}
    staged = trips.write_trips(with_trip_features(clean_rows(counted.trips)), f"{base}/staged/run_date={run_date}")
    facts = counted.frame()
    if not quality.quality_gate(facts, quality_threshold).first().passed:
        trips.discard(spark, staged)
        raise GateFailed("data quality is below the threshold")
    trips.publish(spark, staged, paths["cleaned"])
    clean = spark.read.parquet(paths["cleaned"])

    paths["master"] = master.write_master(master.master_full(clean, run_date), f"{base}/master", master_format)
    paths |= build_views(clean, f"{base}/views", run_date)

    metrics = _train_or_evaluate(spark, clean, f"{base}/model", run_date, trees, depth)
    if not scoring.model_gate(metrics, model_threshold).first().passed:
        raise GateFailed("model performance is below the threshold")

    reconciliation = None
    if speed_base is not None:
        daily = view_store.read_view(spark, f"{base}/views", "daily_summary", run_date)
        reconciliation = serving.reconcile_layers(daily, speed_files.read_batches(spark, speed_base), run_date)

    report = reporting.run_report(quality.checked(facts), metrics, reconciliation)
    paths["report"] = documents.write_document(
        reporting.report_document(report, run_date, generated_at), f"{base}/reports/run_date={run_date}"
    )
    return BatchRun(facts, report, paths)


def _train_or_evaluate(spark, clean, base: str, run_date: str, trees: int, depth: int) -> DataFrame:
    """One row of metrics: of the stored model if there is one, else of a new one, which is stored."""
    path = f"{base}/pipeline"
    if trips.path_exists(spark, path):
        metrics = training.evaluate(training.load_model(path), clean)
    else:
        trained = training.train_batch_gbt(clean, trees, depth)
        training.save_model(trained.model, path)
        train, _ = training.train_test_split(clean)
        training.log_experiment(trained, train.count(), run_date, f"{base}/experiments")
        metrics = trained.metrics
    return spark.createDataFrame([metrics.first()], metrics.schema)


def run_simple_batch(raw: DataFrame, base: str, run_date: str, master_format: str = "parquet") -> dict[str, str]:
    """The small variant: uncleaned master records and three basic views."""
    require_columns(raw)
    rows = with_trip_features(raw)
    store = f"{base}/views"
    return {
        "master": master.write_master(master.master_simple(raw, run_date), f"{base}/master_simple", master_format),
        "hourly_stats": view_store.write_view(views.hourly_stats_basic(rows), store, "hourly_stats_basic", run_date),
        "daily_summary": view_store.write_view(
            views.daily_summary_basic(rows, run_date), store, "daily_summary_basic", run_date),
        "vendor_stats": view_store.write_view(views.vendor_stats_basic(rows), store, "vendor_stats_basic", run_date),
    }
