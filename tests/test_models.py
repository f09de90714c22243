import pytest
from pyspark.sql import functions as F

from tripweave.operators import scoring, training
from tripweave.plans import fixtures as fx
from tripweave.schemas import BATCH_FEATURES, TRAINING_FEATURES
from tripweave.session import fresh_dir
from tripweave.sources import messages
from tripweave.streaming import speed_layer


@pytest.fixture(scope="module")
def linear(spark):
    return training.train_linear(fx.trips(spark, "/root/testdata/sf0.001"))


def test_defaults_are_the_source_systems(spark):
    stage = training.gbt()
    assert (stage.getMaxIter(), stage.getMaxDepth(), stage.getStepSize(), stage.getSeed()) == (100, 8, 0.1, 42)


def test_training_features_have_no_gaps(spark, sf_dir):
    rows = training.training_features(fx.trips(spark, sf_dir))
    gaps = rows.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in TRAINING_FEATURES]).first()
    assert sum(gaps) == 0 and rows.agg(F.max("trip_duration")).first()[0] <= 7200


def test_split_covers_all_rows_once(spark, sf_dir):
    rows = training.training_features(fx.trips(spark, sf_dir))
    train, test = training.train_test_split(rows)
    assert train.count() + test.count() == rows.count() and train.join(test, "id").count() == 0


def test_linear_model_beats_the_mean(linear):
    row = linear.metrics.first()
    assert row.r2 > 0.7 and row.mae <= row.rmse


def test_pipeline_inputs_are_standard_scores(spark, linear, sf_dir):
    train, _ = training.train_test_split(training.training_features(fx.trips(spark, sf_dir)))
    scored = linear.model.transform(train)
    row = scored.agg(F.avg("x_distance_km").alias("m"), F.stddev_pop("x_distance_km").alias("s")).first()
    assert row.m == pytest.approx(0, abs=1e-9) and row.s == pytest.approx(1)


def test_stored_model_scores_the_stream(spark, linear, sf_dir):
    stored = training.load_model(training.save_model(linear.model, fresh_dir(spark, "model")))
    log, out, progress = (fresh_dir(spark, n) for n in ("log", "out", "progress"))
    messages.append_to_folder(fx.messages(spark, sf_dir), log)
    speed_layer.start_speed_layer(
        messages.read_folder_stream(spark, log), out, progress, stored, trigger=None).awaitTermination()
    from tripweave.sources.speed_files import read_batches

    rows = read_batches(spark, out)
    batch = speed_layer.enrich(messages.decode(fx.messages(spark, sf_dir)), linear.model)
    both = rows.select("id", "predicted_duration").join(
        batch.select("id", F.col("predicted_duration").alias("p")), "id")
    assert both.count() == rows.count() > 0
    assert both.filter(F.abs(F.col("p") - F.col("predicted_duration")) > 1e-6).count() == 0
    # A missing passenger count is scored as 0 and stays null.
    assert rows.filter("passenger_count IS NULL AND predicted_duration IS NOT NULL").count() > 0


def test_batch_gbt_uses_seven_scaled_features(spark, sf_dir):
    trained = training.train_batch_gbt(fx.clean(spark, sf_dir), trees=3, depth=3)
    assert trained.features == BATCH_FEATURES and trained.params["maxDepth"] == "3"
    assert trained.model.stages[-1].getNumTrees == 3
    assert scoring.model_gate(trained.metrics, threshold=-10).first().passed


def test_leaderboard_order_and_log(spark, sf_dir):
    models = training.train_all(fx.trips(spark, sf_dir), trees=3, depth=3)
    board = training.leaderboard(models)
    errors = [r.rmse for r in board.collect()]
    assert errors == sorted(errors) and len(errors) == 3
    assert training.best_model(board).first().rmse == errors[0]
    path = fresh_dir(spark, "experiments")
    for trained in models[:2]:
        training.log_experiment(trained, 1, "20240101", path)
    logged = training.read_experiments(spark, path)
    assert logged.count() == 2 and "params" in logged.columns
