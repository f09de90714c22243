import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tripweave.operators import boosting, training
from tripweave.session import fresh_dir

LABEL = training.LABEL


@pytest.fixture(scope="module")
def rows(spark):
    """Few values in each column, so that Spark's cuts and ours are the same."""
    return spark.range(4000, numPartitions=5).select(
        (F.col("id") * 7919 % 23).cast("double").alias("a"), (F.col("id") * 104729 % 29).cast("double").alias("b"), F.lit(3.0).alias("c"),
        (F.pow(F.col("id") * 7919 % 23 - 11, 2) * 3 + F.col("id") * 104729 % 29 * 5 + F.col("id") % 13).alias(LABEL))


def both(rows, **options):
    regressor = GBTRegressor(labelCol=LABEL, seed=42, **options)
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)
    return boosting.fit_boosted(rows, ["a", "b", "c"], regressor), regressor.fit(vectors), vectors


def test_boosted_trees_are_spark_s(spark, rows):
    ours, theirs, vectors = both(rows, maxIter=25, maxDepth=4, checkpointInterval=10)
    assert ours.getNumTrees == 25 and ours.treeWeights == theirs.treeWeights
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-9)
    scored = ours.transform(vectors).withColumnRenamed("prediction", "p")
    assert theirs.transform(scored).agg(F.max(F.abs(F.col("p") - F.col("prediction")))).first()[0] < 1e-6
    for one, other in zip(ours.trees, theirs.trees):
        assert one.toDebugString.split("\n")[1].strip() == other.toDebugString.split("\n")[1].strip()
    again = type(ours).load(training.save_model(ours, fresh_dir(spark, "model")))
    assert again.toDebugString == ours.toDebugString and again.extractParamMap() == ours.extractParamMap()


def test_trees_end_where_nothing_is_left_to_split(rows):
    ours, _, vectors = both(rows.withColumn(LABEL, F.when(F.col("a") < 10, 1.0).otherwise(5.0)), maxIter=3, maxDepth=5)
    assert [t.numNodes for t in ours.trees] == [3, 1, 1]
    assert ours.transform(vectors).where(F.col("prediction") != F.col(LABEL)).count() == 0


def test_passes_do_not_run_on_objects_of_rows(spark, rows, monkeypatch):
    """The trip models are fitted by summed histograms; a regressor that asks for more is left to Spark."""
    seen = []
    monkeypatch.setattr(training, "fit_boosted", lambda *a: seen.append(a) or boosting.fit_boosted(*a))
    named = rows.withColumnRenamed("c", "id")
    training.fit_model(named, named, training.gbt(2, 2), "g", "gbt", ["a", "b"])
    assert len(seen) == 1
    training.fit_model(named, named, training.gbt(2, 2).setSubsamplingRate(0.5), "g", "gbt", ["a", "b"])
    assert len(seen) == 1


def test_gaps_are_refused(rows):
    for gap in (F.lit(None).cast("double"), F.lit(float("nan"))):
        with pytest.raises(ValueError, match="a"):
            boosting.fit_boosted(rows.withColumn("a", gap), ["a", "b"], training.gbt(2, 2))
    with pytest.raises(ValueError, match="no rows"):
        boosting.fit_boosted(rows.limit(0), ["a", "b"], training.gbt(2, 2))


def test_rows_are_dealt_evenly_whatever_the_files(rows):
    n, cuts = boosting.cut_points(rows, ["a", "b", "c"], LABEL, 32)
    assert n == 4000 and list(cuts[0]) == [k + 0.5 for k in range(22)] and len(cuts[2]) == 0
    blocks = boosting.binned_blocks(rows.coalesce(1).union(rows), ["a", "b", "c"], LABEL, cuts, 3)
    assert blocks.getNumPartitions() == 3 and blocks.map(lambda b: b[0].shape[1]).sum() == 8000
    splits = [(np.array([0]), np.array([10])), (np.array([1, 1]), np.array([32, 3]))]
    summed = blocks.map(lambda b: np.bincount(boosting.places(b[0], splits), minlength=4)).reduce(lambda x, y: x + y)
    counted = [rows.where(w).count() * 2 for w in ("a <= 10", "false", "a > 10 AND b <= 3", "a > 10 AND b > 3")]
    assert list(summed) == counted
