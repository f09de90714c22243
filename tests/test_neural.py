import numpy as np
import pytest
from pyspark.sql import functions as F

from tripweave.operators import neural, training


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    shape = (3, 5, 4, 1)
    w = neural.first_weights(shape, 2)
    x, y = rng.normal(size=(20, 3)), rng.normal(size=20)
    g, loss = neural.gradient(w, shape, x, y)
    assert loss == pytest.approx(((neural.forward(w, shape, x)[-1][:, 0] - y) ** 2).sum() / 2)
    for i in rng.choice(len(w), 25, replace=False):
        e = np.zeros_like(w)
        e[i] = 1e-6
        near = (neural.gradient(w + e, shape, x, y)[1] - neural.gradient(w - e, shape, x, y)[1]) / 2e-6
        assert g[i] == pytest.approx(near, abs=1e-4)


def test_a_curve_is_learned_and_repeats(spark):
    rows = spark.range(6000).select(
        F.col("id").cast("string").alias("id"), ((F.col("id") * 37 % 1000) / 500 - 1).alias("a"), F.when(F.col("id") % 50 > 0, (F.col("id") * 91 % 1000) / 500 - 1).alias("b"))
    rows = rows.withColumn("y", 100 + 40 * F.col("a") * F.col("a") - 20 * F.abs(F.coalesce("b", F.lit(0.0))))
    train, test = training.train_test_split(rows)
    fit = lambda: neural.fit_network(train, ["a", "b"], "y", hidden=(32, 16), batch_rows=1200, passes=50, step=2e-2)
    one, two = fit(), fit()
    assert np.allclose(one.weights, two.weights) and one.losses[-1] < one.losses[0] / 10
    found = one.transform(test).select("y", "prediction").collect()
    y, p = np.array([r["y"] for r in found]), np.array([r["prediction"] for r in found])
    assert 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum() > 0.9
    with pytest.raises(ValueError):
        neural.fit_network(rows.limit(0), ["a"], "y")
