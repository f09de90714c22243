"""A neural regressor trained data-parallel: each pass sums the gradients of one mini-batch over its partitions.

Rows are scaled and stored once, dealt into mini-batches by a hash. A pass reads the files of one mini-batch only; each task works out the
gradient of its rows in matrix products, the driver adds one gradient per task and takes an Adam step. What moves is
the weights and their gradients, never rows, and a lost task repeats its rows of one pass.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.session import fresh_dir

#: Hidden layers, rows of a mini-batch, passes and first step size.
HIDDEN, BATCH_ROWS, PASSES, STEP = (256, 128, 64, 32), 8192, 120, 2e-3
#: Tasks of a pass at most: each sends one gradient to the driver.
TASKS = 16


def _layers(weights: np.ndarray, shape: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The flat weights as (matrix, offsets) of each layer; views, not copies."""
    out, at = [], 0
    for a, b in zip(shape, shape[1:]):
        out.append((weights[at:at + a * b].reshape(a, b), weights[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def first_weights(shape: tuple[int, ...], seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in zip(shape, shape[1:]):
        parts += [rng.normal(0, np.sqrt(2 / a), a * b), np.zeros(b)]
    return np.concatenate(parts)


def forward(weights: np.ndarray, shape: tuple[int, ...], x: np.ndarray) -> list[np.ndarray]:
    """The input and what each layer makes of it; all but the last are rectified."""
    out = [x]
    layers = _layers(weights, shape)
    for i, (w, b) in enumerate(layers):
        z = out[-1] @ w + b
        out.append(np.maximum(z, 0) if i < len(layers) - 1 else z)
    return out


def gradient(weights: np.ndarray, shape: tuple[int, ...], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Gradient and sum of half the squared errors over the rows."""
    made = forward(weights, shape, x)
    error = made[-1][:, 0] - y
    back, parts = error[:, None], []
    for (w, _), below in zip(reversed(_layers(weights, shape)), reversed(made[:-1])):
        parts += [back.sum(axis=0), (below.T @ back).ravel()]
        back = (back @ w.T) * (below > 0)
    return np.concatenate(parts[::-1]), float((error * error).sum() / 2)


@dataclass
class NeuralModel:
    """Weights and scaling; ``transform`` adds ``prediction``. Missing features are taken as their mean."""

    features: list[str]
    shape: tuple[int, ...]
    weights: np.ndarray
    mean: np.ndarray
    deviation: np.ndarray
    label_mean: float
    label_deviation: float
    losses: list[float]

    def transform(self, rows: DataFrame) -> DataFrame:
        box = rows.sparkSession.sparkContext.broadcast(self)
        names = self.features

        @F.pandas_udf("double")
        def predicted(columns: pd.DataFrame) -> pd.Series:
            model = box.value
            x = np.nan_to_num((columns[names].to_numpy(np.float64) - model.mean) / model.deviation)
            return pd.Series(forward(model.weights, model.shape, x)[-1][:, 0] * model.label_deviation + model.label_mean)

        return rows.withColumn("prediction", predicted(F.struct(*[F.col(c).cast("double").alias(c) for c in names])))


def fit_network(
    train: DataFrame, features: list[str], label: str, hidden: tuple[int, ...] = HIDDEN, batch_rows: int = BATCH_ROWS, passes: int = PASSES,
    step: float = STEP, seed: int = 42, id_column: str = "id",
) -> NeuralModel:
    """Fit by mini-batches of about ``batch_rows`` rows; equal rows, seed and partitions give equal weights."""
    spark = train.sparkSession
    aggregates = [f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in [*features, label] for n, f in (("m", F.avg), ("d", F.stddev_pop))]
    known = train.agg(F.count(F.lit(1)).alias("n"), *aggregates).first()
    if not known["n"]:
        raise ValueError("no rows to fit a network on")
    mean = np.array([known[f"m_{c}"] or 0.0 for c in features])
    deviation = np.array([known[f"d_{c}"] or 1.0 for c in features])
    y_mean, y_deviation = known[f"m_{label}"], known[f"d_{label}"] or 1.0
    blocks = max(1, round(known["n"] / batch_rows))
    scaled = [((F.coalesce(F.col(c).cast("double"), F.lit(float(m))) - float(m)) / float(d)).alias(c) for c, m, d in zip(features, mean, deviation)]
    path = fresh_dir(spark, "network")
    # Files of a mini-batch come from a bounded number of tasks, and so do its gradients.
    rows = train.select(F.pmod(F.xxhash64(F.lit(seed), id_column), F.lit(blocks)).cast("int").alias("block"),
                        F.pmod(F.xxhash64(F.lit("part"), id_column), F.lit(min(TASKS, 8))).alias("part"), *scaled, ((F.col(label) - y_mean) / y_deviation).alias("y"))
    rows.repartition("block", "part").drop("part").write.partitionBy("block").parquet(path)
    stored = spark.read.parquet(path)
    shape = (len(features), *hidden, 1)
    weights = first_weights(shape, seed)
    first, second, losses = np.zeros_like(weights), np.zeros_like(weights), []
    for k in range(passes):
        box = spark.sparkContext.broadcast(weights)

        def summed(batches):
            total, loss, n = np.zeros(len(box.value)), 0.0, 0
            for batch in batches:
                x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in features], axis=1)
                g, e = gradient(box.value, shape, x, batch.column("y").to_numpy(zero_copy_only=False))
                total, loss, n = total + g, loss + e, n + len(x)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()]), pa.array([loss]), pa.array([n])], ["g", "loss", "n"])

        found = stored.where(F.col("block") == k % blocks).select(*features, "y").coalesce(TASKS).mapInArrow(summed, "g binary, loss double, n long").collect()
        box.unpersist()
        n = sum(r["n"] for r in found)
        if not n:
            continue
        g = np.sum([np.frombuffer(r["g"], np.float64) for r in sorted(found, key=lambda r: bytes(r["g"]))], axis=0) / n
        losses.append(sum(r["loss"] for r in found) / n)
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        rate = step * 0.5 * (1 + np.cos(np.pi * k / passes))
        weights = weights - rate * (first / (1 - 0.9 ** (k + 1))) / (np.sqrt(second / (1 - 0.999 ** (k + 1))) + 1e-8)
    return NeuralModel(list(features), shape, weights, mean, deviation, y_mean, y_deviation, losses)
