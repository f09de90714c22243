"""Gradient boosting by histograms: rows are binned and dealt out once, a pass sums the histograms of one level over the partitions.

What is fitted is what ``GBTRegressor`` describes, with its parameters: regression trees on the residuals of squared error, grown level by level by the
gain in variance over binned features. A row is a byte for each feature and the value it is to be fitted to; a task works on blocks of rows with
array operations. Histograms and splits move, never rows. The fitted trees are stored as Spark stores them and read back as Spark's own model.
"""

from __future__ import annotations

import json
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.session import fresh_dir

#: Rows a task has at least and at most, while the cores allow it; histograms of more tasks than ``FLAT`` are summed in two steps.
LEAST_ROWS, MOST_ROWS, FLAT = 20_000, 4_000_000, 32
#: A gain below this share of a node's mean square is rounding.
ROUNDING = 1e-12
NODES = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, "
    "leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)

Block = tuple[np.ndarray, np.ndarray]  # (feature, row) bins, what each row is fitted to
Splits = list[tuple[np.ndarray, np.ndarray]]  # by level: the feature and the last bin that goes left, of each node


# -- bins ------------------------------------------------------------------------------------

def cut_points(rows: DataFrame, columns: list[str], label: str, bins: int) -> tuple[int, list[np.ndarray]]:
    """The number of rows and the upper bounds of all bins but the last: between the values if they are few, else quantiles of all rows."""
    missing = [F.count(F.when(F.col(c).isNull() | F.isnan(c), 1)).alias(f"missing_{c}") for c in [*columns, label]]
    seen = rows.agg(F.count(F.lit(1)).alias("n"), *missing, *[F.approx_count_distinct(c).alias(f"values_{c}") for c in columns]).first()
    if not seen["n"]:
        raise ValueError("no rows to fit trees on")
    lacking = [c for c in [*columns, label] if seen[f"missing_{c}"]]
    if lacking:
        raise ValueError(f"null or NaN in {', '.join(lacking)}")
    few = [c for c in columns if seen[f"values_{c}"] <= 2 * bins]
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    found = rows.agg(
        *[F.percentile_approx(c, shares, 10_000).alias(f"quantiles_{c}") for c in columns], *[F.collect_set(c).alias(f"values_{c}") for c in few]).first()
    cuts = []
    for c in columns:
        values = np.unique(found[f"values_{c}"]) if c in few else None
        cuts.append((values[1:] + values[:-1]) / 2 if values is not None and len(values) <= bins else np.unique(found[f"quantiles_{c}"]))
    return seen["n"], cuts


def binned_blocks(rows: DataFrame, columns: list[str], label: str, cuts: list[np.ndarray], tasks: int) -> RDD:
    """The rows as blocks, dealt evenly to ``tasks`` partitions."""
    kind, width = np.min_scalar_type(max(len(k) for k in cuts)), len(columns)

    def packed(batches):
        for batch in batches:
            if batch.num_rows:
                bins = np.stack([np.searchsorted(k, batch.column(c).to_numpy(zero_copy_only=False)) for k, c in zip(cuts, columns)]).astype(kind)
                y = batch.column(label).to_numpy(zero_copy_only=False).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([bins.tobytes()]), pa.array([y.tobytes()])], ["bins", "y"])

    blocks = rows.select(*columns, label).mapInArrow(packed, "bins binary, y binary").repartition(tasks)
    return blocks.rdd.map(lambda r: (np.frombuffer(bytes(r[0]), kind).reshape(width, -1), np.frombuffer(bytes(r[1]), np.float64)))


# -- trees -----------------------------------------------------------------------------------

def places(bins: np.ndarray, splits: Splits) -> np.ndarray:
    """The node of each row on the level below the splits, from the left."""
    n = bins.shape[1]
    flat, rows, node = bins.ravel(), np.arange(n), np.zeros(n, np.int64)
    for feature, last in splits:
        node = 2 * node + (flat.take((feature * n).take(node) + rows) > last.take(node))
    return node


def histograms(blocks, splits: Splits, width: int, bins: int, squared: int) -> np.ndarray:
    """(count, sum and sum of squares; feature; node and bin) of some rows on the level below the splits; squares of the first ``squared`` features only."""
    cells = bins << len(splits)
    total = np.zeros((3, width, cells))
    for x, y in blocks:
        base, squares = places(x, splits) * bins, y * y
        for f in range(width):
            at = base + x[f]
            total[0, f] += np.bincount(at, minlength=cells)
            total[1, f] += np.bincount(at, y, cells)
            if f < squared:
                total[2, f] += np.bincount(at, squares, cells)
    return total


def _summed(state: RDD, splits: Splits, width: int, bins: int, squared: int) -> np.ndarray:
    parts = state.mapPartitions(lambda blocks: [histograms(blocks, splits, width, bins, squared)])
    if state.getNumPartitions() > FLAT:
        return parts.treeReduce(lambda a, b: a + b, 2)
    return reduce(lambda a, b: a + b, parts.collect())


def best_splits(total: np.ndarray, nodes: int, bins: int, least_rows: int, least_gain: float) -> dict[str, np.ndarray]:
    """Of each node: feature, last bin that goes left, gain (0 if no split is allowed), and (count, sum, squares) of itself and of both sides."""
    width = total.shape[1]
    upto = total.reshape(3, width, nodes, bins).cumsum(axis=3)
    whole = upto[:, 0, :, -1]
    left = upto[..., :-1]
    right = whole[:, None, :, None] - left
    with np.errstate(divide="ignore", invalid="ignore"):
        n, mean_square = whole[0], np.where(whole[0] > 0, whole[2] / whole[0], 0)
        gain = (left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - (whole[1] ** 2 / n)[None, :, None]) / n[None, :, None]
    allowed = (left[0] >= least_rows) & (right[0] >= least_rows) & (gain >= least_gain) & (gain > ROUNDING * mean_square[None, :, None])
    gain = np.where(allowed, gain, 0).transpose(1, 0, 2).reshape(nodes, -1)
    best, each = gain.argmax(axis=1), np.arange(nodes)
    feature, last = best // (bins - 1), best % (bins - 1)
    return {"feature": feature, "last": last, "gain": gain[each, best], "whole": whole,
            "left": left[:, feature, each, last], "right": right[:, feature, each, last]}


def grow(state: RDD, width: int, bins: int, depth: int, least_rows: int, least_gain: float) -> tuple[Splits, list[dict], np.ndarray]:
    """The splits by level, the nodes (children by place in the list) and the prediction of each place on the last level.

    A node that is not split sends all its rows left, so that they keep one place to the end.
    """
    splits, nodes, level, ends = [], [{}], {0: 0}, np.zeros(1 << depth)

    def known(k: int, stats) -> None:
        n, total, squares = (float(s) for s in stats)
        nodes[k] |= {"prediction": total / n, "impurity": max(squares / n - (total / n) ** 2, 0.0), "stats": [n, total, squares]}

    def ended(k: int, place: int) -> None:
        ends[place << (depth - len(splits))] = nodes[k]["prediction"]

    for d in range(depth):
        if not level:
            break
        # Squares do not bear on the choice of a split. A node's own come with its pass; the last level has none, so there they come by side.
        found = best_splits(_summed(state, splits, width, bins, width if d == depth - 1 else 1), 1 << d, bins, least_rows, least_gain)
        feature, last, below = np.zeros(1 << d, np.int64), np.full(1 << d, bins), {}
        for place, k in level.items():
            known(k, found["whole"][:, place])
            if found["gain"][place] <= 0:
                ended(k, place)
                continue
            feature[place], last[place] = found["feature"][place], found["last"][place]
            nodes[k] |= {"gain": float(found["gain"][place]), "feature": int(feature[place]), "last": int(last[place]), "children": [len(nodes), len(nodes) + 1]}
            for side in (0, 1):
                below[2 * place + side] = len(nodes)
                nodes.append({})
                if d == depth - 1:
                    known(len(nodes) - 1, found[("left", "right")[side]][:, place])
        splits.append((feature, last))
        level = below
    for place, k in level.items():
        ended(k, place)
    return splits, nodes, ends[::1 << (depth - len(splits))]


# -- boosting --------------------------------------------------------------------------------

def covers(regressor: GBTRegressor) -> bool:
    """Whether ``fit_boosted`` knows all that ``regressor`` asks for: squared error on all rows, all features and equal weights."""
    return (regressor.getLossType() == "squared" and regressor.getSubsamplingRate() == 1.0 and regressor.getFeatureSubsetStrategy() == "all"
            and regressor.getMinWeightFractionPerNode() == 0.0 and not regressor.isDefined("weightCol") and not regressor.isDefined("validationIndicatorCol"))


def fit_boosted(train: DataFrame, columns: list[str], regressor: GBTRegressor) -> GBTRegressionModel:
    """The boosted trees that ``regressor`` asks for, on all rows of ``train``; ``columns`` are doubles, in the order of the model's vector."""
    spark, sc = train.sparkSession, train.sparkSession.sparkContext
    depth, bins, trees, step = regressor.getMaxDepth(), regressor.getMaxBins(), regressor.getMaxIter(), regressor.getStepSize()
    label = regressor.getLabelCol()
    rows = train.select(*columns, F.col(label).cast("double").alias(label))
    n, cuts = cut_points(rows, columns, label, bins)
    cores = max(1, sc.defaultParallelism)
    tasks = max(min(cores, -(-n // LEAST_ROWS)), cores * (n // (cores * MOST_ROWS)))
    state = binned_blocks(rows, columns, label, cuts, tasks).persist(StorageLevel.MEMORY_AND_DISK)
    grown, before, stored = [], None, None
    for k in range(trees):
        # The first pass of a tree works out what the trees before it leave, and keeps it.
        if kept := k and k % regressor.getCheckpointInterval() == 0:
            state.checkpoint()
        splits, nodes, ends = grow(state, len(columns), bins, depth, regressor.getMinInstancesPerNode(), regressor.getMinInfoGain())
        grown.append(nodes)
        if before is not None:
            before.unpersist()
        if kept:
            _delete(sc, stored)
            stored = state.getCheckpointFile()
        # A tree is fitted to the negative gradient, twice the residual; the first one to the values themselves, with weight 1.
        factor, taken = (2.0, 2.0) if k == 0 else (1.0, 2.0 * step)

        def left_over(block: Block, splits=splits, ends=ends, factor=factor, taken=taken) -> Block:
            return block[0], factor * block[1] - taken * ends.take(places(block[0], splits))

        before, state = state, state.map(left_over).persist(StorageLevel.MEMORY_AND_DISK)
    before.unpersist()
    state.unpersist()
    _delete(sc, stored)
    return _as_spark_model(spark, regressor, len(columns), cuts, grown, [1.0] + [step] * (trees - 1))


def _delete(sc, path: str | None) -> None:
    if path:
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def _as_spark_model(spark, regressor: GBTRegressor, width: int, cuts: list[np.ndarray], grown: list[list[dict]], weights: list[float]) -> GBTRegressionModel:
    """The trees in the form in which Spark stores such a model, read back.

    All that is not trees comes from a stored model of one leaf, fitted by ``regressor`` itself.
    """
    leaf = spark.createDataFrame([(Vectors.dense([0.0] * width), 0.0)], [regressor.getFeaturesCol(), regressor.getLabelCol()])
    small, path = fresh_dir(spark, "leaf"), fresh_dir(spark, "trees")
    regressor.copy({regressor.maxIter: 1, regressor.maxDepth: 0}).fit(leaf).write().save(small)
    meta = json.loads(spark.read.text(f"{small}/metadata").first()[0])
    meta["paramMap"] |= {"maxIter": len(grown), "maxDepth": regressor.getMaxDepth()}
    meta["numTrees"] = len(grown)
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    about = json.loads(spark.read.parquet(f"{small}/treesMetadata").first()[1])
    if "maxDepth" in about.get("paramMap", {}):
        about["paramMap"]["maxDepth"] = regressor.getMaxDepth()
    spark.createDataFrame(
        [(k, json.dumps(about | {"uid": f"{about['uid']}_{k}"}), w) for k, w in enumerate(weights)], "_1 int, _2 string, _3 double",
    ).coalesce(1).write.parquet(f"{path}/treesMetadata")

    def stored(i: int, node: dict) -> tuple:
        n = int(node["stats"][0])
        if "children" not in node:
            return i, node["prediction"], node["impurity"], node["stats"], n, -1.0, -1, -1, (-1, [], -1)
        threshold = float(cuts[node["feature"]][node["last"]])
        return i, node["prediction"], node["impurity"], node["stats"], n, node["gain"], *node["children"], (node["feature"], [threshold], -1)

    spark.createDataFrame([(k, stored(i, x)) for k, nodes in enumerate(grown) for i, x in enumerate(nodes)], NODES).write.parquet(f"{path}/data")
    return GBTRegressionModel.load(path)
