"""Trip-duration regression with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions.rows import taken, the_row
from tripweave.functions.trip import with_trip_features
from tripweave.operators.boosting import covers, fit_boosted
from tripweave.operators.filters import training_rows
from tripweave.operators.neural import fit_network
from tripweave.operators.scoring import regression_metrics
from tripweave.operators.statistics import fill_with, medians
from tripweave.schemas import BATCH_FEATURES, TRAINING_FEATURES
from tripweave.session import materialize, shared_dir

LABEL = "trip_duration"
SEED = 42


# -- data ------------------------------------------------------------------------------------

def training_features(trips: DataFrame, features: list[str] = TRAINING_FEATURES) -> DataFrame:
    """Rows of plausible duration with features; missing features take the median.

    The features are written once, since the medians and the fits read them several times.
    """
    rows = materialize(with_trip_features(training_rows(trips)).select("id", *features, LABEL))
    return fill_with(rows, medians(rows, features))


def is_test_row(id_column: str = "id") -> Column:
    """About one row in five, by a hash of its id, so the split survives any repartitioning."""
    return F.substring(F.md5(F.col(id_column)), 1, 2) < F.lit("33")


def train_test_split(rows: DataFrame, id_column: str = "id") -> tuple[DataFrame, DataFrame]:
    test = is_test_row(id_column)
    return rows.filter(~test), rows.filter(test)


# -- scaling ---------------------------------------------------------------------------------

def scaling(rows: DataFrame, features: list[str]) -> DataFrame:
    """One row of mean and population deviation per feature; a constant feature scales by 1."""
    aggregates = []
    for c in features:
        deviation = F.stddev_pop(c)
        aggregates += [
            F.avg(c).alias(f"mean_{c}"),
            F.when(deviation == 0, F.lit(1.0)).otherwise(deviation).alias(f"std_{c}"),
        ]
    return rows.agg(*aggregates)


def scale_with(rows: DataFrame, moments: DataFrame, features: list[str]) -> DataFrame:
    """Features replaced by their standard scores under a one-row frame of moments."""
    known = the_row(moments)
    scores = [((F.col(c) - known[f"mean_{c}"]) / known[f"std_{c}"]).alias(c) for c in features]
    return rows.select(*[c for c in rows.columns if c not in features], *scores)


def _prepare(features: list[str], moments: dict[str, float] | None) -> list:
    """Pipeline stages from feature columns to one vector; moments become literals of the plan."""
    def term(c: str) -> str:
        value = f"CAST({c} AS DOUBLE)"
        if moments is None:
            return f"{value} AS x_{c}"
        return f"({value} - {moments[f'mean_{c}']!r}D) / {moments[f'std_{c}']!r}D AS x_{c}"

    to_inputs = SQLTransformer(statement=f"SELECT *, {', '.join(term(c) for c in features)} FROM __THIS__")
    to_vector = VectorAssembler(inputCols=[f"x_{c}" for c in features], outputCol="features")
    return [to_inputs, to_vector]


# -- models ----------------------------------------------------------------------------------

@dataclass
class Trained:
    name: str
    kind: str
    model: PipelineModel
    features: list[str]
    params: dict[str, str]
    metrics: DataFrame  # one row: rmse, mae, r2, samples

    def summary(self) -> DataFrame:
        """One row: name, kind and metrics."""
        return self.metrics.select(
            F.lit(self.name).alias("name"), F.lit(self.kind).alias("type"), "rmse", "mae", "r2", "samples"
        )


def fit_model(
    train: DataFrame, test: DataFrame, regressor, name: str, kind: str,
    features: list[str] = TRAINING_FEATURES, scaled: bool = False,
) -> Trained:
    """Fit one pipeline on ``train`` and measure it on ``test``."""
    shared_dir(train.sparkSession)  # boosting cuts its lineage there
    moments = scaling(train, features).first().asDict() if scaled else None
    prepared = _prepare(features, moments)
    if isinstance(regressor, GBTRegressor) and covers(regressor):
        to_vector = Pipeline(stages=prepared).fit(train)
        trees = fit_boosted(prepared[0].transform(train), [f"x_{c}" for c in features], regressor)
        model = PipelineModel([*to_vector.stages, trees])
    else:
        model = Pipeline(stages=[*prepared, regressor]).fit(train)
    params = {p.name: str(v) for p, v in regressor.extractParamMap().items()}
    # Ranking and logging the metrics must not score the test rows again.
    metrics = taken(evaluate(model, test))
    return Trained(name, kind, model, features, params, metrics)


def gbt(trees: int = 100, depth: int = 8, step: float = 0.1, seed: int = SEED) -> GBTRegressor:
    return GBTRegressor(
        labelCol=LABEL, maxIter=trees, maxDepth=depth, stepSize=step, seed=seed, checkpointInterval=10
    )


def linear() -> LinearRegression:
    return LinearRegression(labelCol=LABEL)


def forest(trees: int = 20, depth: int = 8, seed: int = SEED) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=LABEL, numTrees=trees, maxDepth=depth, seed=seed)


def evaluate(model, rows: DataFrame) -> DataFrame:
    """Metrics of a fitted model on rows that carry its features and the label."""
    return regression_metrics(model.transform(rows), LABEL, "prediction")


def _prepared(trips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train and test rows with features."""
    return train_test_split(training_features(trips))


def train_gbt(trips: DataFrame, trees: int = 100, depth: int = 8) -> Trained:
    """The stand-alone boosted model: nine features, unscaled."""
    train, test = _prepared(trips)
    return fit_model(train, test, gbt(trees, depth), "GradientBoosting", "gbt")


def train_batch_gbt(clean: DataFrame, trees: int = 100, depth: int = 6) -> Trained:
    """The batch run's boosted model: seven scaled features of cleaned trips."""
    train, test = train_test_split(clean.select("id", *BATCH_FEATURES, LABEL))
    return fit_model(train, test, gbt(trees, depth), "GradientBoosting", "gbt", BATCH_FEATURES, scaled=True)


def train_linear(trips: DataFrame) -> Trained:
    """The linear model on nine scaled features."""
    train, test = _prepared(trips)
    return fit_model(train, test, linear(), "LinearRegression", "linear", scaled=True)


def fit_neural(train: DataFrame, test: DataFrame, **options) -> Trained:
    model = fit_network(train, TRAINING_FEATURES, LABEL, **options)
    params = {"hidden": str(model.shape[1:-1]), "passes": str(len(model.losses))} | {k: str(v) for k, v in options.items()}
    return Trained("NeuralNetwork", "mlp", model, TRAINING_FEATURES, params, taken(evaluate(model, test)))


def train_neural(trips: DataFrame, **options) -> Trained:
    """The neural model on nine scaled features, trained in passes over mini-batches."""
    return fit_neural(*_prepared(trips), **options)


def train_all(trips: DataFrame, trees: int = 100, depth: int = 8) -> list[Trained]:
    """All candidate models on one split of one prepared table."""
    train, test = _prepared(trips)
    return [
        fit_model(train, test, linear(), "LinearRegression", "linear", scaled=True),
        fit_model(train, test, forest(depth=depth), "RandomForest", "forest", scaled=True),
        fit_model(train, test, gbt(trees, depth), "GradientBoosting", "gbt"),
    ]


# -- comparison and storage ------------------------------------------------------------------

def leaderboard(models: list[Trained]) -> DataFrame:
    """(name, type, rmse, mae, r2, samples), best first."""
    return reduce(DataFrame.unionByName, [m.summary() for m in models]).orderBy("rmse")


def best_model(board: DataFrame) -> DataFrame:
    return board.orderBy("rmse").limit(1)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def log_experiment(trained: Trained, training_samples: int, run_date: str, path: str) -> str:
    """Append one row of parameters, features and metrics to the experiments table."""
    pairs = [F.lit(x) for item in sorted(trained.params.items()) for x in item]
    (
        trained.summary()
        .withColumns({
            "run_date": F.lit(run_date),
            "features": F.array(*[F.lit(c) for c in trained.features]),
            "params": F.create_map(*pairs),
            "training_samples": F.lit(training_samples).cast("bigint"),
        })
        .withColumnRenamed("samples", "test_samples")
        .write.mode("append").parquet(path)
    )
    return path


def read_experiments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
