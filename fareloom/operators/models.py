"""Fitting, tuning and scoring with `pyspark.ml`, boosted trees and k-nearest rows."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import TrainValidationSplit
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from fareloom.functions.projections import with_model_stamp
from fareloom.operators import boosting, knn
from fareloom.operators.asof import FeatureLookup, create_training_set
from fareloom.operators.forest import ForestRegressor
from fareloom.operators.gbt import BoostedRegressor
from fareloom.sources.staging import stage

FEATURES = (
    "trip_distance",
    "pickup_zip",
    "dropoff_zip",
    "mean_fare_window_1h_pickup_zip",
    "count_trips_window_1h_pickup_zip",
    "count_trips_window_30m_dropoff_zip",
    "dropoff_is_weekend",
)
LABEL = "fare_amount"


def depth_for_leaves(leaves: int) -> int:
    """Depth of the smallest full binary tree with that many leaves."""
    return max(1, math.ceil(math.log2(leaves)))


def gbt(
    label: str = LABEL,
    rounds: int = 100,
    leaves: int = 32,
    rate: float = 0.1,
    min_child: int = 20,
    seed: int = 123,
) -> BoostedRegressor:
    return BoostedRegressor(
        labelCol=label,
        maxIter=rounds,
        maxDepth=depth_for_leaves(leaves),
        stepSize=rate,
        minInstancesPerNode=min_child,
        seed=seed,
    )


def elastic_net(label: str = LABEL, alpha: float = 0.1, l1_ratio: float = 0.5) -> LinearRegression:
    return LinearRegression(
        labelCol=label, regParam=alpha, elasticNetParam=l1_ratio, standardization=False
    )


def random_forest(
    label: str = LABEL,
    trees: int = 200,
    depth: int = 30,
    seed: int = 123,
    min_child: int = 1,
    node_memory_mb: int = 256,
) -> ForestRegressor:
    """30 is the deepest tree `pyspark.ml` grows; here nodes of few rows are finished within tasks.

    Trees are a table, not on the driver. `node_memory_mb` decides how many nodes of many rows
    one pass splits.
    """
    return ForestRegressor(
        labelCol=label,
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        minInstancesPerNode=min_child,
        maxMemoryInMB=node_memory_mb,
    )


# Model contract: a name and a function that returns an unfitted estimator.
MODELS: dict[str, Callable[..., Estimator]] = {
    "gbt": gbt,
    "elastic_net": elastic_net,
    "random_forest": random_forest,
}


def register_model(name: str, factory: Callable[..., Estimator]) -> None:
    MODELS[name] = factory


@dataclass(frozen=True)
class NearestModel:
    """The training rows themselves, and the medians that stand for missing features."""

    rows: DataFrame
    features: tuple[str, ...]
    medians: tuple[float, ...]
    k: int

    def transform(self, df: DataFrame) -> DataFrame:
        names = [f"_near{i}" for i in range(len(self.features))]
        asked = df.withColumns(
            {n: _filled(f, m) for n, f, m in zip(names, self.features, self.medians)}
        )
        return knn.knn_regress(self.rows, asked, names, "_label", "_row", self.k).drop(*names)


def _filled(feature: str, value: float) -> Column:
    return F.nanvl(F.coalesce(F.col(f"`{feature}`").try_cast("double"), F.lit(value)), F.lit(value))


def nearest(
    train: DataFrame, features: Sequence[str], label: str = LABEL, k: int = 10
) -> NearestModel:
    """k nearest rows by Euclidean distance. A missing feature becomes the training median."""
    found = train.select(
        *[F.col(f"`{f}`").try_cast("double").alias(f"f{i}") for i, f in enumerate(features)]
    ).approxQuantile([f"f{i}" for i in range(len(features))], [0.5], 0.001)
    medians = tuple(q[0] if q else 0.0 for q in found)
    rows = train.select(
        F.col(label).cast("double").alias("_label"),
        F.monotonically_increasing_id().alias("_row"),
        *[_filled(f, m).alias(f"_near{i}") for i, (f, m) in enumerate(zip(features, medians))],
    )
    return NearestModel(stage(rows, "nearest-rows"), tuple(features), medians, k)


def _boosted(train: DataFrame, features: Sequence[str], label: str, **params):
    return boosting.fit_boosted(train, features, label, **params)


# Models beside the estimators: fitted by a function, scored by `transform`.
FITS: dict[str, Callable] = {"boosted": _boosted, "k_nearest": nearest}


class _Stages(Pipeline):
    """A search over settings of the last stage fits the stages before it once."""

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[dict]) -> Iterator[tuple[int, PipelineModel]]:
        *before, last = self.getStages()
        if any(p.parent != last.uid for m in paramMaps for p in m):
            return super().fitMultiple(dataset, paramMaps)
        ready = Pipeline(stages=before).fit(dataset)
        fits = last.fitMultiple(ready.transform(dataset), paramMaps)
        return map(lambda found: (found[0], PipelineModel([*ready.stages, found[1]])), fits)


def with_assembler(
    estimator: Estimator, features: Sequence[str], empty: Sequence[str] = (), gaps: Sequence[str] = ()
) -> Pipeline:
    """A missing feature becomes the training rows' median: fits and scoring keep every row.

    Text is read as a number, and missing if it is none. Features in `empty` had no value at all and
    count as 0 when missing; those in `gaps` were missing at times and get a flag beside them.
    """
    numbers, filled, flags = [], [], []
    for i, f in enumerate(features):
        name = "`" + f.replace("`", "``") + "`"
        value = f"nullif(try_cast({name} AS double), double('NaN'))"
        numbers.append(f"{f'coalesce({value}, 0D)' if f in empty else value} AS _number_{i}")
        filled.append(f"_filled_{i}")
        if f in gaps:
            numbers.append(f"CASE WHEN {value} IS NULL THEN 1D ELSE 0D END AS _missing_{i}")
            flags.append(f"_missing_{i}")
    cast = SQLTransformer(statement=f"SELECT *, {', '.join(numbers)} FROM __THIS__")
    inputs = [f"_number_{i}" for i in range(len(features))]
    imputer = Imputer(inputCols=inputs, outputCols=filled, strategy="median")
    assembler = VectorAssembler(inputCols=filled + flags, outputCol="features", handleInvalid="keep")
    return _Stages(stages=[cast, imputer, assembler, estimator])


def _present(frame: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    """Features without any value, and those with some missing."""
    n, *present = frame.agg(
        F.count(F.lit(1)),
        *[F.count(F.nullif(F.col(f"`{f}`").try_cast("double"), F.lit(float("nan")))) for f in features],
    ).first()
    empty = [f for f, p in zip(features, present) if p == 0]
    return empty, [f for f, p in zip(features, present) if 0 < p < n]


def fit(name: str, train: DataFrame, features: Sequence[str], label: str = LABEL, **params):
    """Fit a registered model on the rows with a label. The data stays in Spark."""
    extra = [params["held_out"]] if params.get("held_out") else []
    frame = train.select(*features, label, *extra).dropna(subset=[label])
    if name in FITS:
        return FITS[name](frame, features, label, **params)
    return with_assembler(MODELS[name](label, **params), features, *_present(frame, features)).fit(frame)


def fit_gbt(train: DataFrame, features: Sequence[str], label: str = LABEL, **params) -> Model:
    return fit("gbt", train, features, label, **params)


def fit_elastic_net(
    train: DataFrame, features: Sequence[str], label: str = LABEL, **params
) -> Model:
    return fit("elastic_net", train, features, label, **params)


def fit_random_forest(
    train: DataFrame, features: Sequence[str], label: str = LABEL, **params
) -> Model:
    return fit("random_forest", train, features, label, **params)


def fit_boosted(
    train: DataFrame, features: Sequence[str], label: str = LABEL, **params
) -> boosting.BoostedTrees:
    return fit("boosted", train, features, label, **params)


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def holdout_rmse(model: Model, test: DataFrame, label: str = LABEL) -> float:
    evaluator = RegressionEvaluator(labelCol=label, metricName="rmse")
    return evaluator.evaluate(model.transform(test.dropna(subset=[label])))


def draw_trials(n: int, seed: int) -> list[dict]:
    """Random draws from the search space of the boosted trees."""
    rng = random.Random(seed)
    low, high = math.log(1e-3), math.log(0.3)
    return [
        {
            "leaves": rng.randrange(16, 129, 8),
            "rate": math.exp(rng.uniform(low, high)),
            "min_child": rng.randint(5, 100),
        }
        for _ in range(n)
    ]


def tune_boosted(
    train: DataFrame,
    features: Sequence[str],
    held_out: str,
    label: str = LABEL,
    n: int = 4,
    rounds: int = 100,
    seed: int = 42,
    **search: int,
) -> tuple[boosting.BoostedTrees, list[dict]]:
    """Random draws, halved as trees are added, with early stopping on the held-out rows."""
    frame = train.select(*features, label, held_out)
    trials = draw_trials(n, seed)
    return boosting.halving_search(frame, features, label, held_out, trials, rounds=rounds, **search)


def tune(
    train: DataFrame,
    features: Sequence[str],
    label: str = LABEL,
    n: int = 4,
    rounds: int = 100,
    train_ratio: float = 0.75,
    seed: int = 42,
    parallelism: int = 4,
) -> tuple[Model, list[dict]]:
    """Random search; the best draw is fitted again on all rows. Returns it and all trials."""
    frame = train.select(*features, label).dropna(subset=[label])
    estimator = gbt(label, rounds)
    grid, trials = [], draw_trials(n, seed)
    for t in trials:
        grid.append(
            {
                estimator.maxDepth: depth_for_leaves(t["leaves"]),
                estimator.stepSize: t["rate"],
                estimator.minInstancesPerNode: t["min_child"],
            }
        )
    search = TrainValidationSplit(
        estimator=with_assembler(estimator, features, *_present(frame, features)),
        estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(labelCol=label, metricName="rmse"),
        trainRatio=train_ratio,
        seed=seed,
        parallelism=parallelism,
    )
    found = search.fit(frame)
    scored = [{**t, "rmse": float(r)} for t, r in zip(trials, found.validationMetrics)]
    return found.bestModel, scored


def compare_models(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str = LABEL,
    params: Mapping[str, dict] | None = None,
    families: Sequence[str] | None = None,
) -> DataFrame:
    """Hold-out RMSE of every registered estimator, or of the named `families`, best first."""
    params = params or {}
    extra = sorted({p["held_out"] for p in params.values() if p.get("held_out")})
    train = train.select(*features, label, *extra).dropna(subset=[label]).persist()
    try:
        rows = []
        for name in families or MODELS:
            model = fit(name, train, features, label, **params.get(name, {}))
            rows.append((name, holdout_rmse(model, test, label)))
    finally:
        train.unpersist()
    out = train.sparkSession.createDataFrame(rows, "model string, rmse double")
    return out.orderBy("rmse")


Predict = Callable[[pd.DataFrame], pd.Series]


def score_frame(
    df: DataFrame, predict: Mapping[str, Predict], features: Sequence[str]
) -> DataFrame:
    """Add one column per user model, computed on Arrow batches.

    Only the feature columns go to Python, once for all models; the others stay in the JVM.
    """
    out = StructType([StructField(name, DoubleType()) for name in predict])

    def run(x: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({name: fn(x) for name, fn in predict.items()})

    scores = F.pandas_udf(run, out)(F.struct(*features))
    return df.withColumn("_scores", scores).select(
        *df.columns, *[F.col(f"_scores.{name}").alias(name) for name in predict]
    )


def apply_model(
    df: DataFrame, model: Model | Predict, features: Sequence[str], out: str = "prediction"
) -> DataFrame:
    """Add the prediction of a fitted or a user model as column `out`."""
    if hasattr(model, "transform"):
        scored = model.transform(df).withColumnRenamed("prediction", out)
        return scored.select(*df.columns, out)
    return score_frame(df, {out: model}, features)


def score_batch(
    df: DataFrame,
    model: Model | Predict,
    features: Sequence[str],
    model_version: str,
    ts: str,
    lookups: Sequence[FeatureLookup] = (),
    staged: bool = False,
) -> DataFrame:
    """Feature lookup, prediction, and the stamp of the scoring run."""
    found = create_training_set(df, lookups, staged=staged)
    return with_model_stamp(apply_model(found, model, features), model_version, ts)


def score_ab(
    df: DataFrame, model_a: Model | Predict, model_b: Model | Predict, features: Sequence[str]
) -> DataFrame:
    """Both models on every row: `pred_a` and `pred_b`."""
    if not hasattr(model_a, "transform") and not hasattr(model_b, "transform"):
        return score_frame(df, {"pred_a": model_a, "pred_b": model_b}, features)
    return apply_model(apply_model(df, model_a, features, "pred_a"), model_b, features, "pred_b")


def signature_sample(df: DataFrame, n: int = 10) -> DataFrame:
    """A few example rows for a model signature."""
    return df.limit(n)


def label_as(df: DataFrame, label: str = LABEL, name: str = "price") -> DataFrame:
    """The label under the name the monitoring reads."""
    return df.withColumn(name, F.col(label)).drop(label) if label != name else df
