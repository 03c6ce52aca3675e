"""Model building, grid search, scoring and a parquet model registry (MLlib).

Training runs on the executors (distributed trees / logistic regression); the search submits
the fits of all points and folds from driver threads (``parallelism``), where ``CrossValidator`` runs the folds
one after the other. Trees see a feature by its bin only, so rows alike in their bins and label can be fitted
as one with their number for weight (:func:`counted`): passes over the data become passes over its cells.
Folds come from :func:`tessera.operators.split.stratified_folds`, so they are exact and independent of partitioning.
"""

from __future__ import annotations

import itertools
import math
import operator
import uuid
from collections.abc import Iterable
from datetime import datetime, timezone
from functools import partial, reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import c, is_numeric, quote
from tessera.operators.features import TOKEN_PATTERN, fit_scaler, quantile_cuts

MODEL_KINDS = ("gbt", "gbt_leaf")
#: Column that has how many rows a row stands for.
WEIGHT = "__weight"

# The search grids of the two boosted-tree families.
GRID = {
    "n_estimators": [100, 200],
    "max_depth": [3, 5, 7],
    "learning_rate": [0.01, 0.1, 0.2],
    "subsample": [0.8, 1.0],
    "colsample_bytree": [0.8, 1.0],
}
LEAF_GRID = dict(GRID, num_leaves=[31, 50, 70])


def _check_features(df: DataFrame, features: list[str]) -> None:
    for name in features:
        if name not in df.columns:
            raise ValueError(f"Missing feature column: {name}")
        if not is_numeric(df.schema[name].dataType):
            raise TypeError(f"Feature {name} is {df.schema[name].dataType.simpleString()}, not numeric")


class PopulationScaler(Estimator):
    """Fits ``(x - mean) / std`` of the features, population deviation, to columns ``__scaled_0, ...``.

    The fitted stage is plain SQL with the numbers in it, so it is saved and loaded with its pipeline. MLlib's own
    scaler divides by the sample deviation. With ``bins`` it also adds ``__binned_0, ...``: the upper end of the bin
    (:func:`quantile_cuts`) that the scaled value falls into, the highest one's for what lies above.
    """

    def __init__(self, features: list[str], bins: int | None = None):
        super().__init__()
        self.features = list(features)
        self.bins = bins

    def outputs(self) -> list[str]:
        return [f"__{'binned' if self.bins else 'scaled'}_{i}" for i, _ in enumerate(self.features)]

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        stats = {r["column_name"]: (r["mean"], r["std"]) for r in fit_scaler(dataset, self.features).collect()}
        scaled = [f"(CAST({quote(name)} AS DOUBLE) - {stats[name][0]!r}D) / {stats[name][1]!r}D AS __scaled_{i}"
                  for i, name in enumerate(self.features)]
        statement = f"SELECT *, {', '.join(scaled)} FROM __THIS__"
        if self.bins:
            names = [f"__scaled_{i}" for i, _ in enumerate(self.features)]
            cuts = quantile_cuts(SQLTransformer(statement=statement).transform(dataset), names, self.bins)
            binned = [f"{_binned(x, ends)} AS {out}" for x, ends, out in zip(names, cuts, self.outputs())]
            statement = f"SELECT *, {', '.join(binned)} FROM ({statement})"
        return SQLTransformer(statement=statement)


def _binned(x: str, ends: list[float]) -> str:
    """SQL of the upper end of ``x``'s bin; a null and NaN stay what they are."""
    if not ends:
        return x
    below = " ".join(f"WHEN {x} <= {end!r}D THEN {end!r}D" for end in ends)
    return f"CASE {below} WHEN {x} IS NULL OR isnan({x}) THEN {x} ELSE {ends[-1]!r}D END"


def preparation(features: list[str], bins: int | None = None) -> Pipeline:
    """Scaler (and bins) and assembler: what comes before the trees, the same for every point of a search."""
    scaler = PopulationScaler(features, bins)
    return Pipeline(stages=[scaler, VectorAssembler(inputCols=scaler.outputs(), outputCol="features", handleInvalid="error")])


def build_model(kind: str, features: list[str], label: str = "label", seed: int = 42) -> Pipeline:
    """Scaler -> assembler -> boosted trees (binary logistic loss).

    Trees split on feature order only, so scaling leaves their fit
    unchanged; it is kept to match the reference pipeline's shape.
    """
    if kind not in MODEL_KINDS:
        raise ValueError(f"Unsupported model type: {kind}")
    gbt = GBTClassifier(featuresCol="features", labelCol=label, lossType="logistic", seed=seed)
    return Pipeline(stages=[*preparation(features).getStages(), gbt])


def param_grid(pipeline: Pipeline, kind: str, grid: dict | None = None) -> list[dict]:
    """Parameter maps of ``grid``, by default the family's (72 points, or 216 before de-duplication).

    Leaf counts have no MLlib parameter: they cap the depth at
    ``ceil(log2(num_leaves))`` and identical resulting points are dropped.
    Column subsampling is per tree in the originals and per split here.
    """
    gbt = pipeline.getStages()[-1]
    grid = dict(grid or (LEAF_GRID if kind == "gbt_leaf" else GRID))
    names = list(grid)
    seen, maps = set(), []
    for combo in itertools.product(*[grid[n] for n in names]):
        p = dict(zip(names, combo))
        depth = p["max_depth"]
        if "num_leaves" in p:
            depth = min(depth, int(math.ceil(math.log2(p["num_leaves"]))))
        subset = "all" if p["colsample_bytree"] >= 1.0 else str(p["colsample_bytree"])
        point = (p["n_estimators"], depth, p["learning_rate"], p["subsample"], subset)
        if point in seen:
            continue
        seen.add(point)
        maps.append({gbt.maxIter: point[0], gbt.maxDepth: point[1], gbt.stepSize: point[2],
                     gbt.subsamplingRate: point[3], gbt.featureSubsetStrategy: point[4]})
    return maps


def counted(df: DataFrame, cols: list[str], fold_col: str, folds: int, counts: str) -> DataFrame:
    """A row for all rows that are alike in ``cols``; ``counts`` is an array of their number in each fold."""
    return df.groupBy(*[c(x) for x in cols]).agg(F.array(*[F.count_if(c(fold_col) == i) for i in range(folds)]).alias(counts))


def weighted(df: DataFrame, counts: str, folds: Iterable[int]) -> DataFrame:
    """The rows that stand for any row of ``folds``, with their number as weight."""
    n = reduce(operator.add, [c(counts)[i] for i in folds])
    return df.withColumn(WEIGHT, n.cast("double")).where(c(WEIGHT) > 0)


def _check_folds(df: DataFrame, fold_col: str, folds: int, counts: str | None) -> None:
    fold = c(fold_col)
    if counts:
        lost, sizes = 0, df.agg(*[F.coalesce(F.sum(c(counts)[i]), F.lit(0)) for i in range(folds)]).first()
    else:
        stray = F.count_if(fold.isNull() | ~fold.between(0, folds - 1))
        lost, *sizes = df.agg(stray, *[F.count_if(fold == i) for i in range(folds)]).first()
    if lost:
        raise ValueError(f"{lost} rows have no fold of 0 to {folds - 1}")
    for i, n in enumerate(sizes):
        if n in (0, sum(sizes)):
            raise ValueError(f"The {'validation' if n == 0 else 'training'} data at fold {i} is empty")


def grid_search(df: DataFrame, pipeline: Pipeline, grid: list[dict], label: str = "label",
                fold_col: str = "fold", parallelism: int = 4, seed: int = 42, folds: int = 5, counts: str | None = None):
    """Cross-validated accuracy per grid point with the given folds; refits the best on all rows.

    ``parallelism`` fits run side by side, of whatever points and folds, and more where the tasks of so many leave
    cores idle; a lone point is the best whatever its accuracy, so its refit does not wait for them. ``df`` is read by each, so it
    should be cached. With ``counts`` (see :func:`counted`) its rows stand for several; the pipeline's estimator then has
    ``WEIGHT`` as weight column.
    """
    evaluator = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                                  metricName="accuracy")
    if counts:
        evaluator.setWeightCol(WEIGHT)
    _check_folds(df, fold_col, folds, counts)

    def rows(inside: Iterable[int]) -> DataFrame:
        return weighted(df, counts, inside) if counts else df.where(c(fold_col).isin(list(inside)))

    def accuracy(fold: int, point: dict) -> float:
        model = pipeline.fit(rows(i for i in range(folds) if i != fold), point)
        return evaluator.evaluate(model.transform(rows([fold])))

    fits = [inheritable_thread_target(df.sparkSession)(partial(accuracy, i, p)) for p in grid for i in range(folds)]
    together = max(parallelism, df.sparkSession.sparkContext.defaultParallelism // max(1, df.rdd.getNumPartitions()))
    with ThreadPool(min(together, len(fits))) as pool:
        running = pool.map_async(lambda fit: fit(), fits, chunksize=1)
        best = pipeline.fit(rows(range(folds)), grid[0]) if len(grid) == 1 else None
        by_point = np.array(running.get()).reshape(len(grid), folds)
    mean = by_point.mean(axis=1)
    best = best or pipeline.fit(rows(range(folds)), grid[int(np.argmax(mean))])
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator,
                        foldCol=fold_col, numFolds=folds, parallelism=parallelism, seed=seed)
    return cv._copyValues(CrossValidatorModel(best, mean.tolist(), None, by_point.std(axis=1).tolist()))


def leaderboard(spark: SparkSession, cv_model) -> DataFrame:
    """``(rank, params, mean_accuracy)``; the first grid point wins ties."""
    rows = []
    for i, (pm, score) in enumerate(zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics)):
        params = ", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name))
        rows.append((i, params, float(score)))
    ordered = sorted(rows, key=lambda r: (-r[2], r[0]))
    data = [(rank + 1, r[1], r[2]) for rank, r in enumerate(ordered)]
    return spark.createDataFrame(data, "rank int, params string, mean_accuracy double")


def build_text_model(text_col: str = "text", label: str = "label", num_labels: int = 2,
                     max_length: int = 128, num_features: int = 1 << 18) -> Pipeline:
    """Word tokens (lower-cased, cut to ``max_length - 2``) -> TF-IDF -> multinomial logistic regression."""
    tok = RegexTokenizer(inputCol=text_col, outputCol="__words", pattern=TOKEN_PATTERN, gaps=False,
                         toLowercase=True, minTokenLength=1)
    cut = SQLTransformer(statement=f"SELECT *, slice(__words, 1, {max_length - 2}) AS __tokens FROM __THIS__")
    tf = HashingTF(inputCol="__tokens", outputCol="__tf", numFeatures=num_features)
    idf = IDF(inputCol="__tf", outputCol="features")
    lr = LogisticRegression(featuresCol="features", labelCol=label, family="multinomial", maxIter=50)
    return Pipeline(stages=[tok, cut, tf, idf, lr])


def score(model: PipelineModel, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``prediction`` (int) and ``probability`` (array<double>, null when the model has none)."""
    out = model.transform(df)
    prob = vector_to_array(F.col("probability")) if "probability" in out.columns \
        else F.lit(None).cast(T.ArrayType(T.DoubleType()))
    cols = [F.col(c) for c in (keep or [])]
    return out.select(*cols, F.col("prediction").cast("int").alias("prediction"), prob.alias("probability"))


# ---- registry -----------------------------------------------------------------

REGISTRY_SCHEMA = ("name string, model_type string, path string, feature_names array<string>, "
                   "metrics map<string,double>, created string")


def save_model(spark: SparkSession, model: PipelineModel, registry: str, feature_names: list[str],
               metrics: dict, model_type: str) -> str:
    """Save under ``{registry}/{model_type}_{yyyyMMdd_HHmmss}_{random}`` and append a registry row."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    name = f"{model_type}_{stamp}_{uuid.uuid4().hex[:8]}"
    path = f"{registry.rstrip('/')}/{name}"
    model.save(path)
    row = [(name, model_type, path, list(feature_names), {k: float(v) for k, v in metrics.items()}, stamp)]
    spark.createDataFrame(row, REGISTRY_SCHEMA).write.mode("append").parquet(f"{registry.rstrip('/')}/_registry")
    return path


def load_model(spark: SparkSession, registry: str, name: str | None = None,
               model_type: str | None = None) -> tuple[PipelineModel, list[str], dict]:
    """Model, feature names and metrics by name, else the newest (of ``model_type``)."""
    reg = spark.read.parquet(f"{registry.rstrip('/')}/_registry")
    if name:
        reg = reg.where(F.col("name") == name)
    if model_type:
        reg = reg.where(F.col("model_type") == model_type)
    row = reg.orderBy(F.desc("created"), F.desc("name")).first()
    if row is None:
        raise FileNotFoundError(f"No model in {registry} matching name={name} type={model_type}")
    return PipelineModel.load(row["path"]), list(row["feature_names"]), dict(row["metrics"])
