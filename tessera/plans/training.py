"""Training runs: split -> folds -> grid search -> evaluate -> save."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import c
from tessera.operators.evaluate import evaluate, metrics_dict
from tessera.operators.models import (WEIGHT, _check_features, build_model, build_text_model, counted, grid_search,
                                      param_grid, preparation, save_model, score, weighted)
from tessera.operators.split import dealt, stratified_folds, train_test_split
from tessera.session import cut_lineage
from tessera.sources.files import read_training


def split_xy(df: DataFrame, target: str, features: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Feature columns (given, else all but the target) plus the target; and their order."""
    feats = list(features) if features else [x for x in df.columns if x != target]
    return df.select(*[c(x) for x in feats], c(target)), feats


def text_label(df: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """``(text, label)`` with the text as string (null stays null)."""
    return df.select(c(text_col).cast("string").alias("text"), c(label_col).cast("int").alias("label"))


def train_tabular(df: DataFrame, key: str, target: str, features: list[str] | None = None,
                  kind: str = "gbt", grid: dict | None = None, folds: int = 5, test_size: float = 0.2,
                  seed: int = 42, parallelism: int = 4, search: bool = True):
    """Fit on the training part with CV; returns ``(model, features, test_scores, cv_model)``.

    ``search=False`` fits the first grid point once, without folds (``cv_model`` is then None).

    The trees get features in at most as many bins as they use, and rows alike in all bins and the label as one row with
    their number for weight: the same trees as of single rows. A grid with a point that samples rows gets single ones.
    """
    data = df.withColumn("label", c(target).cast("int"))
    feats = list(features) if features else [x for x in df.columns if x not in (target, key)]
    _check_features(data, feats)
    s = train_test_split(data.select(c(key), *[c(x) for x in feats], "label"), key, test_size, seed)
    train = s.where(F.col("split") == "train").drop("split")
    test = s.where(F.col("split") == "test").drop("split")
    # scaled, binned, counted or dealt once, outside the folds and points of the search
    pipe = Pipeline(stages=build_model(kind, feats, "label", seed).getStages()[-1:])
    gbt, points, cv_model, counts = pipe.getStages()[-1], param_grid(pipe, kind, grid), None, None
    if any(p[gbt.subsamplingRate] < 1 for p in points):
        prep = preparation(feats).fit(train)
        folded = stratified_folds(prep.transform(train).select(c(key), "label", "features"), "label", key, folds, seed)
        ready = dealt(folded, key, train.count()).cache()
        every = ready
    else:
        prep, counts = preparation(feats, gbt.getMaxBins()).fit(train), "__counts"
        gbt.setWeightCol(WEIGHT)
        binning, assembler = prep.stages
        alike = [*assembler.getInputCols(), "label"]
        folded = stratified_folds(binning.transform(train).select(c(key), *alike), "label", key, folds, seed)
        cells = counted(folded, alike, "fold", folds, counts).cache()
        # what a fit costs per task of each of its jobs is worth some 100,000 cells; each task carries what is left to trace
        ready = cut_lineage(assembler.transform(dealt(cells, alike, cells.count(), least=100_000)))
        cells.unpersist()
        every = weighted(ready, counts, range(folds))
    if search:
        cv_model = grid_search(ready, pipe, points, "label", "fold", parallelism, seed, folds, counts)
        trees = cv_model.bestModel
    else:
        trees = pipe.fit(every, points[0])
    model = PipelineModel(stages=[*prep.stages, *trees.stages])
    scored = score(model, test, keep=[key, "label"])
    ready.unpersist()
    return model, feats, scored, cv_model


def train_pipeline(spark: SparkSession, path: str, key: str, target: str, registry: str,
                   features: list[str] | None = None, kind: str = "gbt", grid: dict | None = None,
                   format: str | None = None):
    """Read the training file, train, evaluate on the test part, save; returns ``(path, metrics)``."""
    df = read_training(spark, path, format)
    model, feats, scored, _ = train_tabular(df, key, target, features, kind, grid)
    metrics = metrics_dict(scored, "label", "prediction")
    return save_model(spark, model, registry, feats, metrics, kind), metrics


def train_text(df: DataFrame, key: str, text_col: str = "text", label_col: str = "label",
               num_labels: int = 2, test_size: float = 0.2, seed: int = 42):
    """Fit the text classifier on the training part; returns ``(model, test_scores)``."""
    data = df.select(c(key), c(text_col).cast("string").alias("text"), c(label_col).cast("int").alias("label"))
    s = train_test_split(data, key, test_size, seed)
    train = s.where(F.col("split") == "train").drop("split")
    test = s.where(F.col("split") == "test").drop("split")
    model = build_text_model("text", "label", num_labels).fit(train)
    return model, score(model, test, keep=[key, "label"])


def train_text_pipeline(spark: SparkSession, path: str, key: str, text_col: str, label_col: str,
                        registry: str, num_labels: int = 2, format: str | None = None):
    df = read_training(spark, path, format)
    model, scored = train_text(df, key, text_col, label_col, num_labels)
    metrics = metrics_dict(scored, "label", "prediction")
    return save_model(spark, model, registry, [text_col], metrics, "text_classifier"), metrics


def holdout_metrics(scored: DataFrame) -> DataFrame:
    """Accuracy and weighted precision, recall, F1 of scored test rows."""
    return evaluate(scored, "label", "prediction")
