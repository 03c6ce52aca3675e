import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tessera.operators.models import build_model, load_model, param_grid, save_model, score
from tessera.plans.scoring import score_requests
from tessera.sources.requests import parse_tabular_requests, parse_text_requests

SCHEMA = "f1 double, f2 double"


def test_request_shapes(spark):
    df = spark.createDataFrame([(1, '{"f1": 1, "f2": 2}'), (2, '[{"f1": 1}, {"f2": 3}]'), (3, '{"f1": 1}'),
                                (4, '{"f1": '), (5, '[1, 2]')], "request_id long, body string")
    out = parse_tabular_requests(df, "body", SCHEMA, ["f1", "f2"])
    by = {(r["request_id"], r["pos"]): r for r in out.collect()}
    assert by[(1, 0)]["status"] == "ok" and by[(1, 0)]["f2"] == 2.0
    assert by[(2, 0)]["f2"] is None and by[(2, 1)]["f2"] == 3.0  # union of keys: still scored
    assert by[(3, None)]["status"] == "rejected" and by[(3, None)]["error"] == "Missing features: f2"
    assert by[(4, None)]["status"] == "malformed" and by[(5, None)]["status"] == "malformed"
    t = parse_text_requests(spark.createDataFrame([(1, '{"text": "hi"}'), (2, '["x"]'), (3, '{"t": 1}')],
                                                  "request_id long, body string"), "body")
    assert [r["status"] for r in t.orderBy("request_id").collect()] == ["ok", "rejected", "rejected"]


def test_grid_sizes():
    pipe = build_model("gbt", ["a"])
    assert len(param_grid(pipe, "gbt")) == 72
    leaf = param_grid(build_model("gbt_leaf", ["a"]), "gbt_leaf")
    assert len(leaf) == 2 * 4 * 3 * 2 * 2  # depths {3,5,6,7} after leaf caps, duplicates dropped
    with pytest.raises(ValueError):
        build_model("forest", ["a"])


def test_model_fits_saves_reloads_and_scores(spark, tmp_path):
    df = spark.range(400).select((F.col("id") % 7).cast("double").alias("a"),
                                 (F.col("id") % 5).cast("double").alias("b"),
                                 ((F.col("id") % 7) > 3).cast("int").alias("label"))
    pipe = build_model("gbt", ["a", "b"])
    gbt = pipe.getStages()[-1]
    model = pipe.fit(df, {gbt.maxIter: 5, gbt.maxDepth: 3})
    scored = score(model, df, keep=["label"])
    acc = scored.select(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert acc > 0.95  # majority class is 4/7
    path = save_model(spark, model, str(tmp_path / "reg"), ["a", "b"], {"accuracy": acc}, "gbt")
    m2, feats, metrics = load_model(spark, str(tmp_path / "reg"))
    assert feats == ["a", "b"] and metrics["accuracy"] == acc and "gbt_" in path
    again = score(m2, df, keep=["label"])
    assert again.select("prediction").collect() == scored.select("prediction").collect()
    req = spark.createDataFrame([(1, '{"a": 6, "b": 1}'), (2, '{"a": 1}')], "request_id long, body string")
    parsed = parse_tabular_requests(req, "body", "a double, b double", ["a", "b"])
    res = {r["request_id"]: r for r in score_requests(m2, parsed, ["a", "b"]).collect()}
    assert res[1]["prediction"] == 1 and len(res[1]["probability"]) == 2
    assert res[2]["prediction"] is None and res[2]["status"] == "rejected"


def test_training_scales_by_the_population_once_and_chooses_between_points(spark, tmp_path):
    import math

    from tessera.operators.models import leaderboard, load_model, save_model, score
    from tessera.plans.training import train_tabular
    df = spark.range(300).selectExpr("id as key", "cast(id % 17 as double) as `a.b`", "7.0 as same", "cast(id % 17 > 8 as int) as y")
    grid = {"n_estimators": [1, 4], "max_depth": [1], "learning_rate": [0.1], "subsample": [1.0], "colsample_bytree": [1.0]}
    model, feats, scored, cv = train_tabular(df, "key", "y", ["a.b", "same"], grid=grid, folds=3)
    assert feats == ["a.b", "same"] and [type(s).__name__ for s in model.stages] == ["SQLTransformer", "VectorAssembler", "GBTClassificationModel"]
    train = [r.key % 17 for r in df.join(scored.select("key"), "key", "left_anti").select("key").collect()]
    mean = sum(train) / len(train)
    deviation = math.sqrt(sum((x - mean) ** 2 for x in train) / len(train))
    row = model.transform(df.where("key = 3")).first()
    assert abs(row.features[0] - (3 - mean) / deviation) < 1e-9 and row.features[1] == 0.0  # a constant column keeps its scale
    board = leaderboard(spark, cv).collect()
    assert [r["rank"] for r in board] == [1, 2] and board[0].mean_accuracy >= board[1].mean_accuracy
    assert model.stages[-1].getNumTrees == (1 if "maxIter=1" in board[0].params else 4)
    path = save_model(spark, model, str(tmp_path), feats, {"accuracy": 1.0}, "gbt")
    again = load_model(spark, str(tmp_path))[0]
    assert path and score(again, df, ["key"]).exceptAll(score(model, df, ["key"])).count() == 0


def test_search_runs_folds_side_by_side_and_names_a_bad_fold(spark, monkeypatch):
    import threading
    import pytest
    from pyspark.ml import Pipeline
    from pyspark.sql import functions as F
    from tessera.operators.models import build_model, grid_search, param_grid, preparation
    df = spark.range(120).select((F.col("id") % 10).cast("double").alias("a"), (F.col("id") % 10 > 4).cast("int").alias("label"),
                                 (F.col("id") % 3).cast("int").alias("fold"))
    ready = preparation(["a"]).fit(df).transform(df)
    pipe = Pipeline(stages=build_model("gbt", ["a"]).getStages()[-1:])
    grid = param_grid(pipe, "gbt", {"n_estimators": [2], "max_depth": [2], "learning_rate": [0.1], "subsample": [1.0], "colsample_bytree": [1.0]})
    together, fit = threading.Barrier(3), Pipeline.fit

    def waits(self, data, params=None):
        if threading.current_thread() is not threading.main_thread():
            together.wait(60)  # goes on only if three fits of the one point are running
        return fit(self, data, params)

    monkeypatch.setattr(Pipeline, "fit", waits)
    cv = grid_search(ready, pipe, grid, folds=3)
    assert cv.avgMetrics == [1.0] and cv.bestModel.stages[-1].getNumTrees == 2 and cv.getNumFolds() == 3
    with pytest.raises(ValueError, match="fold 3"):
        grid_search(ready, pipe, grid, folds=4)
    with pytest.raises(ValueError, match="40 rows have no fold"):
        grid_search(ready, pipe, grid, folds=2)


POINT = {"n_estimators": [8], "max_depth": [4], "learning_rate": [0.2], "subsample": [1.0], "colsample_bytree": [1.0]}


def _training(spark, n=6000):
    h = F.xxhash64("id")
    a, b = F.pmod(h, F.lit(1009)) / 10.0, F.exp(F.pmod(h, F.lit(61)) / 7.0)
    y = (a + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(60)) > 80) != (b > 3000)
    return spark.range(n).select(F.col("id").alias("key"), a.alias("a"), b.alias("b"), y.cast("int").alias("y"))


def test_search_fits_rows_alike_in_their_bins_as_one_and_finds_the_same_trees(spark, monkeypatch):
    from pyspark.ml import Pipeline
    from tessera.operators.models import grid_search
    from tessera.operators.split import stratified_folds
    from tessera.plans.training import train_tabular
    df, fit, seen = _training(spark), Pipeline.fit, []

    def counting(self, data, params=None):
        if type(self.getStages()[-1]).__name__ == "GBTClassifier":
            seen.append(data.count())
        return fit(self, data, params)

    monkeypatch.setattr(Pipeline, "fit", counting)
    model, _, scored, cv = train_tabular(df, "key", "y", ["a", "b"], grid=POINT, folds=3)
    monkeypatch.undo()
    assert len(seen) == 4 and max(seen) <= 2 * 32 * 32  # of 4,800 rows
    # the same search over single rows
    train = df.join(scored.select("key"), "key", "left_anti")
    rows = PipelineModel(stages=model.stages[:2]).transform(train).selectExpr("key", "y as label", "features")
    pipe = Pipeline(stages=build_model("gbt", ["a", "b"]).getStages()[-1:])
    one = grid_search(stratified_folds(rows, "label", "key", 3).cache(), pipe, param_grid(pipe, "gbt", POINT), folds=3)
    assert cv.avgMetrics == pytest.approx(one.avgMetrics, abs=1e-12) and cv.avgMetrics[0] > 0.7
    both = [score(PipelineModel(stages=[*model.stages[:2], trees]), df, ["key"]) for trees in (model.stages[-1], one.bestModel.stages[-1])]
    assert both[0].join(both[1].toDF("key", "p", "q"), "key").where("prediction != p or abs(probability[1] - q[1]) > 1e-9").count() == 0


def test_search_that_samples_rows_gets_single_rows(spark, monkeypatch):
    from pyspark.ml import Pipeline
    from tessera.plans.training import train_tabular
    fit, seen = Pipeline.fit, []
    monkeypatch.setattr(Pipeline, "fit", lambda self, data, params=None: seen.append(data.count()) or fit(self, data, params))
    train_tabular(_training(spark, 1000), "key", "y", ["a", "b"], grid=dict(POINT, n_estimators=[1], subsample=[0.8, 1.0]), search=False)
    assert set(seen) == {800}


def test_refit_of_a_lone_point_does_not_wait_for_the_folds(spark, monkeypatch):
    import threading
    from pyspark.ml import Pipeline
    from tessera.plans.training import train_tabular
    refit, fit = threading.Event(), Pipeline.fit

    def waits(self, data, params=None):
        if threading.current_thread() is not threading.main_thread():
            assert refit.wait(60)  # goes on only if the refit has begun
        elif type(self.getStages()[-1]).__name__ == "GBTClassifier":
            refit.set()
        return fit(self, data, params)

    monkeypatch.setattr(Pipeline, "fit", waits)
    model, _, _, cv = train_tabular(_training(spark, 500), "key", "y", ["a", "b"], grid=dict(POINT, n_estimators=[2]), folds=2)
    assert len(cv.avgMetrics) == 1 and model.stages[-1].getNumTrees == 2


def test_training_pipeline_fits_no_more_rows_for_more_data(spark, tmp_path, monkeypatch):
    from pyspark.ml import Pipeline
    from tessera.plans.training import train_pipeline
    fit, seen = Pipeline.fit, {}
    metrics = {}
    for n in (3000, 24_000):
        _training(spark, n).write.parquet(f"{tmp_path}/{n}.parquet")
        monkeypatch.setattr(Pipeline, "fit", lambda self, data, params=None, n=n: (
            seen.setdefault(n, []).append(data.count()) if len(self.getStages()) == 1 else None) or fit(self, data, params))
        path, metrics[n] = train_pipeline(spark, f"{tmp_path}/{n}.parquet", "key", "y", f"{tmp_path}/models", ["a", "b"], "gbt",
                                          grid=dict(POINT, n_estimators=[3]))
        again, feats, stored = load_model(spark, f"{tmp_path}/models", name=path.rsplit("/", 1)[1])
        assert stored == metrics[n] and feats == ["a", "b"]
        assert score(again, spark.read.parquet(f"{tmp_path}/{n}.parquet")).where("prediction in (0, 1)").count() == n
    monkeypatch.undo()
    assert len(seen[24_000]) == 6 and max(seen[24_000]) <= 2 * 32 * 32 < 24_000 * 0.8 * 0.8
    assert metrics[24_000]["accuracy"] > 0.7
