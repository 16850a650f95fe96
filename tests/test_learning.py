import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rasmlens import operators as ops
from rasmlens import schema, sources, workspace
from rasmlens.operators.arena import ModelArena

HUMAN_WORDS = "كتاب مدرسة قلم ورق معلم طالب درس علم".split()
AI_WORDS = "نموذج بيانات شبكة تعلم خوارزمية دقة نتائج تحليل".split()


@pytest.fixture(scope="module")
def prepared(spark):
    rng = random.Random(5)
    rows = []
    for i in range(240):
        label = int(i % 3 > 0)
        mix = (AI_WORDS * 3 + HUMAN_WORDS) if label else (HUMAN_WORDS * 3 + AI_WORDS)
        rows.append((i, " ".join(rng.choice(mix) for _ in range(rng.randrange(6, 30))), label))
    df = ops.prepare(spark.createDataFrame(rows, "id int, text string, label int"))
    path = workspace.fresh_dir(spark, "prepared")
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def features(prepared):
    return ops.fit_features(prepared)


@pytest.fixture(scope="module")
def vectors(spark, features, prepared):
    path = workspace.fresh_dir(spark, "vectors")
    ops.vectorize(features, prepared, keep=("id",)).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def arena(vectors):
    train, validation, _ = ops.hash_split(vectors, "id")
    arena = ModelArena(train, validation)
    arena.add_all(parallelism=2)
    return arena


def test_vector_layout(features, prepared):
    rows = features.transform(prepared).select(
        schema.F023, schema.F046, "n_tokens", "features", "tf").collect()
    deviations = [np.std([r[c] for r in rows], ddof=1)
                  for c in (schema.F023, schema.F046, "n_tokens")]
    for row in rows:
        vector = row["features"].toArray()
        assert len(vector) == 4099
        style = np.array([row[schema.F023], row[schema.F046], row["n_tokens"]]) / deviations
        np.testing.assert_allclose(vector[-3:], style)
        assert row["tf"].toArray().sum() == row["n_tokens"]


def test_idf_can_be_fitted_on_training_rows_only(features, prepared):
    on_train = ops.fit_features(prepared, train=prepared.where("id < 40"))
    assert on_train.stages[1].numDocs == 40 and features.stages[1].numDocs == 240


def test_arena_fits_and_ranks(spark, arena):
    table = arena.summary(spark).collect()
    assert {r["model"] for r in table} == {"NaiveBayes", "LogReg", "RandomForest", "LinearSVC"}
    scores = [r["f1"] for r in table]
    assert scores == sorted(scores, reverse=True) and scores[0] > 0.9
    name, model = arena.best()
    won = next(t for t in arena.trials if t.name == name)
    assert won.f1 == max(t.f1 for t in arena.trials) and model is won.model is arena.model(name)


def test_undefined_scores_never_win(spark):
    arena = ModelArena(spark.range(1), spark.range(1))
    arena.trials = [ops.Trial("a", "model a", 0.5, math.nan, math.nan, 1.0),
                    ops.Trial("b", "model b", 0.1, 0.1, math.nan, 1.0)]
    assert arena.best("f1") == ("b", "model b")
    assert [r["model"] for r in arena.summary(spark).collect()] == ["b", "a"]
    with pytest.raises(ValueError):
        arena.best("auc")


@pytest.mark.parametrize("pairs", [
    [(0, 0.0), (1, 1.0), (1, 1.0)],
    [(0, 1.0), (1, 0.0)],
    [(0, 0.0), (0, 1.0), (1, 1.0), (1, 1.0), (1, 0.0), (1, 1.0)],
    [(0, 0.0), (1, 0.0), (1, 0.0)],
    [(1, 1.0), (1, 0.0)],
])
def test_accuracy_and_f1_equal_the_evaluator(spark, pairs):
    predictions = spark.createDataFrame(pairs, "label int, prediction double")
    got = ops.accuracy_and_f1(predictions).first()
    doubles = predictions.withColumn("label", F.col("label").cast("double"))
    for metric in ("accuracy", "f1"):
        evaluator = MulticlassClassificationEvaluator(metricName=metric)
        assert got[metric] == pytest.approx(evaluator.evaluate(doubles))


def test_metrics_of_nothing(spark):
    row = ops.accuracy_and_f1(spark.createDataFrame([], "label int, prediction double")).first()
    assert tuple(row) == (0, None, None, 0)


def test_auc_with_ties_and_with_one_class(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(2), float(rng.randrange(2)), float(rng.randrange(6))) for _ in range(200)]
    df = spark.createDataFrame(rows, "label int, prediction double, rawPrediction double")
    positive = [s for l, _, s in rows if l == 1]
    negative = [s for l, _, s in rows if l == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    assert ops.roc_auc(df, bins=0) == pytest.approx(wins / len(positive) / len(negative))
    assert math.isnan(ops.score(df.where("label = 1"))["auc"])
    assert math.isnan(ops.score(df.where("label = 7"))["f1"])


def test_confusion_matrix_has_all_classes(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.0), (1, 0.0)], "label int, prediction double")
    assert sorted(map(tuple, ops.confusion_matrix(df).collect())) == [(0, 1, 0), (1, 2, 0)]
    assert {tuple(r) for r in ops.confusion_counts(df).collect()} == {(0, 0.0, 1), (1, 0.0, 2)}
    foreign = spark.createDataFrame([(0, 2.0)], "label int, prediction double")
    with pytest.raises(Exception, match="outside the classes"):
        ops.confusion_matrix(foreign).collect()


def test_scores_take_their_classes_from_the_data(spark):
    rows = [(0, 0.0), (0, 2.0), (2, 2.0), (2, 2.0), (3, 0.0), (None, 0.0), (1, None)]
    df = spark.createDataFrame(rows, "label int, prediction double")
    got = ops.accuracy_and_f1(df).first()
    f1 = 0.0
    for c in (0, 1, 2, 3):
        actual = sum(a == c for a, _ in rows)
        guessed = sum(p == c for _, p in rows)
        f1 += actual * 2 * sum(a == p == c for a, p in rows) / (actual + guessed)
    assert (got["n"], got["labels"]) == (7, 4)
    assert got["accuracy"] == pytest.approx(3 / 7) and got["f1"] == pytest.approx(f1 / 7)


def test_held_out_evaluation(arena, vectors):
    _, _, test = ops.hash_split(vectors, "id")
    got = ops.evaluate_on_test(arena.model("LogReg"), test)
    rows = got["predictions"].select("label", "prediction").collect()
    assert got["accuracy"] == round(sum(r[0] == r[1] for r in rows) / len(rows), 4)
    assert 0.5 < got["auc"] <= 1.0


def test_importance_of_the_style_block(spark, arena):
    forest = arena.model("RandomForest")
    got = ops.feature_importance(spark, forest).collect()
    assert [r["feature"] for r in got] == [schema.F023, schema.F046, "n_tokens"]
    assert [r["importance"] for r in got] == [
        round(float(x), 5) for x in forest.featureImportances.toArray()[-3:]]
    with pytest.raises(ValueError):
        ops.feature_importance(spark, arena.model("LogReg"))


def test_saved_models_predict_the_same(spark, arena, features, prepared, vectors):
    folder = workspace.fresh_dir(spark, "models")
    again = sources.load_features(sources.save_fitted(features, f"{folder}/features"))
    rebuilt = ops.vectorize(again, prepared, keep=("id",))
    same = rebuilt.join(vectors.withColumnRenamed("features", "before"), "id").where(
        vector_to_array("features") == vector_to_array("before"))
    assert same.count() == vectors.count()
    for name, model in ((t.name, t.model) for t in arena.trials):
        path = sources.save_classifier(model, folder, name)
        sources.save_classifier(model, folder, name)
        assert path == f"{folder}/clf_{name}"
        loaded = sources.load_classifier(spark, path)
        assert type(loaded) is type(model)
        def predictions(m):
            return {r[0]: r[1] for r in m.transform(vectors).select("id", "prediction").collect()}
        assert predictions(loaded) == predictions(model)


def test_unknown_classifiers_are_refused(spark, vectors):
    tree = DecisionTreeClassifier(maxDepth=1).fit(vectors.limit(20))
    path = sources.save_fitted(tree, workspace.fresh_dir(spark, "tree"))
    with pytest.raises(ValueError):
        sources.load_classifier(spark, path)


def test_sweep_restores_the_setting(spark, arena, vectors):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = ops.inference_sweep(arena.model("LogReg"), vectors, (2, 3)).collect()
    assert [r["partitions"] for r in got] == [2, 3] and all(r["seconds"] > 0 for r in got)
    assert all(r["rows"] == vectors.count() for r in got)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_default_estimators_have_the_fixed_parameters():
    chosen = ops.default_estimators()
    assert isinstance(chosen["LogReg"], LogisticRegression)
    assert (chosen["NaiveBayes"].getSmoothing(), chosen["NaiveBayes"].getModelType()) == (1.0, "multinomial")
    assert (chosen["LogReg"].getMaxIter(), chosen["LogReg"].getRegParam()) == (30, 0.01)
    assert (chosen["LinearSVC"].getMaxIter(), chosen["LinearSVC"].getRegParam()) == (30, 0.05)
    forest = chosen["RandomForest"]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (80, 10, 2026)
