"""Feature vectors, classifiers, metrics and saved models."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasmlens import operators as ops
from rasmlens import schema, sources, workspace
from rasmlens.operators.features import TF_DIM
from rasmlens.plans.datasets import lab, prepared, prepared_labelled

#: The rule whose predictions SQL can reproduce: more tokens than this means AI.
RULE_TOKENS = 150
RANKED_RULES = (50, 150, 400)


def _vector_facts(features, rows: DataFrame) -> DataFrame:
    """Per row: vector size, hashed term total, and the three scaled values.

    A vector's stored form is read in place, so vectors stay sparse: the three values are
    those with the last indices, and a sparse vector leaves out zeros.
    """
    facts = features.transform(rows).select(
        "doc_id", F.unwrap_udt("features").alias("v"), F.unwrap_udt("tf").alias("tf"))

    def style(i: int) -> Column:
        at = TF_DIM + i
        sparse = F.get("v.values", F.array_position("v.indices", F.lit(at)).cast("int") - 1)
        dense = F.get("v.values", F.lit(at))
        return F.coalesce(F.when(F.col("v.indices").isNotNull(), sparse).otherwise(dense), F.lit(0.0))

    names = ("f023_scaled", "f046_scaled", "n_tokens_scaled")
    return facts.select(
        "doc_id", F.coalesce(F.col("v.size"), F.size("v.values")).alias("dim"),
        F.aggregate("tf.values", F.lit(0.0), lambda a, v: a + v).alias("tf_total"),
        *[F.round(style(i), 6).alias(name) for i, name in enumerate(names)])


def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vector_facts(lab(spark, sf_dir).features, prepared(spark, sf_dir))


def feature_vectors_fit_on_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared(spark, sf_dir)
    train, _, _ = ops.hash_split(rows, "doc_id")
    return _vector_facts(ops.fit_features(rows, train=train), rows)


def hashed_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries of every hashed TF-IDF vector, as rows."""
    rows = lab(spark, sf_dir).features.transform(prepared(spark, sf_dir)).select(
        "doc_id", F.unwrap_udt("tf").alias("tf"), F.unwrap_udt("tfidf").alias("tfidf"))
    entries = F.arrays_zip("tf.indices", F.col("tf.values").alias("tf"),
                           F.col("tfidf.values").alias("tfidf"))
    return rows.select("doc_id", F.inline(entries)).select(
        "doc_id", F.col("indices").alias("bucket"), F.col("tf").cast("bigint").alias("tf"),
        F.round("tfidf", 6).alias("tfidf"))


def _scores(spark: SparkSession, scores: dict, digits: int) -> DataFrame:
    row = spark.createDataFrame(
        [(scores["n"], scores["acc"], scores["f1"], scores["auc"])],
        "n long, accuracy double, f1 double, auc double")
    return row.withColumns({c: F.round(c, digits) for c in ("accuracy", "f1", "auc")})


def _naive_bayes(work):
    return work.fit("NaiveBayes").model("NaiveBayes")


def naive_bayes_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for the labelled corpus of the model fitted on the training split."""
    work = lab(spark, sf_dir)
    return _naive_bayes(work).transform(work.vectors).select("doc_id", "label", "prediction")


def naive_bayes_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = lab(spark, sf_dir)
    return _scores(spark, ops.score(_naive_bayes(work).transform(work.test), bins=0), 6)


def naive_bayes_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The held-out evaluation, four digits."""
    work = lab(spark, sf_dir)
    found = ops.evaluate_on_test(_naive_bayes(work), work.test, bins=0)
    return spark.createDataFrame(
        [(found["accuracy"], found["f1_score"], found["auc"])], "accuracy double, f1_score double, auc double")


def naive_bayes_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = lab(spark, sf_dir)
    return ops.confusion_matrix(_naive_bayes(work).transform(work.test))


def _by_hand(name: str):
    """Whether a fitted linear model's predictions follow from its coefficients, per row."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        work = lab(spark, sf_dir)
        model = work.fit(name).model(name)
        weights = spark.createDataFrame(
            [(i, float(w)) for i, w in enumerate(model.coefficients.toArray()) if w], "j int, w double")
        rows = model.transform(work.vectors).select("doc_id", "prediction", F.unwrap_udt("features").alias("v"))
        at = F.coalesce("v.indices", F.sequence(F.lit(0), F.size("v.values") - 1))
        cells = rows.select("doc_id", F.inline(F.arrays_zip(at.alias("j"), F.col("v.values").alias("x"))))
        margins = cells.join(weights, "j").groupBy("doc_id").agg(F.sum(F.col("x") * F.col("w")).alias("margin"))
        positive = F.coalesce("margin", F.lit(0.0)) + model.intercept > 0
        return rows.join(margins, "doc_id", "left").select(
            "doc_id", (F.col("prediction") == positive.cast("double")).alias("agrees"))
    return run


def random_forest_by_hand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the forest's predictions follow from its stored trees, per row: every row goes
    down every tree, and the leaves' class shares are added up."""
    model, nodes = _forest(spark, sf_dir)
    rows = model.transform(lab(spark, sf_dir).vectors)
    votes = ops.forest_votes(rows, nodes, model.numFeatures, "doc_id", "prediction")
    positive = F.get("votes", F.lit(1)) > F.get("votes", F.lit(0))
    return votes.select("doc_id", (F.col("prediction") == positive.cast("double")).alias("agrees"))


def _gap(work, name: str) -> DataFrame:
    """The certificate of a linear classifier; see ``duality_gap``."""
    model = work.fit(name).model(name)
    return ops.duality_gap(model, work.train, model.getOrDefault("regParam"), hinge=name == "LinearSVC")


def _certified(name: str):
    """Whether the loss is at most half the regularisation above the least possible, which puts the
    standardised coefficients within a distance of 1 of the best ones."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _gap(lab(spark, sf_dir), name).select(
            F.lit(name).alias("model"), (F.col("dual") <= F.col("primal") + 1e-12).alias("is_bound"),
            (F.col("distance") <= 1.0).alias("is_near"))
    return run


def duality_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures of both certificates."""
    work = lab(spark, sf_dir)
    return ops.union_all([_gap(work, name).withColumn("model", F.lit(name)) for name in ("LogReg", "LinearSVC")])


def log_reg_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the regularised loss is as flat, in every standardised feature, as its distance to the
    least possible loss demands: a partial derivative is at most sqrt(2 * curvature * gap)."""
    work = lab(spark, sf_dir)
    model = work.fit("LogReg").model("LogReg")
    reg, gap = model.getOrDefault("regParam"), _gap(work, "LogReg").first()["gap"]
    weights = spark.createDataFrame(
        [(i, float(w)) for i, w in enumerate(model.coefficients.toArray())], "j int, w double")
    errors = model.transform(work.train).select(
        "doc_id", (vector_to_array("probability")[1] - F.col("label")).alias("e"), F.unwrap_udt("features").alias("v"))
    at = F.coalesce("v.indices", F.sequence(F.lit(0), F.size("v.values") - 1))
    cells = errors.select("e", F.inline(F.arrays_zip(at.alias("j"), F.col("v.values").alias("x"))))
    n = errors.agg(F.count("*")).scalar()
    slopes = cells.groupBy("j").agg(
        F.sum(F.col("e") * F.col("x")).alias("g"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    deviation = F.sqrt((F.col("q") - F.col("s") * F.col("s") / n) / (n - 1))
    step = F.col("g") / n / deviation + reg * F.col("w") * deviation
    curvature = F.col("q") / n / deviation / deviation / 4 + reg
    return slopes.join(weights, "j").where(deviation > 0).agg(
        F.min(F.abs(step) - F.sqrt(2 * curvature * gap) < 1e-9).alias("flat"))


def _forest(spark: SparkSession, sf_dir: str):
    """The fitted forest and the nodes of its stored form."""
    model = lab(spark, sf_dir).fit("RandomForest").model("RandomForest")
    path = sources.save_classifier(model, workspace.fresh_dir(spark, "forest"), "RandomForest")
    return model, ops.forest_nodes(spark, path)


def rf_importance_by_hand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each feature's importance is, to five digits, what its splits took away in impurity."""
    model, nodes = _forest(spark, sf_dir)
    said = spark.createDataFrame(
        [(i, float(w)) for i, w in enumerate(model.featureImportances.toArray())], "feature int, said double")
    found = ops.importance_by_hand(nodes, model.numFeatures)
    return found.join(said, "feature").select(
        "feature", (F.round("importance", 5) == F.round("said", 5)).alias("agrees"))


def rf_nodes_add_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the statistics of all inner nodes are the sums of their children's, no split makes
    impurity larger, and every tree has seen as much weight as there are training rows, give or take six
    standard deviations of its bootstrap sample."""
    model, nodes = _forest(spark, sf_dir)
    n = lab(spark, sf_dir).train.agg(F.count("*").alias("n")).first()["n"]
    seen = F.aggregate("stats", F.lit(0.0), lambda a, b: a + b)
    roots = nodes.where("node = 0").agg(
        F.count("*").alias("trees"), F.min(F.abs(seen - n) <= 6 * F.sqrt(F.lit(float(n)))).alias("whole"))
    inner = ops.split_gains(nodes).agg(
        F.min("adds_up").alias("adds_up"), F.min(F.col("gain") >= -1e-9).alias("gains"))
    return roots.select("*", F.lit(1).alias("one")).join(inner.select("*", F.lit(1).alias("one")), "one").drop("one")


SCORES = {"n_tokens": schema.N_TOKENS, "f023": schema.F023, "f046": schema.F046}


def auc_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact areas for three scores and for naive Bayes, as four models of one table."""
    work = lab(spark, sf_dir)
    rules = prepared_labelled(spark, sf_dir).select("label", F.explode(F.create_map(*[
        x for name, c in SCORES.items() for x in (F.lit(name), F.col(c).cast("double"))])).alias("model", "score"))
    bayes = _naive_bayes(work).transform(work.test).select(
        "label", F.lit("NaiveBayes").alias("model"), F.round(vector_to_array("rawPrediction")[1], 8).alias("score"))
    return ops.auc_by_model(rules.unionByName(bayes)).withColumn("auc", F.round("auc", 9))


def _train(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        arena = lab(spark, sf_dir).fit(name)
        return arena.summary(spark).where(F.col("model") == name)
    return run


def model_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lab(spark, sf_dir).fit().summary(spark)


def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, model = lab(spark, sf_dir).fit().best("f1")
    return spark.createDataFrame([(name, type(model).__name__)], "model string, class string")


def test_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = lab(spark, sf_dir)
    name, model = work.fit().best("f1")
    scores = ops.evaluate_on_test(model, work.test)
    return spark.createDataFrame(
        [(name, scores["accuracy"], scores["f1_score"], scores["auc"])],
        "model string, accuracy double, f1_score double, auc double")


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = lab(spark, sf_dir)
    _, model = work.fit().best("f1")
    return ops.confusion_matrix(model.transform(work.test))


def _by_rule(spark: SparkSession, sf_dir: str, more_than: int = RULE_TOKENS) -> DataFrame:
    return prepared_labelled(spark, sf_dir).select(
        "label", (F.col(schema.N_TOKENS) > more_than).cast("double").alias("prediction"),
        F.col(schema.N_TOKENS).cast("double").alias("rawPrediction"))


def rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, ops.score(_by_rule(spark, sf_dir), bins=0), 6)


def _rule_trials(spark: SparkSession, sf_dir: str) -> list[ops.Trial]:
    return [ops.Trial.of(f"over {n}", n, _by_rule(spark, sf_dir, n), auc_bins=0) for n in RANKED_RULES]


def rule_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed rules ranked like fitted classifiers."""
    return ops.ranking(spark, _rule_trials(spark, sf_dir)).select("model", "acc", "f1", "auc")


def rule_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(ops.best_trial(_rule_trials(spark, sf_dir)).name,)], "model string")


def rule_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.confusion_matrix(_by_rule(spark, sf_dir))


def rule_confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.confusion_counts(_by_rule(spark, sf_dir))


def rf_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = lab(spark, sf_dir).fit("RandomForest").model("RandomForest")
    return ops.feature_importance(spark, model)


def rf_importance_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features that are reported, in order, and whether their weights can be shares."""
    rows = rf_importance(spark, sf_dir).coalesce(1).withColumn("place", F.monotonically_increasing_id())
    return rows.select("place", "feature", F.col("importance").between(0, 1).alias("is_share"))


def _predict_all(models: dict, vectors: DataFrame, prefix: str) -> DataFrame:
    for name, model in models.items():
        vectors = model.transform(vectors).withColumnRenamed("prediction", f"{prefix}_{name}").drop(
            "rawPrediction", "probability")
    return vectors


def save_load_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per classifier: rows, and rows on which the loaded copies agree.

    One pass: the fitted features and then the loaded ones, each with all classifiers.
    """
    work = lab(spark, sf_dir)
    folder = workspace.fresh_dir(spark, "models")
    fitted = {t.name: t.model for t in work.fit().trials}
    features = sources.load_features(sources.save_fitted(work.features, f"{folder}/prep_features"))
    loaded = {name: sources.load_classifier(spark, sources.save_classifier(model, folder, name))
              for name, model in fitted.items()}
    made = ["tf", "tfidf", "stylo_raw", "stylo", "features"]
    before = _predict_all(fitted, work.features.transform(prepared_labelled(spark, sf_dir)), "before")
    after = _predict_all(loaded, features.transform(before.drop(*made)), "after")
    counted = after.agg(F.count("*").alias("n"), *[
        F.count_if(F.col(f"before_{name}") == F.col(f"after_{name}")).alias(name) for name in fitted])
    return counted.unpivot(["n"], list(fitted), "model", "n_same").select("model", "n", "n_same")


def _sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = lab(spark, sf_dir)
    _, model = work.fit().best("f1")
    return ops.inference_sweep(model, work.test)


def inference_sweep_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per setting the rows that were classified; the seconds are in ``inference_sweep``."""
    return _sweep(spark, sf_dir).select("partitions", "rows")


def inference_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sweep(spark, sf_dir).select("partitions", "seconds")


QUERIES = {
    "feature_vectors": feature_vectors,
    "feature_vectors_fit_on_train": feature_vectors_fit_on_train,
    "hashed_tfidf": hashed_tfidf,
    "naive_bayes_predictions": naive_bayes_predictions,
    "naive_bayes_test": naive_bayes_test,
    "naive_bayes_evaluation": naive_bayes_evaluation,
    "log_reg_by_hand": _by_hand("LogReg"),
    "linear_svc_by_hand": _by_hand("LinearSVC"),
    "random_forest_by_hand": random_forest_by_hand,
    "log_reg_gradient": log_reg_gradient,
    "log_reg_gap": _certified("LogReg"),
    "linear_svc_gap": _certified("LinearSVC"),
    "duality_gaps": duality_gaps,
    "rf_importance_by_hand": rf_importance_by_hand,
    "rf_nodes_add_up": rf_nodes_add_up,
    "auc_by_model": auc_by_model,
    "naive_bayes_confusion": naive_bayes_confusion,
    "train_naive_bayes": _train("NaiveBayes"),
    "train_log_reg": _train("LogReg"),
    "train_random_forest": _train("RandomForest"),
    "train_linear_svc": _train("LinearSVC"),
    "model_ranking": model_ranking,
    "best_model": best_model,
    "test_metrics": test_metrics,
    "confusion_matrix": confusion_matrix,
    "rule_metrics": rule_metrics,
    "rule_ranking": rule_ranking,
    "rule_best": rule_best,
    "rule_confusion": rule_confusion,
    "rule_confusion_counts": rule_confusion_counts,
    "rf_importance": rf_importance,
    "rf_importance_range": rf_importance_range,
    "save_load_predict": save_load_predict,
    "inference_sweep": inference_sweep,
    "inference_sweep_rows": inference_sweep_rows,
}
