"""Classification metrics from one aggregation over the predictions."""

import math

from pyspark import StorageLevel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasmlens import schema


def confusion_counts(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def confusion_matrix(
    predictions: DataFrame, classes: tuple[int, ...] = schema.CLASSES
) -> DataFrame:
    """One row per label, one ``pred_<class>`` column per class, also if never predicted.

    A prediction outside ``classes`` has no column; it is an error when the result is read.
    """
    known = [float(c) for c in classes]
    checked = F.when(F.col("prediction").isin(known), F.col("prediction")).otherwise(
        F.raise_error(F.concat(F.lit("prediction outside the classes: "),
                               F.coalesce(F.col("prediction").cast("string"), F.lit("null")))))
    wide = (predictions.select("label", checked.alias("prediction")).groupBy("label")
            .pivot("prediction", known).agg(F.count(F.lit(1))))
    return wide.select("label", *[
        F.coalesce(F.col(f"`{float(c)}`"), F.lit(0)).cast("int").alias(f"pred_{c}")
        for c in classes])


def accuracy_and_f1(predictions: DataFrame) -> DataFrame:
    """One row: ``n``, ``accuracy``, ``f1`` (mean of the class F1 values, weighted by the
    share of rows with that label) and ``labels``, the number of classes that occur as label.

    The classes are those in the data. A row without a label counts, and is not right.
    """
    pairs = confusion_counts(predictions).select(
        F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("guess"), "n")
    hit = F.when(F.coalesce(F.col("label") == F.col("guess"), F.lit(False)), F.col("n")).otherwise(F.lit(0))
    nothing = F.lit(0).cast("long")

    def entry(c: Column, actual: Column, guessed: Column, hits: Column) -> Column:
        return F.struct(c.alias("c"), actual.alias("actual"), guessed.alias("guessed"), hits.cast("long").alias("hits"))

    classes = (pairs.select(F.inline(F.array(
        entry(F.col("label"), F.col("n"), nothing, hit), entry(F.col("guess"), nothing, F.col("n"), nothing))))
        .groupBy("c").agg(F.sum("actual").alias("actual"), F.sum("guessed").alias("guessed"), F.sum("hits").alias("hits")))
    is_class = F.col("c").isNotNull()
    share = F.col("actual") * 2.0 * F.col("hits") / (F.col("actual") + F.col("guessed"))
    sums = classes.agg(
        F.coalesce(F.sum("actual"), F.lit(0)).alias("n"), F.sum("hits").alias("hits"),
        F.coalesce(F.sum(F.when(is_class & (F.col("actual") > 0), share)), F.lit(0.0)).alias("f1"),
        F.count_if(is_class & (F.col("actual") > 0)).cast("int").alias("labels"))
    of_all = lambda part: F.when(F.col("n") > 0, part / F.col("n"))
    return sums.select(
        "n", of_all(F.col("hits").cast("double")).alias("accuracy"), of_all(F.col("f1")).alias("f1"), "labels")


def roc_auc(predictions: DataFrame, bins: int = 1000, score: str = "rawPrediction") -> float:
    """Area under the ROC curve; ``bins=0`` keeps every distinct score."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol="label", metricName="areaUnderROC", numBins=bins)
    return evaluator.evaluate(predictions)


def score(
    predictions: DataFrame, bins: int = 1000, raw: str = "rawPrediction"
) -> dict[str, float]:
    """Rows, accuracy, weighted F1 and AUC; AUC is NaN unless exactly two classes occur."""
    needed = predictions.select("label", "prediction", raw).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        row = accuracy_and_f1(needed).first()
        auc = roc_auc(needed, bins, raw) if row["labels"] == 2 else math.nan
    finally:
        needed.unpersist()
    return {
        "n": row["n"],
        "acc": math.nan if row["accuracy"] is None else row["accuracy"],
        "f1": math.nan if row["f1"] is None else row["f1"],
        "auc": auc,
    }


def evaluate_on_test(model, test: DataFrame, bins: int = 1000) -> dict:
    """Metrics of a fitted classifier on held-out rows, rounded to four digits."""
    predictions = model.transform(test)
    scores = score(predictions, bins)
    return {
        "accuracy": round(scores["acc"], 4),
        "f1_score": round(scores["f1"], 4),
        "auc": round(scores["auc"], 4),
        "predictions": predictions,
    }
