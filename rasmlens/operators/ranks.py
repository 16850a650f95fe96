"""Areas under ROC curves from exact rank sums, for any number of models in one pass."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rasmlens import workspace


def auc_by_model(
    predictions: DataFrame, model: str = "model", score: str = "score", label: str = "label",
) -> DataFrame:
    """``model, n, positives, auc`` from rows of model, score and label (1 is positive, any other
    label negative). Rows without a label or score are left out, NaN is the highest score. ``auc`` is null where one
    of the two classes is missing.

    Equal scores are counted first and have the mean of their ranks. Ranks are prefix sums in two
    levels: the counts are dealt out by ranges of (model, score), each range sums up its
    own, and what lies before a range follows from one row per range and model. So
    a model of any size, or with most of the rows, is ranked by many tasks, and no
    model costs a job of its own.
    """
    spark = predictions.sparkSession
    counts = (predictions.select(
        F.col(model).alias("model"), F.col(score).cast("double").alias("score"), (F.col(label) == 1).alias("positive"))
        .where(F.col("score").isNotNull() & F.col("positive").isNotNull())
        .groupBy("model", "score").agg(F.count_if("positive").alias("pos"), F.count("*").alias("n")))
    path = workspace.fresh_dir(spark, "score_ranges")
    (counts.repartitionByRange("model", "score")
     .withColumn("part", F.spark_partition_id()).write.parquet(path))
    dealt = spark.read.parquet(path)

    before = lambda w: F.coalesce(F.sum("n").over(
        w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = dealt.groupBy("model", "part").agg(F.sum("n").alias("n"))
    starts = ranges.select(
        F.col("model").alias("of"), F.col("part").alias("in_part"),
        before(Window.partitionBy("model").orderBy("part")).alias("start"))
    within = dealt.withColumn("ahead", before(Window.partitionBy("part", "model").orderBy("score")))
    ranked = within.join(starts, F.col("model").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in_part")))
    # Twice the mean rank of equal scores is a whole number, and whole sums lose nothing.
    doubled = (2 * (F.col("start") + F.col("ahead")) + F.col("n") + 1).cast("decimal(20,0)") * F.col("pos").cast("decimal(18,0)")
    sums = ranked.groupBy("model").agg(
        F.sum("n").alias("n"), F.sum("pos").alias("positives"), F.sum(doubled).alias("ranks"))
    p, rest = F.col("positives").cast("decimal(18,0)"), (F.col("n") - F.col("positives")).cast("decimal(18,0)")
    over = (F.col("ranks") - p * (p + 1)).cast("double")
    return sums.select("model", "n", "positives", F.when(
        (p > 0) & (rest > 0), over / (2.0 * p.cast("double") * rest.cast("double"))).alias("auc"))
