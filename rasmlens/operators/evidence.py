"""What shows that a fitted classifier is the one its settings ask for."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Widths of the band of margins around 1 in which a support vector's weight falls from 1 to 0.
BANDS = (0.02, 0.05, 0.1, 0.2, 0.4, 0.8)
#: Vectors that a task opens to their full length at a time.
OPENED = 256


def cells_of(rows: DataFrame, *keep: str) -> DataFrame:
    """``keep``, ``j``, ``x``: the entries of the vectors in ``features``, which stay sparse."""
    opened = rows.select(*keep, F.unwrap_udt("features").alias("v"))
    at = F.coalesce("v.indices", F.sequence(F.lit(0), F.size("v.values") - 1))
    return opened.select(*keep, F.inline(F.arrays_zip(at.alias("j"), F.col("v.values").alias("x"))))


def duality_gap(model, train: DataFrame, reg: float, hinge: bool = False) -> DataFrame:
    """One row: ``primal``, ``dual``, ``gap``, ``distance`` and ``norm`` of a linear classifier with
    logistic or hinge loss, fitted on standardised features with an unregularised intercept.

    The loss is at most ``gap`` above the least that any coefficients reach: the dual value of
    any feasible weights of the rows bounds it from below. The weights come from the margins
    (for hinge loss, the best of several), and those of the larger side are scaled down so that both
    classes weigh the same, as the free intercept demands. As the loss is ``reg``-strongly
    convex, the standardised coefficients are at most ``distance = sqrt(2 * gap / reg)`` from the
    best ones, to be read against their ``norm``.
    """
    spark = train.sparkSession
    margin = vector_to_array("rawPrediction")[1]
    signed = model.transform(train).select(
        (F.col("label") == 1).alias("yes"), margin.alias("m"), "features").withColumn(
        "m", F.when(F.col("yes"), F.col("m")).otherwise(-F.col("m")))
    if hinge:
        loss = F.greatest(F.lit(0.0), 1 - F.col("m"))
        weights = [F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.5 + (1 - F.col("m")) / (2 * band))) for band in BANDS]
    else:
        loss = F.log1p(F.exp(-F.abs("m"))) + F.greatest(F.lit(0.0), -F.col("m"))
        weights = [1 / (1 + F.exp(F.col("m")))]
    rows = signed.withColumns({"loss": loss, "a": F.array(*weights)})
    each = range(len(weights))
    of = lambda side, k: F.sum(F.when(F.col("yes") == F.lit(side), F.get("a", F.lit(k))).otherwise(0.0))
    sums = rows.agg(F.count("*").alias("n"), F.avg("loss").alias("loss"),
                    F.array(*[of(True, k) for k in each]).alias("ones"),
                    F.array(*[of(False, k) for k in each]).alias("zeros")).first()
    n = sums["n"]
    scale = [(min(one, zero) / one, min(one, zero) / zero) if one and zero else (0.0, 0.0)
             for one, zero in zip(sums["ones"], sums["zeros"])]

    def balanced(k: int) -> Column:
        return F.get("a", F.lit(k)) * F.when(F.col("yes"), scale[k][0]).otherwise(scale[k][1])

    def entropy(p: Column) -> Column:
        part = lambda q: F.when(q > 0, -q * F.log(q)).otherwise(0.0)
        return part(p) + part(1 - p)

    gains = rows.agg(F.array(*[F.avg(balanced(k) if hinge else entropy(balanced(k))) for k in each])).first()[0]
    coefficients = spark.createDataFrame(
        [(i, float(w)) for i, w in enumerate(model.coefficients.toArray())], "j int, w double")
    sign = F.when(F.col("yes"), 1.0).otherwise(-1.0)
    deviation = F.sqrt(F.greatest(F.lit(0.0), (F.col("q") - F.col("s") * F.col("s") / n) / (n - 1)))
    slopes = cells_of(rows, "yes", "a").groupBy("j").agg(
        F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"),
        F.array(*[F.sum(balanced(k) * sign * F.col("x")) for k in each]).alias("g"))
    standard = slopes.withColumn("d", deviation).where("d > 0").join(coefficients, "j", "left")
    square = lambda c: F.sum(c * c)
    found = standard.agg(
        square(F.coalesce("w", F.lit(0.0)) * F.col("d")).alias("norm2"),
        F.array(*[square(F.get("g", F.lit(k)) / F.col("d") / (reg * n)) for k in each]).alias("duals")).first()
    primal = sums["loss"] + reg / 2 * found["norm2"]
    duals = []
    for gain, norm2 in zip(gains, found["duals"]):
        cost = reg / 2 * norm2
        # All weights of a hinge loss may be scaled down together.
        share = min(1.0, gain / (2 * cost)) if hinge and cost > 0 else 1.0
        duals.append(share * gain - share * share * cost)
    gap = max(0.0, primal - max(duals))
    return spark.createDataFrame(
        [(primal, max(duals), gap, (2 * gap / reg) ** 0.5, found["norm2"] ** 0.5)],
        "primal double, dual double, gap double, distance double, norm double")


def forest_nodes(spark: SparkSession, path: str) -> DataFrame:
    """``tree, node, left, right, feature, bound, stats`` of a stored forest; leaves have -1 for children. ``stats``
    are the class weights of the rows that reached the node."""
    return spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*").select(
        "tree", F.col("id").alias("node"), F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
        F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("bound"), F.col("impurityStats").alias("stats"))


def forest_votes(rows: DataFrame, nodes: DataFrame, n_features: int, *keep: str) -> DataFrame:
    """``keep`` and ``votes`` for every row: the class shares of the leaves that its ``features`` reach,
    added up over the trees in their order. Splits are by thresholds.

    The nodes, which are as many as the model has, go to the tasks as arrays. A vector stays where it
    is and goes down all trees at once, so a row costs the same whatever the number of rows.
    """
    found = nodes.toArrow()
    tree, node = (found.column(c).to_numpy() for c in ("tree", "node"))
    shape = (int(tree.max()) + 1, int(node.max()) + 1)

    def by_tree(name: str) -> np.ndarray:
        values = found.column(name).to_numpy()
        cells = np.zeros(shape, values.dtype)
        cells[tree, node] = values
        return cells

    left, right, feature = (by_tree(c) for c in ("left", "right", "feature"))
    bound = np.nan_to_num(by_tree("bound"))
    stats = np.array(found.column("stats").to_pylist(), float)
    shares = np.zeros((*shape, stats.shape[1]))
    shares[tree, node] = stats / stats.sum(axis=1, keepdims=True)
    opened = rows.select(*keep, F.unwrap_udt("features").alias("v"))
    at = F.coalesce("v.indices", F.sequence(F.lit(0), F.size("v.values") - 1))
    sparse = opened.select(*keep, at.alias("_at"), F.col("v.values").alias("_x"))
    out = T.StructType([*sparse.select(*keep).schema.fields, T.StructField("votes", T.ArrayType(T.DoubleType()))])
    names = [*keep, "votes"]

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = np.arange(shape[0])
        for batch in batches:
            for start in range(0, batch.num_rows, OPENED):
                part = batch.slice(start, OPENED)
                each = np.arange(part.num_rows)
                lengths = part.column("_at").value_lengths().to_numpy()
                x = np.zeros((part.num_rows, n_features))
                x[np.repeat(each, lengths), part.column("_at").flatten().to_numpy()] = part.column("_x").flatten().to_numpy()
                reached = np.zeros((part.num_rows, shape[0]), left.dtype)
                while (inner := left[trees, reached] >= 0).any():
                    small = x[each[:, None], feature[trees, reached]] <= bound[trees, reached]
                    below = np.where(small, left[trees, reached], right[trees, reached])
                    reached = np.where(inner, below, reached)
                votes = np.zeros((part.num_rows, shares.shape[2]))
                for k in trees:
                    votes += shares[k, reached[:, k]]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(list(votes), pa.list_(pa.float64()))], names=names)

    return sparse.mapInArrow(descend, out)


def total(stats: Column) -> Column:
    return F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)


def gini(stats: Column) -> Column:
    return 1 - F.aggregate(stats, F.lit(0.0), lambda a, b: a + b * b) / (total(stats) * total(stats))


def split_gains(nodes: DataFrame) -> DataFrame:
    """``tree, node, feature, gain, adds_up`` for every inner node: the weight times impurity that its split
    took away, and whether its statistics are the sums of its children's."""
    child = lambda side: nodes.select("tree", F.col("node").alias(side), F.col("stats").alias(f"{side}_stats"))
    both = nodes.where("left >= 0").join(child("left"), ["tree", "left"]).join(child("right"), ["tree", "right"])
    weighed = lambda stats: total(stats) * gini(stats)
    sums = F.zip_with("left_stats", "right_stats", lambda a, b: a + b)
    adds_up = F.forall(F.zip_with("stats", sums, lambda a, b: F.abs(a - b) <= 1e-9 * (1 + F.abs(a))), lambda ok: ok)
    gain = weighed(F.col("stats")) - weighed(F.col("left_stats")) - weighed(F.col("right_stats"))
    return both.select("tree", "node", "feature", gain.alias("gain"), adds_up.alias("adds_up"))


def importance_by_hand(nodes: DataFrame, n_features: int) -> DataFrame:
    """``feature, importance`` for all features: gains as shares of their tree's, added up over the
    trees, as shares of all."""
    by_tree = split_gains(nodes).groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
    trees = by_tree.groupBy("tree").agg(F.sum("gain").alias("of_tree")).where("of_tree > 0")
    shares = by_tree.join(trees, "tree").groupBy("feature").agg(F.sum(F.col("gain") / F.col("of_tree")).alias("share"))
    whole = shares.agg(F.sum("share")).scalar()
    every = nodes.sparkSession.range(n_features).select(F.col("id").cast("int").alias("feature"))
    return every.join(shares, "feature", "left").select(
        "feature", F.coalesce(F.col("share") / whole, F.lit(0.0)).alias("importance"))
