"""Exact percentiles per class without gathering or ordering a class."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def percentiles_by_class(
    df: DataFrame,
    column: str,
    shares: tuple[float, ...] = (0.05, 0.25, 0.5, 0.75, 0.95),
    accuracy: int = 10_000,
) -> DataFrame:
    """``label, p, value``: percentiles of a numeric column, interpolated between the two values
    next to them. Nulls, NaN and rows without a label are left out.

    A mergeable quantile sketch brackets each percentile between two values of the column; its
    rank is off by one part in ``accuracy`` at most. The second pass counts what lies below
    each bracket and checks that it holds the wanted ranks (a bracket that did not would be
    replaced by the whole range). The third pass counts the values inside, some four parts in
    ``accuracy`` of the rows, and finds the ranks among them.
    """
    value = F.col(column).cast("double")
    values = df.select("label", value.alias("v")).where(
        F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.isnan("v"))
    off = 2.0 / accuracy
    at = lambda sign: F.percentile_approx(
        "v", [min(1.0, max(0.0, p + sign * off)) for p in shares], accuracy)
    drawn = values.groupBy("label").agg(
        F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"),
        at(-1).alias("lo"), at(1).alias("hi"))
    # One row per label is joined to the values; the brackets stay in arrays.
    counted = values.join(drawn, "label").groupBy("label", "n", "least", "most", "lo", "hi").agg(
        F.array(*[F.count_if(F.col("v") < F.get("lo", F.lit(i))) for i in range(len(shares))]).alias("below"),
        F.array(*[F.count_if(F.col("v") <= F.get("hi", F.lit(i))) for i in range(len(shares))]).alias("upto"))

    def bracket(i: int, p: float):
        place = (F.col("n") - 1) * F.lit(p)
        first, last = F.floor(place), F.ceil(place)
        holds = (F.get("below", F.lit(i)) <= first) & (F.get("upto", F.lit(i)) > last)
        return F.struct(
            F.lit(i).alias("i"), F.lit(p).alias("p"), place.alias("place"), first.alias("first"), last.alias("last"),
            F.when(holds, F.get("lo", F.lit(i))).otherwise(F.col("least")).alias("lo"),
            F.when(holds, F.get("hi", F.lit(i))).otherwise(F.col("most")).alias("hi"),
            F.when(holds, F.get("below", F.lit(i))).otherwise(F.lit(0)).cast("long").alias("below"))

    brackets = counted.select("label", F.array(*[bracket(i, p) for i, p in enumerate(shares)]).alias("brackets"))
    inside = values.join(brackets, "label").select("label", "v", F.explode(F.filter(
        "brackets", lambda b: F.col("v").between(b["lo"], b["hi"]))).alias("b"))
    ordered = Window.partitionBy("label", "b.i").orderBy("v")
    ranked = inside.groupBy("label", "b", "v").agg(F.count("*").alias("copies")).withColumn(
        "upto", F.col("b.below") + F.sum("copies").over(ordered))
    on = lambda rank: F.max(F.when(
        (F.col("upto") > F.col(rank)) & (F.col("upto") - F.col("copies") <= F.col(rank)), F.col("v")))
    found = ranked.groupBy("label", "b").agg(on("b.first").alias("low"), on("b.last").alias("high"))
    between = F.col("b.place") - F.col("b.first")
    return found.select("label", F.col("b.p").alias("p"),
                        (F.col("low") + (F.col("high") - F.col("low")) * between).alias("value"))
