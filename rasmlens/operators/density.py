"""Gaussian kernel density per class on an even grid."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: exp(-z*z/2) is 0.0 in double precision from here on.
KERNEL_REACH = 39.0
#: Cells per bandwidth, and terms of the series about a cell's centre.
CELLS, TERMS = 2, 14


def kernel_density(
    df: DataFrame,
    column: str,
    points: int = 200,
) -> DataFrame:
    """Density of ``column`` per label at ``points`` places from its min to its max.

    Bandwidth is 1.06 * population deviation * n^(-1/5), or 1.0 where that is 0;
    labels with fewer than two values, and rows without a label, are left out. Returns
    label, i, x, density for every label in the data.

    Values are summed up first: a cell, half a bandwidth wide, keeps ``TERMS`` moments of its
    values about its centre. With d the distance to the centre in bandwidths, at most 1/4,
    the kernel is the series of d**k / k! * He_k(t) * exp(-t*t/2) over Hermite polynomials. A term
    is below 1.09 * d**k / sqrt(k!), so what is left out is less than 2e-14 of the values' number. A cell
    contributes only to the grid points its kernels reach in double precision. So rows after the
    first aggregation follow the range in bandwidths, not the number of values, distinct or
    not. The side that is joined to the values has one row per label.
    """
    if points < 2:
        raise ValueError("the grid needs at least two points")
    value = F.col(column).cast("double")
    values = df.select("label", value.alias("v")).where(
        F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.isnan("v"))

    bandwidth = 1.06 * F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-1 / 5))
    stats = (values.groupBy("label").agg(
        F.count("*").alias("n"), F.stddev_pop("v").alias("sd"),
        F.min("v").alias("lo"), F.max("v").alias("hi"))
        .where("n >= 2")
        .withColumn("bw", F.when(bandwidth == 0, 1.0).otherwise(bandwidth))
        .withColumn("step", (F.col("hi") - F.col("lo")) / (points - 1))
        .drop("sd", "hi"))

    last = points - 1
    place = F.round((F.col("v") - F.col("lo")) / F.col("bw") * CELLS)
    apart = (F.col("v") - F.col("lo")) / F.col("bw") - F.col("cell") / CELLS
    cells = (values.join(stats, "label").withColumn("cell", place).withColumn("d", apart)
             .groupBy("label", "cell").agg(F.array(*[
                 F.sum(F.pow("d", F.lit(float(k))) / math.factorial(k)) for k in range(TERMS)]).alias("moments")))

    # The reach of a cell's values goes beyond that of its centre by half a cell.
    reach = (KERNEL_REACH + 0.5 / CELLS) * F.col("bw")
    offset = F.col("cell") * F.col("bw") / CELLS
    first_i = F.greatest(F.lit(0.0), F.ceil((offset - reach) / F.col("step")).cast("double"))
    last_i = F.least(F.lit(float(last)), F.floor((offset + reach) / F.col("step")).cast("double"))
    reached = (F.when(F.col("step") == 0, F.sequence(F.lit(0), F.lit(last)))
               .when(first_i <= last_i, F.sequence(first_i.cast("int"), last_i.cast("int"))))
    x = F.col("lo") + F.col("i") * F.col("step")
    t = F.col("i") * F.col("step") / F.col("bw") - F.col("cell") / CELLS

    def add(state: Column, k: Column) -> Column:
        following = F.col("t") * state["now"] - k * state["before"]
        return F.struct(state["now"].alias("before"), following.alias("now"),
                        (state["sum"] + F.get("moments", k + 1) * following).alias("sum"))

    start = F.struct(F.lit(1.0).alias("before"), F.col("t").alias("now"),
                     (F.get("moments", F.lit(0)) + F.get("moments", F.lit(1)) * F.col("t")).alias("sum"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS - 2)), start, add, lambda state: state["sum"])
    sums = (cells.join(stats, "label")
            .select("label", "cell", "moments", "step", "bw", F.explode(reached).alias("i")).withColumn("t", t)
            .groupBy("label", "i").agg(F.sum(F.exp(-0.5 * F.col("t") * F.col("t")) * series).alias("total")))

    grid = stats.select(
        "label", "n", "bw", "lo", "step", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("i"))
    density = F.coalesce("total", F.lit(0.0)) / (
        F.col("n") * F.col("bw") * F.lit(math.sqrt(2 * math.pi)))
    return grid.join(sums, ["label", "i"], "left").select(
        "label", "i", x.alias("x"), F.greatest(density, F.lit(0.0)).alias("density"))
