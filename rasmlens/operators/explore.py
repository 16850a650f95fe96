"""Corpus statistics behind the exploratory charts, aggregated in Spark."""

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasmlens import schema


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def label_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count("*").alias("n"))


def class_composition(df: DataFrame) -> DataFrame:
    """Rows per label and their share in percent."""
    total = row_count(df).scalar()
    return label_counts(df).withColumn("percent", F.round(100.0 * F.col("n") / total, 1))


def token_counts(df: DataFrame, tokens: str = schema.TOKENS) -> DataFrame:
    return (df.select(F.explode(tokens).alias("w"))
              .groupBy("w").agg(F.count("*").alias("count")))


def top_tokens(df: DataFrame, k: int = 20, tokens: str = schema.TOKENS) -> DataFrame:
    """The ``k`` most frequent tokens, ties by the token itself."""
    return token_counts(df, tokens).orderBy(F.desc("count"), "w").limit(k)


def distribution_by_class(df: DataFrame, column: str) -> DataFrame:
    """Size, mean and extrema of a numeric column per label, nulls left out."""
    return (df.where(F.col(column).isNotNull()).groupBy("label").agg(
        F.count("*").alias("n"),
        F.avg(column).alias("mean"),
        F.min(column).alias("min"),
        F.max(column).alias("max")))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson coefficients as rows ``(a, b, r)``; null where a column is constant.

    All pairs are computed in one aggregation; the output has ``len(columns)**2`` rows.
    A pair uses the rows in which both columns are set. ``corr`` itself is not used:
    in ANSI mode it fails on a constant column.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    stats = []
    for i, (a, b) in enumerate(pairs):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = (F.when(both, F.col(c).cast("double")) for c in (a, b))
        stats += [F.covar_pop(x, y).alias(f"cov{i}"), F.stddev_pop(x).alias(f"sx{i}"),
                  F.stddev_pop(y).alias(f"sy{i}")]
    number = {pair: i for i, pair in enumerate(pairs)}

    def cell(a: str, b: str) -> Column:
        i = number[a, b] if (a, b) in number else number[b, a]
        spread = F.col(f"sx{i}") * F.col(f"sy{i}")
        r = F.lit(1.0) if a == b else F.col(f"cov{i}") / spread
        return F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                        F.when(spread > 0, r).alias("r"))

    cells = F.array(*[cell(a, b) for a, b in product(columns, columns)])
    return df.agg(*stats).select(F.inline(cells))
