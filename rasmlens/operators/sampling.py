"""Samples and train/validation/test splits.

The ``hash_*`` forms decide by a digest of the row's key. They give the same rows
for any partitioning and after any task retry, need no caching, and can be checked
in another engine. The seeded forms are Spark's own and depend on partitioning;
feed them from a stored table.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 32


def hash_position(key: str, seed: int = 0) -> Column:
    """Place of a key in [0, 2^32): the first 32 bits of md5("seed:key")."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    _check_fraction(fraction)
    return df.where(hash_position(key, seed) < int(fraction * _RANGE))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    _check_fraction(fraction)
    return df.sample(False, fraction, seed)


def sample_limit(df: DataFrame, fraction: float, n: int, seed: int, key: str | None = None) -> DataFrame:
    """At most ``n`` rows of a sample; with a key, always the same ones in key order."""
    if key is None:
        return bernoulli_sample(df, fraction, seed).limit(n)
    return hash_sample(df, key, fraction, seed).orderBy(key).limit(n)


def random_split(
    df: DataFrame, ratios: tuple[float, ...] = (0.70, 0.15, 0.15), seed: int = 2026
) -> list[DataFrame]:
    _check_ratios(ratios)
    return df.randomSplit(list(ratios), seed)


def random_split_two_stage(
    df: DataFrame, ratios: tuple[float, float, float] = (0.70, 0.15, 0.15), seed: int = 2026
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Training rows first, then the rest into validation and test."""
    _check_ratios(ratios)
    train, validation, test = ratios
    share = validation / (validation + test)
    train_df, rest = df.randomSplit([train, 1 - train], seed)
    validation_df, test_df = rest.randomSplit([share, 1 - share], seed)
    return train_df, validation_df, test_df


def split_index(key: str, ratios: tuple[float, ...] = (0.70, 0.15, 0.15), seed: int = 2026) -> Column:
    """Number of the split a row belongs to."""
    _check_ratios(ratios)
    position = hash_position(key, seed)
    upper, index = 0.0, None
    for i, ratio in enumerate(ratios[:-1]):
        upper += ratio
        inside = position < int(upper * _RANGE)
        index = F.when(inside, i) if index is None else index.when(inside, i)
    return F.lit(0) if index is None else index.otherwise(len(ratios) - 1)


def hash_split(
    df: DataFrame, key: str, ratios: tuple[float, ...] = (0.70, 0.15, 0.15), seed: int = 2026
) -> list[DataFrame]:
    index = split_index(key, ratios, seed)
    return [df.where(index == i) for i in range(len(ratios))]


def _check_fraction(fraction: float) -> None:
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"fraction {fraction} is not between 0 and 1")


def _check_ratios(ratios: tuple[float, ...]) -> None:
    if not ratios or min(ratios) <= 0 or abs(sum(ratios) - 1.0) > 1e-9:
        raise ValueError(f"ratios {ratios} must be positive and add up to 1")
