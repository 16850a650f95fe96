"""Wide tables of texts to the long labelled corpus."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasmlens import schema
from rasmlens.functions import is_blank
from rasmlens.sources.tables import read_csv, spread


def melt(
    wide: DataFrame,
    source: str,
    human: str = schema.HUMAN_COLUMN,
    generated: tuple[str, ...] = schema.AI_COLUMNS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per non-blank text, labelled by the column it comes from.

    Columns missing from ``wide`` are skipped; ``keep`` columns are carried along.
    """
    present = [c for c in (human, *generated) if c in wide.columns]
    if not present:
        raise ValueError("none of the text columns is in the table")
    long = wide.unpivot(list(keep), present, "_column", "text").where(~is_blank(F.col("text")))
    from_human = F.col("_column") == human
    return long.select(
        *keep,
        "text",
        F.when(from_human, schema.HUMAN).otherwise(schema.AI).alias("label"),
        F.when(from_human, "human")
         .otherwise(F.replace("_column", F.lit(schema.GENERATED_SUFFIX), F.lit("")))
         .alias("model"),
        F.lit(source).alias("source"),
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def ingest(spark: SparkSession, splits: dict[str, str]) -> DataFrame:
    """Read one CSV per split name and return the long corpus of all splits."""
    return union_all([melt(spread(read_csv(spark, path)), name) for name, path in splits.items()])
