"""Small helpers that the operators share."""

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import rasmlens
from rasmlens import workspace

#: Most bytes in one batch between Spark and a Python worker. A single longer row still
#: travels whole.
BATCH_BYTES = 8 << 20
#: The folder that holds the package.
HOME = os.path.dirname(os.path.dirname(os.path.abspath(rasmlens.__file__)))
#: A run of these is what separates words.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends here, nothing is evaluated
    twice, and a lost executor takes nothing with it."""
    path = workspace.fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prepare_workers(spark: SparkSession) -> None:
    """Limit batches by bytes, so that many long texts never meet in a Python worker, and let
    workers import this package from where the driver has it. On a cluster whose nodes lack
    that folder the package must be installed, or passed with ``--py-files``."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if HOME not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([HOME, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digest(*values: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes, together the identity of a value."""
    return F.xxhash64(*values), F.xxhash64(F.lit(1), *values)
