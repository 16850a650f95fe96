"""Sinks that handle each micro-batch as a table of its own.

What a stream cannot do row by row, such as matching its words with a list of any size, a
micro-batch can. Each batch is written to a folder named after the query and the batch number,
and counts once the folder is finished. A batch that is run again after a failure overwrites
what it had left unfinished and leaves alone what it had finished, so rows are neither lost nor
doubled.
"""

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rasmlens import schema, workspace
from rasmlens.streaming.triggers import triggered

#: What tells the rows of a batch apart.
ROW = "_row"
TOTALS = T.StructType([T.StructField("n", T.LongType()), T.StructField("right", T.LongType())])


def write_batches(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    each: Callable[[DataFrame], DataFrame],
    interval: str | None = "3 seconds",
    output_mode: str = "append",
) -> StreamingQuery:
    """Write ``each(batch)`` as JSON for every micro-batch.

    ``each`` may read its batch several times: it gets a stored copy, with a column ``ROW`` that
    numbers the rows, which is deleted when the batch is written.
    """
    spark = rows.sparkSession
    query_id: list[str] = []

    def write(batch: DataFrame, number: int) -> None:
        if not query_id:
            # Written before the first batch; a new checkpoint is a new query.
            query_id.append(json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"])
        folder = f"{path}/query={query_id[0]}/batch={number}"
        if workspace.exists(spark, f"{folder}/_SUCCESS"):
            return
        held = workspace.fresh_dir(spark, "batch")
        try:
            batch.withColumn(ROW, F.monotonically_increasing_id()).write.parquet(held)
            each(spark.read.parquet(held)).write.mode("overwrite").json(folder)
        finally:
            workspace.delete(spark, held)

    writer = (rows.writeStream.outputMode(output_mode).foreachBatch(write)
              .option("checkpointLocation", checkpoint))
    return triggered(writer, interval).start()


def finished_batches(spark: SparkSession, path: str) -> list[str]:
    """The folders of all batches that are finished, in the order of their queries and numbers."""
    marks = workspace.matching(spark, f"{path}/query=*/batch=*/_SUCCESS")
    folders = [mark.rsplit("/", 1)[0] for mark in marks]
    return sorted(folders, key=lambda f: (f.rsplit("/", 2)[1], int(f.rsplit("=", 1)[1])))


def read_batches(
    spark: SparkSession, path: str, columns: T.StructType = schema.STREAM_OUT
) -> DataFrame:
    """The rows of all finished batches; none where there are no batches."""
    folders = finished_batches(spark, path)
    if not folders:
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).json(folders)


def track_accuracy(
    spark: SparkSession,
    predictions: str,
    totals: str,
    checkpoint: str,
    interval: str | None = "3 seconds",
    max_files_per_trigger: int = 5,
    columns: T.StructType = schema.STREAM_OUT,
) -> StreamingQuery:
    """Keep the accuracy of a running stream: a second stream over the folder of its sink.

    The sink's commit log says which files count, and each of them is read once, in whatever
    number of runs. The state is two sums.
    """
    rows = (spark.readStream.schema(columns)
            .option("maxFilesPerTrigger", max_files_per_trigger).json(predictions))
    hit = F.coalesce(F.col("label") == F.col("prediction"), F.lit(False))
    sums = rows.agg(F.count("*").alias("n"), F.count_if(hit).alias("right"))
    return write_batches(sums, totals, checkpoint, lambda batch: batch.drop(ROW), interval, "complete")


def running_accuracy(spark: SparkSession, totals: str) -> DataFrame:
    """One row: number of predictions and share of right ones, after the last finished batch."""
    folders = finished_batches(spark, totals)
    last = (spark.read.schema(TOTALS).json(folders[-1]) if folders
            else spark.createDataFrame([(0, 0)], TOTALS))
    share = F.when(F.col("n") > 0, F.col("right") / F.col("n")).otherwise(F.lit(0.0))
    return last.select("n", share.alias("accuracy"))
