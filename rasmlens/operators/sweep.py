"""Inference time against the number of partitions."""

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTITIONS = (2, 4, 8, 16)


def inference_sweep(
    model, rows: DataFrame, partitions: tuple[int, ...] = PARTITIONS
) -> DataFrame:
    """Rows classified and seconds taken per partition setting, as a table.

    The predictions are summed: a mere count would let the optimiser drop them. Both the shuffle setting and the partitions of the input follow the sweep,
    and the setting is put back afterwards.
    """
    spark = rows.sparkSession
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    timings = []
    try:
        for n in partitions:
            spark.conf.set(setting, n)
            predicted = model.transform(rows.repartition(n)).agg(
                F.sum("prediction"), F.count(F.lit(1)).alias("rows"))
            started = time.perf_counter()
            seen = predicted.first()["rows"]
            timings.append((n, seen, round(time.perf_counter() - started, 3)))
    finally:
        spark.conf.set(setting, before)
    return spark.createDataFrame(timings, "partitions int, rows long, seconds double")
