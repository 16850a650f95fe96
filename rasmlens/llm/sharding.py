"""Shards of near equal bytes, by sampled splitters.

Records are ordered by a key and cut into ranges at the quantiles of a sample in which
a record's chance follows its size. Ranges that turn out overfull are sampled again and
subdivided. Then every range is put in order by itself, which gives each record its
place in bytes and rows, and the shards are equal stretches of the bytes.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasmlens.llm.frames import prepare_workers, stored

#: Ranges for one shard, and sampled keys for one range.
RANGES_PER_SHARD, SAMPLE_PER_RANGE = 16, 16
#: Rows of a range, about, where that makes more ranges. One task puts a range in order.
ROWS_PER_RANGE = 1 << 20
#: A range of more than so many times its share of the bytes is subdivided.
OVERFULL = 2.0
MAX_ROUNDS = 8


def record_key(text: Column, number: Column) -> Column:
    """A key below 2**63: records of equal text are neighbours, and nearly every record has
    a key of its own, so that a range of one much-copied text can be cut too."""
    high = F.shiftrightunsigned(F.xxhash64(text), 32)
    low = F.shiftrightunsigned(F.xxhash64(F.lit(2), number), 33)
    return F.shiftleft(high, 31).bitwiseOR(low).bitwiseAND(F.lit((1 << 63) - 1))


def range_of(key: str, bounds: np.ndarray) -> Column:
    """The number of bounds that are at most the key."""
    @F.pandas_udf("int")
    def find(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy("i8"), side="right").astype("i4"))

    return find(key)


def _sample(rows: DataFrame, rate: float, salt: int) -> np.ndarray:
    """Sorted keys of records drawn with a chance of size times rate."""
    place = F.shiftrightunsigned(F.xxhash64(F.lit(salt), "number"), 11) / float(1 << 53)
    drawn = rows.where(place < F.col("size") * rate).select("key").toPandas()["key"]
    return np.sort(drawn.to_numpy("i8"))


def splitters(rows: DataFrame, total: int, ranges: int) -> tuple[np.ndarray, pd.DataFrame]:
    """Bounds of at least ``ranges`` ranges of about equal bytes, and bytes and rows by range.

    About ``ranges * SAMPLE_PER_RANGE`` keys reach the driver, however large the table is.
    """
    share = max(1.0, total / ranges)
    rate = SAMPLE_PER_RANGE / share
    bounds = np.unique(_sample(rows, rate, 0)[SAMPLE_PER_RANGE - 1::SAMPLE_PER_RANGE])
    for salt in range(1, MAX_ROUNDS + 1):
        ranged = rows.withColumn("range", range_of("key", bounds))
        filled = ranged.groupBy("range").agg(
            F.sum("size").alias("bytes"), F.count("*").alias("rows"),
            F.min("key").alias("low"), F.max("key").alias("high")).toPandas()
        over = filled[(filled["bytes"] > OVERFULL * share) & (filled["low"] < filled["high"])]
        if over.empty or salt == MAX_ROUNDS:
            break
        inside = F.col("range").isin([int(r) for r in over["range"]])
        drawn = _sample(ranged.where(inside), rate * 2 ** salt, salt)
        step = SAMPLE_PER_RANGE * 2 ** salt // 2
        # The largest key of a range always cuts, so a round never ends without a cut.
        new = np.concatenate([drawn[step - 1::step], over["high"].to_numpy("i8")])
        bounds = np.unique(np.concatenate([bounds, new]))
    return bounds, filled.sort_values("range")


def shard(
    docs: DataFrame, shards: int = 40, id: str = "doc_id", text: str = "text", row_bytes: int = 16,
) -> DataFrame:
    """``<id>, size, text_crc32, shard, slot``; every record once.

    A record's size is the UTF-8 bytes of its text plus ``row_bytes``; a null text has none
    and a null ``text_crc32``. Shards are stretches of the order by key that hold equal
    bytes, to within a record at each end; ``slot`` counts a shard's records from 0.
    Records with equal keys stand in the order in which they were read, so equal rows each
    have a place of their own. Other columns are left out; an empty table gives no rows.
    """
    prepare_workers(docs.sparkSession)
    numbered = docs.select(
        F.col(id).alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)) + row_bytes).cast("long").alias("size"),
        F.crc32(F.col(text).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("number"), F.col(text).alias("text"))
    rows = stored(numbered.select(
        "id", "size", "text_crc32", "number", record_key(F.col("text"), F.col("number")).alias("key")), "records")
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    bounds, filled = splitters(rows, total, max(shards * RANGES_PER_SHARD, math.ceil(n / ROWS_PER_RANGE)))
    offsets = pd.DataFrame({
        "range": filled["range"].astype("int32"),
        "bytes_before": (filled["bytes"].cumsum() - filled["bytes"]).astype("int64"),
        "rows_before": (filled["rows"].cumsum() - filled["rows"]).astype("int64")})
    ahead = F.broadcast(rows.sparkSession.createDataFrame(
        offsets, "range int, bytes_before long, rows_before long"))
    in_range = Window.partitionBy("range").orderBy("key", "number")
    placed = (rows.withColumn("range", range_of("key", bounds))
              .withColumns({"upto": F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, 0)),
                            "nth": F.row_number().over(in_range)})
              .join(ahead, "range"))
    # The middle of a record decides, so a shard's end is off by half a record at most.
    middle = F.col("bytes_before") + F.col("upto") - F.col("size") / 2
    which = F.least(F.floor(middle * shards / F.lit(max(1, total))).cast("int"), F.lit(shards - 1))
    placed = stored(placed.select(
        "id", "size", "text_crc32", which.alias("shard"),
        (F.col("rows_before") + F.col("nth") - 1).alias("place")), "placed")
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id), "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot"))


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id: str = "doc_id") -> str:
    """One folder per shard with the documents in slot order; ids must be unique.

    A shard is written by several tasks, each a stretch of its slots.
    """
    rows = docs.join(placed.select(id, "shard", "slot"), id)
    parts = max(1, rows.sparkSession.sparkContext.defaultParallelism * 2)
    (rows.repartitionByRange(parts, "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
    return path
