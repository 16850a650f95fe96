"""Exact inner-product search over vectors of descending length.

Vectors are rotated to the principal axes of all of them, so that their first components
hold most of every inner product. Candidates lie in ranges of descending length, which are
gone through in waves, longest first. By the
Cauchy-Schwarz inequality a query visits only the ranges whose longest vector could still
reach its threshold; inside a range, partial sums over the first axes plus the product
of the remaining lengths discard what cannot reach it. The rest is scored in integers. After a
wave, a query's threshold is the least of its best scores so far, so later waves give
few rows, or none.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasmlens.llm.frames import prepare_workers, stored
from rasmlens.llm.sharding import SAMPLE_PER_RANGE, range_of

#: Candidates held in memory together, and the longest ones that give first thresholds.
BLOCK_ROWS, SEED_ROWS = 8192, 2048
#: Ranges of the first wave, and how many times as many the next one has.
FIRST_WAVE, WAVE_GROWTH = 2, 4
#: Queries scored together.
QUERY_ROWS = 256
#: Pairs scored together.
PAIR_ROWS = 1 << 16
#: Relative slack for the rounding of rotated sums; it only ever lets more through.
SLACK = 1e-9


def integer_vectors(rows: DataFrame, id: str, vector: str, scale: float) -> DataFrame:
    """``id, v`` with floor(scale * x) of every component; vectors that are null, empty, or
    hold a null or non-finite component are left out."""
    x = F.transform(vector, lambda c: c.cast("double"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (rows.select(F.col(id).alias("id"), x.alias("x"))
            .where(F.col("id").isNotNull() & (F.size("x") > 0) & F.coalesce(finite, F.lit(False)))
            .select("id", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v")))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors as rows of float64, shorter ones filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.values.to_numpy(zero_copy_only=False)[
        column.offsets[0].as_py():column.offsets[-1].as_py()].astype("f8")
    if (lengths == dims).all():
        return values.reshape(-1, dims)
    out = np.zeros((len(lengths), dims))
    out[np.arange(dims) < lengths[:, None]] = values
    return out


def principal_axes(vectors: DataFrame, dims: int) -> np.ndarray:
    """Orthonormal axes by descending second moment, from the summed outer products."""
    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            m = matrix(batch.column("v"), dims)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dims, dtype="i4")), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    sums = (vectors.select("v").mapInArrow(outer, "i int, row array<double>")
            .select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).collect())
    moments = np.zeros((dims, dims))
    for s in sums:
        moments[s["i"], s["j"]] = s["x"]
    return np.linalg.eigh(moments)[1][:, ::-1].copy()


def exact_scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of integer rows; float64 where no sum can leave its exact range."""
    largest = max(1.0, np.abs(queries).max(initial=0)) * max(1.0, np.abs(candidates).max(initial=0))
    if largest * queries.shape[1] < 2.0 ** 53:
        return np.einsum("ij,ij->i", queries, candidates).astype("i8")
    return np.array([sum(int(a) * int(b) for a, b in zip(q, c)) for q, c in zip(queries, candidates)], "i8")


class Block:
    """Candidates of one range, longest first, with what pruning needs."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, axes: np.ndarray):
        order = np.lexsort((ids, -np.linalg.norm(vectors, axis=1)))
        self.ids, self.vectors = ids[order], vectors[order]
        self.stages = stages(self.vectors @ axes)

    def best(self, ids: np.ndarray, vectors: np.ndarray, axes: np.ndarray, least: np.ndarray, k: int):
        """(query place, candidate id, score), sorted: up to k for each query, the best in
        this block that reach the query's ``least``."""
        rows, columns = np.arange(len(ids)), np.arange(len(self.ids))
        sums = 0.0
        open_pairs = ids[:, None] != self.ids
        for (head, rest, size), (c_head, c_rest, c_size) in zip(stages(vectors @ axes), self.stages):
            sums = sums + head[rows] @ c_head[columns].T
            reach = sums + rest[rows, None] * c_rest[columns]
            reach += SLACK * size[rows, None] * c_size[columns] + 1e-6
            open_pairs &= reach >= least[rows, None]
            some_rows, some_columns = open_pairs.any(axis=1), open_pairs.any(axis=0)
            rows, columns = rows[some_rows], columns[some_columns]
            keep = np.ix_(some_rows, some_columns)
            sums, open_pairs = sums[keep], open_pairs[keep]
        q, c = np.nonzero(open_pairs)
        q, c = rows[q], columns[c]
        score = np.concatenate([np.zeros(0, "i8"), *[
            exact_scores(vectors[q[at:at + PAIR_ROWS]], self.vectors[c[at:at + PAIR_ROWS]])
            for at in range(0, len(q), PAIR_ROWS)]])
        order = np.lexsort((self.ids[c], -score, q))
        q, c, score = q[order], c[order], score[order]
        top = np.arange(len(q)) - np.searchsorted(q, q, side="left") < k
        return q[top], self.ids[c[top]], score[top]


def stages(rotated: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(components, length of the components after them, whole length) for growing prefixes."""
    dims = rotated.shape[1]
    ends = sorted({max(1, dims // 4), max(1, dims // 2), dims})
    squares = np.square(rotated)
    size = np.sqrt(squares.sum(axis=1))
    out, start = [], 0
    for end in ends:
        out.append((np.ascontiguousarray(rotated[:, start:end]), np.sqrt(squares[:, end:].sum(axis=1)), size))
        start = end
    return out


def top_k(
    candidates: DataFrame, queries: DataFrame, k: int = 20, scale: float = 64.0,
    id: str = "vec_id", vector: str = "embedding", block_rows: int = BLOCK_ROWS, seed_rows: int = SEED_ROWS,
) -> DataFrame:
    """``query_id, rank, <id>, score``: for each query its k best candidates of other ids.

    Components are floor(scale * x), scores whole inner products; equal scores go to the
    smaller id. Vectors that are null, empty, or hold nulls or non-finite components, and
    rows without an id take no part on either side; shorter vectors count as filled up
    with zeros. Where fewer than k candidates exist all are returned. A candidate row given twice
    counts twice; a query id given twice is one query (its smallest vector). Other columns
    are left out; empty tables give no rows.

    Candidates never lie in memory in more than ``block_rows`` at once, and queries pass by
    them in batches. The broadcast block has ``seed_rows`` vectors. A wave has four times the
    ranges of the one before, so there are few waves, and what they found is stored.
    """
    spark = candidates.sparkSession
    prepare_workers(spark)
    base = integer_vectors(candidates, id, vector, scale)
    asked = (integer_vectors(queries, id, vector, scale).groupBy("id").agg(F.min("v").alias("v")))
    length2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    base = stored(base.withColumn("length", F.sqrt(length2)).withColumn(
        "number", F.monotonically_increasing_id()), "vectors")
    n, dims = base.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    n_asked, widest = asked.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    dims = max(dims, widest)
    axes = principal_axes(base, dims)
    keyed = base.withColumn("key", descending("length", "number"))
    placed = stored(keyed.withColumn("block", range_of("key", _bounds(keyed, n, block_rows))).select(
        "block", "id", "v", "length"), "placed")
    heads = sorted(placed.groupBy("block").agg(F.max("length").alias("longest")).collect(), key=lambda r: r["block"])
    longest = np.array([r["longest"] for r in heads])
    blocks = np.array([r["block"] for r in heads], "i4")

    seed = base.orderBy(F.desc("length"), "id").limit(max(seed_rows, k + 1)).select("id", "v")
    sent = spark.sparkContext.broadcast(_collected(seed, dims, axes))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query with its first threshold."""
        first = sent.value
        for batch in batches:
            ids, m = batch.column("id").to_numpy(), matrix(batch.column("v"), dims)
            least = np.full(len(ids), -np.inf)
            for at in range(0, len(ids), QUERY_ROWS):
                part = slice(at, at + QUERY_ROWS)
                q, _, score = first.best(ids[part], m[part], axes, least[part], k)
                counts = np.bincount(q, minlength=len(ids[part]))
                full = np.flatnonzero(counts == k)
                ends = np.cumsum(counts)
                least[at + full] = score[ends[full] - 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array(np.linalg.norm(m, axis=1)), pa.array(least)],
                names=["id", "v", "size", "least"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The candidates of a range come first, then its queries, batch by batch."""
        current, ids, vectors, held = None, [], [], None
        for batch in batches:
            number, side = batch.column("block").to_numpy(), batch.column("side").to_numpy()
            cuts = np.flatnonzero(np.diff(number * 2 + side)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(number)]):
                part = batch.slice(start, end - start)
                if number[start] != current:
                    current, ids, vectors, held = number[start], [], [], None
                if side[start] == 0:
                    ids.append(part.column("id").to_numpy())
                    vectors.append(matrix(part.column("v"), dims))
                    continue
                if held is None and ids:
                    held = Block(np.concatenate(ids), np.concatenate(vectors), axes)
                for at in range(0, end - start, QUERY_ROWS) if held else ():
                    some = part.slice(at, QUERY_ROWS)
                    asking = some.column("id").to_numpy()
                    q, c, score = held.best(
                        asking, matrix(some.column("v"), dims), axes, some.column("least").to_numpy(), k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(asking[q]), pa.array(c), pa.array(score)], names=["query_id", "found", "score"])

    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "found")
    # Few queries are few bytes, which would make them one task.
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(math.ceil(n_asked / QUERY_ROWS), max(shuffled, math.ceil(n_asked / (256 * QUERY_ROWS))))
    asked = stored(asked.repartition(max(1, tasks), "id").mapInArrow(
        ask, "id long, v array<long>, size double, least double"), "asked")
    best = spark.createDataFrame([], "query_id long, found long, score long, rank int")
    least, start, size = asked.select(F.col("id").alias("query_id"), "least"), 0, FIRST_WAVE
    while start < len(blocks):
        wave = slice(start, start + size)
        visits = asked.drop("least").join(least.withColumnRenamed("query_id", "id"), "id").select(
            "id", "v", "size", "least").mapInArrow(
            lambda batches, of=blocks[wave], far=longest[wave]: to_visit(batches, of, far),
            "block int, side int, id long, v array<long>, least double")
        among = F.col("block").between(int(blocks[wave][0]), int(blocks[wave][-1]))
        both = placed.where(among).select(
            "block", F.lit(0).alias("side"), "id", "v", F.lit(0.0).alias("least")).unionByName(visits)
        dealt = both.repartition(len(blocks[wave]), "block").sortWithinPartitions("block", "side")
        found = dealt.mapInArrow(visit, "query_id long, found long, score long")
        best = stored(best.drop("rank").unionByName(found).withColumn("rank", F.row_number().over(by_score)).where(
            F.col("rank") <= k), "best")
        # The k-th best score so far; a query that has fewer keeps its threshold.
        kth = best.where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("kth"))
        least = least.join(kth, "query_id", "left").select("query_id", F.greatest("least", "kth").alias("least"))
        least = stored(least, "least")
        start, size = start + size, size * WAVE_GROWTH
    return best.select("query_id", "rank", F.col("found").alias(id), "score")


def to_visit(
    batches: Iterator[pa.RecordBatch], blocks: np.ndarray, longest: np.ndarray,
) -> Iterator[pa.RecordBatch]:
    """A row for each query and range that could still reach the query's threshold."""
    for batch in batches:
        size, least = batch.column("size").to_numpy(), batch.column("least").to_numpy()
        for at in range(0, len(size), QUERY_ROWS):
            reach = size[at:at + QUERY_ROWS, None] * longest * (1 + SLACK) + 1e-6
            q, b = np.nonzero(reach >= least[at:at + QUERY_ROWS, None])
            rows = pa.array(q + at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks[b]), pa.array(np.ones(len(q), "i4")),
                 *[batch.column(c).take(rows) for c in ("id", "v", "least")]], names=["block", "side", "id", "v", "least"])


def _collected(seed: DataFrame, dims: int, axes: np.ndarray) -> Block:
    rows = seed.toArrow()
    ids = rows.column("id").to_numpy()
    column = rows.column("v").combine_chunks()
    vectors = matrix(column, dims) if len(ids) else np.zeros((0, dims))
    return Block(ids, vectors, axes)


def descending(length: str, number: str) -> Column:
    """A key below 2**62 that falls as the length grows; its low bits, a hash of the row's
    number, tell rows of one length apart."""
    @F.pandas_udf("long")
    def make(lengths: pd.Series, numbers: pd.Series) -> pd.Series:
        bits = lengths.to_numpy("f8").view("i8") >> 20
        with np.errstate(over="ignore"):
            low = (numbers.to_numpy("i8").view("u8") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(45)
        return pd.Series((((1 << 43) - 1 - bits) << 19) | low.astype("i8"))

    return make(length, number)


def _bounds(keyed: DataFrame, n: int, block_rows: int) -> np.ndarray:
    """Keys that cut the rows into ranges of about ``block_rows / 2``, from a sample of
    about ``SAMPLE_PER_RANGE`` keys for each range."""
    ranges = math.ceil(2 * n / block_rows)
    if ranges < 2:
        return np.zeros(0, "i8")
    place = F.shiftrightunsigned(F.xxhash64("number"), 11) / float(1 << 53)
    drawn = keyed.where(place < min(1.0, ranges * SAMPLE_PER_RANGE / n)).select("key").toPandas()["key"]
    return np.unique(np.sort(drawn.to_numpy("i8"))[SAMPLE_PER_RANGE - 1::SAMPLE_PER_RANGE])
