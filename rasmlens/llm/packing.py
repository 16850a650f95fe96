"""Packing by powers of two: no sequence holds more than one document.

A document of n token ids is cut into pieces of ``max_length`` ids and, for what is
left, one piece for each bit of the remainder, long pieces first. Every piece is a
sequence of its own whose length is a power of two, so batches are made of equal
lengths and nothing is padded.
"""

import base64
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rasmlens.llm.frames import prepare_workers, stored


class Encoder:
    """Token ids as little-endian unsigned 32-bit integers, by a byte-level BPE vocabulary.

    A text is encoded in one call, without Python objects for its words or ids. Texts
    that spell the vocabulary's special token, which the full tokenizer reads as that one
    id, go to the full tokenizer.
    """

    SPECIAL = "<|endoftext|>"

    def __init__(self, name: str):
        import public_tokenizers
        import tiktoken
        ranks_file = public_tokenizers.path(f"{name}.tiktoken")
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
            special_tokens={}).encode_to_numpy
        self.full_path = public_tokenizers.path(f"{name}.json")

    def __call__(self, text: str) -> bytes:
        if self.SPECIAL in text:
            from tokenizers import Tokenizer
            full = Tokenizer.from_file(self.full_path)
            return np.array(full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.plain(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    return Encoder(name)


def binary_lengths(n: int, longest: int) -> list[int]:
    """Descending powers of two that sum to n, ``longest`` as often as it fits."""
    rest = n % longest
    return [longest] * (n // longest) + [
        1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]


def pack(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k",
    max_length: int = 1024,
    end_id: int = 0,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: ``<id>, start, length, doc_tokens, sequence_id, offset, nth, tokens``.

    ``tokens`` holds the ids as little-endian unsigned 32-bit integers; ``end_id`` closes
    each document. ``max_length`` is a power of two. A null or empty text is a document
    of ``end_id`` alone; a null id stays null; equal rows are packed each for itself;
    other columns are not looked at; an empty table gives no rows. One pass without a
    shuffle. ``sequence_id`` comes from the row's place in its partition, so keep the
    result by writing it. ``nth`` counts the partition's pieces of one length; ``in_buckets`` makes
    of it a place among all.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    prepare_workers(docs.sparkSession)
    chosen = docs.select(F.col(id).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    kind = chosen.schema["id"].dataType
    out = T.StructType([
        T.StructField("id", kind), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("nth", T.LongType()),
        T.StructField("tokens", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        seen: Counter[int] = Counter()
        for batch in batches:
            places, starts, lengths, totals, order, tokens = [], [], [], [], [], []
            for place, value in enumerate(batch.column("text")):
                ids = encode(value.as_py()) + end
                start, total = 0, len(ids) // 4
                for length in binary_lengths(total, max_length):
                    places.append(place)
                    starts.append(start)
                    lengths.append(length)
                    totals.append(total)
                    order.append(seen[length])
                    seen[length] += 1
                    tokens.append(ids[4 * start:4 * (start + length)])
                    start += length
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(places, pa.int64())),
                 pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.array(totals, pa.int64()), pa.array(order, pa.int64()), pa.array(tokens, pa.binary())],
                names=["id", "start", "length", "doc_tokens", "nth", "tokens"])

    return chosen.mapInArrow(cut, out).select(
        F.col("id").alias(id), "start", "length", "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), "nth", "tokens")


def in_buckets(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``bucket``, the binary logarithm of the length, and ``place``, gapless from 0 in each
    bucket, in place of ``nth``: so many places after one another are a batch of equal lengths.

    The pieces are written as they come. What is put in order is how many of each length
    a partition has. That is at most one row for each of the lengths and partitions, far fewer
    than the pieces, so it is broadcast and the pieces stay where they are.
    """
    kept = stored(pieces, "pieces").withColumn("part", F.shiftright("sequence_id", 33))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept.groupBy("length", "part").agg(F.count("*").alias("n")).select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start_place"))
    return kept.join(F.broadcast(starts), ["length", "part"]).select(
        *[c for c in pieces.columns if c != "nth"], F.log2("length").cast("int").alias("bucket"),
        (F.col("start_place") + F.col("nth")).alias("place"))


def write_buckets(pieces: DataFrame, path: str) -> str:
    """One folder per length. The hint lets a length that holds most of the pieces be
    written by many tasks."""
    pieces.hint("rebalance", "length").write.partitionBy("length").parquet(path)
    return path
