"""URL filters: host rules, and exact list membership by a cascade of Bloom filters.

The first filter of a cascade holds the listed keys; the second holds the unlisted keys
of the corpus that the first one lets through; the third holds the listed keys that the
second one lets through, and so on until nothing is let through. Walking the levels up to
the first filter that misses a key is then exact for every key of the corpus.
Keys are split into shards by hash, each with a small cascade of its own.
"""

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rasmlens.llm.frames import digest, prepare_workers, stored

KEYS_PER_SHARD = 1 << 18
#: Cascades of no more bytes are broadcast.
BROADCAST_BYTES = 64 << 20
#: Tasks among which the rows of one shard are dealt out.
SALTS = 8
MAX_LEVELS = 200

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty for a null url or one without ://."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))
    return F.translate(host, UPPER, LOWER), path


@dataclass(frozen=True)
class Rule:
    """Holds for ``host`` and its subdomains where the path starts with ``prefix``."""

    host: str
    prefix: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.prefix

    def fits(self, host: Column, path: Column) -> Column:
        inside = (host == self.host) | host.endswith(f".{self.host}")
        return inside & path.startswith(self.prefix)


def longest_rule(rules: Iterable[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or nulls."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = rule.fits(host, path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, count: int, bits: int) -> np.ndarray:
    """``count`` bit positions per key, different ones in each level."""
    x = h1 ^ (np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1) & np.uint64(0xFFFFFFFFFFFFFFFF))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    step = h2 | np.uint64(1)
    return (x[:, None] + np.arange(count, dtype="u8") * step[:, None]) % np.uint64(bits)


@dataclass(frozen=True)
class Level:
    count: int
    bits: int
    field: np.ndarray

    @staticmethod
    def of(h1: np.ndarray, h2: np.ndarray, level: int, rate: float) -> "Level":
        per_key = max(1.0, -math.log2(rate))
        bits = max(8, math.ceil(len(h1) * per_key / math.log(2)))
        count = max(1, round(per_key))
        marks = np.zeros(bits, bool)
        marks[_positions(h1, h2, level, count, bits).astype("i8").ravel()] = True
        return Level(count, bits, np.packbits(marks))

    def holds(self, h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
        at = _positions(h1, h2, level, self.count, self.bits).astype("i8")
        return ((self.field[at >> 3] >> (7 - (at & 7)).astype("u1")) & 1).all(axis=1)


def build_levels(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> list[Level]:
    """Levels until no key of the other side is let through."""
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    levels: list[Level] = []
    with np.errstate(over="ignore"):
        while len(inside):
            n = len(levels)
            if n == MAX_LEVELS:
                raise ValueError("a listed and an unlisted key have the same 128-bit hash")
            rate = 0.5 if n else min(0.5, len(inside) / (math.sqrt(2) * max(1, len(outside))))
            levels.append(Level.of(h1[inside], h2[inside], n, rate))
            through = outside[levels[-1].holds(h1[outside], h2[outside], n)]
            inside, outside = through, inside
    return levels


def walk(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether each key is listed: the number of filters passed is odd."""
    passed, left = np.zeros(len(h1), "i8"), np.arange(len(h1))
    with np.errstate(over="ignore"):
        for n, level in enumerate(levels):
            left = left[level.holds(h1[left], h2[left], n)]
            passed[left] += 1
    return passed % 2 == 1


def pack_levels(levels: list[Level]) -> bytes:
    head = np.array([len(levels), *[x for lv in levels for x in (lv.count, lv.bits)]], "<i8")
    return head.tobytes() + b"".join(lv.field.tobytes() for lv in levels)


def unpack_levels(blob: bytes) -> list[Level]:
    n = int(np.frombuffer(blob, "<i8", 1)[0])
    head = np.frombuffer(blob, "<i8", 2 * n, 8).reshape(n, 2)
    levels, at = [], 8 + 16 * n
    for count, bits in head.tolist():
        size = (bits + 7) // 8
        levels.append(Level(count, bits, np.frombuffer(blob, "u1", size, at)))
        at += size
    return levels


class Cascade:
    """Cascades of all shards, stored as rows (shard, blob)."""

    def __init__(self, filters: DataFrame, shards: int, broadcast_bytes: int = BROADCAST_BYTES):
        self.filters, self.shards, self.broadcast_bytes = filters, shards, broadcast_bytes

    @staticmethod
    def build(
        listed: DataFrame, universe: DataFrame, key: str = "key",
        keys_per_shard: int = KEYS_PER_SHARD, broadcast_bytes: int = BROADCAST_BYTES,
    ) -> "Cascade":
        """Exact for every key of ``universe``; null keys are ignored, repeats count once.

        Distinct keys are dealt out by hash to shards of about ``keys_per_shard``, so no
        group is larger than that, however often one key occurs.
        """
        prepare_workers(universe.sparkSession)
        h1, h2 = digest(F.col(key))
        rows = universe.select(h1.alias("h1"), h2.alias("h2"), F.lit(0).alias("l"), F.lit(1).alias("u")
                               ).where(F.col(key).isNotNull())
        rows = rows.unionByName(listed.where(F.col(key).isNotNull()).select(
            h1.alias("h1"), h2.alias("h2"), F.lit(1).alias("l"), F.lit(0).alias("u")))
        keys = stored(rows.groupBy("h1", "h2").agg(F.max("l").alias("l"), F.max("u").alias("u"))
                      .where("u = 1").select("h1", "h2", (F.col("l") == 1).alias("listed")), "urlkeys")
        shards = max(1, math.ceil(keys.count() / keys_per_shard))

        def build(group: pd.DataFrame) -> pd.DataFrame:
            as_hash = lambda c: group[c].to_numpy("i8").view("u8")
            levels = build_levels(as_hash("h1"), as_hash("h2"), group["listed"].to_numpy(bool))
            return pd.DataFrame({"shard": [group["shard"].iloc[0]], "blob": [pack_levels(levels)]})

        filters = (keys.withColumn("shard", shard_of(F.col("h2"), shards)).groupBy("shard")
                   .applyInPandas(build, "shard int, blob binary"))
        return Cascade(stored(filters, "cascade"), shards, broadcast_bytes)

    def mark(self, rows: DataFrame, key: str = "key", name: str = "listed") -> DataFrame:
        """Add ``name``: whether the row's key is listed (false for a null key).

        Cascades that have at most ``broadcast_bytes`` together are broadcast, and rows stay where they
        are. Larger ones stay in the shared folder's table and go to tasks shard by shard, with
        the rows of that shard; the driver sees none of them. A shard's rows are dealt out to
        ``SALTS`` tasks, as one key may have many.
        """
        prepare_workers(rows.sparkSession)
        known = F.col(key).isNotNull()
        h1, h2 = digest(F.col(key))
        size = self.filters.agg(F.sum(F.length("blob"))).first()[0] or 0
        if size <= self.broadcast_bytes:
            blobs = {r["shard"]: r["blob"] for r in self.filters.collect()}
            sent = rows.sparkSession.sparkContext.broadcast(blobs)
            return rows.withColumn(name, F.coalesce(
                _lookup(sent)(h1, h2, shard_of(h2, self.shards)) & known, F.lit(False)))
        place = shard_of(h2, self.shards) * SALTS + F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
        asked = rows.select(
            place.alias("place"), F.lit(1).alias("side"), h1.alias("h1"), h2.alias("h2"), known.alias("known"),
            F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
        copies = self.filters.select(
            F.explode(F.sequence(F.col("shard") * SALTS, F.col("shard") * SALTS + (SALTS - 1))).alias("place"),
            F.lit(0).alias("side"), "blob")
        dealt = (asked.unionByName(copies, allowMissingColumns=True)
                 .repartition(self.shards * SALTS, "place").sortWithinPartitions("place", "side"))
        out = T.StructType([dealt.schema["row"], T.StructField("listed", T.BooleanType())])

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """A place's cascade comes first, then its rows; a place without listed keys has none."""
            current, levels = None, []
            for batch in batches:
                of, side = batch.column("place").to_numpy(), batch.column("side").to_numpy()
                cuts = np.flatnonzero(np.diff(of.astype("i8") * 2 + side)) + 1
                for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(of)]):
                    part = batch.slice(start, end - start)
                    if of[start] != current:
                        current, levels = of[start], []
                    if side[start] == 0:
                        levels = unpack_levels(part.column("blob")[0].as_py())
                        continue
                    h1, h2 = (part.column(c).to_numpy(zero_copy_only=False).astype("i8").view("u8") for c in ("h1", "h2"))
                    found = walk(levels, h1, h2) & part.column("known").to_numpy(zero_copy_only=False).astype(bool)
                    yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(found)], names=["row", "listed"])

        return dealt.mapInArrow(look_up, out).select("row.*", F.col("listed").alias(name))


def shard_of(h2: Column, shards: int) -> Column:
    return F.pmod(F.shiftrightunsigned(h2, 20), F.lit(shards)).cast("int")


def _lookup(sent):
    opened: dict[int, list[Level]] = {}

    @F.pandas_udf("boolean")
    def listed(h1: pd.Series, h2: pd.Series, shard: pd.Series) -> pd.Series:
        answer = np.zeros(len(h1), bool)
        a, b, of = h1.to_numpy("i8").view("u8"), h2.to_numpy("i8").view("u8"), shard.to_numpy()
        for one in np.unique(of).tolist():
            if one not in opened and one in sent.value:
                opened[one] = unpack_levels(sent.value[one])
            if one in opened:
                here = np.flatnonzero(of == one)
                answer[here] = walk(opened[one], a[here], b[here])
        return pd.Series(answer)

    return listed


def judge_urls(
    pages: DataFrame, rules: Iterable[Rule], listed: DataFrame, id: str = "page_id",
    url: str = "url", key: str = "key", **sizes: int,
) -> DataFrame:
    """``<id>, host, path, rule, verdict`` for every page.

    The longest rule that fits decides; without one, ``block`` if host and path together
    are among the ``listed`` keys, else ``allow``. Null urls have an empty host and path.
    Equal rows stay, other columns are left out, an empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    parts = pages.select(F.col(id).alias("id"), F.col(url).alias("url")).select(
        "id", host.alias("host"), path.alias("path"))
    keyed = parts.withColumn("key", F.concat("host", "path"))
    cascade = Cascade.build(listed.select(F.col(key).alias("key")), keyed, "key", **sizes)
    name, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return cascade.mark(keyed, "key").select(
        F.col("id").alias(id), "host", "path", name.alias("rule"),
        F.coalesce(verdict, by_list).alias("verdict"))
