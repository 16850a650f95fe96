"""Quality rules whose thresholds follow the corpus.

Each measure's distribution is kept per language and source as a sketch of logarithmic
buckets, whose counts add up when sketches are merged: a quantile read from it is off by
at most ``ACCURACY`` of its value, in whatever order the parts came together. Fences
drawn from its quantiles take the place of fixed cutoffs.

A fence lies a number of spreads from the median, on a logarithmic scale. A measure that is
0 for a tenth of a group or more has no such median. What one occurrence amounts to, 1 in so many words,
does: its fence says which values are still few occurrences for a text of this group, and
the other values within it draw the measure's own fence, if that is the further one. So values
that stand apart from all others draw nothing, however many they are.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rasmlens.llm.frames import prepare_workers, stored

ACCURACY = 0.01
#: Values below this count as zero.
LEAST = 1e-6
#: Bucket of values that count as zero.
ZERO = -10_000
#: Quantiles of which the spread is read, and how far apart the outer and the inner two are in
#: standard deviations of a normal distribution.
AT = {"q10": 0.1, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q90": 0.9}
OUTER, INNER = 2.563, 1.349
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window of ``window`` words found at least twice."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), "i8", len(words))
    code = ids[:n]
    for k in range(1, window):
        if len(number) ** (k + 1) >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
        code = code * len(number) + ids[k:n + k]
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k:n + k] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one text."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode()
    words = raw.split()  # bytes split at ASCII white space, which is x20 and x09-x0D
    blank = sum(map(raw.count, (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c")))
    lines = [line for line in raw.split(b"\n") if not (not line or line.isspace())]
    return (len(words), len(text) - blank, sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def with_counts(docs: DataFrame, id: str, text: str, groups: tuple[str, ...]) -> DataFrame:
    """``id, g0, g1, ...`` and the counts of every whole text."""
    prepare_workers(docs.sparkSession)
    keys = [F.col(g).cast("string").alias(f"g{i}") for i, g in enumerate(groups)]
    chosen = docs.select(F.col(id).alias("id"), *keys, F.col(text).alias("text"))
    out = T.StructType([f for f in chosen.schema.fields if f.name != "text"]
                       + [T.StructField(c, T.LongType()) for c in COUNTS])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([measure(t.as_py()) for t in batch.column("text")], "i8").reshape(-1, len(COUNTS))
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], *[pa.array(found[:, i]) for i in range(len(COUNTS))]],
                names=[*kept, *COUNTS])

    return chosen.mapInArrow(count, out)


def _measures() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {"word_length": F.col("word_chars") / words, "symbols": F.col("n_symbols") / words,
            "dup_lines": F.col("n_dup_lines") / words, "repeats": F.col("n_repeat_words") / words}


#: The measure that no document is judged by: one occurrence in the text's words.
ONE = "one"


def _bucket(value: Column) -> Column:
    return F.when(value < LEAST, F.lit(ZERO)).otherwise(F.ceil(F.log(value) / math.log(GAMMA)).cast("int"))


def _value(bucket: Column) -> Column:
    return F.when(bucket == ZERO, F.lit(0.0)).otherwise(2 * F.pow(F.lit(GAMMA), bucket.cast("double")) / (GAMMA + 1))


def sketch(rows: DataFrame, groups: list[str]) -> DataFrame:
    """``groups, measure, bucket, n``; adding up ``n`` merges sketches.

    A measure spans fewer than 2,000 buckets, so that is what a group holds at most. Rows of a group
    with the same counts, copies above all, are one entry.
    """
    one = 1 / F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    entries = F.explode(F.array(*[
        F.struct(F.lit(name).alias("measure"), _bucket(value).alias("bucket"))
        for name, value in [*_measures().items(), (ONE, one)]]))
    return (rows.select(*groups, *COUNTS).distinct().select(*groups, entries.alias("e")).select(*groups, "e.*")
            .groupBy(*groups, "measure", "bucket").agg(F.count("*").alias("n")))


def quantiles(sketches: DataFrame, groups: list[str], at: dict[str, float]) -> DataFrame:
    """``groups, measure, total`` and one column for each entry of ``at``."""
    by = Window.partitionBy(*groups, "measure")
    counted = sketches.withColumns({
        "below": F.sum("n").over(by.orderBy("bucket")), "total": F.sum("n").over(by)})
    return counted.groupBy(*groups, "measure", "total").agg(*[
        _value(F.min(F.when(F.col("below") >= F.ceil(F.col("total") * q), F.col("bucket")))).alias(name)
        for name, q in at.items()])


def _spread() -> Column:
    """Of ``AT``'s quantiles, as a factor's logarithm. Copies in the middle make the inner quantiles meet
    and leave the outer ones apart; outliers at the ends do the opposite."""
    return F.greatest((F.log("q75") - F.log("q25")) / INNER, (F.log("q90") - F.log("q10")) / OUTER)


def _key(groups: list[str], level: int) -> Column:
    """The first ``level`` keys as one value, the others null; nulls in it are equal to each other."""
    return F.struct(F.lit(level).alias("level"), *[
        (F.col(g) if i < level else F.lit(None).cast("string")).alias(g) for i, g in enumerate(groups)])


def drawn(sketches: DataFrame, reach: float) -> DataFrame:
    """``key, total, f`` for sketches ``key, measure, bucket, n``; ``f`` has ``low`` and ``high`` by measure.

    A measure whose quantiles are all in one bucket has no spread to draw fences from, and no entry.
    """
    whole = quantiles(sketches, ["key"], AT).withColumn("spread", _spread())
    whole = whole.withColumn("spread", F.when(F.col("spread") > math.log(GAMMA), F.col("spread")))
    far = lambda sign: F.col("q50") * F.exp(sign * reach * F.col("spread"))
    few = whole.where(F.col("measure") == ONE).select("key", far(1).alias("few"))
    near = sketches.join(few, "key").where(
        (F.col("bucket") != ZERO) & (_value(F.col("bucket")) <= F.col("few"))).drop("few")
    own = quantiles(near, ["key"], AT).withColumn("spread", _spread()).select(
        "key", "measure", far(1).alias("own"))
    both = whole.where(F.col("measure") != ONE).join(few, "key").join(own, ["key", "measure"], "left")
    usual = F.col("q10") > 0
    # A bucket's width further out: values are known by their buckets only.
    fence = F.when(usual, F.struct((far(-1) / GAMMA).alias("low"), (far(1) * GAMMA).alias("high"))).otherwise(
        F.struct(F.lit(0.0).alias("low"), (F.greatest("few", "own") * GAMMA).alias("high")))
    return both.select("key", "measure", "total", F.when(fence["high"].isNotNull(), fence).alias("fence")).groupBy("key").agg(
        F.max("total").alias("total"),
        F.map_from_entries(F.collect_list(F.struct("measure", "fence"))).alias("f"))


def fences(rows: DataFrame, groups: list[str], reach: float, min_rows: int) -> DataFrame:
    """``key`` (all of ``groups``) and one column ``<measure>`` with ``low`` and ``high`` for each group.

    Where a group has fewer than ``min_rows`` different rows, or a measure no spread, the fence is that of the
    group without its last key, for which its sketch has been merged with those of its
    neighbours, and so on; null if not even all documents have a spread.
    """
    base = stored(sketch(rows, groups), "sketches")
    levels = range(len(groups), -1, -1)
    # The sketches of all levels are merged, and their fences drawn, in one go.
    merged = base.select(F.explode(F.array(*[_key(groups, level) for level in levels])).alias("key"), "measure", "bucket", "n"
                         ).groupBy("key", "measure", "bucket").agg(F.sum("n").alias("n"))
    found = stored(drawn(stored(merged, "merged"), reach).where(
        (F.col("total") >= min_rows) | (F.col("key.level") == 0)), "fences")
    out = base.select(*groups).distinct()
    for level in levels:
        parent = found.where(F.col("key.level") == level).select(F.col("key").alias(f"key_{level}"), F.col("f").alias(f"f_{level}"))
        out = out.join(parent, _key(groups, level) == F.col(f"key_{level}"), "left")
    return stored(out.select(_key(groups, len(groups)).alias("key"), *[
        F.coalesce(*[F.col(f"f_{level}")[name] for level in levels]).alias(name) for name in _measures()]), "chosen")


def judge(
    docs: DataFrame, id: str = "doc_id", text: str = "text", groups: tuple[str, ...] = ("lang", "source"),
    reach: float = 4.5, min_rows: int = 100, min_words: int = 50, max_repeat_percent: int = 50,
) -> DataFrame:
    """``<id>``, the counts, ``base_failed`` and ``kept`` for every document.

    The base rules fail a document of fewer than ``min_words`` words or with more than
    ``max_repeat_percent`` of them in repeated windows. The others, all of them, draw the fences
    of their group, ``reach`` spreads from the median; a document outside a fence is not kept. A null text has no words; a
    null language or source is a group like any other; equal rows are judged alike; other
    columns are left out; an empty table gives no rows.
    """
    rows = stored(with_counts(docs, id, text, groups), "counts")
    keys = [f"g{i}" for i in range(len(groups))]
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    limits = fences(rows.where(~failed), keys, reach, min_rows)
    inside = F.lit(True)
    for name, value in _measures().items():
        inside = inside & F.coalesce(value.between(F.col(f"{name}.low"), F.col(f"{name}.high")), F.lit(True))
    return rows.join(limits, _key(keys, len(keys)) == F.col("key"), "left").select(
        F.col("id").alias(id), *COUNTS, failed.alias("base_failed"), (~failed & inside).alias("kept"))
