"""Near-duplicate texts by SimHash, found with Golay-code fuzzy keys.

A 64-bit fingerprint is cut into three segments. Two fingerprints that differ in at most
four bits either agree in a whole segment, and then differ in at most two bits of another
one, or differ in exactly one bit in each of two segments. The Golay code turns both cases
into equal keys (see ``golay``), so candidates meet in a shuffle by key, and every
candidate pair is verified on the whole fingerprint. Equal fingerprints are merged first.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rasmlens.llm import golay
from rasmlens.llm.components import components
from rasmlens.llm.frames import digest, prepare_workers, stored

MAX_BITS = 4
#: Widths of the segments, low bits first; none may exceed the code's length.
WIDTHS = (22, 21, 21)
PAIRS = ((0, 1), (0, 2), (1, 2))
#: Fingerprints of one key that a task holds. More of them are linked another way.
MOST_HELD = 20_000
#: Runs of at most so many fingerprints are compared by shifting the whole batch.
SHORT_RUN = 8
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: str | None, window: int) -> np.ndarray:
    """XXH64 (seed 42) of all shingles, repeats included; of the whole sequence where it has
    fewer words; none for a text without words."""
    from xxhash import xxh64_intdigest
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(0, len(words) - window)
    return np.array([xxh64_intdigest(joined[a:b], 42) for a, b in zip(
        starts[:last + 1].tolist(), ends[min(window, len(words)) - 1:].tolist())], "<u8")


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half the hashes."""
    ones = np.zeros(64, "i8")
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)]
        ones += np.unpackbits(part.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="i8")
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, window: int = 4) -> int:
    """SimHash over all shingles; 0 for a text without words."""
    return majority(shingle_hashes(text, window))


def fingerprints(docs: DataFrame, keep: list[Column], text: str = "text", window: int = 4) -> DataFrame:
    """Columns ``keep`` and ``fp``, the fingerprint as a signed long."""
    prepare_workers(docs.sparkSession)
    chosen = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"))
    out = T.StructType([chosen.schema["row"], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), window) for t in batch.column("text")], "u8")
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(prints.view("i8"))], names=["row", "fp"])

    return chosen.mapInArrow(run, out).select("row.*", "fp")


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, key) of all keys of unsigned fingerprints.

    Where two segments differ in one bit each, both parities differ. So for each pair of
    segments the words of even parity in the first are filed under their nearest codewords only,
    and those of odd parity look under all of theirs; whether both parities agree is part of
    the key. Where a segment agrees, its bits and the key of another segment are the key.
    """
    segments, shift = [], 0
    for width in WIDTHS:
        segments.append((prints >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype("u4"))
        shift += width
    coded = [golay.keys(s) for s in segments]
    parity = [np.bitwise_count(s) & 1 for s in segments]
    places, found = [], []

    def add(chosen: np.ndarray, key: np.ndarray, tag: int) -> None:
        places.append(chosen)
        found.append(key.astype("i8") | np.int64(tag) << np.int64(40))

    slots = np.arange(golay.MOST_KEYS)
    for tag, (i, j) in enumerate(PAIRS):
        (first, n_first), (second, n_second) = coded[i], coded[j]
        mixed = (parity[i] ^ parity[j]).astype("i8") << np.int64(24)
        both = lambda a, b: a.astype("i8") << np.int64(12) | b.astype("i8")
        even = np.flatnonzero(parity[i] == 0)
        add(even, both(first[even, 0], second[even, 0]) | mixed[even], tag)
        odd = np.flatnonzero(parity[i] == 1)
        p, a, b = np.nonzero((slots < n_first[odd, None])[:, :, None] & (slots < n_second[odd, None])[:, None, :])
        p = odd[p]
        add(p, both(first[p, a], second[p, b]) | mixed[p], tag)
    for i in range(3):
        for j in range(3):
            if i != j:
                codes, n = coded[j]
                p, a = np.nonzero(slots < n[:, None])
                add(p, segments[i][p].astype("i8") << np.int64(12) | codes[p, a].astype("i8"), 4 + 3 * i + j)
    return np.concatenate(places), np.concatenate(found)


def linked(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one ^ other) <= MAX_BITS


def spanning_links(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever the links between these fingerprints connect."""
    ends_a, ends_b = [], []
    left = prints
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = linked(left, at)
            if near.any():
                ends_a.append(np.full(int(near.sum()), at))
                ends_b.append(left[near])
                queue.extend(left[near])
                left = left[~near]
    none = np.zeros(0, prints.dtype)
    return np.concatenate([none, *ends_a]), np.concatenate([none, *ends_b])


def _links_of_runs(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Verified links within the runs of equal keys."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    ends_a, ends_b = [np.zeros(0, "u8")], [np.zeros(0, "u8")]
    short = np.repeat((sizes > 1) & (sizes <= SHORT_RUN), sizes)
    some, of = prints[short], keys[short]
    for step in range(1, SHORT_RUN):
        a, b = some[:-step], some[step:]
        near = (of[:-step] == of[step:]) & linked(a, b)
        ends_a.append(a[near])
        ends_b.append(b[near])
        if not (of[:-step] == of[step:]).any():
            break
    for start, size in zip(starts[sizes > SHORT_RUN].tolist(), sizes[sizes > SHORT_RUN].tolist()):
        a, b = spanning_links(np.unique(prints[start:start + size]))
        ends_a.append(a)
        ends_b.append(b)
    return np.concatenate(ends_a), np.concatenate(ends_b)


def candidate_links(distinct: DataFrame, most_held: int = MOST_HELD) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column fp), enough to connect whatever is
    linked; pairs of a null ``b`` name fingerprints of a key with more than ``most_held``."""
    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("fp").to_numpy()
            for at in range(0, len(prints), 2000):
                part = prints[at:at + 2000]
                place, key = fuzzy_keys(part.view("u8"))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[place])], names=["key", "fp"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; the last key of a batch may go on in the next."""
        held_keys, held = np.zeros(0, "i8"), np.zeros(0, "u8")
        crowded = None  # the key whose fingerprints are passed on

        def links(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
            other = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view("i8"))
            return pa.RecordBatch.from_arrays([pa.array(a.view("i8")), other], names=["a", "b"])

        for batch in batches:
            keys = np.concatenate([held_keys, batch.column("key").to_numpy()])
            prints = np.concatenate([held, batch.column("fp").to_numpy().view("u8")])
            if crowded is not None:
                n = int(np.searchsorted(keys, crowded, side="right"))
                if n:
                    yield links(prints[:n], None)
                keys, prints = keys[n:], prints[n:]
                if not len(keys):
                    held_keys, held = keys, prints
                    continue
                crowded = None
            last = int(np.searchsorted(keys, keys[-1], side="left")) if len(keys) else 0
            if last:
                yield links(*_links_of_runs(keys[:last], prints[:last]))
            held_keys, held = keys[last:], prints[last:]
            if len(held) > most_held:
                crowded = held_keys[0]
                yield links(held, None)
                held_keys, held = held_keys[:0], held[:0]
        if len(held) > 1:
            yield links(*_links_of_runs(held_keys, held))

    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A fingerprint becomes some 76 rows, so few of them already make work for many tasks.
    keyed = distinct.repartition(parts, "fp").mapInArrow(file, "key long, fp long")
    return (keyed.repartition(parts, "key").sortWithinPartitions("key")
            .mapInArrow(meet, "a long, b long"))


def crowded_links(prints: DataFrame) -> DataFrame:
    """``a, b`` for fingerprints (column fp) of crowded keys, without pairs.

    Two fingerprints differ in at most four bits if and only if some word is within two bits of
    both. Each is filed under its 2,081 words within two bits and linked with the
    smallest fingerprint of every word.
    """
    flips = [0, *[1 << i for i in range(64)], *[1 << i | 1 << j for i in range(64) for j in range(i)]]

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = np.array(flips, "u8")
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                some = batch.column("fp").to_numpy()[at:at + 100].view("u8")
                words = (some[:, None] ^ masks).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.view("i8")), pa.array(np.repeat(some, len(masks)).view("i8"))],
                    names=["word", "fp"])

    filed = prints.mapInArrow(around, "word long, fp long")
    shared = filed.groupBy("word").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a <> b")
    return filed.join(shared.select("word", "a"), "word").where("a <> fp").select("a", F.col("fp").alias("b"))


def groups(prints: DataFrame, most_held: int = MOST_HELD) -> DataFrame:
    """``fp, root`` for the fingerprints that are linked with another one."""
    distinct = stored(prints.select("fp").distinct(), "distinct")
    found = stored(candidate_links(distinct, most_held).distinct(), "candidates")
    links = found.where("b is not null")
    crowded = found.where("b is null").select(F.col("a").alias("fp")).distinct()
    if not crowded.isEmpty():
        links = links.unionByName(crowded_links(crowded))
    return components(links).select(F.col("node").alias("fp"), "root")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 4, most_held: int = MOST_HELD,
) -> DataFrame:
    """``<id>, fingerprint, component_id`` for every row.

    ``fingerprint`` has 16 hex digits; ``component_id`` is the smallest id that can be reached
    over links of at most four differing bits. A null or empty text has fingerprint 0 and
    is linked like any other; rows without an id count, but give a component no name (one of
    such rows only has a null ``component_id``). Equal rows stay. Other columns are left
    out; an empty table gives no rows. No pairs are written out for equal fingerprints.
    """
    rows = stored(fingerprints(docs, [F.col(id).alias("id")], text, window), "fingerprints")
    named = _named(rows, F.col("id"), most_held)
    return rows.join(named, "fp").select(
        F.col("id").alias(id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("name").alias("component_id"))


def _named(rows: DataFrame, name: Column, most_held: int) -> DataFrame:
    """``fp, name``: for every fingerprint the smallest name in its component."""
    first = stored(rows.groupBy("fp").agg(F.min(name).alias("first")), "firsts")
    linked_prints = groups(first, most_held)
    of = first.join(linked_prints, "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = of.groupBy("root").agg(F.min("first").alias("name"))
    return stored(of.select("fp", "root").join(least, "root").select("fp", "name"), "named")


def drop_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 4, most_held: int = MOST_HELD,
) -> DataFrame:
    """``docs`` with all columns and one row of each component of ``near_duplicates``: that of the
    smallest id (rows without an id come last), of equal ids that of the smallest text hash.

    Texts without words, null ones too, have fingerprint 0 and are one group with whatever is
    linked to it. Of equal rows one stays; an empty table gives an empty one; columns keep
    their names, whatever they are.
    """
    h1, h2 = digest(F.col(text))
    key = F.struct(F.col(id).isNull().alias("no_id"), F.col(id).alias("id"), h1.alias("h1"), h2.alias("h2"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    rows = stored(fingerprints(docs, [key.alias("key")], text, window), "fingerprints")
    kept = _named(rows, F.col("key"), most_held).select(F.col("name").alias("kept")).distinct()
    once = Window.partitionBy("key").orderBy(F.lit(1))
    return (whole.join(kept, F.col("key") == F.col("kept"), "left_semi")
            .withColumn("nth", F.row_number().over(once)).where("nth = 1").select("row.*"))
