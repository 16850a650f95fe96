"""Document fingerprints by a threshold-scaled sketch.

A text's sketch is every hash of its word shingles that lies below a fixed fraction of the
hash range. Whether a shingle is kept depends on the shingle alone, so the sketch of
several texts together is the union of their sketches, and a sketch grows with
its text: how much of a short text stands in a very long one can be read from the two
sketches, which fixed-size sketches cannot tell. Native: built-in functions only.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasmlens.llm.frames import WORD, stored

#: Words in a shingle.
SHINGLE = 5
#: Hex digits of a shingle's hash that a sketch keeps.
DIGITS = 16
#: Hashes that begin below this hex digit are kept: with 2, one in eight.
BELOW = "2"
#: Low binary digits of an id that its block leaves out.
BLOCK_BITS = 8


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def shingle_hashes(text: Column) -> Column:
    """MD5 of every shingle, as hex; of the whole sequence where it has fewer words."""
    def hashes(found: Column) -> Column:
        last = F.greatest(F.size(found) - (SHINGLE - 1), F.lit(1))
        return F.transform(F.sequence(F.lit(1), last), lambda i: F.md5(
            F.array_join(F.slice(found, i, F.lit(SHINGLE)), " ").cast("binary")))
    # The one-element array makes the words once, for all shingles.
    return F.flatten(F.transform(F.array(words(text)), hashes))


def sketch(text: Column) -> Column:
    """The kept hashes, in ascending order, each once."""
    kept = F.filter(shingle_hashes(text), lambda h: h < BELOW)
    return F.array_sort(F.array_distinct(F.transform(kept, lambda h: F.substring(h, 1, DIGITS))))


def merge(one: Column, other: Column) -> Column:
    """The sketch of two texts' shingles together."""
    return F.array_sort(F.array_union(one, other))


def containment(one: Column, other: Column) -> Column:
    """Estimated share of the first text's shingles that the second one has; null where the
    first sketch is empty."""
    return F.size(F.array_intersect(one, other)) / F.nullif(F.size(one), F.lit(0))


def as_string(kept: Column, text: Column) -> Column:
    """The sketch's hashes one after the other. A text of which none was kept is named by a
    dash and the hash of its whole word sequence, which only equal sequences share."""
    whole = F.md5(F.array_join(words(text), " ").cast("binary"))
    return F.when(F.size(kept) > 0, F.array_join(kept, "")).otherwise(
        F.concat(F.lit("-"), F.substring(whole, 1, DIGITS)))


def likeness(one: Column, other: Column) -> Column:
    """0 to 1: how much of the shorter text stands in the longer one; ``one`` and ``other`` are
    structs of ``kept`` and ``print``. Equal fingerprints have 1, others of which one has kept
    no hash have 0."""
    shared = F.size(F.array_intersect(one["kept"], other["kept"]))
    least = F.least(F.size(one["kept"]), F.size(other["kept"]))
    return F.when(one["print"] == other["print"], F.lit(1.0)).when(least == 0, F.lit(0.0)).otherwise(shared / least)


def following(blocks: DataFrame) -> DataFrame:
    """``block, before``: for each of the distinct ``block``s the next larger one, and for the
    largest the smallest. Blocks are dealt out by ranges; a range knows its own order, and
    where one ends the ranges' ends, a row for each, say how it goes on."""
    dealt = stored(blocks.repartitionByRange("block").select("block", F.spark_partition_id().alias("part")), "ranges")
    ends = dealt.groupBy("part").agg(F.min("block").alias("first"))
    in_order = Window.orderBy("part")
    on = ends.select("part", F.coalesce(
        F.lead("first").over(in_order), F.min("first").over(Window.partitionBy(F.lit(0)))).alias("after"))
    return dealt.join(on, "part").select("block", F.coalesce(
        F.lead("block").over(Window.partitionBy("part").orderBy("block")), "after").alias("before"))


def with_next(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``id, text, kept, next, next_kept``: every row's text and sketch with those of the row with
    the next smaller id (the largest one's for the smallest). A row without an id has no next.

    Texts move once, to the block of their id. The first text of each block moves once more, to the
    block that comes before it in this order.
    """
    rows = docs.select(F.col(id).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    placed = rows.where(F.col("id").isNotNull()).withColumn("block", F.shiftright("id", BLOCK_BITS))
    moved = placed.repartition("block")
    first = moved.groupBy("block").agg(F.max_by("text", F.struct("id", "text")).alias("text"))
    handed = first.join(following(placed.select("block").distinct()), "block").select(
        F.col("before").alias("block"), F.struct("text", sketch(F.col("text")).alias("kept")).alias("handed"))
    down = Window.partitionBy("block").orderBy(F.col("id").desc(), F.col("own")["text"].desc())
    own = F.struct("text", sketch(F.col("text")).alias("kept"))
    found = moved.select("block", "id", own.alias("own")).withColumn("next", F.lead("own").over(down))
    found = found.join(handed, "block").select("id", "own", F.coalesce("next", "handed").alias("next"))
    alone = rows.where(F.col("id").isNull()).select("id", own.alias("own"), F.lit(None).cast(
        found.schema["next"].dataType).alias("next"))
    return found.unionByName(alone).select(
        "id", "own.*", F.col("next")["text"].alias("next"), F.col("next")["kept"].alias("next_kept"))


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``<id>, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next, in_edited``.

    ``edited`` is the text whose last half has been replaced by the start of the next document, in
    descending order of ids, the first one following the last; ``near_*`` are likenesses and
    ``in_edited`` the containment of the text in its edited form (null where the sketch is
    empty). ``n_chars`` counts code points.

    A null text is an empty one. Rows without an id are fingerprinted and have no next
    document: their ``edited`` and what follows from it are null. Rows of one id stand in the
    order of their texts, so of equal rows one follows the other. A single row follows itself. Other
    columns are not looked at; an empty table gives no rows.
    """
    half = F.shiftright("n_chars", 1)
    rows = with_next(docs, id, text).withColumn("n_chars", F.char_length("text")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars") - half), F.substring("next", F.lit(1), half)))
    found = rows.withColumn("edited_kept", F.when(F.col("edited").isNotNull(), sketch(F.col("edited"))))
    named = lambda kept, said: F.struct(
        F.col(kept).alias("kept"), as_string(F.col(kept), F.col(said)).alias("print"))
    compared = found.select(
        "id", "n_chars", "edited", named("kept", "text").alias("own"),
        named("edited_kept", "edited").alias("other"), named("next_kept", "next").alias("after"))
    known = F.col("edited").isNotNull()
    return compared.select(
        F.col("id").alias(id), F.col("n_chars").cast("long").alias("n_chars"), "edited",
        F.col("own")["print"].alias("fingerprint"), F.col("other")["print"].alias("edited_fingerprint"),
        F.when(known, likeness(F.col("own"), F.col("other"))).alias("near_edited"),
        F.when(known, likeness(F.col("own"), F.col("after"))).alias("near_next"),
        F.when(known, containment(F.col("own")["kept"], F.col("other")["kept"])).alias("in_edited"))
