"""A Merkle manifest of a table: one digest for all rows, one per group, and a proof per row.

Rows of a group stand in the order of their ids. A node's binary digits of its rank are
grouped away one after the other, lowest first, and each grouping nests the structs of the
two nodes below. That happens within blocks of ``2 ** BITS`` nodes, which hold everything
that a proof needs from their part of the tree, so no struct grows with the table. Only a
block's digest goes on to the next tier, whose nodes are the blocks. The way back down
makes no join either: what stands above a block comes to it as one more row of its group,
and nested transforms with one explode give each node its siblings.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasmlens.llm.frames import stored

#: Binary digits of a rank that one block groups away.
BITS = 8
#: The row in a partition stands in so many low bits of ``monotonically_increasing_id``.
ROW_BITS = 33
STEP = "struct<left: string, right: string>"


def framed(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon and the value as text."""
    said = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(said).cast("string"), F.lit(":"), said))


def digest(parts: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the parts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0, within ``group``, by ``order``) and ``total``, the group's
    size. Rows are dealt out by ranges of (group, order), so a group of any size is spread;
    each range's rows and where it starts are one small row per range and group."""
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = stored(dealt.withColumn("at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("at", ROW_BITS)
    runs = placed.groupBy(part.alias("part"), F.col(group).alias("of")).agg(
        F.min("at").alias("first"), F.count("*").alias("n"))
    of_group = Window.partitionBy("of")
    before = of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        "part", "of", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(of_group).alias("total"))
    return placed.join(starts, (part == F.col("part")) & (F.col(group) == F.col("of"))).select(
        *rows.columns, (F.col("at") + F.col("shift")).alias("rank"), "total")


def height(total: Column) -> Column:
    """Levels above so many leaves: a lone one has none."""
    return F.length(F.bin(total - 1)) * (total > 1).cast("int")


def blocks(nodes: DataFrame, base: int) -> DataFrame:
    """``grp, height, rank, node``: blocks of nodes ``grp, height, rank, hash, item``.

    ``rank`` counts the blocks of a group; ``node`` nests ``hash`` and ``kids`` ``BITS`` levels deep,
    down to ``hash`` and ``item``. ``base`` is the level of the given nodes. A group whose tree
    is lower than its block passes its last node up as it is.
    """
    digits = [f"d{i}" for i in range(BITS)]
    keys = ["grp", "height", "block"]
    # One shuffle: all further groupings have its keys among theirs.
    rolled = nodes.select(
        "grp", "height", F.shiftright("rank", BITS).alias("block"),
        *[F.shiftright("rank", i).bitwiseAND(1).alias(d) for i, d in enumerate(digits)],
        F.struct("hash", "item").alias("node")).repartition(*keys)
    for i, digit in enumerate(digits):
        rolled = rolled.groupBy(*keys, *digits[i + 1:]).agg(
            F.array_sort(F.collect_list(F.struct(digit, "node"))).alias("pair"))
        kids = F.transform("pair", lambda kid: kid["node"])
        first = F.element_at("pair", 1)["node"]["hash"]
        second = F.try_element_at("pair", F.lit(2))["node"]["hash"]
        joined = F.sha2(F.concat(first, F.coalesce(second, F.lit(""))), 256)
        rolled = rolled.select(*keys, *digits[i + 1:], F.struct(
            F.when(F.col("height") > base + i, joined).otherwise(first).alias("hash"),
            kids.alias("kids")).alias("node"))
    return rolled.withColumnRenamed("block", "rank")


def proofs(tier: DataFrame, above: DataFrame, base: int) -> DataFrame:
    """``grp, hash, item, path, from_above`` for the nodes of ``tier`` (made by ``blocks``).

    ``above`` has ``grp, rank, path, from_above`` for every block: the steps from the block's
    node to the root, and whatever else is handed down.
    """
    one = (tier.unionByName(above, allowMissingColumns=True).groupBy("grp", "rank").agg(*[
               F.first(c, ignorenulls=True).alias(c) for c in ("height", "node", "path", "from_above")]))

    def below(node: Column, path: Column, level: int) -> Column:
        if level == 0:
            return F.array(F.struct(
                node["hash"].alias("hash"), node["item"].alias("item"), path.alias("path")))
        kids = node["kids"]

        def child(kid: Column, at: Column) -> Column:
            step = F.struct(
                F.when(at == 1, F.element_at(kids, 1)["hash"]).alias("left"),
                F.when(at == 0, F.try_element_at(kids, F.lit(2))["hash"]).alias("right"))
            own = F.when(F.col("height") >= base + level, F.array(step)).otherwise(F.array().cast(f"array<{STEP}>"))
            return below(kid, F.concat(own, path), level - 1)

        return F.flatten(F.transform(kids, child))

    return one.select("grp", "from_above", F.explode(below(F.col("node"), F.col("path"), BITS)).alias("leaf")).select(
        "grp", "leaf.*", "from_above")


def trees(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The tiers of all groups' trees, lowest first, and ``grp, hash``: the top of each.

    ``leaves`` has ``grp, rank, total, hash, item``.
    """
    nodes = leaves.select("grp", height(F.col("total")).alias("height"), "rank", "hash", "item")
    tiers = [stored(blocks(nodes, 0), "blocks")]
    highest = tiers[0].agg(F.max("height")).first()[0] or 0
    for tier in range(1, max(1, math.ceil(highest / BITS))):
        below = tiers[-1].select(
            "grp", "height", "rank", F.col("node")["hash"].alias("hash"), F.struct("rank").alias("item"))
        tiers.append(stored(blocks(below, tier * BITS), "blocks"))
    return tiers, tiers[-1].select("grp", F.col("node")["hash"].alias("hash"))


def handed_down(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """``hash, item, path, from_above`` of the leaves. ``above`` has ``grp, path, from_above``."""
    found = above.withColumn("rank", F.lit(0).cast("long"))
    for tier in reversed(range(1, len(tiers))):
        found = stored(proofs(tiers[tier], found, tier * BITS).select(
            "grp", F.col("item")["rank"].alias("rank"), "path", "from_above"), "paths")
    return proofs(tiers[0], found, 0)


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    id: str = "doc_id",
    group: str = "lang",
    changed: tuple[Column, dict[str, Column]] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``<id>, leaf, subroot, root, path, proof_sha256, folded_root,
    verified``.

    A leaf is the digest of the framed ``fields``. Leaves of a group ascend by id, and two and
    two become the digest of their hex forms, a last one alone too, until one is left, the
    ``subroot``; subroots in the order of their groups give ``root`` likewise. ``path`` has the
    siblings left and right, lowest level first. ``changed`` is a condition and what it
    puts in the place of fields: ``folded_root`` starts from the leaf of the row so changed and goes
    up the path of the table as it was given.

    A null group comes first, as a group of its own; null ids come first within a group;
    rows of one id stand in the order of their leaves, so equal rows, which are leaves each for
    itself, may have each other's proofs. Null, empty and very long values are framed whole;
    other columns are not looked at; an empty table gives no rows. A group with most of the rows is
    dealt out by ranges of ids. The driver sees one number, the highest tree's height.
    """
    leaf = digest([framed(F.col(c)) for c in fields])
    condition, put = changed or (F.lit(False), {})
    other = digest([framed(put.get(c, F.col(c))) for c in fields])
    rows = stored(docs.select(
        # A sign in front keeps a null apart from an empty name, and before it.
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"),
        F.col(id).alias("id"), leaf.alias("hash"),
        F.when(condition, other).alias("changed"),
        F.monotonically_increasing_id().alias("row")), "leaves")
    leaves = ranked(rows, "grp", ["id", "hash", "row"])
    tiers, tops = trees(leaves.select(
        "grp", "rank", "total", "hash", F.struct("id", "changed").alias("item")))

    tops = tops.select(F.lit("").alias("grp"), "hash", F.col("grp").alias("name"))
    top_tiers, root = trees(ranked(tops, "grp", ["name"]).select(
        "grp", "rank", "total", "hash", F.struct("name").alias("item")))
    start = root.select(
        "grp", F.array().cast(f"array<{STEP}>").alias("path"), F.struct(F.col("hash").alias("root")).alias("from_above"))
    named = handed_down(top_tiers, start).select(
        F.col("item")["name"].alias("grp"), "path",
        F.struct(F.col("hash").alias("subroot"), F.col("from_above")["root"].alias("root")).alias("from_above"))

    both = lambda step, middle: [
        F.coalesce(step["left"], F.lit("")), middle, F.coalesce(step["right"], F.lit(""))]
    found = handed_down(tiers, named).select(
        F.col("item")["id"].alias(id), F.col("hash").alias("leaf"), "from_above.*", "path",
        F.sha2(F.array_join(F.transform("path", lambda s: F.concat(*both(s, F.lit("")))), ""), 256).alias("proof_sha256"),
        F.aggregate(
            "path", F.coalesce(F.col("item")["changed"], F.col("hash")),
            lambda middle, s: digest(both(s, middle))).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
