"""Mixing sources to target weights, by budgets that run down a tree.

A node's budget goes to its children in proportion to their weights. A child that cannot
use its share, even when all below it is read ``max_epochs`` times, gets what it can use,
and the rest goes to its siblings; only what no sibling can use stays with the ancestors,
whose own siblings took it up one level higher. A leaf reads whole epochs and then a prefix
of one more epoch, in an order seeded by epoch and document.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasmlens.llm.frames import WORD, stored

#: How many digits of the order keys are looked at, one step after the other.
KEY_DIGITS = (2, 4)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(seed: int, epoch: Column, id: Column) -> Column:
    """32 hex digits, the place of a document in its leaf's order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(id.cast("string"), F.lit(""))).cast("binary"))


def weight_of(weights: dict[tuple[str, ...], int], keys: list[str]) -> Column:
    """The weight of the node with this path, 1 where none is given."""
    chosen = F.lit(1)
    for path, weight in weights.items():
        if len(path) == len(keys):
            fits = F.lit(True)
            for key, value in zip(keys, path):
                fits = fits & F.col(key).eqNullSafe(F.lit(value))
            chosen = F.when(fits, F.lit(weight)).otherwise(chosen)
    return chosen.cast("long")


def share_out(nodes: DataFrame, parent: list[str], keys: list[str]) -> DataFrame:
    """``nodes`` (keys, capacity, weight, budget of the parent) with ``share``.

    In the order of capacity per weight, a child is filled up if all before it are and
    its level still fits into the budget; the others share what is left by weight.
    """
    ratio = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight"))
    by = Window.partitionBy(*parent)
    before = by.orderBy(F.asc_nulls_last("ratio"), *keys).rowsBetween(Window.unboundedPreceding, -1)
    ahead = by.orderBy(F.asc_nulls_last("ratio"), *keys).rowsBetween(0, Window.unboundedFollowing)
    ranked = nodes.withColumn("ratio", ratio).withColumns({
        "used": F.coalesce(F.sum("capacity").over(before), F.lit(0)),
        "weights": F.sum("weight").over(ahead)})
    full = ranked.withColumn("full", F.coalesce(
        F.col("used") + F.col("ratio") * F.col("weights") <= F.col("budget"), F.lit(False)))
    left = full.withColumns({
        "filled": F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(by),
        "open": F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(by)})
    rest = F.when(F.col("open") > 0, (F.col("budget") - F.col("filled")) / F.col("open")).otherwise(0.0)
    return left.withColumn("share", F.when(F.col("full"), F.col("capacity").cast("double"))
                           .otherwise(F.greatest(rest, F.lit(0.0)) * F.col("weight")))


def leaf_budgets(
    rows: DataFrame, levels: list[str], weights: dict[tuple[str, ...], int],
    budget_share: float, max_epochs: int,
) -> DataFrame:
    """Per leaf: levels, ``leaf_tokens`` and ``leaf_budget`` (whole tokens)."""
    leaves = stored(rows.groupBy(*levels).agg(F.sum("tokens").alias("leaf_tokens")), "leaves")
    above = leaves.agg(F.coalesce(F.sum("leaf_tokens"), F.lit(0)).alias("t")).select(
        F.least(F.floor(F.col("t") * budget_share), F.col("t") * max_epochs).cast("double").alias("budget"))
    for depth in range(1, len(levels) + 1):
        keys, parent = levels[:depth], levels[:depth - 1]
        nodes = leaves.groupBy(*keys).agg((F.sum("leaf_tokens") * max_epochs).alias("capacity"))
        match = F.lit(True)
        for p in parent:
            match = match & F.col(p).eqNullSafe(F.col(f"_{p}"))
        over = above.select(*[F.col(p).alias(f"_{p}") for p in parent], "budget")
        # The root has one row.
        nodes = nodes.join(over if parent else F.broadcast(over), match).drop(*[f"_{p}" for p in parent])
        shares = share_out(nodes.withColumn("weight", weight_of(weights, keys)), parent, keys)
        above = shares.select(*keys, F.col("share").alias("budget"))
    return above.join(leaves.select(*[F.col(c).alias(f"_{c}") for c in levels], "leaf_tokens"), _same(levels)
                      ).select(*levels, "leaf_tokens", F.floor("budget").cast("long").alias("leaf_budget"))


def _same(levels: list[str]) -> Column:
    condition = F.lit(True)
    for c in levels:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return condition


def cut_keys(rows: DataFrame, levels: list[str], budgets: DataFrame, seed: int) -> DataFrame:
    """Per leaf: ``epochs`` read whole, and ``cut``, the last order key of the prefix.

    The tokens of a leaf are summed by the first digits of the order keys, to find the
    digits at which the prefix ends; the next digits are looked at for those documents
    only. So 256 sums of a leaf are put in order at a time, and in the end the documents of
    one in 65,536 parts of the leaf.
    """
    leaves = stored(budgets.withColumn("epochs", F.when(
        F.col("leaf_tokens") > 0, F.floor(F.col("leaf_budget") / F.col("leaf_tokens"))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("leaf_budget") - F.col("epochs") * F.col("leaf_tokens")), "budgets")
    open_leaves = leaves.where("rest > 0").select(
        *[F.col(c).alias(f"_{c}") for c in levels], "epochs", "rest")
    keyed = rows.join(open_leaves, _same(levels)).select(
        *levels, "tokens", "rest", order_key(seed, F.col("epochs"), F.col("id")).alias("key"))

    inside, known = keyed.withColumn("before", F.lit(0).cast("long")), [*levels, "rest", "before"]
    by = Window.partitionBy(*levels)
    for digits in KEY_DIGITS:
        ahead = F.coalesce(F.sum("tokens").over(
            by.orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ends = (inside.groupBy(*known, F.substring("key", 1, digits).alias("digits"))
                .agg(F.sum("tokens").alias("tokens"))
                .withColumn("before", F.col("before") + ahead)
                .where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("tokens") >= F.col("rest")))
                .select(*[F.col(c).alias(f"_{c}") for c in levels], "digits", "before"))
        inside = keyed.join(stored(ends, "ends"), _same(levels) & (
            F.substring("key", 1, digits) == F.col("digits")))
    per_key = inside.groupBy(*known, "key").agg(F.sum("tokens").alias("tokens"))
    ahead = F.coalesce(F.sum("tokens").over(
        by.orderBy("key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = (per_key.withColumn("sum", F.col("before") + ahead)
            .where(F.col("sum") < F.col("rest")).groupBy(*levels).agg(F.max("key").alias("cut"))
            .select(*[F.col(c).alias(f"_{c}") for c in levels], "cut"))
    return stored(leaves.join(cuts, _same(levels), "left").select(
        *levels, "leaf_budget", "epochs", "cut"), "cuts")


def mix(
    docs: DataFrame, levels: dict[str, Column], weights: dict[tuple[str, ...], int],
    budget_share: float = 1.0, max_epochs: int = 4, seed: int = 17,
    id: str = "doc_id", tokens: Column | None = None, text: str = "text",
    copies: str = "copies", leaf_budget: str | None = None,
) -> DataFrame:
    """The chosen documents with all their columns and ``copies``, how often each is read.

    ``levels`` names the tree's levels from the root down and says how to compute them;
    ``weights`` gives whole-number weights by path, 1 for all others, 0 for none of a node.
    The budget is ``budget_share`` of all tokens (words, unless ``tokens`` says otherwise). The
    prefix of the last epoch ends with the document that reaches the leaf's budget; that
    document is read whole. Documents without tokens are read along with the others.
    A null in a level is a node like any other. Rows with equal ids, and rows without
    one, have one place in the order, and stand or fall together. An empty table gives
    no rows. A column called like ``copies`` or ``leaf_budget`` is replaced.
    """
    names = [f"level{i}" for i in range(len(levels))]
    keys = [c.cast("string").alias(n) for c, n in zip(levels.values(), names)]
    counted = tokens if tokens is not None else word_count(F.col(text))
    rows = stored(docs.select(F.col(id).alias("id"), *keys, counted.cast("long").alias("tokens")), "tokens")
    budgets = leaf_budgets(rows, names, weights, budget_share, max_epochs)
    cuts = cut_keys(rows, names, budgets, seed).select(
        *[F.col(c).alias(f"_{c}") for c in names], "leaf_budget", "epochs", "cut")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col(id).alias("id"), *keys)
    extra = F.col("cut").isNotNull() & (order_key(seed, F.col("epochs"), F.col("id")) <= F.col("cut"))
    read = whole.join(cuts, _same(names)).withColumn(
        "n", F.col("epochs") + F.when(extra, 1).otherwise(0)).where("n > 0")
    added = {copies: F.col("n")} | ({leaf_budget: F.col("leaf_budget")} if leaf_budget else {})
    return read.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in added],
                       *[value.alias(name) for name, value in added.items()])
