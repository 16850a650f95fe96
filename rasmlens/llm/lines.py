"""Line dedup by distinct-site spread.

A line that stands on many sites is boilerplate, however often one site repeats it. Each
line's sites are counted by a HyperLogLog sketch, merged by aggregation, so that a line on
every site costs one small sketch per task and no list of sites. Only lines whose
estimate is near the threshold are counted again exactly. One copy of each boilerplate
line, that of the smallest document id, stays in the corpus.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasmlens.llm.frames import digest, stored

#: Standard errors of the sketch within which an estimate is not relied on.
SURE_ERRORS = 4.0


def _content(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\x0b\x0c"))


def _lines(docs: DataFrame) -> DataFrame:
    """``id, t1, t2, site, h1, h2, pos`` for every line that is not blank."""
    cut = docs.select("id", "t1", "t2", "site", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    content = cut.select("id", "t1", "t2", "site", "pos", _content(F.col("line")).alias("line"))
    h1, h2 = digest(F.col("line"))
    return content.where(F.col("line") != "").select(
        "id", "t1", "t2", "site", "pos", h1.alias("h1"), h2.alias("h2"))


def shared_lines(lines: DataFrame, min_sites: int, lg_k: int) -> DataFrame:
    """``h1, h2, owner``: lines on at least ``min_sites`` sites, owner the smallest id."""
    error = SURE_ERRORS * 1.04 / math.sqrt(1 << lg_k)
    spread = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"),
        F.min("id").alias("owner"))
    likely = stored(spread.where(F.col("sites") >= math.floor(min_sites * (1 - error))), "spread")
    sure = likely.where(F.col("sites") > math.ceil(min_sites * (1 + error)))
    near = likely.where(F.col("sites") <= math.ceil(min_sites * (1 + error)))
    exact = (lines.select("h1", "h2", "site").join(near.select("h1", "h2"), ["h1", "h2"], "left_semi")
             .groupBy("h1", "h2", "site").agg(F.lit(1).alias("one"))
             .groupBy("h1", "h2").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites))
    return sure.select("h1", "h2", "owner").unionByName(
        near.join(exact.select("h1", "h2"), ["h1", "h2"], "left_semi").select("h1", "h2", "owner"))


def remove_shared_lines(
    docs: DataFrame, min_sites: int = 10, lg_k: int = 12,
    id: str = "doc_id", text: str = "text", site: str = "source",
    n_lines: str | None = None, n_removed: str | None = None,
) -> DataFrame:
    """``docs`` with all columns, its texts without boilerplate lines.

    A line is what stands between ``\\n``; lines are the same if they agree without the
    white space at both ends. Blank lines are always kept. A line on ``min_sites`` sites
    or more stays only in the rows that hold the smallest id it occurs with (in the rows
    without an id, if no other has it), with all its repeats there.
    ``n_lines`` and ``n_removed`` name columns to add with the number of lines and of
    removed ones. A null text stays null with 0 lines, an empty one is one blank line. Rows
    with a null site share one site. Equal rows get equal results, an empty table an
    empty one. Other columns are carried along, whatever their names.
    """
    t1, t2 = digest(F.col(text))
    narrow = docs.select(
        F.col(id).alias("id"), t1.alias("t1"), t2.alias("t2"), F.col(text).alias("text"),
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"))
    lines = _lines(narrow)
    shared = stored(shared_lines(lines, min_sites, lg_k), "sharedlines")
    found = (lines.join(shared, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("owner")))
             .groupBy("id", "t1", "t2").agg(F.sort_array(F.collect_set("pos")).alias("removed"))
             .select(F.struct("id", "t1", "t2").alias("_hit_key"), "removed"))
    # Rows of one id and text have one outcome, so these are the key, and rows need no number.
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.struct(F.col(id).alias("id"), t1.alias("t1"), t2.alias("t2")).alias("_row_key"),
        F.split(text, "\n").alias("lines"))
    joined = row.join(found, F.col("_row_key").eqNullSafe(F.col("_hit_key")), "left")
    edges = joined.select("row", "lines", "removed", F.inline(F.array(F.struct(
        F.concat(F.array(F.lit(-1)), F.col("removed"), F.array(F.size("lines"))).alias("edge")))))
    kept = F.flatten(F.transform(
        F.sequence(F.lit(0), F.size("edge") - 2),
        lambda i: F.slice("lines", F.get("edge", i) + 2, F.get("edge", i + 1) - F.get("edge", i) - 1)))
    new_text = F.when(F.col("removed").isNull(), F.col("row").getField(text)).otherwise(
        F.array_join(kept, "\n"))
    columns = [new_text.alias(c) if c == text else F.col("row").getField(c).alias(c)
               for c in docs.columns if c not in (n_lines, n_removed)]
    if n_lines:
        columns.append(F.greatest(F.size("lines"), F.lit(0)).cast("long").alias(n_lines))
    if n_removed:
        columns.append(F.coalesce(F.greatest(F.size("removed"), F.lit(0)), F.lit(0)).cast("long").alias(n_removed))
    return edges.select(*columns)
