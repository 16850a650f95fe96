"""Slow word taggers, run once per distinct word."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasmlens import schema, workspace
from rasmlens.operators.terms import term_counts

#: Loads what a tagger needs and returns the tagger: a list of words to a list of verdicts.
Loader = Callable[[], Callable[[list[str]], list[bool]]]


def tag_vocabulary(words: DataFrame, load: Loader, word: str = "word") -> DataFrame:
    """``word, verdict`` for the distinct words. The tagger is loaded once per task and gets words
    in Arrow batches; a null verdict counts as false."""
    vocabulary = words.select(F.col(word).alias("word")).where("word is not null").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = load()
        for batch in batches:
            verdicts = tagger(batch["word"].tolist())
            yield pd.DataFrame({"word": batch["word"], "verdict": [bool(v) for v in verdicts]})

    return vocabulary.mapInPandas(run, "word string, verdict boolean")


def count_by_vocabulary(
    df: DataFrame, load: Loader, key: str, name: str, tokens: str = schema.TOKENS, salts: int = 16,
) -> DataFrame:
    """``df`` with the column ``name``: how many of a row's tokens the tagger says yes to. ``key`` identifies a
    row, without nulls.

    Words are counted inside their row and stored as pairs, which the vocabulary and the
    counts both come from. The words with a yes are matched by (word, salt): the pairs of
    a very frequent word meet in ``salts`` tasks. Rows without such a word, or without any, have 0.
    """
    path = workspace.fresh_dir(df.sparkSession, "pairs")
    term_counts(df, key, tokens).write.parquet(path)
    pairs = df.sparkSession.read.parquet(path)
    said_yes = tag_vocabulary(pairs, load, "w").where("verdict").select(
        F.col("word").alias("w"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    salted = pairs.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(salts)).cast("int"))
    found = salted.join(said_yes, ["w", "_salt"]).groupBy(F.col(key).alias("_key")).agg(
        F.sum("tf").cast("int").alias("_found"))
    columns = [F.col(c) for c in df.columns if c != name]
    return df.join(found, F.col(key) == F.col("_key"), "left").select(
        *columns, F.coalesce("_found", F.lit(0)).alias(name))
