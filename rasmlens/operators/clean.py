"""Preparation shared by batch and stream: clean, tokenise, filter, add features."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasmlens import schema
from rasmlens.functions import DEFAULT, TextProfile, avg_syllables, count_nouns
from rasmlens.functions import drop_stopwords, drop_stopwords_by_table
from rasmlens.functions.normalize import respell, tidy
from rasmlens.functions.tokens import split_spelled

#: Column of the text with its words respelled, while tokens are made.
_SPELLED = "_rasmlens_spelled"


def with_column_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters and projections do not recompute.

    Catalyst pushes a filter on a projected expression below the projection and so
    evaluates it twice. Filters on a generator's output stay above it, and a
    one-element ``inline`` returns exactly one row per input row.
    """
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def list_tokens(
    df: DataFrame, profile: TextProfile = DEFAULT, text: str = "text", drop: bool = False
) -> DataFrame:
    """Add the cleaned text and all its tokens, with ``drop`` without the profile's stop-words.

    The tokens come from the spelled text, so where the cleaned one is not read, the pass over what
    lies between words is left out. Rows stay where they are: this works on streams.
    """
    spelled = df.withColumn(_SPELLED, respell(F.col(text), profile))
    cleaned = spelled.withColumn(schema.CLEAN, tidy(F.col(_SPELLED)))
    words = split_spelled(F.col(_SPELLED), profile)
    words = drop_stopwords(words, profile) if drop else words
    return with_column_once(cleaned, schema.TOKENS, words).drop(_SPELLED)


def add_tokens(
    df: DataFrame,
    profile: TextProfile = DEFAULT,
    text: str = "text",
    stopwords: DataFrame | None = None,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Add the cleaned text, its tokens and their number.

    ``stopwords`` is a table of any size with the column ``word``, which then takes the
    place of the profile's list; ``keys`` must identify a row. It regroups rows, so a stream
    can use it inside ``foreachBatch`` only.
    """
    if stopwords is None:
        tokenized = list_tokens(df, profile, text, drop=True)
    else:
        tokenized = drop_stopwords_by_table(list_tokens(df, profile, text), stopwords, list(keys), schema.TOKENS)
    return tokenized.withColumn(schema.N_TOKENS, F.size(schema.TOKENS))


def clean(
    df: DataFrame,
    profile: TextProfile = DEFAULT,
    text: str = "text",
    stopwords: DataFrame | None = None,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """``add_tokens`` without the rows of fewer than ``profile.min_tokens`` tokens."""
    counted = add_tokens(df, profile, text, stopwords, keys)
    return counted.where(F.col(schema.N_TOKENS) >= profile.min_tokens)


def add_stylometrics(
    df: DataFrame,
    profile: TextProfile = DEFAULT,
    f023: str = schema.F023,
    f046: str = schema.F046,
) -> DataFrame:
    tokens = F.col(schema.TOKENS)
    return df.withColumns({f023: avg_syllables(tokens), f046: count_nouns(tokens, profile)})


def prepare(
    df: DataFrame,
    profile: TextProfile = DEFAULT,
    text: str = "text",
    f023: str = schema.F023,
    f046: str = schema.F046,
    stopwords: DataFrame | None = None,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Cleaned rows with both stylometric features; works on batch and stream alike."""
    return add_stylometrics(clean(df, profile, text, stopwords, keys), profile, f023, f046)


def prepare_listed(
    df: DataFrame,
    stopwords: DataFrame,
    keys: tuple[str, ...],
    profile: TextProfile = DEFAULT,
    f023: str = schema.F023,
    f046: str = schema.F046,
) -> DataFrame:
    """``prepare`` with a table of stop-words, for rows that ``list_tokens`` has been through.

    The table is matched with the words of a row and the row is joined with what was found, so rows
    are read twice: store them with their tokens, and the text rules run once.
    """
    left = drop_stopwords_by_table(df, stopwords, list(keys), schema.TOKENS)
    counted = left.withColumn(schema.N_TOKENS, F.size(schema.TOKENS))
    return add_stylometrics(counted.where(F.col(schema.N_TOKENS) >= profile.min_tokens), profile, f023, f046)
