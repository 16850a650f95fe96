"""Word-level style features: syllables and noun-like words."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rasmlens.functions import lexicon as lex
from rasmlens.functions.profile import DEFAULT, TextProfile

_VOWEL_RUN = f"[{lex.ranges(lex.LONG_VOWELS + lex.SHORT_VOWELS)}]+"


def syllables(word: Column) -> Column:
    """Vowel clusters of one word: at least 1, but 0 for an empty or null word."""
    clusters = F.size(F.regexp_extract_all(word, F.lit(_VOWEL_RUN), F.lit(0)))
    return F.when(F.length(word) > 0, F.greatest(F.lit(1), clusters)).otherwise(F.lit(0))


def avg_syllables(tokens: Column) -> Column:
    """Feature f023; 0.0 where there are no words."""
    total = F.aggregate(tokens, F.lit(0).cast("long"), lambda acc, w: acc + syllables(w))
    return F.when(F.size(tokens) > 0, total / F.size(tokens)).otherwise(F.lit(0.0))


def looks_like_noun(word: Column, profile: TextProfile = DEFAULT) -> Column:
    """At least three letters, not a listed verb, and noun-like at either end or
    exactly three letters long."""
    length = F.length(word)
    shape = reduce(
        lambda a, b: a | b,
        [word.endswith(s) for s in profile.noun_suffixes],
        (length == 3) | word.startswith(lex.NOUN_PREFIX),
    )
    verdict = (length >= 3) & shape & ~word.isin(profile.words(profile.verbs))
    return F.coalesce(verdict, F.lit(False))


def count_nouns(tokens: Column, profile: TextProfile = DEFAULT) -> Column:
    """Feature f046; 0 where there are no words."""
    if profile.noun_counter is not None:
        return profile.noun_counter(tokens).cast("int")
    nouns = F.size(F.filter(tokens, lambda w: looks_like_noun(w, profile)))
    return F.when(F.size(tokens) > 0, nouns).otherwise(F.lit(0)).cast("int")


def type_token_ratio(tokens: Column) -> Column:
    """Distinct words over words; null where there are no words."""
    return F.when(F.size(tokens) > 0, F.size(F.array_distinct(tokens)) / F.size(tokens))
