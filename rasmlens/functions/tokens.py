"""Tokenising cleaned text and removing stop-words."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasmlens.functions import lexicon as lex
from rasmlens.functions.normalize import tidy
from rasmlens.functions.profile import DEFAULT, TextProfile

# Letters, digits, underscore, diacritics, apostrophe. The first range, Arabic letters
# and diacritics, is there for speed: it decides most characters of an Arabic text.
_WORD = r"\u0620-\u0652\p{L}\p{N}_'"
_WORD_RUN = rf"[{_WORD}]{{2,}}"
_OTHER_RUN = rf"[^{_WORD} \t\r\f\x0B]{{2,}}"
# The word characters that cleaning keeps; it turns all others into blanks, which part words too.
_KEPT_RUN = r"[\u0620-\u0652A-Za-z0-9[\u0600-\u06FF&&[\p{L}\p{N}]]]{2,}"


def split_words(clean: Column, profile: TextProfile = DEFAULT) -> Column:
    """Runs of at least two word characters, in text order; null gives ``[]``."""
    if profile.punctuation_tokens:
        runs = F.regexp_extract_all(clean, F.lit(f"{_WORD_RUN}|{_OTHER_RUN}"), F.lit(0))
        runs = F.filter(runs, lambda w: F.btrim(w, F.lit(lex.WHITESPACE)) != "")
    else:
        runs = F.regexp_extract_all(clean, F.lit(_WORD_RUN), F.lit(0))
    return F.coalesce(runs, F.array().cast("array<string>"))


def split_spelled(spelled: Column, profile: TextProfile = DEFAULT) -> Column:
    """The tokens of a text after ``respell`` alone, which are those of the cleaned text: without
    runs of punctuation, they do not depend on how the characters between words are cleaned."""
    if profile.punctuation_tokens:
        return split_words(tidy(spelled), profile)
    runs = F.regexp_extract_all(spelled, F.lit(_KEPT_RUN), F.lit(0))
    return F.coalesce(runs, F.array().cast("array<string>"))


def drop_stopwords(tokens: Column, profile: TextProfile = DEFAULT) -> Column:
    words = profile.words(profile.stopwords)
    return F.filter(tokens, lambda w: ~w.isin(words)) if words else tokens


def tokenize(clean: Column, profile: TextProfile = DEFAULT) -> Column:
    return drop_stopwords(split_words(clean, profile), profile)


def drop_stopwords_by_table(
    df: DataFrame,
    stopwords: DataFrame,
    keys: list[str],
    tokens: str = "tokens",
    word: str = "word",
    salts: int = 16,
) -> DataFrame:
    """Stop-word removal against a table of any size; ``keys`` identify a row, without nulls.

    The distinct words of each row are matched with the list, and the few that are
    stop-words go back to their row, which filters its own tokens. Tokens are never
    moved by word, and rows left without any word keep ``[]``. Both sides are matched by
    (word, salt), so the rows of a very frequent word meet in ``salts`` tasks; Spark
    broadcasts a list that turns out to be small.
    """
    banned = stopwords.select(F.col(word).alias("_word")).where("_word is not null").distinct()
    copies = banned.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    words = df.select(
        *keys, F.pmod(F.xxhash64(*keys), F.lit(salts)).cast("int").alias("_salt"),
        F.explode(F.array_distinct(tokens)).alias("_word"))
    found = (words.join(copies, ["_word", "_salt"], "left_semi")
             .groupBy(*keys).agg(F.collect_list("_word").alias("_found")))
    kept = F.filter(tokens, lambda w: ~F.array_contains("_found", w))
    remaining = F.when(F.col("_found").isNull(), F.col(tokens)).otherwise(kept)
    # From a one-row generator, so that a filter on the tokens left does not evaluate them again below it.
    once = F.inline(F.array(F.struct(remaining.alias(tokens))))
    return df.join(found, keys, "left").select(*[once if c == tokens else F.col(c) for c in df.columns])
