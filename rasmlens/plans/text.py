"""Text rules over all documents."""

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasmlens import schema, workspace
from rasmlens.functions import DEFAULT, drop_stopwords_by_table, normalize, split_words
from rasmlens.functions import looks_like_noun, normalize_arabic, syllables, tokenize
from rasmlens.operators import (
    add_stylometrics, add_tokens, clean, count_by_vocabulary, prepare, prepare_listed, token_counts)
from rasmlens.plans.datasets import corpus, documents, labelled, once, tokenized

UNIFORM = replace(DEFAULT, hamza="hamza")
MAKSURA = replace(DEFAULT, fold_alef_maksura=True)
PUNCTUATION = replace(DEFAULT, punctuation_tokens=True)
RESPELLED = replace(DEFAULT, normalize_lexicon=True)
#: A noun counter from outside: tokens with the article.
ARTICLES = replace(DEFAULT, noun_counter=lambda tokens: F.size(F.filter(tokens, lambda w: w.startswith("ال"))))


def class_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepare(labelled(corpus(spark, sf_dir)))
    ttr = F.size(F.array_distinct(schema.TOKENS)) / F.col(schema.N_TOKENS)
    return rows.groupBy("label").agg(
        F.count("*").alias("n"),
        F.round(F.avg(schema.F023), 6).alias("avg_f023"),
        F.round(F.avg(schema.F046), 6).alias("avg_f046"),
        F.round(F.avg(schema.N_TOKENS), 6).alias("avg_n_tokens"),
        F.round(F.avg(ttr), 6).alias("avg_ttr"))


def _rule(rule):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return documents(spark, sf_dir).select("doc_id", rule(F.col("text")).alias("result"))
    return run


def _words(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def _tokens(make):
    """doc_id, joined tokens and their number for one way to tokenise."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cleaned = documents(spark, sf_dir).select(
            "doc_id", normalize_arabic(F.col("text")).alias("clean"))
        listed = cleaned.select("doc_id", make(F.col("clean")).alias("tokens"))
        return listed.select(
            "doc_id", _words(F.col("tokens")).alias("tokens"), F.size("tokens").alias("n_tokens"))
    return run


def stopword_filter_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    banned = spark.createDataFrame([(w,) for w in DEFAULT.stopwords], "word string")
    kept = drop_stopwords_by_table(tokenized(spark, sf_dir), banned, ["doc_id"])
    return kept.select(
        "doc_id", _words(F.col("tokens")).alias("tokens"), F.size("tokens").alias("n_tokens"))


def min_token_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(documents(spark, sf_dir)).select("doc_id", schema.N_TOKENS)


def _features(*columns: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = add_stylometrics(add_tokens(documents(spark, sf_dir)))
        names = {"f023": schema.F023, "f046": schema.F046, "n_tokens": schema.N_TOKENS}
        return rows.select("doc_id", *[F.col(names[c]).alias(c) for c in columns])
    return run


def noun_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_stylometrics(add_tokens(documents(spark, sf_dir)), ARTICLES)
    return rows.select("doc_id", F.col(schema.F046).alias("articles"))


def noun_hook_by_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``noun_hook`` by a tagger in Python, which sees every distinct word once."""
    def load():
        return lambda words: [w.startswith("ال") for w in words]

    rows = add_tokens(documents(spark, sf_dir)).select("doc_id", schema.TOKENS)
    return count_by_vocabulary(rows, load, "doc_id", "articles").select("doc_id", "articles")


def long_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct words of the list, as a stored table: Spark then knows how large it is before it plans
    the match, and does not move the words of all rows to meet a list that could be broadcast."""
    def write() -> str:
        path = workspace.fresh_dir(spark, "long_list")
        short = tokenized(spark, sf_dir).select(F.explode("tokens").alias("word")).where(F.length("word") == 3)
        listed = spark.createDataFrame([(w,) for w in DEFAULT.stopwords], "word string").unionByName(short)
        listed.distinct().write.parquet(path)
        return path

    return spark.read.parquet(once(spark, sf_dir, "long_list", write))


def prepare_stopword_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole preparation with a table of stop-words: the list itself, and every word of
    three letters that occurs."""
    rows = prepare_listed(tokenized(spark, sf_dir), long_list(spark, sf_dir), ("doc_id",))
    return rows.select("doc_id", schema.N_TOKENS, F.col(schema.F023).alias("f023"), F.col(schema.F046).alias("f046"))


def _vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(add_tokens(documents(spark, sf_dir)))


def word_syllables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vocabulary(spark, sf_dir).select(
        "w", F.col("count").alias("n"), syllables(F.col("w")).alias("syllables"))


def word_nouns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vocabulary(spark, sf_dir).select(
        "w", F.col("count").alias("n"), looks_like_noun(F.col("w")).cast("int").alias("noun"))


QUERIES = {
    "class_profile": class_profile,
    "strip_diacritics": _rule(normalize.strip_diacritics),
    "strip_tatweel": _rule(normalize.strip_tatweel),
    "fold_hamza": _rule(normalize.fold_hamza),
    "fold_alef": _rule(normalize.fold_alef),
    "split_ligatures": _rule(normalize.split_ligatures),
    "blank_other_characters": _rule(normalize.blank_other_characters),
    "collapse_blanks": _rule(normalize.collapse_blanks),
    "strip_ends": _rule(normalize.strip_ends),
    "normalize_text": _rule(normalize_arabic),
    "normalize_hamza_uniform": _rule(lambda text: normalize_arabic(text, UNIFORM)),
    "normalize_alef_maksura": _rule(lambda text: normalize_arabic(text, MAKSURA)),
    "tokenize": _tokens(split_words),
    "tokenize_punctuation": _tokens(lambda clean: split_words(clean, PUNCTUATION)),
    "stopword_filter_inset": _tokens(tokenize),
    "stopword_filter_respelled": _tokens(lambda clean: tokenize(clean, RESPELLED)),
    "stopword_filter_antijoin": stopword_filter_antijoin,
    "min_token_filter": min_token_filter,
    "noun_hook": noun_hook,
    "noun_hook_by_vocabulary": noun_hook_by_vocabulary,
    "prepare_stopword_table": prepare_stopword_table,
    "syllables_f023": _features("f023"),
    "nouns_f046": _features("f046"),
    "stylometrics": _features("f023", "f046", "n_tokens"),
    "word_syllables": word_syllables,
    "word_nouns": word_nouns,
}
