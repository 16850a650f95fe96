"""Sources and sinks, reshaping, exploration, terms and sampling."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasmlens import operators as ops
from rasmlens import schema, sources, workspace
from rasmlens.functions import type_token_ratio
from rasmlens.plans.datasets import (
    corpus, documents, labelled, prepared, prepared_labelled, table, wide_conversations, wide_documents)

MEASURES = {
    schema.F023: "f023", schema.F046: "f046", schema.N_TOKENS: "n_tokens", "label": "label"}


def melt_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = ops.melt(wide_conversations(spark, sf_dir), "conversations", keep=("conv_id",))
    return long.select("conv_id", F.md5("text").alias("text_md5"), "label", "model", "source")


def union_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = ops.union_all([
        ops.melt(wide_conversations(spark, sf_dir), "conversations"),
        ops.melt(wide_documents(spark, sf_dir), "documents")])
    return long.groupBy("source", "model", "label").agg(
        F.count("*").alias("n"), F.sum(F.length("text")).alias("n_chars"))


def ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    splits = sources.write_splits(
        {"train": wide_documents(spark, sf_dir).drop("doc_id"),
         "validation": wide_conversations(spark, sf_dir).drop("conv_id")},
        workspace.fresh_dir(spark, "raw"))
    return ops.ingest(spark, splits).select(
        F.md5("text").alias("text_md5"), "label", "model", "source")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace.fresh_dir(spark, "documents.csv")
    sources.write_csv(documents(spark, sf_dir).select("doc_id", "text"), path)
    back = sources.read_csv(spark, path, ["doc_id", "text"], missing=())
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace.fresh_dir(spark, "abstracts.parquet")
    sources.write_parquet(ops.clean(corpus(spark, sf_dir)), path)
    back = sources.read_parquet(spark, path)
    return back.select(
        F.md5("text").alias("text_md5"), schema.CLEAN,
        F.array_join(schema.TOKENS, " ").alias("tokens"), "n_tokens", "label", "model", "source")


def parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace.fresh_dir(spark, "by_label.parquet")
    sources.write_parquet_by(
        prepared_labelled(spark, sf_dir).select("doc_id", "n_tokens", "label"), path, "label")
    return sources.read_parquet(spark, path)


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.row_count(prepared(spark, sf_dir))


def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.label_counts(prepared_labelled(spark, sf_dir))


def class_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.class_composition(prepared_labelled(spark, sf_dir))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.token_counts(prepared(spark, sf_dir))


def top_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.top_tokens(prepared(spark, sf_dir), 20)


def _with_ttr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir).select(
        "doc_id", "label", type_token_ratio(F.col(schema.TOKENS)).alias("ttr"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "min", "max")})


def ttr_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labelled(_with_ttr(spark, sf_dir))
    return _rounded(ops.distribution_by_class(rows, "ttr"))


def _distribution(column: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = prepared_labelled(spark, sf_dir).withColumn(column, F.col(column).cast("double"))
        return _rounded(ops.distribution_by_class(rows, column))
    return run


def percentiles_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The violins' percentiles, for the length and both features."""
    rows = prepared_labelled(spark, sf_dir)
    names = {c: short for c, short in MEASURES.items() if c != "label"}
    return ops.union_all([
        ops.percentiles_by_class(rows, c).select(
            F.lit(short).alias("measure"), "label", "p", F.round("value", 6).alias("value"))
        for c, short in names.items()])


def _density(column: str, sampled: bool = False):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = prepared_labelled(spark, sf_dir)
        if sampled:
            rows = ops.hash_sample(rows, "doc_id", 0.5, seed=3)
        return ops.kernel_density(rows, column).select(
            "label", "i", F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))
    return run


def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared_labelled(spark, sf_dir).select(
        *[F.col(c).alias(short) for c, short in MEASURES.items()])
    return ops.correlation_matrix(rows, list(MEASURES.values())).withColumn("r", F.round("r", 6))


def term_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.term_idf(prepared(spark, sf_dir)).withColumn("idf", F.round("idf", 9))


def tfidf_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.tfidf(prepared(spark, sf_dir), "doc_id").select(
        "doc_id", "w", "tf", F.round("tfidf", 6).alias("tfidf"))


def stylo_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {c: short for c, short in MEASURES.items() if c != "label"}
    rows = prepared(spark, sf_dir).select(
        "doc_id", *[F.col(c).alias(short) for c, short in names.items()])
    scaled = ops.scale_by_deviation(rows, list(names.values()))
    return scaled.select("doc_id", *[
        F.round(f"{short}_scaled", 6).alias(f"{short}_scaled") for short in names.values()])


def sample_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.hash_sample(documents(spark, sf_dir), "doc_id", 0.5, seed=3).select("doc_id", "lang")


def sample_bernoulli(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark's own sample. It reads the table as it is, so that cores don't change the rows."""
    return ops.bernoulli_sample(table(spark, sf_dir, "documents"), 0.5, seed=3).select("doc_id", "lang")


def sample_bernoulli_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the table, rows drawn that it doesn't have or that were drawn twice, and whether
    the share drawn lies within six standard deviations of one half."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang")
    drawn = sample_bernoulli(spark, sf_dir).groupBy("doc_id", "lang").agg(F.count("*").alias("times"))
    both = rows.join(drawn, ["doc_id", "lang"], "full").agg(
        F.count("doc_id").alias("n"), F.count_if(F.col("times") > 1).alias("doubled"),
        F.count("times").alias("drawn"))
    n = rows.agg(F.count("*")).scalar()
    return both.select(
        n.alias("n"), (F.col("n") - n).alias("foreign"), "doubled",
        (F.abs(F.col("drawn") - n / 2) <= 3 * F.sqrt(n)).alias("about_half"))


def sample_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ops.sample_limit(documents(spark, sf_dir), 0.05, 20, seed=9, key="doc_id")
    return rows.select("doc_id", "lang")


def _split_counts(parts) -> DataFrame:
    names = ("train", "validation", "test")
    tagged = [p.select(F.lit(name).alias("split"), "doc_id", "label")
              for name, p in zip(names, parts)]
    return ops.union_all(tagged)


def hash_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ops.hash_split(prepared(spark, sf_dir), "doc_id")
    return _split_counts(parts).groupBy("split", "label").agg(F.count("*").alias("n"))


def random_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ops.random_split(prepared(spark, sf_dir).select("doc_id", "label"))
    return _split_counts(parts).groupBy("split").agg(F.count("*").alias("n"))


def random_split_two_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ops.random_split_two_stage(prepared(spark, sf_dir).select("doc_id", "label"))
    return _split_counts(parts).groupBy("split").agg(F.count("*").alias("n"))


def random_split_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In how many splits each row of the corpus landed (it must be one)."""
    parts = ops.random_split(prepared(spark, sf_dir).select("doc_id", "label"))
    return _split_counts(parts).groupBy("doc_id").agg(F.count("*").alias("splits"))


def random_split_two_stage_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In how many of the three splits each row landed (it must be one)."""
    parts = ops.random_split_two_stage(prepared(spark, sf_dir).select("doc_id", "label"))
    return _split_counts(parts).groupBy("doc_id").agg(F.count("*").alias("splits"))


def ingest_csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One split of three files: two with their columns in different orders, one without one of
    them."""
    path = workspace.fresh_dir(spark, "mixed")
    wide = wide_documents(spark, sf_dir).drop("doc_id")
    human, ai = wide.columns
    turns = wide_conversations(spark, sf_dir).select(human)
    for n, rows in enumerate((wide.select(human, ai), wide.select(ai, human), turns)):
        sources.write_csv(rows, f"{path}/{n}")
    return ops.ingest(spark, {"train": f"{path}/*"}).select(
        F.md5("text").alias("text_md5"), "label", "model", "source")


QUERIES = {
    "ingest_csv_mixed_headers": ingest_csv_mixed_headers,
    "random_split_two_stage_cover": random_split_two_stage_cover,
    "sample_bernoulli_subset": sample_bernoulli_subset,
    "melt_conversations": melt_conversations,
    "union_splits": union_splits,
    "ingest_csv": ingest_csv,
    "csv_roundtrip": csv_roundtrip,
    "parquet_roundtrip": parquet_roundtrip,
    "parquet_partitioned": parquet_partitioned,
    "row_count": row_count,
    "label_counts": label_counts,
    "class_composition": class_composition,
    "token_counts": token_counts,
    "top_tokens": top_tokens,
    "type_token_ratio": _with_ttr,
    "ttr_by_class": ttr_by_class,
    "token_distribution_by_class": _distribution(schema.N_TOKENS),
    "noun_distribution_by_class": _distribution(schema.F046),
    "percentiles_by_class": percentiles_by_class,
    "kde_tokens_by_class": _density(schema.N_TOKENS),
    "kde_tokens_sampled": _density(schema.N_TOKENS, sampled=True),
    "kde_f023_by_class": _density(schema.F023),
    "corr_matrix": corr_matrix,
    "term_idf": term_idf,
    "tfidf_exact": tfidf_exact,
    "stylo_scaled": stylo_scaled,
    "sample_hash": sample_hash,
    "sample_bernoulli": sample_bernoulli,
    "sample_limit": sample_limit,
    "hash_split_counts": hash_split_counts,
    "random_split_counts": random_split_counts,
    "random_split_two_stage": random_split_two_stage,
    "random_split_cover": random_split_cover,
}
