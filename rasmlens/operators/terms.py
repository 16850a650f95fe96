"""TF-IDF on the words themselves, and scaled columns, in DataFrame operations.

They compute what ``HashingTF`` + ``IDF`` and ``StandardScaler`` compute, without
hash collisions and in a form that plain SQL can check.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasmlens import schema, workspace
from rasmlens.operators.clean import with_column_once


def term_counts(df: DataFrame, key: str, tokens: str = schema.TOKENS) -> DataFrame:
    """Rows ``(key, w, tf)``, counted inside each row so that no token is shuffled.

    The sorted tokens of a row fall into runs; a run's length is the word's count.
    """
    ordered = with_column_once(
        df.where(F.size(tokens) > 0).select(key, F.col(tokens).alias("_t")),
        "_s", F.sort_array("_t"))
    starts = F.filter(
        F.sequence(F.lit(0), F.size("_s") - 1),
        lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1)))
    runs = with_column_once(ordered.select(key, "_s"), "_at", starts)
    following = F.coalesce(F.get("_at", F.col("_j") + 1), F.size("_s"))
    return (runs.select(key, "_s", "_at", F.posexplode("_at").alias("_j", "_i"))
            .select(key, F.get("_s", F.col("_i")).alias("w"),
                    (following - F.col("_i")).cast("long").alias("tf")))


def term_idf(df: DataFrame, tokens: str = schema.TOKENS) -> DataFrame:
    """Rows ``(w, doc_freq, idf)`` with idf = ln((documents + 1) / (doc_freq + 1))."""
    documents = df.agg(F.count("*")).scalar()
    return (df.select(F.explode(F.array_distinct(tokens)).alias("w"))
            .groupBy("w").agg(F.count("*").alias("doc_freq"))
            .withColumn("idf", F.log((documents + 1) / (F.col("doc_freq") + 1))))


def tfidf(df: DataFrame, key: str, tokens: str = schema.TOKENS) -> DataFrame:
    """Rows ``(key, w, tf, idf, tfidf)``.

    The pairs are counted once and stored; document frequencies come from the stored
    pairs. A word holds at most one pair per document; where a frequent one outgrows
    the other partitions, adaptive execution splits it.
    """
    path = workspace.fresh_dir(df.sparkSession, "pairs")
    term_counts(df, key, tokens).write.parquet(path)
    pairs = df.sparkSession.read.parquet(path)
    documents = df.agg(F.count("*")).scalar()
    terms = pairs.groupBy("w").agg(F.count("*").alias("doc_freq")).select(
        "w", F.log((documents + 1) / (F.col("doc_freq") + 1)).alias("idf"))
    return pairs.join(terms, "w").select(
        key, "w", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def scale_by_deviation(df: DataFrame, columns: list[str], suffix: str = "_scaled") -> DataFrame:
    """Divide by the sample standard deviation without centring; 0 where it is 0."""
    scaled = {}
    for column in columns:
        deviation = df.agg(F.stddev_samp(column)).scalar()
        scaled[column + suffix] = F.when(deviation > 0, F.col(column) / deviation).otherwise(0.0)
    return df.withColumns(scaled)
