"""Structured Streaming over the corpus; documents without a label have a null one."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rasmlens import schema, sources, streaming, workspace
from rasmlens.operators import list_tokens, prepare, prepare_listed
from rasmlens.plans.datasets import corpus, lab, labelled, once
from rasmlens.plans.text import long_list

#: Micro-batches in which a query takes a folder at most. Each costs some seconds whatever it holds, so
#: their number must not grow with the tables; folders of few files go by the least number of files.
MOST_BATCHES = 16

#: The text of every row is written as the feed and again as the answer; the answer is compressed. The feed
#: is not: whole files that cannot be split leave cores idle at the end of every batch.
CODEC = "lz4"

PREPARED_OUT = T.StructType([
    T.StructField("text_md5", T.StringType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("n_tokens", T.IntegerType()),
    T.StructField("f023", T.DoubleType()),
    T.StructField("f046", T.IntegerType()),
])


def _feed(spark: SparkSession, sf_dir: str) -> str:
    def write() -> str:
        path = workspace.fresh_dir(spark, "incoming")
        return streaming.write_feed(corpus(spark, sf_dir), path)
    return once(spark, sf_dir, "feed", write)


def _files_a_batch(spark: SparkSession, folder: str, least: int = 5) -> int:
    files = len(workspace.matching(spark, f"{folder}/*.json*"))
    return max(least, -(-files // MOST_BATCHES))


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _feed(spark, sf_dir)
    return streaming.read_stream(spark, feed, _files_a_batch(spark, feed))


def stream_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepare(_stream(spark, sf_dir)).select(
        F.md5("text").alias("text_md5"), "label", schema.N_TOKENS,
        F.col(schema.F023).alias("f023"), F.col(schema.F046).alias("f046"))
    output = workspace.fresh_dir(spark, "prepared_stream")
    query = streaming.write_stream(
        rows, output, workspace.fresh_dir(spark, "checkpoint"), interval=None)
    query.awaitTermination()
    return streaming.read_output(spark, output, PREPARED_OUT)


def stream_stopword_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preparation with a table of stop-words, of a stream: each micro-batch is tokenised on its way
    in, held with its tokens, and matched with the list."""
    banned = long_list(spark, sf_dir)

    def each(batch: DataFrame) -> DataFrame:
        rows = prepare_listed(batch, banned, (streaming.ROW,))
        return rows.select(
            "text_md5", "label", schema.N_TOKENS, F.col(schema.F023).alias("f023"), F.col(schema.F046).alias("f046"))

    output = workspace.fresh_dir(spark, "prepared_batches")
    query = streaming.write_batches(
        list_tokens(_stream(spark, sf_dir)).select(F.md5("text").alias("text_md5"), "label", schema.TOKENS),
        output, workspace.fresh_dir(spark, "checkpoint"), each, interval=None)
    query.awaitTermination()
    return streaming.read_batches(spark, output, PREPARED_OUT)


def stream_running_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accuracy that a stream over the predictions' folder keeps, after two runs."""
    predictions, folder = _predicted(spark, sf_dir, "NaiveBayes"), workspace.fresh_dir(spark, "tracked")
    for files in (_files_a_batch(spark, predictions, 2), 1000):
        query = streaming.track_accuracy(
            spark, predictions, f"{folder}/totals", f"{folder}/checkpoint", interval=None, max_files_per_trigger=files)
        query.awaitTermination()
    return streaming.running_accuracy(spark, f"{folder}/totals").withColumn("accuracy", F.round("accuracy", 6))


def _predicted(spark: SparkSession, sf_dir: str, name: str | None = None) -> str:
    """Folder of the predictions of one run with the saved named, or best, classifier."""
    def run() -> str:
        work = lab(spark, sf_dir)
        chosen = name or work.fit().best("f1")[0]
        model = work.fit(chosen).model(chosen)
        folder = workspace.fresh_dir(spark, "served")
        output = f"{folder}/predictions"
        feed = _feed(spark, sf_dir)
        streaming.run_stream(
            spark, feed, output, f"{folder}/checkpoint",
            sources.save_fitted(work.features, f"{folder}/prep_features"),
            sources.save_classifier(model, folder, chosen),
            max_files_per_trigger=_files_a_batch(spark, feed), interval=None, compression=CODEC)
        return output
    return once(spark, sf_dir, f"predicted by {name}", run)


def _predictions(name: str | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        output = streaming.read_output(spark, _predicted(spark, sf_dir, name))
        return output.select(F.md5("text").alias("text_md5"), "label", "prediction")
    return run


def _accuracy(name: str | None = None, unlabelled: bool = False):
    """Accuracy on the labelled rows, or on all of them, those without a label being wrong."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        output = streaming.read_output(spark, _predicted(spark, sf_dir, name))
        output = output if unlabelled else labelled(output)
        return streaming.stream_accuracy(output).withColumn("accuracy", F.round("accuracy", 6))
    return run


def stream_matches_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the stream, of a batch over the same feed, and rows they share."""
    work = lab(spark, sf_dir)
    _, model = work.fit().best("f1")
    feed = spark.read.schema(schema.STREAM_IN).json(_feed(spark, sf_dir))
    def counted(df: DataFrame, batch: int, stream: int) -> DataFrame:
        return df.select(F.md5("text").alias("text_md5"), "label", "prediction",
                         F.lit(batch).alias("in_batch"), F.lit(stream).alias("in_stream"))

    batch = counted(streaming.classify(feed, work.features, model), 1, 0)
    stream = counted(streaming.read_output(spark, _predicted(spark, sf_dir)), 0, 1)
    both = batch.unionByName(stream).groupBy("text_md5", "label", "prediction").agg(
        F.sum("in_batch").alias("in_batch"), F.sum("in_stream").alias("in_stream"))
    return both.agg(
        F.sum("in_stream").alias("n_stream"), F.sum("in_batch").alias("n_batch"),
        F.sum(F.least("in_stream", "in_batch")).alias("n_shared"))


def console_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a query to the console reported to have read."""
    feed = _stream(spark, sf_dir).select("label")
    query = streaming.write_console(feed, interval=None)
    query.awaitTermination()
    return spark.createDataFrame([(sum(p["numInputRows"] for p in query.recentProgress),)], "n long")


def timed_stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written by a query on a timed trigger that is stopped once all have come."""
    feed = _stream(spark, sf_dir)
    output = workspace.fresh_dir(spark, "timed")
    query = streaming.write_stream(
        feed.select("text", "label"), output, workspace.fresh_dir(spark, "checkpoint"), interval="1 second")
    query.processAllAvailable()
    streaming.run_for(query, 1)
    return streaming.read_output(spark, output, schema.STREAM_IN).groupBy("label").agg(F.count("*").alias("n"))


QUERIES = {
    "console_rows": console_rows,
    "timed_stream_rows": timed_stream_rows,
    "stream_accuracy_with_unlabelled": _accuracy("NaiveBayes", unlabelled=True),
    "stream_prepare": stream_prepare,
    "stream_stopword_table": stream_stopword_table,
    "stream_running_accuracy": stream_running_accuracy,
    "stream_naive_bayes": _predictions("NaiveBayes"),
    "stream_naive_bayes_accuracy": _accuracy("NaiveBayes"),
    "stream_predict": _predictions(),
    "stream_accuracy": _accuracy(),
    "stream_matches_batch": stream_matches_batch,
}
