"""Structured Streaming inference over a folder of JSON files."""

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rasmlens import schema
from rasmlens.functions import DEFAULT, TextProfile
from rasmlens.operators.clean import list_tokens, prepare, prepare_listed
from rasmlens.sources.models import load_classifier, load_features
from rasmlens.streaming.batches import ROW, read_batches, write_batches
from rasmlens.streaming.triggers import triggered


def write_feed(df: DataFrame, path: str, rows_per_file: int = 0, compression: str = "none") -> str:
    """Write all ``(text, label)`` rows as JSON files for the stream to pick up.

    Each partition becomes a file, or several of at most ``rows_per_file`` rows. A compressed file is
    read by one task, so it should hold few rows.
    """
    writer = df.select("text", "label").write.mode("append")
    writer.option("maxRecordsPerFile", rows_per_file).json(path, compression=compression)
    return path


def read_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int = 5,
    columns: T.StructType = schema.STREAM_IN,
) -> DataFrame:
    """Malformed lines come out as null rows, which preparation drops."""
    return (spark.readStream.schema(columns)
            .option("maxFilesPerTrigger", max_files_per_trigger).json(path))


def classify(
    rows: DataFrame,
    features: PipelineModel,
    model,
    profile: TextProfile = DEFAULT,
    f023: str = schema.F023,
    f046: str = schema.F046,
    stopwords: DataFrame | None = None,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Predictions for raw texts; the same call serves a batch and, without a table of
    ``stopwords``, a stream. ``f023`` and ``f046`` are the names that ``features`` was fitted with."""
    return _predicted(prepare(
        rows, profile, f023=f023, f046=f046, stopwords=stopwords, keys=keys), features, model)


def _predicted(prepared: DataFrame, features: PipelineModel, model) -> DataFrame:
    return model.transform(features.transform(prepared)).select("text", "label", "prediction")


def write_stream(
    rows: DataFrame, path: str, checkpoint: str, interval: str | None = "3 seconds", compression: str = "none"
) -> StreamingQuery:
    """Append JSON files exactly once. ``interval=None`` takes what is there, in
    micro-batches, and stops."""
    writer = (rows.writeStream.outputMode("append").format("json").option("compression", compression)
              .option("path", path).option("checkpointLocation", checkpoint))
    return triggered(writer, interval).start()


def write_console(rows: DataFrame, interval: str | None = "3 seconds") -> StreamingQuery:
    return triggered(rows.writeStream.outputMode("append").format("console"), interval).start()


def run_for(query: StreamingQuery, seconds: int) -> bool:
    """Let a query run for a while, then stop it; true if it ended by itself."""
    try:
        return query.awaitTermination(seconds)
    finally:
        query.stop()


def read_output(
    spark: SparkSession, path: str, columns: T.StructType = schema.STREAM_OUT
) -> DataFrame:
    """Read the sink's folder, not its files, so that its commit log decides which
    files count."""
    return spark.read.schema(columns).json(path)


def stream_accuracy(output: DataFrame) -> DataFrame:
    """One row: number of predictions and share of right ones (0.0 without any). A row
    without a label counts, and is not right."""
    hit = F.coalesce(F.col("label") == F.col("prediction"), F.lit(False))
    right = F.avg(hit.cast("double"))
    return output.agg(F.count("*").alias("n"), F.coalesce(right, F.lit(0.0)).alias("accuracy"))


def evaluate_output(spark: SparkSession, path: str) -> tuple[DataFrame | None, float]:
    """The written predictions and their accuracy; ``(None, 0.0)`` if there are none."""
    try:
        output = read_output(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None, 0.0
    return _evaluated(output)


def _evaluated(output: DataFrame) -> tuple[DataFrame | None, float]:
    row = stream_accuracy(output).first()
    return (output, row["accuracy"]) if row["n"] else (None, 0.0)


def run_stream(
    spark: SparkSession,
    feed: str,
    output: str,
    checkpoint: str,
    features_path: str,
    model_path: str,
    profile: TextProfile = DEFAULT,
    max_files_per_trigger: int = 5,
    interval: str | None = "3 seconds",
    seconds: int | None = None,
    f023: str = schema.F023,
    f046: str = schema.F046,
    stopwords: DataFrame | None = None,
    compression: str = "none",
) -> tuple[DataFrame | None, float]:
    """Load the saved models, classify the feed and evaluate what was written.

    Runs until the feed is used up (``interval=None``) or for ``seconds``. ``stopwords`` is a table
    of any size with the column ``word``, which takes the place of the profile's list; the output
    is then one folder per micro-batch (see ``read_batches``), which ``compression`` does not reach.
    """
    if interval is not None and seconds is None:
        raise ValueError("an endless trigger needs a time limit")
    rows = read_stream(spark, feed, max_files_per_trigger)
    features, model = load_features(features_path), load_classifier(spark, model_path)
    if stopwords is None:
        query = write_stream(
            classify(rows, features, model, profile, f023, f046), output, checkpoint, interval, compression)
    else:
        query = write_batches(
            list_tokens(rows, profile).drop(schema.CLEAN), output, checkpoint,
            lambda batch: _predicted(
                prepare_listed(batch, stopwords, (ROW,), profile, f023, f046), features, model), interval)
    if seconds is None:
        query.awaitTermination()
    else:
        run_for(query, seconds)
    if stopwords is not None:
        return _evaluated(read_batches(spark, output))
    return evaluate_output(spark, output)
