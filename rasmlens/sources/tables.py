"""CSV and Parquet sources and sinks."""

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rasmlens import schema, workspace
from rasmlens.functions import DEFAULT, TextProfile, normalize_arabic
from rasmlens.functions.lexicon import WHITESPACE


# The cells that pandas' CSV reader takes as missing.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    missing: tuple[str, ...] = MISSING,
) -> DataFrame:
    """CSV with header, quoted fields that may span lines, and an optional BOM.

    Every column is a string, and cells in ``missing`` are null. Every file is read by its
    own header: files of one folder may have their columns in any order, and a column that
    a file lacks is null there. With ``columns``, a file with another header is an error.
    Headers are told apart by their first line. A multi-line file is read by one task, so
    large splits should be stored as many files.
    """
    reader = (spark.read.option("header", True).option("multiLine", True)
              .option("quote", '"').option("escape", '"').option("encoding", "UTF-8"))
    if columns:
        fields = [T.StructField(c, T.StringType(), True) for c in columns]
        cells = reader.schema(T.StructType(fields)).option("enforceSchema", False).csv(path)
    else:
        alike = _files_by_header(spark, path)
        parts = [reader.csv(files) for files in alike] if len(alike) > 1 else [reader.csv(path)]
        cells = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return cells.select(*[
        F.when(~F.col(f"`{c}`").isin(*missing), F.col(f"`{c}`")).alias(c) for c in cells.columns])


def _files_by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The files below a path, those with equal first lines together.

    The names come from Spark's own listing, and of each file only the first line is read: some
    kilobytes, several files at a time.
    """
    files = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(max_workers=16) as pool:
        headers = pool.map(lambda file: workspace.first_line(spark, unquote(file)), files)
        alike: dict[str, list[str]] = {}
        for file, header in zip(files, headers):
            alike.setdefault(header.removeprefix("\ufeff").rstrip("\r"), []).append(unquote(file))
    return [sorted(alike[header]) for header in sorted(alike)]


def read_words(spark: SparkSession, path: str, profile: TextProfile = DEFAULT) -> DataFrame:
    """A word list, one word a line, as the table ``word`` that ``prepare`` and ``run_stream`` take for
    stop-words. Blank lines and what follows a ``#`` are left out; with the profile's
    ``normalize_lexicon``, words get the spelling of cleaned text."""
    word = F.btrim(F.split(F.regexp_replace("value", "^\uFEFF", ""), "#")[0], F.lit(WHITESPACE))
    spelled = normalize_arabic(word, profile) if profile.normalize_lexicon else word
    return spark.read.text(path).select(spelled.alias("word")).where("word <> ''").distinct()


def write_csv(df: DataFrame, path: str) -> str:
    """Write unless a finished table is there already; returns the path.

    A folder without the writer's success mark was left by a write that failed, and is
    written again.
    """
    mode = "ignore" if workspace.exists(df.sparkSession, f"{path}/_SUCCESS") else "overwrite"
    (df.write.mode(mode).option("header", True)
       .option("quote", '"').option("escape", '"').option("quoteAll", True)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))
    return path


def write_splits(splits: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """One CSV per named split, existing ones left as they are."""
    return {name: write_csv(df, f"{folder}/arabic_abstracts_{name}.csv")
            for name, df in splits.items()}


def write_parquet(df: DataFrame, path: str, columns: tuple[str, ...] = schema.STORED_COLUMNS) -> str:
    df.select(*columns).write.mode("overwrite").parquet(path)
    return path


def write_parquet_by(df: DataFrame, path: str, column: str = "label") -> str:
    """One folder per value of ``column``, files of about the advisory size.

    A hash shuffle on a two-valued column would leave all work to two tasks. The
    rebalance hint lets adaptive execution cut the big values into many tasks.
    """
    df.hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out evenly where the input has fewer partitions than the cluster cores.

    Text rules cost far more time per byte than moving the raw text, so a few unsplittable
    files should not decide the parallelism. An input with enough partitions, as any
    large one, is returned as it is, without a shuffle. Meant for plain scans: asking
    a plan that shuffles for its partitions would run part of it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
